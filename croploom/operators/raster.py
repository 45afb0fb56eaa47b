"""Parcels as raster runs, and the year overlay on them.

A pixel row of a parcel is kept as one run ``[x0, x1)`` instead of single pixels: at two metres a
field is then some seventy rows rather than several thousand.  Pixel ``k`` covers ``[k*s, (k+1)*s)``
and belongs to a parcel when its centre does.  Runs are cut at block borders of ``BLOCK`` pixels, so
that ``(row, block)`` is a bounded unit of work however many parcels pile up there.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from croploom.functions import runs as N

BLOCK = 512
# Pixel rows of a tile: rows of a block that are worked on together.
BAND = 64
# Lists of packed runs: rows, first pixels, ends.
PACKED = ("_ys", "_x0s", "_x1s")


def _run_columns(runs: DataFrame) -> list[str]:
    return ["_band", "px", *PACKED] if "_ys" in runs.columns else ["py", "px", "x0", "x1"]


def _unpacked_schema(rows: DataFrame) -> T.StructType:
    """That of tiles' rows once their runs are unpacked."""
    kept = [f for f in rows.schema.fields if f.name not in (*PACKED, "py", "x0", "x1")]
    return T.StructType([*kept, *[T.StructField(c, T.IntegerType()) for c in ("py", "x0", "x1")]])


def _first_pixel(v: Column, scale: float) -> Column:
    """First pixel whose centre is not below ``v``."""
    return F.ceil((v - scale / 2) / scale).cast("bigint")


def _cut_at_blocks(df: DataFrame) -> DataFrame:
    """Runs ``x0, x1`` split at block borders, with the block number ``px``."""
    return (
        df.where(F.col("x0") < F.col("x1"))
        .withColumn("px", F.explode(F.sequence(F.floor(F.col("x0") / BLOCK), F.floor((F.col("x1") - 1) / BLOCK))))
        .withColumns(
            {
                "x0": F.greatest(F.col("x0"), F.col("px") * BLOCK).cast("int"),
                "x1": F.least(F.col("x1"), (F.col("px") + 1) * BLOCK).cast("int"),
                "py": F.col("py").cast("int"),
                "px": F.col("px").cast("int"),
            }
        )
    )


def rasterise(
    pc: DataFrame,
    scale: float,
    geom: str | None = "geom",
    by: Iterable[str] = ("nuts",),
    value: str = "cropfield",
    extra: Iterable[str] = (),
    merged: bool = False,
    packed: str | None = None,
) -> DataFrame:
    """Runs ``(by..., year, cf, extra..., py, px, x0, x1)`` of every parcel; nothing is shuffled.

    ``geom=None`` means the rows are rectangles given by ``xmin, ymin, xmax, ymax``.  With ``merged``
    equal runs of polygons of one batch are left to the highest id, as ``burn`` does; so parcels that
    pile up are not moved one by one.

    ``packed="tiles"`` gives polygons' runs packed by tile, one row for all runs of a parcel in a tile, as
    ``burn``, ``overlay`` and ``rare_values_of`` take them as well; with ``packed="halo"`` tiles have the
    pixels next to them too.
    """
    extra = list(extra)
    keys = [*by, "year"]
    if geom is None:
        rows = pc.select(
            *keys,
            F.col(value).alias("cf"),
            *extra,
            _first_pixel(F.col("xmin"), scale).alias("x0"),
            _first_pixel(F.col("xmax"), scale).alias("x1"),
            _first_pixel(F.col("ymin"), scale).alias("_r0"),
            (_first_pixel(F.col("ymax"), scale) - 1).alias("_r1"),
        ).where((F.col("_r0") <= F.col("_r1")) & (F.col("x0") < F.col("x1")))
        runs = rows.withColumn("py", F.explode(F.sequence("_r0", "_r1")))
        return _cut_at_blocks(runs).select(*keys, "cf", *extra, "py", "px", "x0", "x1")

    rows = pc.select(*keys, F.col(value).alias("cf"), *extra, F.col(geom).alias("_g"))
    if packed:
        lists = [T.StructField(c, T.ArrayType(T.IntegerType())) for c in PACKED]
        schema = T.StructType([*rows.schema.fields[:-1], *[T.StructField(c, T.IntegerType()) for c in ("_band", "px")], *lists])
    else:
        schema = T.StructType([*rows.schema.fields[:-1], *[T.StructField(c, T.IntegerType()) for c in ("py", "px", "x0", "x1")]])
    names = schema.names

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = pa.Table.from_batches([b])
            edges, owner = N.edges(t["_g"].combine_chunks())
            for who, *run in N.scan(edges, owner, scale, BLOCK):
                out = t.drop_columns("_g").take(pa.array(who))
                for name, v in zip(("py", "px", "x0", "x1"), run):
                    out = out.append_column(name, pa.array(v.astype(np.int32)))
                out = out.append_column("_who", pa.array(who)) if packed else out
                if merged:
                    out = N.merge_equal(out, keys)
                if packed:
                    out = N.packed(out, "_who", BAND, BLOCK, packed == "halo")
                yield from out.select(names).to_batches(max_chunksize=50_000)

    return rows.mapInArrow(scanned, schema)


def _by_tiles(runs: DataFrame, by: list[str], halo: bool = False) -> DataFrame:
    """Runs sorted by tile, ``BAND`` rows of a block, whose rows all are in one task.

    With ``halo`` a tile also has the pixels next to it.  Packed runs have their tiles already.
    """
    if "_ys" in runs.columns:
        tiled = runs
    elif not halo:
        tiled = runs.withColumn("_band", F.floor(F.col("py") / BAND).cast("int"))
    else:
        first, last = (F.floor((F.col("py") + d) / BAND).cast("int") for d in (-1, 1))
        part = lambda p, a, b: F.struct(p.alias("px"), a.alias("x0"), b.alias("x1"))
        px, x0, x1 = (F.col(c) for c in ("px", "x0", "x1"))
        parts = F.array_compact(
            F.array(part(px, x0, x1), F.when(x0 == px * BLOCK, part(px - 1, x0, x0 + 1)), F.when(x1 == (px + 1) * BLOCK, part(px + 1, x1 - 1, x1)))
        )
        tiled = (
            runs.withColumn("_p", F.explode(parts))
            .withColumns({c: F.col(f"_p.{c}") for c in ("px", "x0", "x1")})
            .drop("_p")
            .withColumn("_band", F.explode(F.sequence(first, last)))
        )
    tile = [*by, "_band", "px"]
    # As many tasks as the session has partitions: small rows, much work.
    n = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return tiled.repartition(n, *tile).sortWithinPartitions(*tile)


def burn(runs: DataFrame, by: Iterable[str] = ("nuts",)) -> DataFrame:
    """One parcel per pixel and year: where several overlap, the highest id wins.

    All runs of a ``(row, block)`` are cut at each other's ends, over all years at once, so that the
    pieces of different years line up.  Runs move once, to their tile's task, which works on many tiles
    at a time; a tile never holds more than its pixels, no matter how many parcels lie on it.
    """
    by = list(by)
    rows = _by_tiles(runs.select(*by, "year", F.col("cf").cast("bigint").alias("cf"), *_run_columns(runs)), by)
    schema, tile = _unpacked_schema(rows), [*by, "_band", "px"]

    def burned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = lambda t: N.burn_table(t, tile).select(schema.names)
        return N.by_tile(N.unpacked(batches), tile, work, work)

    return rows.mapInArrow(burned, schema).select(*by, "py", "px", "year", "x0", "x1", "cf")


def rare_values_of(runs: DataFrame, min_pixels: int = 10, by: Iterable[str] = ("nuts",)) -> DataFrame:
    """``rare_values(burn(runs))``, of which only the pixels of each id in some tiles at a time leave a task."""
    by = list(by)
    rows = _by_tiles(runs.select(*by, "year", F.col("cf").cast("bigint").alias("cf"), *_run_columns(runs)), by)
    tile, keys = [*by, "_band", "px"], [*by, "year", "cf"]
    schema = T.StructType([*(rows.schema[c] for c in keys), T.StructField("n", T.LongType())])

    def counted(t: pa.Table) -> pa.Table:
        t = N.burn_table(t, tile)
        n = pa.array(N.numbers(t, "x1") - N.numbers(t, "x0"))
        return t.select(keys).append_column("n", n).group_by(keys).aggregate([("n", "sum")]).rename_columns([*keys, "n"])

    def support(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return N.by_tile(N.unpacked(batches), tile, counted, lambda t: N.burn_table(t, tile))

    return rows.mapInArrow(support, schema).groupBy(*keys).agg(F.sum("n").alias("n")).where(F.col("n") < min_pixels).drop("n")


def pixel_support(burned: DataFrame, by: Iterable[str] = ("nuts",)) -> DataFrame:
    """Pixels per parcel and year."""
    return burned.groupBy(*by, "year", "cf").agg(F.sum(F.col("x1") - F.col("x0")).alias("n"))


def rare_values(burned: DataFrame, min_pixels: int = 10, by: Iterable[str] = ("nuts",)) -> DataFrame:
    return pixel_support(burned, by).where(F.col("n") < min_pixels).drop("n")


def min_support(burned: DataFrame, min_pixels: int = 10, by: Iterable[str] = ("nuts",)) -> DataFrame:
    """Without the runs of parcels that cover fewer pixels than the minimum in their year.

    A run as long as the minimum proves its parcel large enough and skips the join, so a parcel with
    very many pixels does not weigh on one task.  ``burned`` is read several times and should be a
    stored table.
    """
    by = list(by)
    length = F.col("x1") - F.col("x0")
    rare = rare_values(burned, min_pixels, by)
    short = burned.where(length < min_pixels).join(rare, [*by, "year", "cf"], "left_anti")
    return burned.where(length >= min_pixels).unionByName(short.select(*burned.columns))


def combine_years(burned: DataFrame, years: Iterable[int], by: Iterable[str] = ("nuts",)) -> DataFrame:
    """The years of every piece side by side as ``cf<year>``; 0 = no parcel that year.

    The pieces of ``burn`` already line up, so this is a single grouping.
    """
    return (
        burned.where(F.col("year").isin(list(years)))
        .groupBy(*by, "py", "px", "x0", "x1")
        .agg(
            *[
                F.coalesce(F.max(F.when(F.col("year") == y, F.col("cf"))), F.lit(0)).alias(f"cf{y}")
                for y in years
            ]
        )
    )


def overlay(runs: DataFrame, years: Iterable[int], by: Iterable[str] = ("nuts",), inset: bool = False) -> DataFrame:
    """``combine_years(burn(runs))`` in one shuffle, with touching pieces of the same ids joined.

    Ids of runs marked ``weak`` become 0 once they have won their pixels.  With ``inset`` only pixels
    whose eight neighbours carry the same ids are left, and rows without ``py`` tell in ``n`` how many
    pixels each combination of ids had before in one tile; packed runs must have been packed with
    ``halo`` then, and without it otherwise.
    """
    years, by = list(years), list(by)
    marks = [c for c in ("weak",) if c in runs.columns]
    rows = runs.where(F.col("year").isin(years)).select(*by, "year", F.col("cf").cast("bigint").alias("cf"), *marks, *_run_columns(runs))
    rows, tile = _by_tiles(rows, by, inset), [*by, "_band", "px"]

    def combined(t: pa.Table) -> pa.Table:
        p = N.Pieces(t, tile, years)
        cf = np.where(p.cf > N.LEAST, p.cf, 0)
        if p.weak is not None:
            cf[p.weak] = 0
        return _labelled(t, p.row, p.tile, p.py, p.x0, p.x1, cf, years, by, inset)

    def burned(t: pa.Table) -> pa.Table:
        return N.burn_table(t, tile)

    return rows.mapInArrow(lambda batches: N.by_tile(N.unpacked(batches), tile, combined, burned), _label_schema(rows, years, by, inset))


def overlay_marked(runs: DataFrame, years: Iterable[int], by: Iterable[str] = ("nuts",)) -> DataFrame:
    """``overlay`` with all ids kept: one row for each combination of ids in a tile, its runs packed.

    Bit ``i`` of ``_weak`` tells that the id of the i-th year was marked ``weak``; ``_n`` are the pixels.
    """
    years, by = list(years), list(by)
    cf = [f"cf{y}" for y in years]
    rows = runs.where(F.col("year").isin(years)).select(*by, "year", F.col("cf").cast("bigint").alias("cf"), "weak", *_run_columns(runs))
    rows, tile = _by_tiles(rows, by), [*by, "_band", "px"]
    lists = [T.StructField(c, T.ArrayType(T.IntegerType())) for c in PACKED]
    schema = T.StructType([*(rows.schema[c] for c in by), *[T.StructField(c, T.LongType()) for c in (*cf, "_weak", "_n")], *lists])

    def combined(t: pa.Table) -> pa.Table:
        p = N.Pieces(t, tile, years)
        ids = np.where(p.cf > N.LEAST, p.cf, 0)
        weak = (p.weak * (1 << np.arange(len(years)))).sum(axis=1)
        # Bits follow from the ids, so that they part no combination.
        out = _labelled(t, p.row, p.tile, p.py, p.x0, p.x1, np.column_stack([ids, weak]), [*years, "_weak"], by, False)
        out = out.append_column("_who", pa.array(N.codes(out, [*by, *cf])))
        out = N.packed(out, "_who", BAND, BLOCK, False)
        ends = out["_x1s"].combine_chunks()
        width = ends.flatten().to_numpy() - out["_x0s"].combine_chunks().flatten().to_numpy()
        n = np.add.reduceat(width, np.cumsum(ends.value_lengths().to_numpy()) - ends.value_lengths().to_numpy()) if len(ends) else width
        return out.append_column("_n", pa.array(n.astype(np.int64))).rename_columns({"cf_weak": "_weak"}).select(schema.names)

    def burned(t: pa.Table) -> pa.Table:
        return N.burn_table(t, tile)

    return rows.mapInArrow(lambda batches: N.by_tile(N.unpacked(batches), tile, combined, burned), schema)


def erode(combined: DataFrame, years: Iterable[int], by: Iterable[str] = ("nuts",)) -> DataFrame:
    """Only pixels whose eight neighbours carry the same ids in all years.

    Tiles also hold the pixels next to them, so one shuffle serves all steps: join touching runs, take
    a pixel off both ends, and keep what three rows in turn share.
    """
    years, by = list(years), list(by)
    cf = [f"cf{y}" for y in years]
    rows = _cut_at_blocks(combined.select(*by, "py", "x0", "x1", *[F.col(c).cast("bigint").alias(c) for c in cf]))
    rows, tile = _by_tiles(rows, by, halo=True), [*by, "_band", "px"]

    def taken_in(t: pa.Table) -> pa.Table:
        py, x0, x1 = (N.numbers(t, c) for c in ("py", "x0", "x1"))
        code = N.codes(t, tile)
        order = np.lexsort((x0, py, code))
        ids = np.column_stack([N.numbers(t, c) for c in cf])[order]
        return _labelled(t, order, code[order], py[order], x0[order], x1[order], ids, years, by, True)

    out = rows.mapInArrow(lambda batches: N.by_tile(batches, tile, taken_in, None), _label_schema(rows, years, by, True))
    return out.where(F.col("n").isNull()).select(*by, *cf, "py", "x0", "x1")


def _label_schema(rows: DataFrame, years: list[int], by: list[str], inset: bool) -> T.StructType:
    fields = [rows.schema[c] for c in by]
    fields += [T.StructField(c, T.IntegerType()) for c in ("py", "px", "x0", "x1")]
    fields += [T.StructField(f"cf{y}", T.LongType()) for y in years]
    return T.StructType([*fields, T.StructField("n", T.LongType())] if inset else fields)


def _labelled(t: pa.Table, row, tile, py, x0, x1, cf, years: list[int], by: list[str], inset: bool) -> pa.Table:
    """Joined runs of pieces, in order of tile, row and place; with ``inset`` what is left of them, and
    each combination's pixels within its tile."""
    label = N.label_numbers(tile, cf)
    first, end = N.runs_of_labels(tile, py, x0, x1, label)
    row, label, cf, py, x0 = row[first], label[first], cf[first], py[first], x0[first]
    keys = t.select([*by, "px"])

    def frame(k, columns: dict, n=None) -> pa.Table:
        out = keys.take(pa.array(row[k]))
        out = {c: out[c] for c in by} | {"py": columns["py"], "px": out["px"], "x0": columns["x0"], "x1": columns["x1"]}
        out |= {f"cf{y}": cf[k, i] for i, y in enumerate(years)}
        if inset:
            out["n"] = pa.nulls(len(k), pa.int64()) if n is None else n
        return pa.table({c: v if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array(v.astype(np.int32 if c in ("py", "px", "x0", "x1") else np.int64)) for c, v in out.items()})

    if not inset:
        return frame(np.arange(len(first)), {"py": py, "x0": x0, "x1": end})
    k, y, a, b = N.taken_in(py, x0, end, label)
    left = frame(k, {"py": y, "x0": a, "x1": b})
    band, px = N.numbers(t, "_band")[row], N.numbers(t, "px")[row]
    n = np.minimum(end, (px + 1) * BLOCK) - np.maximum(x0, px * BLOCK)
    n = np.where(py // BAND == band, np.maximum(n, 0), 0)
    one = np.unique(label, return_index=True, return_inverse=True)
    total = np.bincount(one[2], weights=n, minlength=len(one[0])).astype(np.int64)
    some = np.flatnonzero(total)
    none = pa.nulls(len(some), pa.int32())
    return pa.concat_tables([left, frame(one[1][some], {"py": none, "x0": none, "x1": none}, total[some])])


def pixels(runs: DataFrame) -> DataFrame:
    """One row per pixel, for small areas and checks."""
    keep = [c for c in runs.columns if c not in ("px", "x0", "x1")]
    return runs.select(*keep, F.explode(F.sequence(F.col("x0"), F.col("x1") - 1)).alias("px"))
