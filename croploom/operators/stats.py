"""Aggregated reports over parcel layers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from croploom.functions import geometry as G
from croploom.operators.joins import lookup
from croploom.session import materialise


def area_stats(pc: DataFrame) -> DataFrame:
    """Hectares by region, year, crop and usage; missing codes form groups of their own."""
    return pc.groupBy("nuts", "year", "hcat4_code", "usage_code").agg(
        F.sum(F.col("area_ha").cast("double")).alias("area_ha")
    )


def named_stats(stats: DataFrame, hierarchy: DataFrame, usage: DataFrame) -> DataFrame:
    """Statistics with crop and usage names looked up."""
    return lookup(lookup(stats, hierarchy, "hcat4_code", "hcat4_name"), usage, "usage_code", "usage_name")


def count_by(df: DataFrame, keys: Iterable[str] = ("nuts", "year"), name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def id_bounds(df: DataFrame, keys: Iterable[str] = ("nuts", "year"), col: str = "cropfield") -> DataFrame:
    return df.groupBy(*keys).agg(F.min(col).alias("lowest"), F.max(col).alias("highest"))


def reconcile(src: DataFrame, dst: DataFrame, key: str, present: DataFrame | None = None) -> DataFrame:
    """Rows in the source and rows loaded, per layer, with their ratio, what is missing and a status.

    Status: ``complete``, ``partial``, ``missing`` (nothing was loaded; null count and ratio), or
    ``present`` for layers named in ``present``, which an earlier run has loaded.  Where ``present`` has
    their rows as ``n_present``, these are compared too, and a layer whose rows are not as many as in the
    source is ``present partial``.
    """
    a = src.groupBy(key).agg(F.count(F.lit(1)).alias("n_original"))
    b = dst.groupBy(key).agg(F.count(F.lit(1)).alias("n_final"))
    out = a.join(b, key, "full")
    if present is not None:
        n = F.max("n_present") if "n_present" in present.columns else F.lit(None).cast("bigint")
        out = out.join(present.groupBy(key).agg(n.alias("_n"), F.max(F.lit(True)).alias("_present")), key, "left")
        out = out.withColumn("n_final", F.coalesce("n_final", "_n"))
    out = out.withColumns(
        {"ratio": F.col("n_final") / F.col("n_original"), "n_missing": F.col("n_original") - F.coalesce("n_final", F.lit(0))}
    )
    status = F.when(F.col("n_final").isNull(), "missing").when(F.col("n_missing") == 0, "complete").otherwise("partial")
    if present is None:
        return out.withColumn("status", status)
    was = F.when((F.col("n_missing") != 0) & F.col("n_final").isNotNull(), "present partial").otherwise("present")
    return out.withColumn("status", F.when(F.col("_present"), was).otherwise(status)).drop("_present", "_n")


def layer_extent(pc: DataFrame, keys: Iterable[str] = ("year",)) -> DataFrame:
    """Outer limits per year and, in the row with null key, over all of them."""
    keys = list(keys)
    limits = [
        F.min("xmin").alias("xmin"),
        F.min("ymin").alias("ymin"),
        F.max("xmax").alias("xmax"),
        F.max("ymax").alias("ymax"),
    ]
    per = pc.groupBy(*keys).agg(*limits)
    total = per.agg(*limits).withColumns({k: F.lit(None).cast(pc.schema[k].dataType) for k in keys})
    return per.unionByName(total)


def snapped_extent(extent: DataFrame, step: int) -> DataFrame:
    """Limits snapped outward to whole steps, the upper ones by one step more."""
    return extent.withColumns(
        {
            "xmin": (F.col("xmin") / step).cast("bigint") * step,
            "ymin": (F.col("ymin") / step).cast("bigint") * step,
            "xmax": F.ceil(F.col("xmax") / step) * step + step,
            "ymax": F.ceil(F.col("ymax") / step) * step + step,
        }
    )


def thin_points(df: DataFrame, size: int = 1000, x: str = "cx", y: str = "cy", by: Iterable[str] = ()) -> DataFrame:
    """Distinct points after rounding to a coarse raster, separately for each ``by`` group."""
    return df.select(
        *by, (F.rint(F.rint(x) / size) * size).alias("x"), (F.rint(F.rint(y) / size) * size).alias("y")
    ).distinct()


def median_by(
    df: DataFrame, by: Iterable[str], col: str, name: str = "median", weight: str | None = None
) -> DataFrame:
    """Exact median of a whole-number column per group, for groups of any size.

    With ``weight`` a row stands for that many equal rows.

    Values are counted first, which spreads even one dominant group over all tasks.  Their high
    part then tells in which slice of 65,536 values the middle lies, and only that slice of each
    group is put in order.
    """
    by = list(by)
    counts = (
        df.where(F.col(col).isNotNull())
        .groupBy(*by, F.col(col).cast("bigint").alias("_v"))
        .agg((F.count(F.lit(1)) if weight is None else F.sum(weight)).alias("_n"))
        .withColumn("_hi", F.shiftright("_v", 16))
    )
    counts = materialise(counts, "counts")  # read twice
    slices = counts.groupBy(*by, "_hi").agg(F.sum("_n").alias("_s"))
    whole = Window.partitionBy(*by)
    upto = whole.orderBy("_hi").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    slices = (
        slices.withColumn("_total", F.sum("_s").over(whole))
        .withColumn("_end", F.sum("_s").over(upto))
        .withColumn("_start", F.col("_end") - F.col("_s"))
        # 0-based positions of the two middle values
        .withColumn("_lo", F.expr("(_total - 1) div 2"))
        .withColumn("_up", F.expr("_total div 2"))
        .where((F.col("_up") >= F.col("_start")) & (F.col("_lo") < F.col("_end")))
    )
    null_safe = [F.col(f"c.{k}").eqNullSafe(F.col(f"s.{k}")) for k in by]
    cond = F.col("c._hi") == F.col("s._hi")
    for k in null_safe:
        cond = cond & k
    inside = counts.alias("c").join(slices.alias("s"), cond).select(
        *[F.col(f"c.{k}").alias(k) for k in by], F.col("c._hi"), "_v", "_n", "_start", "_lo", "_up"
    )
    run = Window.partitionBy(*by, "_hi").orderBy("_v")
    last = F.col("_start") + F.sum("_n").over(run)
    first = last - F.col("_n")
    picked = inside.withColumn(
        "_hits",
        ((F.col("_lo") >= first) & (F.col("_lo") < last)).cast("int")
        + ((F.col("_up") >= first) & (F.col("_up") < last)).cast("int"),
    ).where(F.col("_hits") > 0)
    return picked.groupBy(*by).agg((F.sum(F.col("_v") * F.col("_hits")) / 2).alias(name))


def join_ids(df: DataFrame, keys: Iterable[str], col: str = "cropfield", per_row: int = 1000) -> DataFrame:
    """Ids of each group as blank-separated text, at most ``per_row`` ids per row and part.

    Every id appears; a group with many simply takes several rows, numbered by ``part``.
    """
    from croploom.operators.numbering import number_rows

    keys = list(keys)
    numbered = number_rows(df.select(*keys, col), "_i", [col], keys)
    return (
        numbered.withColumn("part", F.expr(f"cast((_i - 1) div {per_row} as int)"))
        .groupBy(*keys, "part")
        .agg(
            F.array_join(
                F.transform(F.array_sort(F.collect_list(col)), lambda v: v.cast("string")), " "
            ).alias("ids")
        )
    )


def tile_key(v: Column, step: int, origin: float = 0) -> Column:
    return F.floor((v - origin) / step)


def with_tile(df: DataFrame, step: int, x: str = "xmin", y: str = "ymin") -> DataFrame:
    """The tile a point falls in."""
    return df.withColumns({"tx": tile_key(F.col(x), step), "ty": tile_key(F.col(y), step)})


def tile_presence(pc: DataFrame, step: int, overlap: int = 0, geom: str | None = None) -> DataFrame:
    """Tiles (closed, grown by half the overlap on every side) and the years in which some parcel meets
    them.

    Candidates come from the limits ``xmin, ymin, xmax, ymax``.  With ``geom`` a parcel that is not
    wholly inside a candidate tile is then tested itself; without, the rows are rectangles.
    """
    half = overlap / 2

    def lo(c):
        return (F.ceil((F.col(c) - half) / step) - 1).cast("bigint")

    def hi(c):
        return F.floor((F.col(c) + half) / step).cast("bigint")

    tiles = pc.withColumn("tx", F.explode(F.sequence(lo("xmin"), hi("xmax")))).withColumn(
        "ty", F.explode(F.sequence(lo("ymin"), hi("ymax")))
    )
    if geom is not None:
        x0, y0 = F.col("tx") * step - F.lit(half), F.col("ty") * step - F.lit(half)
        x1, y1 = x0 + (step + overlap), y0 + (step + overlap)
        inside = (F.col("xmin") >= x0) & (F.col("xmax") <= x1) & (F.col("ymin") >= y0) & (F.col("ymax") <= y1)
        tiles = tiles.where(inside | G.intersects_cell(F.col(geom), x0, y0, x1, y1))
    return tiles.groupBy("tx", "ty", "year").agg(F.lit(1).alias("present"))
