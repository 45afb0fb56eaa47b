"""Parcels on a regular statistics grid: overlap join, cell aggregates, byte rasters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from croploom.functions import geometry as G
from croploom.functions.scalars import let
from croploom.operators.filters import BRANCHES, branches_of


@dataclass(frozen=True)
class Grid:
    """Square cells counted from the lower left corner."""

    cell: int = 10_000
    x0: int = 2_640_000
    y0: int = 1_560_000
    cols: int = 317
    rows: int = 375

    def span(self, low: Column, high: Column, origin: int, count: int) -> tuple[Column, Column]:
        """First and last cell a closed range meets; a mere touch counts on both sides."""
        first = F.ceil((low - origin) / self.cell) - 1
        last = F.floor((high - origin) / self.cell)
        return (
            F.greatest(first, F.lit(0)).cast("bigint"),
            F.least(last, F.lit(count - 1)).cast("bigint"),
        )

    def grd_id(self, gi: Column, gj: Column) -> Column:
        return gi * 1000 + gj

    def limits(self, gi: Column, gj: Column) -> tuple[Column, Column, Column, Column]:
        x = (self.x0 + gi * self.cell).cast("double")
        y = (self.y0 + gj * self.cell).cast("double")
        return x, y, x + self.cell, y + self.cell


EUROPE_10K = Grid()


def _spread(pc: DataFrame, grid: Grid) -> DataFrame:
    """One row per parcel and candidate cell, from the parcel's limits."""
    i0, i1 = grid.span(F.col("xmin"), F.col("xmax"), grid.x0, grid.cols)
    j0, j1 = grid.span(F.col("ymin"), F.col("ymax"), grid.y0, grid.rows)
    # Whole numbers keep the later keys free of floating point.  sequence() would count backwards
    # over an empty span, hence the condition; it is no filter, as that would be pushed below the
    # limits and have them worked out twice.
    return (
        pc.withColumns({"_i0": i0, "_i1": i1, "_j0": j0, "_j1": j1})
        .withColumn("gi", F.explode(F.when(F.col("_i0") <= F.col("_i1"), F.sequence("_i0", "_i1"))))
        .withColumn("gj", F.explode(F.when(F.col("_j0") <= F.col("_j1"), F.sequence("_j0", "_j1"))))
        .drop("_i0", "_i1", "_j0", "_j1")
        .withColumn("grd_id", grid.grd_id(F.col("gi"), F.col("gj")))
    )


def grid_join(pc: DataFrame, grid: Grid = EUROPE_10K, geom: str | None = "geom") -> DataFrame:
    """Every parcel with every cell it meets, and the overlap ``inter_m2``; a touch has overlap 0.

    The cells follow from the coordinates, so nothing is shuffled or broadcast.  ``geom=None``
    means the rows are rectangles given by ``xmin, ymin, xmax, ymax``.
    """
    if geom is None:
        cells = _spread(pc, grid)
        x0, y0, x1, y1 = grid.limits(F.col("gi"), F.col("gj"))
        width = F.least(F.col("xmax"), x1) - F.greatest(F.col("xmin"), x0)
        height = F.least(F.col("ymax"), y1) - F.greatest(F.col("ymin"), y0)
        return cells.withColumn(
            "inter_m2",
            F.greatest(width, F.lit(0.0)).cast("double") * F.greatest(height, F.lit(0.0)),
        )
    b = pc.withColumn("_b", G.bbox(F.col(geom)))
    own = {c: F.col(f"_b.{c}") for c in ("xmin", "ymin", "xmax", "ymax") if c not in pc.columns}
    cells = _spread(b.withColumns(own), grid)
    x0, y0, x1, y1 = grid.limits(F.col("gi"), F.col("gj"))
    within = (
        (F.col("_b.xmin") >= x0) & (F.col("_b.xmax") <= x1) & (F.col("_b.ymin") >= y0) & (F.col("_b.ymax") <= y1)
    )
    g = F.col(geom)
    # Most parcels lie inside one cell and need no cutting.
    hit = F.when(F.col("_in"), F.array(G.area(g))).otherwise(
        let(
            G.area(G.clip_cell(g, x0, y0, x1, y1)),
            lambda m2: F.when(G.intersects_cell(g, x0, y0, x1, y1, m2), F.array(m2)),
        )
    )
    return (
        # The array goes straight into explode(): held in a column first, it would be worked out once
        # more for a filter that Spark infers from it.
        cells.withColumn("_in", within)
        .withColumn("inter_m2", F.explode(hit))
        .drop("_b", "_in", *own)
    )


def grid_stats(
    pc: DataFrame,
    grid: Grid = EUROPE_10K,
    geom: str | None = "geom",
    by: Iterable[str] = ("hcat4_code",),
) -> DataFrame:
    """Hectares inside each cell and number of parcels meeting it, by crop."""
    needed = [*by, "cropfield", *([geom] if geom else []), "xmin", "ymin", "xmax", "ymax"]
    lean = pc.select(*[c for c in dict.fromkeys(needed) if c in pc.columns])
    return (
        grid_join(lean, grid, geom)
        .groupBy("grd_id", *by)
        .agg(
            (F.sum("inter_m2") / 10000).alias("area_ha"),
            F.count("cropfield").alias("counts"),
        )
    )


def attach_cells(agg: DataFrame, grid: Grid = EUROPE_10K, cells: DataFrame | None = None) -> DataFrame:
    """Cell squares back on cell aggregates: computed, or from a cell table where one is given."""
    if cells is not None:
        from croploom.operators.joins import dim_join

        return dim_join(agg, cells, ["grd_id"], "inner")
    gi = F.expr("grd_id div 1000")
    gj = F.col("grd_id") % 1000
    x0, y0, x1, y1 = grid.limits(gi, gj)
    return agg.withColumn("geom", G.envelope(x0, y0, x1, y1))


def grid_branch(
    stats: DataFrame,
    branches: Mapping[int, str] = BRANCHES,
    by: Iterable[str] = (),
) -> DataFrame:
    """Hectares per cell for every crop branch, all branches in one pass."""
    names = F.create_map(*[F.lit(v) for kv in branches.items() for v in kv])
    return (
        stats.withColumn("branch", F.explode(branches_of(F.col("hcat4_code"), tuple(branches))))
        .groupBy(*by, "grd_id", "branch")
        .agg(F.sum("area_ha").alias("area_ha"))
        .withColumn("branch_name", names[F.col("branch")])
    )


def grid_byte(branch: DataFrame, grid: Grid = EUROPE_10K) -> DataFrame:
    """Raster row and column counted from the upper left corner, share of the cell as 0..255."""
    full = grid.cell * grid.cell / 10000
    return branch.select(
        *[c for c in branch.columns if c not in ("grd_id", "area_ha", "geom")],
        (F.lit(grid.rows - 1) - F.col("grd_id") % 1000).alias("row"),
        F.expr("grd_id div 1000").alias("col"),
        F.least(F.lit(255), F.rint(F.col("area_ha") * 255 / full).cast("int")).alias("area_perc"),
    )


# Bands of the colour composite, red, green, blue.
COMPOSITE_BANDS = ("permanent_crops_perennial", "grassland_grass", "arable_crops")


def grid_composite(bytes_df: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """Three branches as columns of one row per cell; 0 where a branch has no data."""
    return (
        bytes_df.where(F.col("branch_name").isin(*COMPOSITE_BANDS))
        .groupBy(*by, "row", "col")
        .agg(
            *[
                F.coalesce(
                    F.max(F.when(F.col("branch_name") == b, F.col("area_perc"))), F.lit(0)
                ).alias(b)
                for b in COMPOSITE_BANDS
            ]
        )
    )
