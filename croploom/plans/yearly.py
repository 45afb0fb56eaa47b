"""The yearly European layer and everything that follows from it, as one job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from croploom.operators.columns import centroid_layer
from croploom.operators.grid import EUROPE_10K, Grid, attach_cells, grid_branch, grid_byte, grid_composite, grid_stats
from croploom.operators.joins import map_crops
from croploom.operators.stats import area_stats, named_stats
from croploom.session import materialise


@dataclass(frozen=True)
class YearlyProducts:
    """All lazily defined; ``mapped`` and ``grid`` are the shared intermediate results."""

    mapped: DataFrame
    centroids: DataFrame
    grid: DataFrame
    grid_cells: DataFrame
    branches: DataFrame
    bytes: DataFrame
    composite: DataFrame
    stats: DataFrame


def yearly_products(
    pc: DataFrame,
    crop_map: DataFrame,
    usage_map: DataFrame,
    hierarchy: DataFrame,
    usage: DataFrame,
    grid: Grid = EUROPE_10K,
    geom: str | None = "geom",
    pattern: bool = False,
) -> YearlyProducts:
    """Map crops, take centroids, put parcels on the grid and sum them up, for all years at once.

    The grid aggregate is a few rows per cell and crop; it is written once because four products
    build on it.
    """
    mapped = map_crops(pc, crop_map, usage_map, pattern)
    cells = materialise(grid_stats(mapped, grid, geom, by=("year", "hcat4_code")), "grid")
    branches = grid_branch(cells, by=("year",))
    raster = grid_byte(branches, grid)
    return YearlyProducts(
        mapped=mapped,
        centroids=centroid_layer(mapped, geom) if geom else mapped,
        grid=cells,
        grid_cells=attach_cells(cells, grid),
        branches=branches,
        bytes=raster,
        composite=grid_composite(raster, by=("year",)),
        stats=named_stats(area_stats(mapped), hierarchy, usage),
    )
