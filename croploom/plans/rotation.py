"""The rotation stack of one or more regions, with codes and outlines."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from croploom.operators import stack as S
from croploom.operators.columns import centroid_layer
from croploom.operators.numbering import number_rows
from croploom.operators.tracing import stack_geometry
from croploom.session import materialise


@dataclass(frozen=True)
class RotationProducts:
    stack: DataFrame
    outlines: DataFrame
    gaps: DataFrame


def rotation_products(
    pc: DataFrame,
    years: Iterable[int],
    scale: float = 2.0,
    min_pixels: int = 10,
    min_ha: float = 0.1,
    by: Iterable[str] = ("nuts",),
    sequential: bool = False,
) -> RotationProducts:
    """The stack with ``cropfield``, ``cf<year>``, ``c<year>``, ``area_ha``; its outlines; the 1 km
    squares that hold parcels but nothing of the stack."""
    years, by = list(years), list(by)
    cf = [f"cf{y}" for y in years]
    # Written once each: the runs feed the stack and its outlines, the numbered rows name them.
    runs = materialise(S.stack_runs(pc, years, scale, "geom", by, min_pixels, sequential=sequential), "stackruns")
    kept = S.dissolve(runs, years, scale, by).where(F.col("area_ha") >= min_ha)
    numbered = materialise(number_rows(kept, "cropfield", cf, by, unique=True), "stack")
    labelled = materialise(S.label_runs(runs, numbered, years, by), "labelled")
    points = centroid_layer(pc.where(F.col("year").isin(years)).select(*by, "geom")).select(*by, "cx", "cy")
    return RotationProducts(
        stack=S.attach_codes(numbered, pc, years, by),
        outlines=stack_geometry(labelled, [*by, "cropfield"], scale),
        gaps=S.coverage_gaps(points, S.run_centroids(labelled, [*by, "cropfield"], scale), by=by),
    )
