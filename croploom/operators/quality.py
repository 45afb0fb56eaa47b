"""Geometry audit and the repair cascade."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from croploom.functions import geometry as G
from croploom.functions import validity as V
from croploom.operators.columns import hold
from croploom.operators.crossings import large_validity
from croploom.operators.stats import join_ids
from croploom.session import materialise

MOST_POINTS = 2_000  # points of a geometry that is tested in one piece


def _with_suspect(df: DataFrame, geom: str) -> DataFrame:
    """``_easy``: the ring of a convex geometry of one ring; ``_suspect``: every other geometry, which
    needs the full test."""
    eased = hold(df, "_easy", V.easy_ring(F.col(geom)))
    return eased.withColumn("_suspect", F.when(F.col("_easy").isNull(), F.col(geom)))


def with_validity(df: DataFrame, geom: str = "geom", most_points: int = MOST_POINTS) -> DataFrame:
    """Adds ``valid``; convex rings are settled without leaving the JVM.

    Of the others, geometries of up to ``most_points`` points are tested whole, batch by batch, and larger
    ones by ``large_validity``, whose edges meet in cells.
    """
    easy = F.col("_easy").isNotNull()
    n = F.expr("aggregate(_suspect, 0, (s, poly) -> s + aggregate(poly, 0, (t, r) -> t + size(r)))")
    eased = _with_suspect(df, geom).withColumn("_large", F.coalesce(n > most_points, F.lit(False)))
    eased = eased.withColumn("_suspect", F.when(~F.col("_large"), F.col("_suspect")))
    valid = F.when(easy, V.is_closed(F.col(geom))).otherwise(V.is_valid(F.col("_suspect")))
    # Stored, as large ones are picked from it: ``df`` may be a repair, which must not be done twice.
    tested = materialise(eased.withColumn("valid", valid).drop("_easy", "_suspect"), "tested")
    small, rest = (tested.where(c).drop("_large") for c in ("not _large", "_large"))
    if not rest.limit(1).count():
        return small
    return small.unionByName(large_validity(rest.drop("valid"), geom))


def invalid_rows(df: DataFrame, geom: str = "geom", most_points: int = MOST_POINTS) -> DataFrame:
    return with_validity(df, geom, most_points).where(~F.col("valid")).drop("valid")


def invalid_snapshot(df: DataFrame, geom: str = "geom") -> DataFrame:
    """The invalid rows as they are, with ``method`` 0."""
    return invalid_rows(df, geom).withColumn("method", F.lit(0))


def repair_layer(df: DataFrame, geom: str = "geom") -> DataFrame:
    """Every row with a valid geometry where one could be made, and the ``method`` that did it.

    0 was valid already, 1 made valid, 3 zero-width buffer, 4 shrunk and grown, 9 still invalid.
    """
    easy, closed = F.col("_easy").isNotNull(), V.is_closed(F.col(geom))
    method = F.when(easy, F.when(closed, 0).otherwise(1)).otherwise(F.col("_fix.method"))
    return (
        _with_suspect(df, geom)
        .withColumn("_fix", V.repair(F.col("_suspect")))
        .withColumns(
            {
                "method": F.when(F.col(geom).isNotNull(), method),
                geom: F.when(easy & closed, F.col(geom)).when(easy, F.array(F.array("_easy"))).otherwise(F.col("_fix.geom")),
            }
        )
        .drop("_fix", "_easy", "_suspect")
    )


def validity_report(repaired: DataFrame, by: Iterable[str] = ("nuts", "year")) -> DataFrame:
    """Invalid rows per layer on entry and after each of the three steps."""

    def still(*methods: int) -> Column:
        return F.count(F.when(F.col("method").isin(*methods), 1))

    return repaired.groupBy(*by).agg(
        still(1, 3, 4, 9).alias("input"),
        still(3, 4, 9).alias("makevalid"),
        still(4, 9).alias("buffer0"),
        still(9).alias("buffer1"),
    )


def remaining_ids(repaired: DataFrame, by: Iterable[str] = ("nuts", "year"), per_row: int = 1000) -> DataFrame:
    """Ids that stayed invalid, as text, in as many rows per layer as it takes."""
    return join_ids(repaired.where(F.col("method") == 9), by, "cropfield", per_row)


def geom_types(df: DataFrame, by: Iterable[str] = (), geom: str = "geom") -> DataFrame:
    return df.groupBy(*by, G.geom_type(F.col(geom)).alias("geom_type")).agg(F.count(F.lit(1)).alias("n"))
