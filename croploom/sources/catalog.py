"""Which layers there are, by file or table name."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ALL = ["all"]


def _listed(part: Column, wanted: Iterable) -> Column:
    wanted = list(wanted)
    return F.lit(True) if wanted == ALL else part.isin([str(w) for w in wanted])


def layer_catalog(
    names: DataFrame, regions: Iterable[str], years: Iterable, stack: bool, col: str = "name"
) -> DataFrame:
    """Names ``<region>_<year>.<ext>`` or ``<region>_stack.<ext>`` that a run asks for.

    ``['all']`` lets every region or year pass.  Each name appears once, in order.
    """
    stem = F.split_part(F.col(col), F.lit("."), F.lit(1))
    region = F.split_part(stem, F.lit("_"), F.lit(1))
    kind = F.split_part(stem, F.lit("_"), F.lit(2))
    wanted = _listed(kind, years)
    if stack:
        wanted = wanted | (kind == "stack")
    return names.where(_listed(region, regions) & wanted).select(col).distinct().orderBy(col)


def table_catalog(spark: SparkSession, database: str | None = None) -> DataFrame:
    """One row per table and column of the session catalog."""
    tables = spark.catalog.listTables(database)
    rows = [
        (t.name, c.name)
        for t in tables
        for c in spark.catalog.listColumns(f"{t.namespace[0]}.{t.name}" if t.namespace else t.name)
    ]
    return spark.createDataFrame(rows, "table_name string, column_name string")
