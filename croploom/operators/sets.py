"""Unions, appends, sorted and first rows."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_layers(dfs: Iterable[DataFrame]) -> DataFrame:
    """All rows of all layers; a column a layer lacks becomes null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_distinct(dfs: Iterable[DataFrame]) -> DataFrame:
    """All rows of all layers, equal rows once."""
    return union_layers(dfs).distinct()


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that ``b`` does not have."""
    return a.select(*b.columns).subtract(b)


def sorted_names(df: DataFrame, col: str = "name") -> DataFrame:
    return df.select(col).distinct().orderBy(col)


def head_rows(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, same columns: the schema probe of a table."""
    return df.sparkSession.createDataFrame([], df.schema)


def top1(df: DataFrame, part: Iterable[str], order: Iterable[Column], desc: bool = False) -> DataFrame:
    """The first (or last) row of every group, by aggregation rather than by sorting the group.

    Every order column must be comparable; ties fall to the row whose remaining columns are
    smallest (largest).
    """
    part = list(part)
    rest = [c for c in df.columns if c not in part]
    key = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)], *rest)
    pick = F.max(key) if desc else F.min(key)
    return df.groupBy(*part).agg(pick.alias("_r")).select(*part, *[F.col(f"_r.{c}").alias(c) for c in rest])


def first_by(df: DataFrame, keys: Iterable[str], col: str) -> DataFrame:
    """One value per group: the smallest, so that it does not depend on row order."""
    return df.groupBy(*keys).agg(F.min(col).alias(col))
