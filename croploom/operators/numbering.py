"""Serial numbers without sending a whole group through one task."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from croploom.session import materialise


def number_rows(
    df: DataFrame,
    name: str,
    order_cols: Iterable[str | Column],
    by: Iterable[str] = (),
    unique: bool = False,
) -> DataFrame:
    """Number rows from 1 in the given order, separately for each ``by`` group.

    The frame is range-sorted on the whole key, so a group of any size is spread over many tasks.
    Each sorted partition then needs only its starting number, which comes from the partition
    counts: as groups are contiguous there are at most (partitions + groups) of those.

    Unless the order is said to be ``unique``, a random last key spreads rows that are equal in all
    others.  It is written down before the sort, so that a task that runs again sees the same values.
    """
    from croploom.operators.joins import is_small

    by = list(by)
    order = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    columns = df.columns
    if not unique:
        df = materialise(df.withColumn("_tie", F.rand(7)), "ties")
        order.append(F.col("_tie"))
    placed = materialise(
        df.sort(*by, *order)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_idx", F.monotonically_increasing_id()),
        "numbered",
    )
    starts = placed.groupBy(*by, "_pid").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_idx").alias("_first")
    )
    before = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    # Null group keys are matched too, hence the null-safe comparison.
    s = starts.select(*[F.col(c).alias(f"_k_{c}") for c in by], F.col("_pid").alias("_p"), "_first", "_before")
    cond = F.col("_pid") == F.col("_p")
    for c in by:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    # One row per sorted partition and per group: broadcast within the bound of code tables.
    s = materialise(s, "starts")
    joined = placed.join(F.broadcast(s) if is_small(s) else s, cond)
    return joined.withColumn(
        name, (F.col("_idx") - F.col("_first") + F.col("_before") + 1).cast("bigint")
    ).select(*[c for c in columns if c != name], name)


def dense_label(df: DataFrame, cols: Iterable[str], name: str = "label", min_rows: int = 1) -> DataFrame:
    """Distinct values of ``cols`` numbered 1..n in value order, with their row count ``n``.

    Values carried by fewer than ``min_rows`` rows are left out, so a left join of the result back
    to the data leaves them without label (background).
    """
    cols = list(cols)
    kept = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_rows)
    return number_rows(kept, name, cols, unique=True)


def relabel(df: DataFrame, cols: Iterable[str], name: str = "label", min_rows: int = 1) -> DataFrame:
    """Each row with the dense label of its value; 0 marks values that are too rare."""
    from croploom.operators.joins import dim_join

    cols = list(cols)
    labels = dense_label(df, cols, name, min_rows).drop("n")
    return dim_join(df, labels, cols).withColumn(name, F.coalesce(name, F.lit(0)).cast("bigint"))
