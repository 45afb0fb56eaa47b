"""Order within chains and rings whose members only know their successor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from croploom.session import materialise


def cycles(links: DataFrame) -> DataFrame:
    """Ring and place of every member of closed rings.

    ``links`` has ``id`` and ``nxt``, each id once in either column.  ``ring`` is the smallest id of the
    ring and ``place`` counts from 0 there.  Pointers are doubled: after k rounds a member knows the
    smallest id among the 2^k that follow, and how far that is, so the rounds grow with the logarithm of
    the longest ring.  Every join is on ids that occur once, and no ring is ever in one row or task.
    """
    now = materialise(links.select("id", "nxt", F.col("id").alias("low"), F.lit(0).cast("long").alias("far"), F.lit(True).alias("grew")), "cycles")
    step = 1
    while now.where("grew").limit(1).count():
        ahead = now.select(F.col("id").alias("nxt"), F.col("nxt").alias("_nxt"), F.col("low").alias("_low"), F.col("far").alias("_far"))
        lower = F.col("_low") < F.col("low")
        now = materialise(
            now.join(ahead, "nxt").select(
                "id",
                F.col("_nxt").alias("nxt"),
                F.least("low", "_low").alias("low"),
                F.when(lower, F.col("_far") + step).otherwise(F.col("far")).alias("far"),
                lower.alias("grew"),
            ),
            "cycles",
        )
        step *= 2
    # ``far`` is the number of steps to the smallest id.  With n members, the place is (n - far) mod n.
    sizes = now.groupBy("low").agg(F.count(F.lit(1)).alias("n"))
    return now.join(sizes, "low").select("id", F.col("low").alias("ring"), F.expr("(n - far) % n").alias("place"))
