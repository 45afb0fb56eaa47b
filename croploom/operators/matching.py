"""Matching of free crop names to the hierarchy, and reports on its quality."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from croploom.functions.scalars import norm_text, spaces_to_underscores, underscores_to_spaces
from croploom.functions.similarity import best_of_batch
from croploom.operators.gramindex import best_by_index, edit_similarity
from croploom.operators.joins import BROADCAST_ROWS, dim_join, lookup
from croploom.session import materialise

# Candidates compared with one name at a time, and names handed over together.
CHUNK = 512
BATCH = 64
# Pairs of names and candidates from which an index is cheaper than comparing them all.
INDEX_FROM = 1_000_000


def best_match(
    names: DataFrame, candidates: DataFrame, method: str = "weighted", chunk: int = CHUNK, index_from: int = INDEX_FROM
) -> DataFrame:
    """The best candidate of every distinct name: ``(text, best, score)``.

    ``names`` has one column of texts, ``candidates`` has ``pos`` (list order) and ``text``.  Ties go
    to the first candidate of the list; texts without any letter or digit find nothing.

    The candidate list is packed into arrays of at most ``chunk`` entries and each name visits each
    array, so no name x candidate rows ever exist.  The arrays are broadcast up to the usual bound of
    rows; beyond it the visits to one array are spread over several tasks.  With the edit distance, and
    from ``index_from`` pairs on, only names do so that have no candidate near enough for the prefix index
    (``gramindex``); the result is the same.
    """
    col = names.columns[0]
    clean = (
        names.select(norm_text(F.col(col)).alias("name")).where(F.col("name") != "").distinct()
    )
    near = None
    if method == "levenshtein":
        listed = candidates.select(F.col("pos").cast("bigint"), norm_text(F.col("text")).alias("text"))
        clean = materialise(clean, "names")
        if clean.count() * listed.count() >= index_from:
            near, clean = best_by_index(clean, listed)
    packs = (
        candidates.select(F.col("pos").cast("bigint"), norm_text(F.col("text")).alias("text"))
        .withColumn("pack", F.expr(f"pos div {chunk}"))
        .groupBy("pack")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "text"))).alias("cands"))
    )
    last = candidates.agg(F.max(F.expr(f"pos div {chunk}")).alias("m")).first().m
    if last is None:
        return clean.select(
            F.col("name").alias("text"),
            F.lit(None).cast("bigint").alias("best"),
            F.lit(None).cast("double").alias("score"),
        )
    most_packs = BROADCAST_ROWS // chunk
    visits = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(last).cast("bigint"))).alias("pack")
    if method == "levenshtein":
        scored = dim_join(clean.select("name", visits), packs, ["pack"], "inner", most_packs)
        found = scored.select(
            "name",
            F.array_max(
                F.transform(
                    "cands",
                    lambda c: F.struct(
                        edit_similarity(F.col("name"), c.text).alias("score"), (-c.pos).alias("rank")
                    ),
                )
            ).alias("hit"),
        )
    else:
        # Names travel in small batches, so a pack of candidates is handed over once per batch.
        groups = max(1, clean.count() // BATCH)
        batches = (
            clean.groupBy(F.pmod(F.xxhash64("name"), F.lit(groups)).alias("_g"))
            .agg(F.collect_list("name").alias("names"))
            .select("_g", "names", visits)
        )
        found = (
            dim_join(batches, packs, ["pack"], "inner", most_packs)
            .select(F.explode(best_of_batch("names", "cands")).alias("r"))
            .select("r.name", F.struct(F.col("r.score").alias("score"), (-F.col("r.pos")).alias("rank")).alias("hit"))
        )
    hits = found.groupBy("name").agg(F.max("hit").alias("hit"))
    return (
        (hits if near is None else hits.unionByName(near))
        .select(
            F.col("name").alias("text"), (-F.col("hit.rank")).alias("best"), F.col("hit.score").alias("score")
        )
    )


def match_crop_names(
    df: DataFrame,
    hierarchy: DataFrame,
    name: str = "translated_name",
    method: str = "weighted",
    index_from: int = INDEX_FROM,
) -> DataFrame:
    """Adds ``hcat4_name_auto`` and ``hcat4_code_auto``, the best crop of the hierarchy by name.

    ``hierarchy`` has ``pos`` (list order), ``hcat4_name``, ``hcat4_code``.
    """
    cands = hierarchy.select("pos", underscores_to_spaces(F.col("hcat4_name")).alias("text"))
    # Stored, as the joins below count their right side before they use it.
    hits = materialise(best_match(df.select(name), cands, method, index_from=index_from), "hits")
    named = dim_join(
        hits, hierarchy.select(F.col("pos").alias("best"), F.col("hcat4_name").alias("hcat4_name_auto")), ["best"]
    ).select(F.col("text").alias("_key"), spaces_to_underscores(F.col("hcat4_name_auto")).alias("hcat4_name_auto"))
    out = dim_join(df.withColumn("_key", norm_text(F.col(name))), named, ["_key"]).drop("_key")
    codes = hierarchy.select(
        F.col("hcat4_name").alias("hcat4_name_auto"), F.col("hcat4_code").alias("hcat4_code_auto")
    )
    return lookup(out, codes, "hcat4_name_auto", "hcat4_code_auto")


def match_accuracy(df: DataFrame, by: Iterable[str] = ("nuts",)) -> DataFrame:
    """Percentage of rows whose automatic name equals the reviewed one; a missing name counts as wrong."""
    right = F.coalesce((F.col("hcat4_name_auto") == F.col("hcat4_name")).cast("int"), F.lit(0))
    return df.groupBy(*by).agg((F.avg(right) * 100).alias("accuracy"))


# Codes of the error sub-classes.
ERROR_CAUSES = {
    1: "niche_or_homonym",
    2: "colloquial_or_regional",
    3: "spelling_error",
    4: "abbreviation",
    5: "separable_prefix",
}


def error_rates(df: DataFrame, by: Iterable[str] = ("nuts",)) -> DataFrame:
    """Agreement and error percentages; every column leaves out its own nulls.

    Odd translations are classes 2 and 3; the causes are shares of that percentage.
    """

    def share(col: str, value: int) -> Column:
        return F.avg((F.col(col) == value).cast("int"))

    odd = (share("type_error", 2) + share("type_error", 3)) * 100
    return df.groupBy(*by).agg(
        (share("translation_flag", 1) * 100).alias("correct"),
        (share("type_error", 1) * 100).alias("one_engine_wrong"),
        odd.alias("odd"),
        *[(share("cause", k) * odd).alias(name) for k, name in ERROR_CAUSES.items()],
    )
