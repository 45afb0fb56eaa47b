"""Best match by edit similarity through a prefix index of letter pairs.

Texts of a similarity of t or more share so many of their letter pairs that, with all pairs in one order,
they share one among the first few of each.  Candidates are indexed by these; a name meets only those that
it shares one with and whose length fits.  If the best of them reaches t, no other candidate can win.
Names that find none go on with a lower t, and those left after the last round are compared with all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from croploom.operators.joins import dim_join
from croploom.session import materialise

ROUNDS = (0.75, 0.55)  # at 0.5 and below texts need not share a pair
LONGEST = 200  # letters of a text that the index takes; longer ones are compared with all


def edit_similarity(a: Column, b: Column) -> Column:
    """1 minus the edit distance over the longer length."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest > 0, 1 - F.levenshtein(a, b) / longest).otherwise(F.lit(0.0))


def letter_pairs(text: str) -> Column:
    """All pairs of neighbours, the ends of the text included, each with how often it came before."""
    pairs = f"transform(sequence(1, length({text}) + 1), i -> substring(concat('\\u0002', {text}, '\\u0003'), i, 2))"
    return F.expr(f"transform(array({pairs}), p -> transform(p, (g, i) -> concat(g, size(filter(slice(p, 1, i), x -> x = g)))))[0]")


def _first_pairs(texts: DataFrame, text: str, common: DataFrame, share: float) -> DataFrame:
    """``texts`` once for each of its first pairs, the rarest first.

    A similarity of ``share`` or more leaves n + 1 - 2 (1 - share) n pairs of a text of n letters in place,
    so that one of those must be among the first 2 (1 - share) n + 1.
    """
    exploded = texts.withColumn("pair", F.explode(letter_pairs(text)))
    known = dim_join(exploded, common, ["pair"])
    ordered = F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "pair")))
    kept = F.slice(ordered, F.lit(1), F.floor(F.length(text) * 2 * (1 - share) + 1e-9).cast("int") + 1)
    first = known.groupBy(*texts.columns).agg(F.transform(kept, lambda s: s["pair"]).alias("pairs"))
    return first.select(*texts.columns, F.explode("pairs").alias("pair"))


def best_by_index(names: DataFrame, candidates: DataFrame, rounds: tuple[float, ...] = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """The best candidate of the names that have one of similarity ``rounds[-1]`` or more, and the names left.

    ``names`` has distinct ``name``, ``candidates`` have ``pos`` and ``text``, all normalised.  The first
    result has name and hit (score, rank = -pos); ties go to the smaller pos.  ``pairs`` met in each round
    are stored under that label.
    """
    cands = materialise(candidates.where(F.length("text").between(1, LONGEST)), "index-texts")
    common = materialise(cands.select(F.explode(letter_pairs("text")).alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "index-pairs")
    left, done = names.where(F.length("name").between(1, LONGEST)), None
    for share in rounds:
        index = materialise(_first_pairs(cands, "text", common, share), "index")
        met = dim_join(_first_pairs(left, "name", common, share), index, ["pair"], "inner")
        fits = F.least(F.length("name"), F.length("text")) >= F.greatest(F.length("name"), F.length("text")) * share - 1e-9
        met = materialise(met.where(fits).select("name", "pos", "text").distinct(), "pairs")
        hits = met.withColumn("score", edit_similarity(F.col("name"), F.col("text"))).where(F.col("score") >= share)
        hits = materialise(hits.groupBy("name").agg(F.max(F.struct("score", (-F.col("pos")).alias("rank"))).alias("hit")), "index-hits")
        done = hits if done is None else done.unionByName(hits)
        left = materialise(left.join(hits, "name", "left_anti"), "index-left")
    return done, left.unionByName(names.where(F.length("name") > LONGEST))
