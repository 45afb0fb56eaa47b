"""A Merkle manifest of a dataset, kept as node rows that know their parents.

Every row of the table is a leaf.  The leaves of each source form a tree of runs of 16, and the roots of
the sources form one more tree.  Levels are built from below and stored as one row for each run: its
digests in order, and the run and place that its own digest has one level up.  A proof is checked by a
recursive query: each leaf climbs from run to run, its digest is folded with its siblings there, and the
siblings are appended to its proof.

Siblings above a leaf's first run are the same for all leaves of that run, so one leaf of each run carries
them upwards and the others get them at the end; a climbing row is otherwise one digest and its place.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from croploom.operators.joins import dim_join
from croploom.operators.numbering import number_rows
from croploom.session import materialise, settled

ARITY = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = "*"  # the tree over sources; trees of sources have "" (null) or "=" and the source
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    """SHA-256 (lowercase hex) of the values, each `-` if null, else its UTF-8 byte count, `:` and itself."""
    return F.sha2(F.concat(*(_field(v) for v in values)), 256)


def lowered(text: Column) -> Column:
    """The text with A-Z in lower case, all else as it is."""
    return F.translate(text, UPPER, LOWER)


def _up(groups: DataFrame) -> DataFrame:
    """One level: (g, idx, h, n) with h in hex -> (g, run, kids), n being the nodes of the group's level."""
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("idx", "h"))), lambda x: x["h"])
    return groups.groupBy("g", F.expr(f"idx div {ARITY}").alias("run"), "n").agg(F.array_join(ordered, "").alias("kids"))


def build(nodes: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """Runs and roots of trees over nodes (g, idx from 0, h in hex, n = nodes of g).

    runs: (g, level, run, kids, n_up), kids being the run's digests as bytes, n_up the nodes of the next
    level.  roots: (g, root).  A group of one node has no run, its node is its root.  The loop runs once
    for each level, so a sixteenfold table takes one more step.
    """
    runs, roots = [], [nodes.filter("n = 1").select("g", F.col("h").alias("root"))]
    level, left = nodes.filter("n > 1"), nodes.agg(F.max("n")).first()[0] or 0
    n_up = F.ceil(F.col("n") / ARITY).cast("long")
    for k in range(64):
        if left <= 1:
            break
        made = materialise(_up(level).withColumns({"h": F.sha2("kids", 256), "n": n_up}), f"{label}-level")
        runs.append(made.select("g", F.lit(k).alias("level"), "run", F.unhex("kids").alias("kids"), F.col("n").alias("n_up")))
        roots.append(made.filter("n = 1").select("g", F.col("h").alias("root")))
        level = made.filter("n > 1").select("g", F.col("run").alias("idx"), "h", "n")
        left = -(-left // ARITY)
    none = nodes.sparkSession.createDataFrame([], "g string, level int, run long, kids binary, n_up long")
    return _union(runs or [none]), materialise(_union(roots), f"{label}-roots")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@contextmanager
def _any_number_of_rows(spark: SparkSession) -> Iterator[None]:
    """Recursive queries end at a million rows unless told otherwise."""
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


# One step up: the run's digests left and right of the climbing one.
_BEFORE = "substring(r.kids, 1, 32 * c.pos)"
_AFTER = "substring(r.kids, 32 * c.pos + 33)"
CLIMB = f"""
    with recursive climb(doc_id, leaf, g0, i0, h, upper, g, level, run, pos, first) as (
        select doc_id, leaf, g0, i0, h, cast(X'' as binary), g, level, run, pos, first from {{starts}}
        union all
        select c.doc_id, c.leaf, c.g0, c.i0, unhex(sha2(lower(hex(concat({_BEFORE}, c.h, {_AFTER}))), 256)),
            case when not c.first and c.i0 % {ARITY} = 0 then concat(c.upper, {_BEFORE}, {_AFTER}) else c.upper end,
            r.up_g, r.up_level, r.up_run, r.up_pos, false
        from climb c join {{runs}} r on r.g = c.g and r.level = c.level and r.run = c.run
    )
    select doc_id, leaf, g0, i0, h as folded, upper from climb where g is null
"""


def manifest(docs: DataFrame) -> DataFrame:
    """Leaf, subroot, root and proof of every row, and the root folded from tampered rows.

    ``docs`` has doc_id, source, lang, n_chars and text; other columns are ignored.  A row's leaf is the
    digest of these five.  Per source, leaves ascend by doc_id (null first; rows of one id by their
    digests, equal rows in any order); sources ascend bytewise, null first.  Where 5 divides the unsigned
    crc32 of the decimal doc_id the text is tampered with: its A-Z become lower case; a null doc_id or
    text is left alone.

    Returns doc_id, leaf, subroot, root, proof_sha256 (of all siblings' digests from the leaf to the root,
    left to right), folded_root (from the row as it is now and the siblings as they were), verified
    (folded_root = root).  Each input row gives one row.  A table of one row has its leaf as subroot and
    root and the digest of nothing as proof; an empty table gives no rows.

    The work is done when this is called; the result is stored, its stages are removed.
    """
    return settled(docs.sparkSession, "merkle", lambda: _manifest(docs))


def _manifest(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    own = [F.col(c) for c in FIELDS]
    hit = F.expr("crc32(cast(doc_id as string)) % 5 = 0 and text rlike '[A-Z]'")
    leaves = docs.select(
        "doc_id",
        F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), F.col("source"))).alias("g"),
        leaf_digest(*own).alias("h"),
        F.when(hit, leaf_digest(*own[:-1], lowered(F.col("text")))).alias("tampered"),
    )
    placed = number_rows(leaves, "idx", ["doc_id", "h"], by=["g"]).withColumn("idx", F.col("idx") - 1)
    counts = materialise(placed.groupBy("g").agg(F.count("*").alias("n")), "merkle-counts")
    placed = materialise(dim_join(placed, counts, ["g"], "inner"), "merkle-leaves")
    runs, subroots = build(placed.select("g", "idx", "h", "n"), "merkle")

    # The tree over sources, and where each source stands in it.
    n_sources = counts.count()
    stands = number_rows(subroots, "s", ["g"], unique=True).withColumn("s", F.col("s") - 1)
    stands = materialise(stands, "merkle-sources")
    top = stands.select(F.lit(TOP).alias("g"), F.col("s").alias("idx"), F.col("root").alias("h"), F.lit(n_sources).cast("long").alias("n"))
    top_runs, root = build(top, "merkle-top")
    root = root.select(F.col("root").alias("top")).first()
    root = root["top"] if root else None

    # Parent links: one level up in the same tree, from a source's root to its place among the sources.
    more, up_top = F.col("n_up") > 1, F.lit(n_sources > 1)
    inner = runs.filter(more).unionByName(top_runs.filter(more)).select(
        "g", "level", "run", "kids", F.col("g").alias("up_g"), (F.col("level") + 1).alias("up_level"),
        F.expr(f"run div {ARITY}").alias("up_run"), F.expr(f"cast(run % {ARITY} as int)").alias("up_pos"),
    )
    at_top = [
        F.when(up_top, F.lit(TOP)).alias("up_g"), F.lit(0).alias("up_level"),
        F.expr(f"s div {ARITY}").alias("up_run"), F.expr(f"cast(s % {ARITY} as int)").alias("up_pos"),
    ]
    ends = runs.filter("n_up = 1").join(stands.select("g", "s"), "g").select("g", "level", "run", "kids", *at_top)
    last = top_runs.filter("n_up = 1").withColumn("s", F.lit(0).cast("long")).select(
        "g", "level", "run", "kids", F.lit(None).cast("string").alias("up_g"), *at_top[1:]
    )
    linked = materialise(inner.unionByName(ends).unionByName(last), "merkle-nodes")

    base = ["doc_id", F.unhex("h").alias("leaf"), F.col("g").alias("g0"), F.col("idx").alias("i0"), F.unhex(F.coalesce("tampered", "h")).alias("h")]
    many = placed.filter("n > 1").select(
        *base, "g", F.lit(0).alias("level"), F.expr(f"idx div {ARITY}").alias("run"),
        F.expr(f"cast(idx % {ARITY} as int)").alias("pos"), F.lit(True).alias("first"),
    )
    alone = placed.filter("n = 1").join(stands.select("g", "s"), "g").select(
        *base, at_top[0].alias("g"), F.lit(0).alias("level"), at_top[2].alias("run"), at_top[3].alias("pos"), F.lit(False).alias("first")
    )
    starts = many.unionByName(alone)
    with _any_number_of_rows(spark):
        climbed = materialise(spark.sql(CLIMB, starts=starts, runs=linked), "merkle-climbed")

    # What the first leaf of each run carried belongs to all leaves of the run.
    run0 = F.expr(f"i0 div {ARITY}").alias("run0")
    carried = climbed.filter(f"i0 % {ARITY} = 0").select("g0", run0, "upper")
    first = linked.filter(f"level = 0 and g <> '{TOP}'").select(F.col("g").alias("g0"), F.col("run").alias("run0"), "kids")
    carried = carried.join(first, ["g0", "run0"], "left").join(stands.select(F.col("g").alias("g0"), F.col("root").alias("subroot")), "g0")
    out = climbed.drop("upper").withColumn("run0", run0).join(carried, ["g0", "run0"])
    at = f"cast(32 * (i0 % {ARITY}) as int)"
    siblings = f"concat(coalesce(concat(substring(kids, 1, {at}), substring(kids, {at} + 33)), cast(X'' as binary)), upper)"
    return out.select(
        "doc_id",
        F.expr("lower(hex(leaf))").alias("leaf"),
        "subroot",
        F.lit(root).cast("string").alias("root"),
        F.expr(f"sha2(lower(hex({siblings})), 256)").alias("proof_sha256"),
        F.expr("lower(hex(folded))").alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
