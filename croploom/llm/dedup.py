"""Near duplicates by min-max hashing.

Each permutation gives two signature values, the smallest and the largest image of a document's
shingles, so half as many hash evaluations fill a signature.  Bands of five values make candidates, so
many that a pair at the threshold is missed with a probability of less than 5e-7: 25 for 0.85, 37 for
0.8.  Every link is confirmed on the full sets.

Documents with equal sets are one node from the start.  In each bucket every node first meets the
bucket's leader, the node that shares most bands with others (in a group of near copies: the text they
were made from).  Connected components follow.  Where a leader has met nodes of several components, all
that it has met are dealt into blocks of bounded size, pairs of blocks compare their full sets with each
other, and what comes out is at most a spanning forest of the components.  Pairs among those that are
already connected with the leader are not compared again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from croploom.llm.components import components
from croploom.llm.words import SPACED, U64, Words, buffers, fold, mix, slices
from croploom.session import materialise, settled

SHINGLE = 5
EVALUATIONS = 64
ROWS, MISS = 5, 5e-7  # values of a band, and how likely a pair at the threshold may be missed
BLOCK_ROWS, BLOCK_BYTES = 1024, 4 << 20  # texts, and bytes of text, of one side of a block
COLUMNS = 1 << 22  # cells of the membership matrix held at a time
NUMERATOR, DENOMINATOR = 85, 100


def _factors(evaluations: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and addends of the permutations; more of them begin with the same ones."""
    rng = np.random.default_rng(20)
    a, b = zip(*(rng.integers(0, 1 << 63, (2, EVALUATIONS), dtype=np.int64).astype(U64) for _ in range(-(-evaluations // EVALUATIONS))))
    return np.concatenate(a) * U64(2) + U64(1), np.concatenate(b)


def bands_for(numerator: int, denominator: int) -> int:
    """How many bands a threshold needs."""
    if not 0 < numerator <= denominator:
        raise ValueError("the threshold must be above 0 and at most 1")
    same = (numerator / denominator) ** ROWS
    return 1 if same == 1 else math.ceil(math.log(MISS) / math.log1p(-same))


def shingles(col: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of texts, repeats included, and where each text's begin."""
    data, off = buffers(col)
    w = Words(data, off, SPACED)
    pos, h = w.windows(size)
    count = np.diff(w.first)
    short = np.flatnonzero((count > 0) & (count < size))
    first = np.searchsorted(pos, w.first)
    if len(short):
        extra = np.concatenate([fold([w.hash[j : j + 1] for j in range(w.first[i], w.first[i + 1])]) for i in short])
        h = np.insert(h, first[short], extra)
        add = np.zeros(len(count) + 1, np.int64)
        add[short + 1] = 1
        first = first + np.cumsum(add)
    return h, first


def distinct(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same without repeats, sorted within each text."""
    sets = [np.unique(h[a:b]) for a, b in zip(first[:-1], first[1:])]
    sizes = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else h), np.concatenate([[0], np.cumsum(sizes)])


def signature(h: np.ndarray, first: np.ndarray, evaluations: int = EVALUATIONS) -> np.ndarray:
    """Minima and maxima of all permutations, one row per non-empty set."""
    times, plus = _factors(evaluations)
    out = np.empty((len(first), 2 * evaluations), U64)
    for k in range(evaluations):
        v = h * times[k] + plus[k]
        out[:, 2 * k] = np.minimum.reduceat(v, first)
        out[:, 2 * k + 1] = np.maximum.reduceat(v, first)
    return out


def band_keys(sig: np.ndarray, bands: int) -> np.ndarray:
    keys = [fold([sig[:, b * ROWS + r] for r in range(ROWS)] + [np.full(len(sig), b, U64)]) for b in range(bands)]
    return np.stack(keys, axis=1).view(np.int64) if len(sig) else np.zeros((0, bands), np.int64)


def _sign(n_bands: int):
    evaluations = -(-n_bands * ROWS // 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                h, first = distinct(*shingles(batch.column("text")))
                n = np.diff(first)
                full = np.flatnonzero(n > 0)
                node = np.zeros((len(n), 2), U64)
                bands = np.zeros((0, n_bands), np.int64)
                if len(full):
                    at = first[:-1][full]
                    node[full, 0] = np.add.reduceat(mix(h ^ U64(0x5851F42D4C957F2D)), at)
                    node[full, 1] = np.add.reduceat(mix(h ^ U64(0x14057B7EF767814F)), at)
                    bands = band_keys(signature(h, at, evaluations), n_bands)
                ends = np.concatenate([[0], np.cumsum((n > 0) * n_bands)]).astype(np.int32)
                raw = node.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        batch.column("text_key"),
                        pa.array(n, pa.int64()),
                        pa.array([raw[16 * i : 16 * i + 16] if c else None for i, c in enumerate(n)], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(bands.ravel())),
                    ],
                    names=["doc_id", "text_key", "n_shingles", "node", "bands"],
                )

    return run


def _linked(numerator: int, denominator: int):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, last, known = [], None, None
            left, right, a = batch.column("left_text"), batch.column("right_text"), batch.column("a").to_pylist()
            for i in range(batch.num_rows):
                if a[i] != last:
                    last, known = a[i], np.unique(shingles(left.slice(i, 1))[0])
                other = np.unique(shingles(right.slice(i, 1))[0])
                if min(len(known), len(other)) * denominator < max(len(known), len(other)) * numerator:
                    keep.append(False)
                    continue
                both = len(np.intersect1d(known, other, assume_unique=True))
                keep.append(denominator * both >= numerator * (len(known) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return check


def common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets on the left with all on the right."""
    h = np.concatenate([*left, *right])
    owner = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in (*left, *right)])
    values, place, seen = np.unique(h, return_inverse=True, return_counts=True)
    shared = np.cumsum(seen > 1) - 1  # what is in one set only cannot be common
    ok = seen[place] > 1
    owner, place = owner[ok], shared[place[ok]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    out = np.zeros((len(left), len(right)), np.float32)
    total = int(place[-1]) + 1 if len(place) else 0
    step = max(256, COLUMNS // (len(left) + len(right)))
    for lo in range(0, total, step):
        i, j = np.searchsorted(place, (lo, lo + step))
        m = np.zeros((len(left) + len(right), min(step, total - lo)), np.float32)
        m[owner[i:j], place[i:j] - lo] = 1
        out += m[: len(left)] @ m[len(left) :].T
    return np.rint(out).astype(np.int64)


def _bridges(numerator: int, denominator: int):
    """Components that similar texts of one block connect; a spanning forest of them at most."""

    def run(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        i, j = key[1], key[2]
        sets = distinct(*shingles(pa.array(block["text"], pa.large_string())))
        sets = [sets[0][a:b] for a, b in zip(sets[1][:-1], sets[1][1:])]
        root, part = block["root"].to_list(), block["part"].to_numpy()
        rows, cols = np.flatnonzero(part == i), np.flatnonzero(part == j)
        if not len(rows) or not len(cols):
            return pd.DataFrame({"a": [], "b": []})
        names = {r: n for n, r in enumerate(dict.fromkeys(root))}
        own = np.array([names[r] for r in root])
        size = np.array([len(s) for s in sets])
        both = common([sets[k] for k in rows], [sets[k] for k in cols])
        near = denominator * both >= numerator * (size[rows][:, None] + size[cols][None, :] - both)
        near &= own[rows][:, None] != own[cols][None, :]
        roots, out = list(names), []
        above = list(range(len(roots)))

        def top(x: int) -> int:
            while above[x] != x:
                above[x] = x = above[above[x]]
            return x

        for x, y in {(own[rows[p]], own[cols[q]]) for p, q in zip(*np.nonzero(near))}:
            tx, ty = top(x), top(y)
            if tx != ty:
                above[tx] = ty
                out.append((roots[x], roots[y]))
        return pd.DataFrame(out, columns=["a", "b"])

    return run


def near_duplicates(docs: DataFrame, numerator: int = NUMERATOR, denominator: int = DENOMINATOR) -> DataFrame:
    """Near-duplicate components of documents (columns doc_id and text; others are ignored).

    Words are separated by ASCII white space and lower-cased in A-Z; a set holds the distinct 5-word
    shingles, or the whole sequence where there are fewer words.  Documents whose sets have a Jaccard
    similarity of at least numerator/denominator are linked.  One row per input row:
    doc_id, n_shingles, component_id (smallest doc_id reachable), kept (doc_id = component_id).

    Null, empty or wordless text: n_shingles 0, linked with nothing, kept.  Repeated rows: each comes
    out, linked as any copy.  Several texts under one id: each row is linked by its own text.  A null
    doc_id takes no part: component_id null, kept true.  An empty table gives no rows.

    The work is done when this is called; the result is stored.
    """
    return settled(docs.sparkSession, "near-duplicates", lambda: _components_of(docs, numerator, denominator))


def keep_one(docs: DataFrame, numerator: int = NUMERATOR, denominator: int = DENOMINATOR) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) with one row of each group of near duplicates.

    Rows are judged by their own texts: of a group the row with the smallest doc_id stays (null last), of
    several texts under that id the one with the smallest digest, of equal rows any.  Rows whose text has
    no word all stay.
    """
    found = settled(docs.sparkSession, "near-groups", lambda: _groups(docs, numerator, denominator, nameless=True)[0])
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id"), F.col("text_key"))).alias("m")
    kept = found.groupBy("component").agg(first).select(F.coalesce("m.doc_id", F.lit(0)).alias("_id"), "m.nameless", F.col("m.text_key").alias("_key"))
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    keyed = docs.filter(worded).withColumns({"_id": F.coalesce("doc_id", F.lit(0)), "nameless": F.col("doc_id").isNull(), "_key": F.md5("text")})
    own = keyed.join(kept, ["_id", "nameless", "_key"], "left_semi").dropDuplicates(["_id", "nameless", "_key"])
    return own.select(*docs.columns).unionByName(docs.filter(~worded))


def _components_of(docs: DataFrame, numerator: int, denominator: int) -> DataFrame:
    groups, signed = _groups(docs, numerator, denominator)
    smallest = groups.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    placed_ids = groups.join(smallest, "component").select("node", "component_id")
    out = signed.select("doc_id", "n_shingles", F.expr("if(doc_id is null, null, node)").alias("node")).join(placed_ids, "node", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def _groups(docs: DataFrame, numerator: int, denominator: int, nameless: bool = False) -> tuple[DataFrame, DataFrame]:
    """(node, doc_id, text_key, component) of each distinct set, and the signed rows.

    doc_id and text_key are those of the set's first row; rows without id take part if ``nameless``.
    """
    rows = docs.select("doc_id", "text", F.md5("text").alias("text_key"))
    signed = materialise(
        rows.mapInArrow(_sign(bands_for(numerator, denominator)), "doc_id long, text_key string, n_shingles long, node binary, bands array<long>"), "dedup-signed"
    )
    named = signed.filter("n_shingles > 0" if nameless else "doc_id is not null and n_shingles > 0")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id"), F.col("text_key"))).alias("m")
    nodes = materialise(
        named.groupBy("node").agg(first, F.first("bands").alias("bands")).select("node", "m.doc_id", "m.text_key", "bands"),
        "dedup-nodes",
    )
    each = nodes.select("node", F.explode("bands").alias("band"))
    # Sums by band or leader are stored before they are joined back, so that both sides of the join are plain
    # shuffles and the planner may split a hot key's rows over tasks.
    shared = materialise(each.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1"), "dedup-shared")
    members = materialise(each.join(shared, "band"), "dedup-members")
    weight = members.groupBy("node").agg(F.sum("n").alias("weight"))
    best = members.join(weight, "node").groupBy("band").agg(F.max(F.struct("weight", "node")).alias("top"))
    leaders = materialise(best.select("band", F.col("top.node").alias("a")), "dedup-leaders")
    stars = materialise(
        members.join(leaders, "band").filter("node <> a").select("a", F.col("node").alias("b")).distinct(), "dedup-stars"
    )
    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", "doc_id", "text_key")
    same = ["_id", "nameless", "text_key"]
    keyed = {"_id": F.coalesce("doc_id", F.lit(0)), "nameless": F.col("doc_id").isNull()}
    texts = rows.withColumns(keyed).drop("doc_id").join(wanted.withColumns(keyed).drop("doc_id"), same).dropDuplicates(same).select("node", "text")
    texts = materialise(texts, "dedup-texts")
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("left_text"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("right_text"))
    sided = stars.join(right, "b").join(left, "a").select("a", "b", "left_text", "right_text")
    links = materialise(sided.mapInArrow(_linked(numerator, denominator), "a binary, b binary"), "dedup-links")
    groups = components(links)

    # Pairs of one bucket meet among all that met the bucket's leader.
    met = stars.select(F.col("a").alias("leader"), F.col("b").alias("node"))
    met = met.unionByName(met.select("leader", F.col("leader").alias("node")).distinct())
    met = met.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    main = met.filter("node = leader").select("leader", F.col("root").alias("main"))
    met = materialise(met.join(main, "leader").withColumn("open", F.expr("root <> main")).drop("main"), "dedup-met")
    texts = texts.withColumn("size", F.octet_length("text").cast("long"))
    tally = {f"{k}_n": F.expr(f"count_if(open = {k})") for k in ("true", "false")}
    tally |= {f"{k}_b": F.expr(f"sum(if(open = {k}, size, 0))") for k in ("true", "false")}
    sizes = met.join(texts.select("node", "size"), "node").groupBy("leader").agg(*(c.alias(k) for k, c in tally.items()))
    parts = {k: F.ceil(F.greatest(F.col(f"{k}_n") / BLOCK_ROWS, F.col(f"{k}_b") / BLOCK_BYTES)).cast("int") for k in ("false", "true")}
    sizes = sizes.filter("true_n > 0").select("leader", parts["false"].alias("closed_parts"), parts["true"].alias("open_parts"))
    sizes = materialise(sizes, "dedup-sizes")
    own = F.expr("if(open, closed_parts + pmod(xxhash64(node), open_parts), pmod(xxhash64(node), closed_parts))").cast("int")
    cells = F.expr(
        "if(open, concat(transform(sequence(0, part), i -> named_struct('i', i, 'j', part)), "
        "transform(filter(sequence(part, closed_parts + open_parts), k -> k > part and k < closed_parts + open_parts), k -> named_struct('i', part, 'j', k))), "
        "transform(sequence(closed_parts, closed_parts + open_parts - 1), k -> named_struct('i', part, 'j', k)))"
    )
    cells = met.join(sizes, "leader").withColumn("part", own).select("leader", "node", "root", "part", F.explode(cells).alias("c"))
    blocks = cells.join(texts, "node").select("leader", "c.i", "c.j", "part", "root", "text")
    bridges = materialise(
        blocks.groupBy("leader", "i", "j").applyInPandas(_bridges(numerator, denominator), "a binary, b binary"), "dedup-bridges"
    )
    again = components(bridges).select(F.col("node").alias("root"), F.col("root").alias("final"))

    ids = nodes.select("node", "doc_id", "text_key").join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = ids.join(again, "root", "left").select("node", "doc_id", "text_key", F.coalesce("final", "root").alias("component"))
    return ids, signed
