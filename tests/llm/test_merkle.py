import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from croploom.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain(rows):
    """The contract, written down with lists: doc_id and the seven results of each row."""
    def leaf(row, text):
        return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)))

    def tree(hashes):
        """Root and, for each leaf, (siblings left, siblings right) level by level."""
        paths, where, level = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
        while len(level) > 1:
            for k, at in enumerate(where):
                lo = at // 16 * 16
                paths[k].append((level[lo:at], level[at + 1 : lo + 16]))
                where[k] = at // 16
            level = [digest(*level[i : i + 16]) for i in range(0, len(level), 16)]
        return level[0], paths

    sources = {}
    for r in rows:
        sources.setdefault(r[1], []).append(r)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        sources[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        trees[s] = tree([leaf(r, r[4]) for r in sources[s]])
    if not rows:
        return []
    root, tops = tree([trees[s][0] for s in order])
    out = []
    for s, top in zip(order, tops):
        for r, path in zip(sources[s], trees[s][1]):
            text = r[4]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            h = leaf(r, text)
            for left, right in path + top:
                h = digest(*left, h, *right)
            proof = digest(*(x for left, right in path + top for x in left + right))
            out.append((r[0], leaf(r, r[4]), trees[s][0], root, proof, h, h == root))
    return out


def check(spark, rows, columns=()):
    df = spark.createDataFrame(rows, SCHEMA)
    for c in columns:
        df = df.withColumn(c, F.lit(7))
    got = [tuple(r) for r in merkle.manifest(df).collect()]
    assert sorted(got, key=str) == sorted(plain(rows), key=str)
    return got


def test_runs_of_sixteen_over_several_levels(spark):
    sizes = {"a": 1, "b": 15, "ä": 16, "c": 17, "B": 257, None: 300, "": 2, "d": 33}
    rows, n = [], 0
    for s, k in sizes.items():
        for _ in range(k):
            rows.append((n, s, None if n % 7 == 0 else "en", n % 11 or None, None if n % 13 == 0 else f"Text {n} Ä"))
            n += 1
    got = check(spark, rows, ("g", "h", "n", "idx", "run", "leaf", "root"))
    assert {r[6] for r in got} == {True, False}


def test_more_than_sixteen_sources_of_one_row(spark):
    check(spark, [(i, f"s{i}", "en", 3, "Abc") for i in range(40)])


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(5, None, None, None, None)],
        [(1, "a", "en", 1, "X")],
        [(1, "a", "en", 1, "X")] * 20,
        [(None, "a", "en", 1, "Xy"), (None, "a", "en", 1, "Z"), (3, "a", None, 1, ""), (3, "a", None, 1, "Q" * 300_000)],
        [(i, "*", "en", 1, "Same") for i in range(18)] + [(i, "", "en", 1, "Same") for i in range(3)],
    ],
    ids=["empty", "nulls", "one", "repeated", "ties", "names"],
)
def test_special_tables(spark, rows):
    check(spark, rows)


def test_tampered_rows_are_found(spark):
    rows = [(i, "s", "en", 5, "Upper" if i % 2 else "lower") for i in range(200)]
    for r in merkle.manifest(spark.createDataFrame(rows, SCHEMA)).collect():
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 5 != 0 or r.doc_id % 2 == 0)


def test_more_rows_than_a_recursion_returns_by_default(spark):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit", None)
    spark.conf.set("spark.sql.cteRecursionRowLimit", "50")
    try:
        check(spark, [(i, "s", "en", 5, "Upper") for i in range(300)])
        assert spark.conf.get("spark.sql.cteRecursionRowLimit") == "50"
    finally:
        spark.conf.set("spark.sql.cteRecursionRowLimit", before) if before else spark.conf.unset("spark.sql.cteRecursionRowLimit")
