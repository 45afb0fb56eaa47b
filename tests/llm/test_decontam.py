"""Windows of items in documents against plain Python, in one part and in several."""

import random
import re

import pytest

from croploom.llm import decontam as D

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return [(m.group(), m.start(), m.end()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))]


def brute(text, items, size):
    ws = words(text)
    hit, found = set(), set()
    for item, t in items:
        own = [w for w, *_ in words(t)]
        k = min(size, len(own))
        grams = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)} if k else set()
        for i in range(len(ws) - k + 1):
            if tuple(w for w, *_ in ws[i : i + k]) in grams:
                hit.update(range(i, i + k))
                if item is not None:
                    found.add(str(item))
    spans = []
    for i in sorted(hit):
        if spans and spans[-1][0] + spans[-1][1] == i:
            f, n, a, _ = spans[-1]
            spans[-1] = (f, n + 1, a, ws[i][2])
        else:
            spans.append((i, 1, ws[i][1], ws[i][2]))
    return len(ws), sorted(found), spans


@pytest.mark.parametrize("bound", [100_000, 40])
def test_spans_and_items(spark, bound):
    rnd = random.Random(bound)
    vocab = ["Ab", "cd", "é", "字9", "x1", "to", "OF", "end"]
    say = lambda n: rnd.choice(["", " ", "- "]).join([""]) + rnd.choice([" ", ", ", "_ "]).join(rnd.choice(vocab) for _ in range(n))
    items = [(i, say(rnd.choice([1, 3, 4, 5, 9, 14]))) for i in range(12)] + [(12, None), (13, " -- "), (None, say(4)), (3, say(6)), (10, "AB cd"), (10, "ab, CD")]
    items = [x for x in items if x[1] is None or len(words(x[1])) != 1] + [(77, "zebra")]
    docs = [(i, say(rnd.choice([0, 1, 3, 20, 60]))) for i in range(40)]
    docs += [(50, None), (51, ""), (52, "a zebra. Zebra_zebra"), (52, "a zebra. Zebra_zebra"), (None, items[0][1]), (53, "é " * 30000 + (items[0][1] or ""))]
    df = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(docs)], "doc_id long, text string, row long").selectExpr("*", "1 items", "'x' spans", "2 n_words")
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "0 words", "9 k")
    got = {r.row: (r.n_words, r["items"], [tuple(s) for s in r.spans]) for r in D.decontaminate(df, bench, 4, bound).collect()}
    for n, (_, t) in enumerate(docs):
        assert got[n] == brute(t, items, 4), docs[n]


def test_removal(spark):
    bench = spark.createDataFrame([(1, "one two three four")], "item_id long, text string")
    rows = [(1, "é say ONE, two three four! end"), (2, "clean"), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in D.remove(df, bench, window=4).collect()) == [2, 3]
    assert sorted(tuple(r) for r in D.remove(df, bench, whole=False, window=4).fillna("-").collect()) == [(1, "é say  ! end"), (2, "clean"), (3, "-")]
    assert D.remove(df.limit(0), bench).count() == 0
    assert D.remove(df, bench.limit(0)).count() == 3


def test_benchmark_windows_of_patterned_words_are_all_found(spark):
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    two = one.translate(str.maketrans("ab", "ba"))
    bench = spark.createDataFrame([(1, one), (2, two)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"x {one} y"), (2, f"x {two} y")], "doc_id long, text string")
    got = {r.doc_id: list(r["items"]) for r in D.decontaminate(docs, bench).collect()}
    assert got == {1: ["1"], 2: ["2"]}
