"""Word hashing and near-duplicate components against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from croploom.llm import words as W
from croploom.llm.dedup import keep_one, near_duplicates

RULES = {
    "spaced": (W.SPACED, r"[^\x20\x09-\x0D]+"),
    "alnum": (W.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"),
}


def low(t):
    return re.sub("[A-Z]", lambda m: m.group().lower(), t or "")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAb Z0.é \n_字", max_size=40)), max_size=6), st.sampled_from(sorted(RULES)))
def test_words_are_those_of_the_pattern(texts, rule):
    kind, pattern = RULES[rule]
    data, off = W.buffers(pa.array(texts, pa.string()))
    w = W.Words(data, off, kind)
    want = [re.findall(pattern, low(t)) for t in texts]
    raw = bytes(kind.lower[data])
    assert [[raw[w.start[j] : w.end[j]].decode() for j in range(a, b)] for a, b in zip(w.first[:-1], w.first[1:])] == want
    flat = [x for ws in want for x in ws]
    known = {}
    for x, h in zip(flat, w.hash.tolist()):
        assert known.setdefault(x, h) == h
    assert len(set(known.values())) == len(known)


def test_hash_does_not_depend_on_place_or_chunk():
    big = "filler " * 60000 + "needle in hay"
    data, off = W.buffers(pa.array([big, "needle in hay"]))
    w = W.Words(data, off, W.SPACED)
    assert (w.hash[w.first[1] - 3 : w.first[1]] == w.hash[w.first[1] :]).all()
    pos, h = w.windows(3)
    assert h[-1] == h[-2] and len(h) == 60001 + 1


def brute(rows, num=85, den=100):
    sets = []
    for _, t in rows:
        ws = re.findall(r"[^\x20\x09-\x0D]+", low(t))
        sets.append({tuple(ws[i : i + 5]) for i in range(len(ws) - 4)} if len(ws) >= 5 else ({tuple(ws)} if ws else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is not None and rows[j][0] is not None and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                    root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        c = d
        if d is not None and sets[i]:
            c = min(rows[j][0] for j in range(len(rows)) if rows[j][0] is not None and sets[j] and find(j) == find(i))
        out.append((d, len(sets[i]), c, True if d is None else d == c))
    return sorted(out, key=str)


def got(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def made(seed=3):
    rnd = random.Random(seed)
    vocab = ["w%d" % i for i in range(300)]
    rows, n = [], 0
    for _ in range(12):
        base = [rnd.choice(vocab) for _ in range(rnd.randint(60, 200))]
        for _ in range(rnd.randint(1, 9)):
            t = list(base)
            for _ in range(rnd.randint(0, 4)):
                t[rnd.randrange(len(t))] = "X%d" % rnd.randrange(10**6)
            rows.append((n, " ".join(t)))
            n += 1
    rnd.shuffle(rows)
    return rows


def test_components_match_all_pairs(spark):
    rows = made() + [(900, None), (901, ""), (902, " \n"), (903, "a b"), (904, "A  b"), (905, "b a"), (None, "a b"), (903, "a b"), (906, "a b")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit(1)).withColumn("component_id", F.lit("x"))
    assert got(near_duplicates(df)) == brute(rows)


def test_chain_of_edits_is_one_component(spark):
    t = ["t%d" % i for i in range(200)]
    rows = []
    for i in range(40):
        t[i * 5] = "edit%d" % i
        rows.append((100 - i, " ".join(t)))
    want = brute(rows)
    assert len({r[2] for r in want}) == 1
    assert got(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == want


def test_a_loose_group_is_compared_in_blocks(spark, monkeypatch):
    from croploom.llm import dedup

    monkeypatch.setattr(dedup, "BLOCK_ROWS", 7)
    monkeypatch.setattr(dedup, "COLUMNS", 4000)
    rnd = random.Random(8)
    base = ["b%d" % i for i in range(160)]
    rows = []
    for i in range(70):
        t = list(base)
        for k in rnd.sample(range(5, 150), rnd.choice([1, 2, 3, 4])):
            t[k] = "e%d" % rnd.randrange(25 if i % 2 else 10**6)
        rows.append((1000 - i, " ".join(t)))
    want = brute(rows)
    assert 1 < len({r[2] for r in want}) < len(rows)
    assert got(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == want


def test_one_id_with_two_texts_and_empty_table(spark):
    rows = [(1, "a b c d e f"), (1, "g h i j k l"), (2, "g h i j k l"), (0, "a b c d e f")]
    assert got(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_signature_agreement_estimates_similarity():
    from croploom.llm.dedup import signature

    rng = np.random.default_rng(1)
    errors = []
    for _ in range(30):
        common, a, b = (W.mix(rng.integers(0, 1 << 62, n).astype(np.uint64)) for n in (340, 30, 30))
        h = np.concatenate([common, a, common, b])
        s = signature(h, np.array([0, 370]))
        errors.append((s[0] == s[1]).mean() - 340 / 400)
    assert abs(np.mean(errors)) < 0.03


def test_bands_follow_the_threshold(spark):
    from croploom.llm.dedup import bands_for

    assert bands_for(85, 100) == 25 and bands_for(1, 1) == 1
    for n in (50, 80, 85, 90):
        assert (1 - (n / 100) ** 5) ** bands_for(n, 100) <= 5e-7
    rows = made(5)
    assert got(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 80, 100)) == brute(rows, 80)


def thue_morse(n):
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return one, one.translate(str.maketrans("ab", "ba"))


def test_long_words_of_a_pattern_are_not_equal(spark):
    for n in (64, 1024, 4096):
        data, off = W.buffers(pa.array(thue_morse(n)))
        assert len(set(W.Words(data, off, W.SPACED).hash.tolist())) == 2
    a, b = thue_morse(2048)
    docs = spark.createDataFrame([(1, a), (2, b), (3, a)], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_duplicates(docs).collect()} == {1: 1, 2: 2, 3: 1}


def test_hash_of_words_over_several_chunks():
    long = "q" * (W.CHUNK - 3) + " " + "x" * (2 * W.CHUNK) + " tail " + "z" * 70
    for text in (long, " " + long, "a" + long):
        data, off = W.buffers(pa.array([text, *text.split(" ")]))
        w = W.Words(data, off, W.SPACED)
        assert w.hash[: w.first[1]].tolist() == w.hash[w.first[1] :].tolist()


def test_one_row_of_each_group_is_kept(spark):
    a, b = " ".join(f"w{i}" for i in range(40)), " ".join(f"v{i}" for i in range(40))
    rows = [(1, a, "x"), (2, a, "x"), (2, b, "clean"), (None, a, "n"), (None, b + " end", "n"), (None, "only here", "n"), (None, "only here", "n")]
    rows += [(5, "", "e"), (5, "", "e"), (6, None, "e"), (None, " \t", "e"), (7, "a b", "t"), (7, "a b", "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, node string")
    got = sorted(map(tuple, keep_one(df).collect()), key=str)
    want = [(1, a, "x"), (2, b, "clean"), (None, "only here", "n"), (5, "", "e"), (5, "", "e"), (6, None, "e"), (None, " \t", "e"), (7, "a b", "t")]
    assert got == sorted(want, key=str)
    assert keep_one(df.limit(0)).collect() == []
