import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from croploom.llm import toxicity as T

TERMS = [T.Term("idiot"), T.Term("moron"), T.Term("scum"), T.Term("worthless"), T.Term("disgust", stem=True), T.Term("vequ", stem=True), T.Term("disco")]
MARKS = [T.Term("said", kind=T.REPORTS), T.Term("you", kind=T.ADDRESSES)]
MODEL = T.Model(TERMS + MARKS, {})


def distance(a: str, b: str) -> int:
    """Edits with neighbours in the wrong order as one, by the table of all prefixes."""
    d = {(-1, -1): 0}
    for i in range(-1, len(a)):
        for j in range(-1, len(b)):
            if i < 0 or j < 0:
                d[i, j] = max(i, j) + 1
                continue
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i] != b[j]))
            if i and j and a[i] == b[j - 1] and a[i - 1] == b[j]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a) - 1, len(b) - 1]


def plain_match(word: str, terms):
    """(term, edits) by comparing with every term."""
    word = "".join(T.LOOKS.get(c, c.lower()) for c in word)
    best = []
    for t, term in enumerate(terms):
        if not word or word[0] != term.text[0]:
            continue
        cuts = [word[:k] for k in range(1, len(word) + 1)] if term.stem else [word]
        e = min(distance(c[1:], term.text[1:]) for c in cuts)
        if e <= term.edits:
            best.append((e, -len(term.text), t))
    return (min(best)[2], min(best)[0]) if best else None


def plain_hits(text, model=MODEL):
    """Hits as (start, stop, term, edits, quoted, value), and the number of words."""
    ws = [(m.start(), m.end(), plain_match(m[0], model.terms)) for m in re.finditer(r"[^\W_]+", text or "")]
    out = []
    for i, (a, b, m) in enumerate(ws):
        if not m or model.terms[m[0]].kind != T.HIT:
            continue
        lo = max(text.rfind("\n", 0, a) + 1, a - T.REACH)
        hi = min(text.find("\n", a) if "\n" in text[a:] else len(text), a + T.REACH)
        before, after = text[lo:a], text[a:hi]
        quoted = (before.count('"') % 2 == 1 and '"' in after) or (
            sum(before.count(c) for c in "“„«") > sum(before.count(c) for c in "”»") and any(c in after for c in "”»")
        )
        marks = {model.terms[w[2][0]].kind for w in ws[max(0, i - T.WINDOW) : i + T.WINDOW + 1] if w[2] and abs(w[0] - a) < T.REACH}
        factor = T.QUOTED * (T.REPORTED if T.REPORTS in marks else 1) if quoted else T.ADDRESSED if T.ADDRESSES in marks else 1
        out.append((a, b, m[0], m[1], quoted, T.DEFAULT * T.FUZZY ** m[1] * factor))
    return out, len(ws)


def found(texts):
    h = T.find(texts, MODEL, MODEL.classes())
    rows = list(zip(h.doc.tolist(), h.start.tolist(), h.stop.tolist(), h.term.tolist(), h.edits.tolist(), h.quoted.tolist(), h.value.tolist()))
    return rows, h


def check(texts):
    rows, h = found(texts)
    want = [(i, *x) for i, t in enumerate(texts) for x in plain_hits(t)[0]]
    assert [r[:6] for r in sorted(rows)] == [w[:6] for w in want]
    assert np.allclose([r[6] for r in sorted(rows)], [w[6] for w in want])
    assert h.words.tolist() == [plain_hits(t)[1] for t in texts]


def test_automaton_agrees_with_comparing_every_term():
    rng = random.Random(5)
    words = {t.text for t in TERMS}
    for _ in range(6000):
        w = list(rng.choice([t.text for t in TERMS]))
        for _ in range(rng.randrange(4)):
            k = rng.randrange(len(w) + 1)
            kind = rng.randrange(4)
            if kind == 0:
                w.insert(k, rng.choice("idotvxé0"))
            elif kind == 1 and k < len(w):
                w[k] = rng.choice("idotvx1")
            elif kind == 2 and k < len(w) and len(w) > 1:
                del w[k]
            elif kind == 3 and k + 1 < len(w):
                w[k], w[k + 1] = w[k + 1], w[k]
        words.add("".join(w) + rng.choice(["", "", "s", "ing"]))
    check([" ".join(sorted(words))])


def test_misspellings_are_found_and_ordinary_words_are_not():
    texts = ["an idoit", "an Idi0t!", "a morron", "wrothless", "disgusted", "vequille", "an idea, a scam, oron, scums"]
    got = [{TERMS[r[3]].text for r in found([t])[0]} for t in texts]
    assert got == [{"idiot"}, {"idiot"}, {"moron"}, {"worthless"}, {"disgust"}, {"vequ"}, set()]


def test_context_windows():
    texts = [
        'He said "you idiot" to them.',
        "You idiot, go.",
        'An "open idiot',
        "«idiot» and idiot",
        "“idiot” said they\nidiot",
        '"a"\n"idiot" moron "scum"',
        "idiot " * 30 + "said " + '"scum"',
        None,
        "",
        "... !!",
    ]
    check(texts)
    value = [sum(r[6] for r in found([t])[0]) for t in texts[:3]]
    assert value[0] < value[2] < value[1]


def test_long_texts_are_cut_without_a_trace(monkeypatch):
    rng = random.Random(1)
    bits = ["idiot", "moron,", '"', "said", "you", "the", "worthles", "xx" * 40, "\n", "«", "»", "é"]
    text = " ".join(rng.choice(bits) for _ in range(4000))
    whole = found([text, "scum", text[::-1], "x" * 5000 + " idiot"])[0]
    monkeypatch.setattr(T, "PIECE", 700)
    assert sorted(found([text, "scum", text[::-1], "x" * 5000 + " idiot"])[0]) == sorted(whole)
    check([text])


def test_scores_follow_from_the_hits(spark):
    texts = ["you idiot", "an idiot moron scum idoit " + "word " * 50, None, "", "plain words", "you idiot", "disgusting " * 3]
    df = spark.createDataFrame([(i, t, 1.0, "x") for i, t in enumerate(texts)], "doc_id long, text string, score double, term string")
    rows = sorted(T.score(df, MODEL).collect())
    assert [r.doc_id for r in rows] == list(range(len(texts)))
    for r, t in zip(rows, texts):
        hits, words = plain_hits(t)
        total = sum(h[5] for h in hits)
        x = [1, math.log1p(total), max([h[5] for h in hits], default=0), math.log1p(len({h[2] for h in hits})), math.log1p(100 * total / max(words, 1))]
        assert r.score == pytest.approx(1 / (1 + math.exp(-sum(a * b for a, b in zip(x, MODEL.weights)))))
        assert [(s.start, s.stop, s.term.rstrip("*"), s.edits, s.quoted) for s in r.toxic_spans] == [(h[0], h[1], TERMS[h[2]].text, *h[3:5]) for h in hits]
    assert rows[2].score == rows[3].score == rows[4].score < 0.3 and rows[0].score == rows[5].score


def corpus(n=600):
    rng = random.Random(2)
    syllables = "ba ke lo mi nu sa te vi".split()
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(60)]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                words[rng.randrange(60)] = rng.choice(["zurg", "quofel" + rng.choice(syllables)])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_terms_are_learned_and_held_out_documents_judged(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = T.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    own = {(t.text, t.stem) for t in model.terms[:2]}
    assert own == {("zurg", False), ("quofel", True)}
    got = {r.doc_id: r.score for r in T.score(docs, model).collect()}
    for i, toxic in labels:
        if zlib.crc32(str(i).encode()) % 4 == 2:
            assert (got[i] >= 0.3) == bool(toxic)


def test_labels_of_held_out_documents_teach_nothing(spark):
    rows, labels = corpus(200)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    turned = [(i, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, t in labels]
    a, b = (T.learn(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, turned))
    assert (a.terms, a.odds, a.weights) == (b.terms, b.odds, b.weights)


def test_copies_of_a_toxic_text_teach_no_ordinary_words(spark):
    rows, labels = corpus(300)
    copies = [(1000 + i, "plain ordinary passage of many words zurg that somebody copied around " + str(i)) for i in range(200)]
    docs = spark.createDataFrame(rows + copies, "doc_id long, text string")
    model = T.learn(docs, spark.createDataFrame(labels + [(i, 1) for i, _ in copies], "doc_id long, toxic int"))
    assert not {"plain", "ordinary", "passage", "somebody"} & {t.text for t in model.terms}


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, 0)], [(None, 1), (1, None), (1, 7)], [(1, 1), (1, 0)] * 50])
def test_few_or_odd_labels(spark, labels):
    docs = spark.createDataFrame([(1, "idiot"), (1, None), (None, "fine"), (1, "idiot"), (2, "x" * 200_000)], "doc_id long, text string")
    model = T.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert sorted(r.score > 0 for r in T.score(docs, model).collect()) == [True] * 5
    assert T.score(docs.limit(0), model).collect() == []


def test_sample_is_bounded_and_never_empty(spark):
    rows, labels = corpus(400)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sample, counts = T.labelled(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), toxic=5, clean=7)
    assert {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()} == {1: 5, 0: 7}
    assert counts == {k: sum(zlib.crc32(str(i).encode()) % 4 != 2 and t == k for i, t in labels) for k in (0, 1)}


def test_held_out_accuracy_on_the_tables(spark):
    from croploom.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").filter("toxic is not null").select("doc_id", "toxic")
    rows = QUERIES["op13_toxicity"](spark, sf).join(labels, "doc_id").filter("held_out").collect()
    wrong = sum(r.predicted == 1 and r.toxic == 0 for r in rows)
    assert sum(r.predicted == 1 and r.toxic == 1 for r in rows) >= 0.6 * sum(r.toxic for r in rows) and wrong <= len(rows) / 50
