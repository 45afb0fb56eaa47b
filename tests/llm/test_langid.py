"""Hyperdimensional vectors against letter-by-letter sums, and accuracy on texts not learned from."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from croploom.llm import langid as L


def brute(text, size):
    own = {}

    def vec(c):
        return own.setdefault(c, L.letter_vectors(np.array([c], np.uint32), size)[0].astype(np.int64))

    pts = [0, *(ord(c) if c.isalpha() and L.letters()[ord(c)] else 0 for c in text.lower()), 0]
    total = np.zeros(size, np.int64)
    for a, b, c in zip(pts, pts[1:], pts[2:]):
        if b:
            total += np.roll(vec(a), 2) * np.roll(vec(b), 1) * vec(c)
    return total


@pytest.mark.parametrize("piece,block,cells", [(1 << 20, 4096, 1 << 22), (50, 7, 40)])
def test_vectors_are_sums_of_bound_letters(monkeypatch, piece, block, cells):
    monkeypatch.setattr(L, "PIECE", piece)
    monkeypatch.setattr(L, "BLOCK", block)
    monkeypatch.setattr(L, "CELLS", cells)
    texts = ["Éa b1c dd", None, "", "漢字かな abc" * 20, "x", "the quick brown Fox. " * 9, "12 34"]
    got = L.document_vectors(texts, 128)
    for t, v in zip(texts, got):
        assert (v == brute(t or "", 128)).all()


def test_learning_skips_held_out_and_unlabelled_rows(spark):
    words = {"aa": "lorem ipsum dolor sit amet ", "bb": "wkrz xqj vvw kzz pqr "}
    rows = [(i, words[k] * 3, k) for i, k in enumerate(["aa", "bb"] * 30)]
    rows += [(1000 + i, "zzz zzz", "only_held_out") for i in range(400) if zlib.crc32(str(1000 + i).encode()) % 3 == 1]
    rows += [(5000, "text", None), (5001, None, "no_text"), (None, "text text", "no_id")]
    langs, protos = L.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert langs == ["aa", "bb"] and protos.shape == (2, L.SIZE)
    probe = [(1, "Lorem, IPSUM dolor", "s"), (2, "vvw xqj", "s"), (3, None, "s"), (4, "12 !", "s"), (5, "", "s"), (1, "Lorem, IPSUM dolor", "s")]
    out = L.identify(spark.createDataFrame(probe, "doc_id long, text string, score string"), langs, protos).collect()
    assert sorted((r.doc_id, r.lang_pred) for r in out) == [(1, "aa"), (1, "aa"), (2, "bb"), (3, "und"), (4, "und"), (5, "und")]
    assert all(0 <= r.score <= 1 for r in out)
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert L.learn(empty)[0] == []
    assert L.identify(spark.createDataFrame(probe, "doc_id long, text string, score string"), *L.learn(empty)).filter("lang_pred <> 'und'").count() == 0


def test_held_out_accuracy(spark, sf):
    from croploom.llm.queries import op2_language_id, table

    found = op2_language_id(spark, sf).join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert found and sum(r.lang == r.lang_pred for r in found) >= 0.95 * len(found)


def test_samples_never_go_empty(spark):
    rows = spark.range(100_000).select("id", F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    for n in (1e5, 1e11, 1e15):
        share = L.taken(F.lit(n), int(n / 500), F.col("id"), F.col("text"))
        assert 100 < rows.filter(share).count() < 320
    assert rows.filter(L.taken(F.lit(5), 20, F.col("id"))).count() == 100_000
    tiny = L.taken(F.lit(1e15), 1_000_000, F.col("id"), F.col("text"))
    assert spark.range(1).select(F.lit(1e6) / F.lit(1e15)).first()[0] > 0 and rows.filter(tiny).count() == 0


def test_rare_languages_are_learned_beside_frequent_ones(spark):
    rows = [(i, f"the river and the stone under paper green {i}", "aa") for i in range(400)] + [(1000 + i, f"zql wrk xev jupi ovvo krall {i}", "bb") for i in range(6)]
    languages, prototypes = L.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), train_docs=20)
    assert languages == ["aa", "bb"] and (prototypes != 0).any(axis=1).all()
