"""The pipeline against its stages done by hand on a small corpus."""

import random
from pathlib import Path

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from croploom.llm import pieces
from croploom.session import shared_dir

KEY = "AKIA" + "QZ7M" * 4


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rnd = random.Random(1)
    tongue = {"aa": "the of and from with under river stone paper green".split(), "bb": "zql wrk xev jupi ovvo krall mizz tharn quop belk".split()}
    say = lambda k, n: " ".join(rnd.choice(tongue[k]) + rnd.choice(["", "s", "er"]) for _ in range(n))
    exam = say("aa", 30)
    rows = [(i, say(k, 60), k, "s", 1) for i, k in enumerate(["aa", "bb"] * 30)]
    clean = [r[0] for r in rows]
    rows += [(100, rows[0][1], "aa", "s", 1), (101, rows[2][1] + " extra", "aa", "s", 1), (0, rows[0][1], "aa", "s", 1)]
    rows += [(200, say("aa", 20) + " " + exam[40:] + " " + say("aa", 9), None, None, 1)]
    rows += [(300, say("bb", 30) + f" {KEY} " + say("bb", 5), "bb", "s", 1), (301, say("aa", 12), None, None, None), (None, say("bb", 12), None, "s", 5)]
    rows += [(400, "", "aa", "s", 0), (401, None, "aa", "s", None), (402, "12 !! ##", None, "s", 8)]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, exam), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, clean


def test_run(spark, corpus):
    path, rows, clean = corpus
    folder = Path(shared_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    out = P.run(spark, path)
    left = set(folder.iterdir()) - before
    assert [p.name.rsplit("-", 1)[0] for p in left] == ["pipeline-segment"]
    out = out.collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(map(str, [*clean, 300, 301, None]))
    texts = dict((r[0], r[1]) for r in rows)
    model = pieces.pieces(public_tokenizers.path("piece_bpe_32k.model"))
    for r in out:
        assert r.lossless and r.n_ids == len(r.ids)
        import numpy as np

        text = pieces.decode_ids(model, np.array(r.ids), np.array([0, len(r.ids)]))[0]
        assert text == texts[r.doc_id].replace(KEY, "[SECRET]")


def test_stages_keep_the_columns(spark, corpus):
    path, rows, _ = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes], name
        assert stage(spark, docs.limit(0), path).count() == 0
    red = {r.doc_id: r for r in P.redact(spark, docs, path).collect()}
    assert red[300].n_chars == len(red[300].text) and red[1].n_chars == 1
    filled = {r.doc_id: r.lang for r in P.language(spark, docs, path).collect()}
    assert filled[301] == "aa" and filled[None] == "bb"
    nothing = docs.withColumn("lang", F.lit(None).cast("string"))
    assert P.language(spark, nothing, path).filter("doc_id >= 400").count() == 0
    assert [n for n, _ in P.STAGES] == ["language", "near_dedup", "decontaminate", "redact", "segment"]


def test_near_copies_from_a_similarity_of_080_go(spark, tmp_path):
    words = [f"w{i}" for i in range(104)]  # 100 shingles; a change inside costs five of each
    changed = lambda at: " ".join("x" if i in at else w for i, w in enumerate(words))
    rows = [(1, " ".join(words)), (2, changed([20, 60])), (11, " ".join(f"v{w}" for w in words)), (12, " ".join(f"v{w}" if i not in (20, 60, 90) else "x" for i, w in enumerate(words)))]
    docs = spark.createDataFrame([(i, t, "aa", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert 0.80 <= 90 / 110 < 0.85 and 85 / 115 < 0.80
    assert sorted(r.doc_id for r in P.near_dedup(spark, docs, str(tmp_path)).collect()) == [1, 11, 12]
