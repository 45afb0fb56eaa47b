"""Separator scans against a walk over the ids."""

import random

import numpy as np
import public_tokenizers
import pytest

from croploom.llm import tokencount as T

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def walk(ids, end):
    out, start = [], 0
    for i, x in enumerate(ids):
        if x == end:
            out.append((start, i + 1 - start, True))
            start = i + 1
    if start < len(ids):
        out.append((start, len(ids) - start, False))
    return out


@pytest.mark.parametrize("width,group", [(2, 1024), (4, 3)])
def test_blocks(spark, monkeypatch, width, group):
    monkeypatch.setattr(T, "GROUP", group)
    rnd = random.Random(width)
    files = {"a": 40, "b": 1, "c": 17, "none": 0, "long": 60}
    rows, want = [], []
    for name, n in files.items():
        ids = []
        for b in range(max(1, n)):
            part = [] if n == 0 else [9 if rnd.random() < (0.01 if name == "long" else 0.3) else rnd.randrange(8) for _ in range(rnd.choice([0, 1, 5, 7]))]
            rows.append((name, b * 2, np.array(part, f"<u{width}").tobytes() if part or rnd.random() < 0.5 else None))
            ids += part
        want += [(name, i, *w) for i, w in enumerate(walk(ids, 9))]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "file string, block long, payload binary").selectExpr("*", "1 n", "2 ends", "3 part")
    got = sorted((r.file, r.ordinal, r.start, r.n_tokens, r.terminated) for r in T.count(df, 9, width).collect())
    assert got == sorted(want)
    assert T.count(df.limit(0), 9, width).count() == 0


def test_raw_files(spark, tmp_path):
    rng = np.random.default_rng(3)
    want = []
    for name in ("x.bin", "y.bin"):
        ids = rng.integers(0, 12, 5000)
        ids.astype("<u2").tofile(tmp_path / name)
        want += [(name, i, *w) for i, w in enumerate(walk(ids.tolist(), 3))]
    got = T.count(T.blocks_of_files(spark, str(tmp_path), block=64), 3).collect()
    assert sorted((r.file.rsplit("/", 1)[1], r.ordinal, r.start, r.n_tokens, r.terminated) for r in got) == sorted(want)


def test_documents(spark, tmp_path):
    rnd = random.Random(5)
    rows = [(i, " ".join(rnd.choice(["Étoile", "the", "x\n"]) for _ in range(rnd.choice([0, 3, 200])))) for i in range(60)]
    rows += [(70, None), (71, ""), (None, "no id"), (72, "word " * 90000), (3, rows[3][1]), (73, "<|endoftext|>")]
    T.write_flat(spark.createDataFrame(rows, "doc_id long, text string"), RANKS, str(tmp_path / "flat"))
    stored = spark.read.parquet(str(tmp_path / "flat"))
    got = sorted(((r.doc_id, r.n_tokens) for r in T.count_documents(stored).collect()), key=str)
    enc = T.encoder(RANKS)
    assert got == sorted(((d, len(enc.encode_ordinary(t or "")) + 1) for d, t in rows), key=str)
    T.write_flat(spark.createDataFrame([], "doc_id long, text string"), RANKS, str(tmp_path / "none"))
    assert T.count_documents(spark.read.parquet(str(tmp_path / "none"))).count() == 0
