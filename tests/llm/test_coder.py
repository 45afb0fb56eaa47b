"""Coded blocks: round trips, damage, and documents over block borders against the library's ids."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from croploom.llm import coder as C

PATH = public_tokenizers.path("word_bpe_49k.json")
LIB = Tokenizer.from_file(PATH)


@settings(max_examples=25, deadline=None)
@given(st.integers(1, 6), st.integers(1, 60), st.sampled_from([3, 40, 500, 49408, 300000]), st.integers(0, 10**6))
def test_blocks_round_trip(lanes, steps, vocabulary, seed):
    rng = np.random.default_rng(seed)
    ids = rng.integers(0, vocabulary, (lanes, steps))
    ids[rng.random((lanes, steps)) < 0.5] = vocabulary - 1
    coded = C.encode_blocks(ids, vocabulary)
    assert (C.decode_blocks(coded, steps, vocabulary) == ids).all()
    one = C.decode_blocks(coded[:1], steps, vocabulary)
    assert (one == ids[:1]).all() and C.encode_blocks(ids[:1], vocabulary) == coded[:1]


def test_long_blocks_round_trip_and_shrink():
    rng = np.random.default_rng(0)
    words = [rng.integers(0, 49408, rng.integers(1, 6)) for _ in range(300)]
    rows = [np.concatenate([words[min(int(rng.exponential(40)), 299)] for _ in range(6000)])[:6000] for _ in range(4)]
    ids = np.stack(rows)
    coded = C.encode_blocks(ids, 49408)
    assert (C.decode_blocks(coded, 6000, 49408) == ids).all()
    assert sum(map(len, coded)) < 0.4 * 2 * ids.size


def test_carries_run_through_full_words():
    words = np.array([[5, 0xFFFFFFFF, 0xFFFFFFFF, 0]], np.uint32)
    C._carry(words, np.array([3]), np.array([0]))
    assert words.tolist() == [[6, 0, 0, 0]]


@given(st.binary(max_size=50), st.binary(max_size=50))
def test_checksums_join(a, b):
    assert C.crc32_join(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aBé 字\n  #'s1<|endoftext|>é", max_size=60), min_size=1, max_size=5))
def test_ids_by_word_are_those_of_whole_texts(texts):
    from croploom.llm.words import buffers

    ids, n = C.WordIds(PATH).encode(*buffers(pa.array(texts)), 2)
    ends = np.concatenate([[0], np.cumsum(n)])
    for t, a, b in zip(texts, ends[:-1], ends[1:]):
        assert ids[a:b].tolist() == [*LIB.encode(t, add_special_tokens=False).ids, 2]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aTtSsDs9é\u0308\u0344 \n'.,|<>字", max_size=40), min_size=1, max_size=4))
def test_cut_and_lowered_words_have_the_ids_of_whole_texts(texts):
    from croploom.llm.words import buffers

    texts = [*texts, "<|ENDOFTEXT|> it<|endoftext|>S"] if len(texts) == 4 else texts
    ids, n = C.WordIds(PATH).encode(*buffers(pa.array(texts)), 2)
    want = [[*LIB.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert n.tolist() == list(map(len, want)) and ids.tolist() == sum(want, [])


def test_marks_and_case_make_no_new_words():
    from croploom.llm.words import buffers

    w = C.WordIds(PATH)
    w.encode(*buffers(pa.array(["Tree tree, (tree) TREE. don't", "DON'T tree; (Tree"])), 2)
    assert set(w.known) == {b"tree", b",", b"(tree", b")", b".", b"don", b"'t", b";"}


def test_words_of_one_hash_are_told_apart(monkeypatch):
    from croploom.llm.words import buffers

    class Same(C.Words):
        def __init__(self, *a):
            super().__init__(*a)
            self.hash = self.hash * np.uint64(0)

    monkeypatch.setattr(C, "Words", Same)
    t = "one two, six One"
    ids, _ = C.WordIds(PATH).encode(*buffers(pa.array([t])), 2)
    assert ids.tolist() == [*LIB.encode(t, add_special_tokens=False).ids, 2]


def test_forgetting_words_changes_nothing(monkeypatch):
    from croploom.llm.words import buffers

    monkeypatch.setattr(C.WordIds, "MOST", 3)
    w = C.WordIds(PATH)
    for t in ("one two three four", "two five six", "one one seven", ""):
        ids, _ = w.encode(*buffers(pa.array([t])), 2)
        assert ids.tolist() == [*LIB.encode(t, add_special_tokens=False).ids, 2]


def brute(rows):
    out, start = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*LIB.encode(t or "", add_special_tokens=False).ids, 2]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files(spark, tmp_path):
    rnd = random.Random(1)
    words = ["the", "Étoile", "#", "<|endoftext|>", "x" * 9, "neither"]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 1, 5, 90])))) for i in range(40)]
    rows += [(i, " ".join(rnd.choice(words) for _ in range(n))) for i, n in ((50, 12000), (51, 9000), (52, 3))]
    rows += [(None, "no id"), (100, None), (101, ""), (101, "")]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 file", "'x' block", "2 tie")
    path = str(tmp_path / "ids")
    C.write_ids(df, PATH, path)
    blocks = spark.read.parquet(path)
    got = sorted(tuple(r) for r in C.read_digests(blocks).collect() if r.doc_id is not None)
    assert got == [r for r in brute(rows) if r[0] is not None]
    broken = blocks.withColumn("checksum", F.col("checksum") + 1)
    with pytest.raises(Exception, match="damaged"):
        C.read_digests(broken)


def test_empty_table(spark, tmp_path):
    C.write_ids(spark.createDataFrame([], "doc_id long, text string"), PATH, str(tmp_path / "none"))
    assert C.read_digests(spark.read.parquet(str(tmp_path / "none"))).count() == 0


@pytest.mark.parametrize("n", [1, 127, 128, 257, 5000, 300_000])
def test_strands_of_a_block_share_what_they_learn(n):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, 49408, 1000)[np.minimum(rng.exponential(100, n).astype(int), 999)]
    ids[::7] = ids[0]
    coded = C.encode_block(ids, 49408)
    assert (C.decode_block(coded, n, 49408) == ids).all()
    if n == 300_000:
        seen = np.bincount(ids) / n
        assert len(coded) < 1.1 * n * -(seen[seen > 0] * np.log2(seen[seen > 0])).sum() / 8
    cut = C.decode_block(coded[: len(coded) // 8 * 4], n, 49408)
    assert len(cut) == n and cut.max() < 49408


def test_documents_over_many_blocks(spark, tmp_path):
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice(["the", "Étoile,", "#9", "neither"]) for _ in range(rnd.choice([0, 1, 5, 90, 2000])))) for i in range(60)]
    path = str(tmp_path / "ids")
    C.write_ids(spark.createDataFrame(rows, "doc_id long, text string").repartition(1), PATH, path, block=300)
    blocks = spark.read.parquet(path)
    assert blocks.agg(F.max("n_ids")).first()[0] == 300
    assert sorted(tuple(r) for r in C.read_digests(blocks).collect()) == brute(rows)


def test_words_of_letters_have_the_ids_of_whole_texts():
    from croploom.llm.words import buffers

    letters = [c for c in map(chr, range(0x110000)) if c.isalpha() and not 0x3400 <= ord(c) < 0xAC00 and ord(c) < 0x20000][::3]
    texts = [" ".join(f"{c}a a{c} {c}" for c in letters[k : k + 40]) for k in range(0, len(letters), 40)]
    w = C.WordIds(PATH)
    assert w.closing is not None
    ids, n = w.encode(*buffers(pa.array(texts)), 2)
    ends = np.cumsum(n)
    for t, a, b in zip(texts, ends - n, ends):
        assert ids[a:b].tolist() == [*LIB.encode(t, add_special_tokens=False).ids, 2]


@given(st.lists(st.sampled_from(["", "a", "b", "x" * 7, "x" * 8, "x" * 9, "x" * 64, "x" * 65, "x" * 64 + "y", "x" * 200]), min_size=1, max_size=6), st.integers(0, 5))
def test_runs_of_bytes_are_compared(runs, k):
    data = np.frombuffer("".join(runs).encode(), np.uint8)
    size = np.array([len(r) for r in runs if r], np.int64)
    at = np.cumsum(size) - size
    other = np.roll(at, k)
    known = [r for r in runs if r]
    same = np.flatnonzero(np.roll(size, k) == size)
    want = all(known[i] == np.roll(np.array(known, object), k)[i] for i in same)
    assert C._equal(data, at[same], other[same], size[same]) == want
    assert C._spread(at[same], size[same]).tolist() == [j for i in same for j in range(at[i], at[i] + size[i])]


def test_places_of_hashes_are_found_after_growing():
    rng = np.random.default_rng(3)
    hashes = np.unique(rng.integers(0, 1 << 62, 30_000).astype(np.uint64) << np.uint64(10))  # all meet in few slots
    hashes[:5000] = np.unique(rng.integers(0, 1 << 62, 6000).astype(np.uint64))[:5000]
    hashes = rng.permutation(np.unique(hashes))
    p = C._Places()
    for lo in range(0, 9000, 700):
        part = hashes[lo : lo + 700]
        assert (p.find(part) == -1).all()
        p.add(part)
    assert (p.find(hashes[:9100]) == np.arange(9100)).all() and (p.find(hashes[9100:]) == -1).all()


def test_words_of_all_lengths_have_the_ids_of_whole_texts():
    from croploom.llm.words import buffers

    texts = [" ".join("ab1é"[k % 4] * n + "x" * (k % 3) for k in range(4)) for n in [*range(1, 30), 63, 64, 65, 130, 5000]]
    texts += [t + "\x00" for t in texts] + ["a\x00 a", "  　 a", "İİ ß ﬁ ǅ", "é é"]
    w = C.WordIds(PATH)
    for _ in range(2):
        ids, n = w.encode(*buffers(pa.array(texts)), 2)
        want = [[*LIB.encode(t, add_special_tokens=False).ids, 2] for t in texts]
        assert n.tolist() == list(map(len, want)) and ids.tolist() == sum(want, [])
