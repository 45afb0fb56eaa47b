"""Benchmark decontamination with a broadcast hash set of the benchmark's word windows.

The windows of all benchmark items are brought to the tasks as sorted hashes with their words.  Tasks
hash every word window of every text with array arithmetic, look the hashes up, and compare the words
of each find, so that a result never rests on a hash.  The broadcast set is counted first: a benchmark
of more than ``WINDOWS`` distinct (window, item) pairs is split by hash into parts of about that many,
which go over the texts one after the other; a window that very many items share is in several parts.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from croploom.llm.words import ALNUM, U64, Words, buffers, fold, slices
from croploom.session import materialise

WINDOW = 10
WINDOWS = 100_000  # (window, item) pairs in one broadcast: about 10 MB
_BITS = 20


def _texts_of(w: Words, low: np.ndarray, i: int, k: int) -> bytes:
    return b" ".join(low[w.start[j] : w.end[j]].tobytes() for j in range(i, i + k))


def _item_windows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column("text"))
            w, low = Words(data, off, ALNUM), ALNUM.lower[data]
            ids, found = batch.column("item_id").to_pylist(), defaultdict(set)
            for d, (a, b) in enumerate(zip(w.first[:-1], w.first[1:])):
                k = min(size, int(b - a))
                for i in range(a, b - k + 1) if k else ():
                    found[k, _texts_of(w, low, i, k)].add(ids[d])
            rows = [(k, t, x) for (k, t), items in found.items() for x in items]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.string())],
                names=["k", "words", "item_id"],
            )

    return run


class WindowSet:
    """Benchmark windows by length: sorted hashes, a bit table in front of them, words and items."""

    def __init__(self, rows: list[tuple[int, bytes, list[str]]]) -> None:
        self.by_length = {}
        for k in sorted({r[0] for r in rows}):
            own = [r for r in rows if r[0] == k]
            data = np.frombuffer(b" ".join(r[1] for r in own), np.uint8)
            hashes = fold_all(Words(data, np.array([0, len(data)]), ALNUM).hash.reshape(len(own), k))
            bits = np.zeros(1 << _BITS, bool)
            bits[hashes >> U64(64 - _BITS)] = True
            self.by_length[k] = (bits, {int(h): (r[1], r[2]) for h, r in zip(hashes, own)})


def fold_all(h: np.ndarray) -> np.ndarray:
    return fold([h[:, j] for j in range(h.shape[1])])


def _scan(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = shared.value.by_length
        for whole in batches:
            for batch in slices(whole, "text"):
                data, off = buffers(batch.column("text"))
                w, low = Words(data, off, ALNUM), None
                hits, items = defaultdict(set), defaultdict(set)
                for k, (bits, known) in windows.items():
                    pos, h = w.windows(k)
                    maybe = np.flatnonzero(bits[h >> U64(64 - _BITS)])
                    for i, x in zip(pos[maybe].tolist(), h[maybe].tolist()):
                        if x in known:
                            low = ALNUM.lower[data] if low is None else low
                            words, ids = known[x]
                            if _texts_of(w, low, i, k) == words:
                                d = int(np.searchsorted(w.first, i, side="right")) - 1
                                hits[d].update(range(i, i + k))
                                items[d].update(ids)
                n = batch.num_rows
                old_items, old_spans = batch.column("items").to_pylist(), batch.column("spans").to_pylist()
                spans = [_merged(w, data, off, d, hits[d], s) if d in hits else s for d, s in zip(range(n), old_spans)]
                found = [sorted(items[d].union(s)) if d in items else s for d, s in zip(range(n), old_items)]
                done = {"n_words": pa.array(np.diff(w.first), pa.int64()), "items": pa.array(found, pa.list_(pa.string())), "spans": pa.array(spans, _SPANS)}
                yield pa.RecordBatch.from_arrays([done.get(c, batch.column(c)) for c in batch.schema.names], names=batch.schema.names)

    return run


_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())]))


def _merged(w: Words, data: np.ndarray, off: np.ndarray, d: int, hits: set[int], before: list[dict]) -> list[dict]:
    """Runs of hit words: first word, number of words, and code points from start to stop."""
    base = int(w.first[d])
    hits = hits.union(base + i for s in before for i in range(s["first"], s["first"] + s["words"]))
    at = np.array(sorted(hits))
    cut = np.flatnonzero(np.diff(at) > 1)
    lo, hi = at[np.concatenate([[0], cut + 1])], at[np.concatenate([cut, [len(at) - 1]])]
    own = data[off[d] : off[d + 1]]
    points = np.concatenate([[0], np.cumsum((own & 0xC0) != 0x80)])  # code points before a byte
    return [
        {"first": int(a) - base, "words": int(b - a) + 1, "start": int(points[w.start[a] - off[d]]), "stop": int(points[w.end[b] - off[d]])}
        for a, b in zip(lo, hi)
    ]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, windows: int = WINDOWS) -> DataFrame:
    """``docs`` (any columns besides text) with n_words, items and spans of benchmark passages.

    Words are runs of letters, digits and non-ASCII characters with A-Z lower-cased.  Windows are
    ``window`` consecutive words of an item, or all words of a shorter item.  ``items`` are the sorted
    item ids, as strings, of all windows that occur; ``spans`` are the runs of words inside any
    occurrence (first word, number of words, code points start to stop).

    Null or wordless text: n_words 0, no items, no spans.  Null item id: its windows count as hits
    but name no item.  Repeated rows and items: each row gets its result, an item is listed once.  An
    empty benchmark finds nothing.  Columns of ``docs`` named like the new ones are replaced.
    """
    spark = docs.sparkSession
    pairs = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").mapInArrow(
        _item_windows(window), "k int, words binary, item_id string"
    )
    pairs = materialise(pairs.distinct(), "bench-windows")
    parts = max(1, -(-pairs.count() // windows))
    none = F.array().cast("array<string>")
    out = docs.drop("n_words", "items", "spans").withColumns(
        {"n_words": F.lit(0).cast("long"), "items": none, "spans": F.array().cast("array<struct<first:long,words:long,start:long,stop:long>>")}
    )
    for part in range(parts):
        own = pairs.filter(F.pmod(F.xxhash64("k", "words", "item_id"), F.lit(parts)) == part)
        rows = own.groupBy("k", "words").agg(F.collect_set("item_id").alias("items")).collect()
        shared = spark.sparkContext.broadcast(WindowSet([(r.k, bytes(r.words), list(r["items"])) for r in rows]))
        out = out.mapInArrow(_scan(shared), out.schema)
        if part < parts - 1:
            out = materialise(out, "decontaminated")
    return out


def cleaned(text: Column, spans: Column) -> Column:
    """The text without its spans, each of which leaves one blank."""
    start = F.transform(spans, lambda s: s["stop"] + 1)
    stop = F.transform(spans, lambda s: s["start"])
    lo = F.concat(F.array(F.lit(1).cast("long")), start)
    hi = F.concat(stop, F.array(F.char_length(text).cast("long")))
    pieces = F.transform(F.arrays_zip(lo.alias("lo"), hi.alias("hi")), lambda p: F.substring(text, p["lo"].cast("int"), (p["hi"] - p["lo"] + 1).cast("int")))
    return F.when(F.size(spans) > 0, F.array_join(pieces, " ")).otherwise(text)


def remove(docs: DataFrame, benchmark: DataFrame, whole: bool = True, window: int = WINDOW) -> DataFrame:
    """``docs`` without contaminated documents, or (``whole=False``) without the spans only."""
    found = decontaminate(docs, benchmark, window)
    if whole:
        out = found.filter(F.size("spans") == 0)
    else:
        out = found.withColumn("text", cleaned(F.col("text"), F.col("spans")))
    return out.select(*docs.columns)
