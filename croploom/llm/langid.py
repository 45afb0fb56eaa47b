"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  A trigram's vector binds those of its letters, each
permuted by its place, by element-wise multiplication; a document's vector bundles the vectors of all
its trigrams by addition; a language's prototype bundles the normalised vectors of labelled documents.
A text gets the language whose prototype is nearest by cosine.  Vectors are whole numbers throughout,
so results do not depend on the order of addition.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from croploom.llm.words import U64, mix, slices

SIZE = 1024  # elements of a vector
TRAIN_DOCS = 5_000  # expected number of labelled documents of each language that prototypes are learned from
PIECE = 1 << 20  # characters of one text handled at a time
BLOCK = 4096  # trigram vectors made at a time
CELLS = 1 << 22  # (document, trigram) counts held at a time
UNIT = 4096  # length of a normalised document vector in a prototype

_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000)
    return _letters


def letter_vectors(points: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The random vectors of letters; code point 0 stands for everything that is none."""
    seed = mix(points.astype(U64) * U64(0x9FB21C651E98DF25) + U64(1))
    words = mix(seed[:, None] + np.arange(size // 64, dtype=U64)[None, :] * U64(0xD6E8FEB86659FD93))
    bits = np.unpackbits(words.astype("<u8").view(np.uint8).reshape(len(points), -1), axis=1)
    return bits.astype(np.int8) * np.int8(2) - np.int8(1)


def _points(text: str) -> np.ndarray:
    x = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return np.where(letters()[x], x, 0)


def _trigrams(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(documents, letter triples) by their middle letters, at most about PIECE characters at a time."""
    gap = np.zeros(1, np.uint32)
    held, docs, n = [gap], [np.array([-1])], 0

    def out():
        m, d = np.concatenate(held), np.concatenate(docs)
        mid = np.flatnonzero(d >= 0)
        mid = mid[m[mid] > 0]
        return d[mid], np.stack([m[mid - 1], m[mid], m[mid + 1]])

    for i, t in enumerate(texts):
        m = _points((t or "").lower())
        for lo in range(0, len(m), PIECE):
            part = m[lo : lo + PIECE]
            held += [m[lo - 1 : lo] if lo else gap, part, m[lo + PIECE : lo + PIECE + 1] if lo + PIECE < len(m) else gap]
            docs += [np.array([-1]), np.full(len(part), i), np.array([-1])]
            n += len(part)
            if n >= PIECE:
                yield out()
                held, docs, n = [gap], [np.array([-1])], 0
    if n:
        yield out()


def document_vectors(texts: list[str | None], size: int = SIZE) -> np.ndarray:
    """Bundled trigram vectors of whole texts; zeros where a text has no letter."""
    total = np.zeros((len(texts), size), np.int64)
    for doc, tri in _trigrams(texts):
        if not len(doc):
            continue
        seen = np.zeros(0x110000, bool)
        seen[tri.ravel()] = True
        alphabet = np.flatnonzero(seen)
        place = np.zeros(0x110000, np.int64)
        place[alphabet] = np.arange(len(alphabet))
        a = len(alphabet)
        code = (place[tri[0]] * a + place[tri[1]]) * a + place[tri[2]]
        if a**3 <= 1 << 24:
            there = np.zeros(a**3, bool)
            there[code] = True
            kinds = np.flatnonzero(there)
            number = np.zeros(a**3, np.int64)
            number[kinds] = np.arange(len(kinds))
            code = number[code]
        else:
            kinds, code = np.unique(code, return_inverse=True)
        own = letter_vectors(alphabet, size)
        first, second = np.roll(own, 2, axis=1), np.roll(own, 1, axis=1)
        base, last = int(doc[0]), int(doc[-1])
        step = max(1, CELLS // len(kinds))
        for lo in range(base, last + 1, step):
            i, j = np.searchsorted(doc, (lo, lo + step))
            rows = min(step, last + 1 - lo)
            counts = np.bincount((doc[i:j] - lo) * len(kinds) + code[i:j], minlength=rows * len(kinds)).reshape(rows, -1).astype(np.float32)
            for k in range(0, len(kinds), BLOCK):
                kk = kinds[k : k + BLOCK]
                bound = first[kk // (a * a)] * second[kk // a % a] * own[kk % a]
                total[lo : lo + rows] += np.rint(counts[:, k : k + BLOCK] @ bound.astype(np.float32)).astype(np.int64)
    return total


def _learn(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for whole in batches:
            for batch in slices(whole, "text"):
                v = document_vectors(batch.column("text").to_pylist(), size)
                norm = np.sqrt((v.astype(np.float64) ** 2).sum(axis=1))
                unit = np.rint(v * (UNIT / np.maximum(norm, 1))[:, None]).astype(np.int64)
                for lang, row in zip(batch.column("lang").to_pylist(), unit):
                    sums[lang] = sums[lang] + row if lang in sums else row
        for lang, row in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * size), pa.array(np.arange(size), pa.int32()), pa.array(row)], names=["lang", "place", "value"]
            )

    return run


def taken(n: Column, most: int, *key: Column) -> Column:
    """Whether a row is in a sample of ``most`` of n rows, in expectation; the share is never rounded to nothing."""
    return F.pmod(F.xxhash64(*key), F.lit(1 << 53)) / float(1 << 53) < F.lit(float(most)) / n


def learn(docs: DataFrame, train_docs: int = TRAIN_DOCS, size: int = SIZE) -> tuple[list[str], np.ndarray]:
    """Languages and prototypes from labelled documents (doc_id, text, lang).

    Documents with a null lang or text, or whose crc32(doc_id) mod 3 is 1, teach nothing.  Of the others
    of each language a sample by a hash of (doc_id, text) is used, ``train_docs`` documents in expectation
    and all where there are fewer.
    """
    usable = docs.filter("lang is not null and text is not null and crc32(cast(doc_id as string)) % 3 <> 1")
    counts = usable.groupBy("lang").agg(F.count("*").alias("_n"))
    # one row for each language, which the prototypes gathered below hold anyway
    sample = usable.join(F.broadcast(counts), "lang").filter(taken(F.col("_n"), train_docs, F.col("doc_id"), F.col("text")))
    parts = sample.select("text", "lang").mapInArrow(_learn(size), "lang string, place int, value long")
    rows = parts.groupBy("lang", "place").agg(F.sum("value").alias("value"))
    rows = rows.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("v")).select("lang", F.col("v.value").alias("v")).collect()
    rows = sorted((r.lang, r.v) for r in rows)
    return [r[0] for r in rows], np.array([r[1] for r in rows], np.float64).reshape(len(rows), size)


def identify(docs: DataFrame, languages: list[str], prototypes: np.ndarray) -> DataFrame:
    """``docs`` (any columns besides text) with lang_pred and score.

    score is the cosine with the nearest prototype, 0 at least; of equal ones the first language in
    alphabetical order wins.  A null text, one without letters, or a model without languages gives
    ``und`` and 0.  Whole texts count.  Columns named lang_pred or score are replaced.
    """
    size = prototypes.shape[1]
    model = prototypes / np.maximum(np.sqrt((prototypes**2).sum(axis=1, keepdims=True)), 1e-300)
    docs = docs.drop("lang_pred", "score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = batch.column("text").to_pylist()
                v = document_vectors(texts, size).astype(np.float64)
                some = np.array([bool(len(languages)) and bool(t) and bool(letters()[_raw(t)].any()) for t in texts], bool)
                if len(languages):
                    cos = (v @ model.T) / np.maximum(np.sqrt((v**2).sum(axis=1)), 1e-300)[:, None]
                    best = cos.argmax(axis=1)
                    score = np.clip(cos[np.arange(len(texts)), best], 0.0, 1.0)
                else:
                    best, score = np.zeros(len(texts), int), np.zeros(len(texts))
                pred = [languages[b] if s else "und" for b, s in zip(best, some)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(pred, pa.string()), pa.array(np.where(some, score, 0.0))], names=[*batch.schema.names, "lang_pred", "score"]
                )

    return docs.mapInArrow(run, docs.selectExpr("*", "'' lang_pred", "0d score").schema)


def _raw(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
