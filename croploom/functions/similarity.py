"""Weighted name similarity, 0..100, as published for fuzzy name matching.

The base score is the share of characters in the longest common subsequence.  Names of similar length
are also compared with their words sorted and as word sets; names of very different length by their
best-fitting stretch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the published score: length ratios where the method changes, and the weights.
SAME_LENGTH_BELOW = 1.5
FAR_LENGTH_ABOVE = 8.0
WORD_WEIGHT = 0.95
PARTIAL_WEIGHT = 0.9
FAR_PARTIAL_WEIGHT = 0.6


def _masks(text: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, ch in enumerate(text):
        out[ch] = out.get(ch, 0) | (1 << i)
    return out


def _common(masks: dict[str, int], n: int, other: str) -> int:
    """Length of the longest common subsequence, one machine word operation per character."""
    full = (1 << n) - 1
    free = full
    for ch in other:
        hit = free & masks.get(ch, 0)
        free = (free + hit) | (free - hit)
    return n - (free & full).bit_count()


def ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 200.0 * _common(_masks(a), len(a), b) / total if total else 100.0


def _best_window(short: str, long: str) -> float:
    masks, n = _masks(short), len(short)
    best = 0.0
    # Full windows, and shorter ones hanging over either end.
    for start in range(1 - n, len(long)):
        window = long[max(0, start) : start + n]
        edge = window[-1] if start < 0 else window[0]
        if 0 <= start <= len(long) - n or edge in masks:
            best = max(best, 200.0 * _common(masks, n, window) / (n + len(window)))
            if best == 100.0:
                break
    return best


def partial_ratio(a: str, b: str) -> float:
    if not a or not b:
        return 100.0 if a == b else 0.0
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    best = _best_window(short, long)
    if len(a) == len(b) and best != 100.0:
        best = max(best, _best_window(long, short))
    return best


def _words(a: str, b: str):
    wa, wb = a.split(), b.split()
    sa, sb = set(wa), set(wb)
    return wa, wb, sa & sb, sorted(sa - sb), sorted(sb - sa)


def word_ratio(a: str, b: str) -> float:
    """Better of sorted-word and word-set similarity."""
    wa, wb, both, only_a, only_b = _words(a, b)
    if both and (not only_a or not only_b):
        return 100.0
    best = ratio(" ".join(sorted(wa)), " ".join(sorted(wb)))
    ja, jb = " ".join(only_a), " ".join(only_b)
    shared = len(" ".join(both))
    glue = 1 if shared else 0
    len_a, len_b = shared + glue + len(ja), shared + glue + len(jb)
    apart = len(ja) + len(jb) - 2 * _common(_masks(ja), len(ja), jb)
    best = max(best, 100.0 - 100.0 * apart / (len_a + len_b) if len_a + len_b else 0.0)
    if shared:
        best = max(
            best,
            100.0 - 100.0 * (glue + len(ja)) / (shared + len_a),
            100.0 - 100.0 * (glue + len(jb)) / (shared + len_b),
        )
    return best


def partial_word_ratio(a: str, b: str) -> float:
    wa, wb, both, only_a, only_b = _words(a, b)
    if both:
        return 100.0
    best = partial_ratio(" ".join(sorted(wa)), " ".join(sorted(wb)))
    if len(wa) != len(only_a) or len(wb) != len(only_b):
        best = max(best, partial_ratio(" ".join(only_a), " ".join(only_b)))
    return best


def weighted_ratio(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    stretch = max(len(a), len(b)) / min(len(a), len(b))
    best = ratio(a, b)
    if stretch < SAME_LENGTH_BELOW:
        return max(best, word_ratio(a, b) * WORD_WEIGHT)
    weight = PARTIAL_WEIGHT if stretch <= FAR_LENGTH_ABOVE else FAR_PARTIAL_WEIGHT
    best = max(best, partial_ratio(a, b) * weight)
    return max(best, partial_word_ratio(a, b) * WORD_WEIGHT * weight)


# Character counts are kept in so many bins; characters that share one only loosen the bound.
BINS = 64
_SLACK = 1e-6


class Bounds:
    """Upper bounds of the weighted score of one name with each of many candidates.

    A common subsequence is no longer than what two texts have in common as bags of characters, and a
    stretch of n characters that has k in common with a text is scored 200 k / (n + k) at most.  Word
    scores are bounded by the same bags where no word is shared or repeated, otherwise by 100.
    """

    def __init__(self, texts: list[str]) -> None:
        self.length = np.array([len(t) for t in texts], float)
        self.bags = np.stack([_bag(t) for t in texts]) if texts else np.zeros((0, BINS), np.int32)
        self.words = [set(t.split()) for t in texts]
        self.repeats = np.array([len(w) < len(t.split()) for w, t in zip(self.words, texts)], bool)
        self.holders: dict[str, list[int]] = {}
        for i, ws in enumerate(self.words):
            for w in ws:
                self.holders.setdefault(w, []).append(i)

    def of(self, name: str) -> np.ndarray:
        if not name:
            return np.zeros(len(self.length))
        common = np.minimum(self.bags, _bag(name)).sum(axis=1)
        short, long = np.minimum(self.length, len(name)), np.maximum(self.length, len(name))
        own = name.split()
        loose = self.repeats.copy() if len(set(own)) == len(own) else np.ones(len(short), bool)
        loose[[i for w in set(own) for i in self.holders.get(w, ())]] = True
        plain = 200.0 * common / np.maximum(short + long, 1)
        part = 200.0 * common / np.maximum(short + common, 1)
        stretch = long / np.maximum(short, 1)
        weight = np.where(stretch <= FAR_LENGTH_ABOVE, PARTIAL_WEIGHT, FAR_PARTIAL_WEIGHT)
        near = np.maximum(plain, WORD_WEIGHT * np.where(loose, 100.0, plain))
        far = np.maximum(plain, weight * np.maximum(part, WORD_WEIGHT * np.where(loose, 100.0, part)))
        return np.where(self.length == 0, 0.0, np.where(stretch < SAME_LENGTH_BELOW, near, far)) + _SLACK


def _bag(text: str) -> np.ndarray:
    return np.bincount([ord(c) % BINS for c in text], minlength=BINS).astype(np.int32)


def best_of(name: str, texts: list[str], bounds: Bounds) -> tuple[float, int]:
    """The best score and its first place in the list; the most promising candidates go first, and
    those whose bound is below the best score so far are not compared."""
    limit = bounds.of(name)
    best, at = -1.0, -1
    for i in np.argsort(-limit, kind="stable").tolist():
        if limit[i] < best:
            break
        score = weighted_ratio(name, texts[i])
        if score > best or (score == best and i < at):
            best, at = score, i
    return best, at


@F.arrow_udf(
    T.ArrayType(
        T.StructType(
            [
                T.StructField("name", T.StringType()),
                T.StructField("score", T.DoubleType()),
                T.StructField("pos", T.LongType()),
            ]
        )
    )
)
def best_of_batch(names: pa.Array, candidates: pa.Array) -> pa.Array:
    """For each row: a batch of names against a batch of ``(pos, text)``; the first best one wins."""
    out = []
    for batch, cands in zip(names.to_pylist(), candidates.to_pylist()):
        texts = [c["text"] for c in cands]
        bounds, row = Bounds(texts), []
        for name in batch:
            best, at = best_of(name, texts, bounds)
            row.append({"name": name, "score": best, "pos": cands[at]["pos"] if at >= 0 else None})
        out.append(row)
    return pa.array(out, pa.list_(pa.struct([("name", pa.string()), ("score", pa.float64()), ("pos", pa.int64())])))
