"""SentencePiece encoding with seeded merge dropout, and decoding.

Encoding follows the model's merges: of all neighbouring symbols whose union is a piece, the pair with
the best score is merged first, the leftmost of equals.  Under dropout a candidate, that is a pair of
spans of a word, is skipped when a keyed hash of the seed, the document, the word's place in it, the word
and the spans falls below the dropout rate.  The decision belongs to the candidate and not to the moment
it is looked at, so an encoding can be repeated exactly, on any cluster.  Each occurrence of a word has
decisions of its own.

The distinct words of a batch of texts are merged together without dropout, one merge per word and pass
over the batch.  An occurrence that skips none of its word's merges is cut like that; the others are merged
again, each for itself but together as well.  Words of more than ``LONG`` symbols are cut where no piece can
cross; only parts that are still longer go through an agenda one by one.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from croploom.llm.words import MASK, U64, mix, release, slices

DROPOUT, SEED = 0.1, 17
LONG = 64
OCCURRENCES = 1 << 16  # occurrences of words whose decisions are looked at together
SLICE_BYTES, SLICE_IDS = 1 << 19, 1 << 18  # text and ids handled at a time, a longer document alone
NONE = np.int64(1) << 40  # rank of a pair that is not a candidate
_CHUNK = re.compile(r" *[^ ]+| +")
_BITS = 20
_HASH = U64(0x9E3779B97F4A7C15)


class Pieces:
    """Merge and decoding tables of a model file."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.first_byte = next(i for i in range(n) if sp.is_byte(i))
        self.n = n
        ids = {names[i]: i for i in plain}
        for i in plain:  # characters that are parts of pieces but none themselves
            for c in names[i]:
                ids.setdefault(c, len(ids) + n)
        self.symbols = max(ids.values()) + 1
        self.char = np.full(0x110000, -1, np.int64)
        for c, i in ids.items():
            if len(c) == 1:
                self.char[ord(c)] = i
        self.char[ord(" ")], self.char[0x2581] = self.char[0x2581], -1
        order = sorted({sp.get_score(i) for i in plain}, reverse=True)
        rank = {s: r for r, s in enumerate(order)}
        pairs = {}
        for i in plain:
            for k in range(1, len(names[i])):
                a, b = ids.get(names[i][:k]), ids.get(names[i][k:])
                if a is not None and b is not None:
                    pairs[a * self.symbols + b] = (i, rank[sp.get_score(i)])
        self.pairs = pairs
        # characters that stand side by side in a piece
        self.beside = np.array(sorted({ids[a] * self.symbols + ids[b] for i in plain for a, b in zip(names[i], names[i][1:])}), np.int64)
        self.key = np.full(1 << _BITS, -1, np.int64)
        self.merged, self.rank = np.zeros(1 << _BITS, np.int64), np.full(1 << _BITS, NONE)
        for k, (i, r) in pairs.items():
            at = (k * int(_HASH) & MASK) >> (64 - _BITS)
            while self.key[at] >= 0:
                at = (at + 1) & ((1 << _BITS) - 1)
            self.key[at], self.merged[at], self.rank[at] = k, i, r
        text = [names[i].replace("▁", " ").encode() if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)) else b"" for i in range(n)]
        for b in range(256):
            text[self.first_byte + b] = bytes([b])
        self.bytes = np.frombuffer(b"".join(text), np.uint8)
        self.begin = np.concatenate([[0], np.cumsum([len(t) for t in text])])

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged piece and rank of each pair of symbols."""
        k = np.where((left < 0) | (right < 0), -2, left * self.symbols + right)
        at = ((k.astype(U64) * _HASH) >> U64(64 - _BITS)).astype(np.int64)
        got = self.key[at]
        hit = got == k
        rank, merged = np.where(hit, self.rank[at], NONE), np.where(hit, self.merged[at], 0)
        more = np.flatnonzero(~hit & (got >= 0) & (k >= 0))  # an empty place ends a search
        while len(more):
            at[more] = (at[more] + 1) & ((1 << _BITS) - 1)
            got = self.key[at[more]]
            hit = got == k[more]
            found = more[hit]
            rank[found], merged[found] = self.rank[at[found]], self.merged[at[found]]
            more = more[~hit & (got >= 0)]
        return merged, rank


_loaded: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def skipped(key: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray, dropout: float) -> np.ndarray:
    """Whether candidates (spans of a word with that key) are skipped."""
    if dropout <= 0:
        return np.zeros(len(key), bool)
    h = mix(mix(mix(key + start.astype(U64)) + middle.astype(U64)) + end.astype(U64))
    return (h >> U64(11)).astype(np.float64) < dropout * 2.0**53


def _draw(key: int, start: int, middle: int, end: int) -> int:
    """The number that ``skipped`` draws for one candidate."""
    for x in (start, middle, end):
        key = (key + x) & MASK
        key = (key ^ key >> 30) * 0xBF58476D1CE4E5B9 & MASK
        key = (key ^ key >> 27) * 0x94D049BB133111EB & MASK
        key ^= key >> 31
    return key >> 11


def agenda(model: Pieces, points: np.ndarray, key: int, dropout: float, offset: int = 0) -> list[int]:
    """Symbols of one word, or of its part from ``offset`` on; -1-c for a character c that is no piece.

    A candidate is one number, its rank and its place, and holds while it is the last one noted for the place.
    """
    chars = model.char[points]
    n, at = len(chars), np.arange(max(len(chars) - 1, 0)) + offset
    merged, rank = model.look_up(chars[:-1], chars[1:])
    rank[skipped(np.full(len(at), key, U64), at, at + 1, at + 2, dropout)] = NONE
    noted = np.append(np.where(rank < NONE, rank * n + at - offset, -1), -1)
    heap = np.sort(noted[noted >= 0]).tolist()
    sym, new, noted = chars.tolist(), [*merged.tolist(), 0], noted.tolist()
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    pairs, symbols, limit = model.pairs, model.symbols, dropout * 2.0**53
    while heap:
        best = heapq.heappop(heap)
        i = best % n
        if noted[i] != best:
            continue
        j = right[i]
        sym[i], noted[j] = new[i], -1
        right[i] = after = right[j]
        if after < n:
            left[after] = i
        for p in (left[i], i):
            if p < 0:
                continue
            noted[p], q = -1, right[p]
            hit = pairs.get(sym[p] * symbols + sym[q]) if q < n and sym[p] >= 0 and sym[q] >= 0 else None
            if hit and not (dropout > 0 and _draw(key, p + offset, q + offset, right[q] + offset) < limit):
                new[p], noted[p] = hit[0], hit[1] * n + p
                heapq.heappush(heap, noted[p])
    out, i = [], 0
    while i < n:
        out.append(sym[i] if sym[i] >= 0 else -1 - int(points[i]))
        i = right[i]
    return out


def long_word(model: Pieces, points: np.ndarray, key: int, dropout: float) -> np.ndarray:
    """Symbols of a word of any length.

    No merge crosses a place whose two characters stand side by side in no piece, so the word falls into parts
    there: short ones are merged together, longer ones go through an agenda each.
    """
    chars = model.char[points]
    pair = np.where((chars[:-1] < 0) | (chars[1:] < 0), -1, chars[:-1] * model.symbols + chars[1:])
    at = np.minimum(np.searchsorted(model.beside, pair), len(model.beside) - 1)
    first = np.concatenate([[0], np.flatnonzero(model.beside[at] != pair) + 1, [len(points)]])
    size, kept = np.diff(first), np.zeros(len(first) - 1, np.int64)
    start, out, total = kept.copy(), [], 0
    short = np.flatnonzero(size <= LONG)
    for lo in range(0, len(short), OCCURRENCES):
        some = short[lo : lo + OCCURRENCES]
        part = points[_ranges(first[some], size[some])]
        own = np.concatenate([[0], np.cumsum(size[some])])
        sym, kept[some] = merge_all(model, part, own, np.full(len(some), key, U64), dropout, offset=first[some])
        start[some] = total + np.cumsum(kept[some]) - kept[some]
        out.append(sym)
        total += len(sym)
    for k in np.flatnonzero(size > LONG).tolist():
        out.append(np.array(agenda(model, points[first[k] : first[k + 1]], key, dropout, int(first[k])), np.int64))
        start[k], kept[k] = total, len(out[-1])
        total += len(out[-1])
    return np.concatenate(out)[_ranges(start, kept)]


def merge_all(
    model: Pieces, points: np.ndarray, first: np.ndarray, key: np.ndarray, dropout: float,
    made: list[tuple[np.ndarray, ...]] | None = None, offset: np.ndarray | int = 0,
) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of many words, as ``agenda`` gives them, and how many each word has.

    ``first`` tells where each word's characters begin; no word is empty.  The merges, as word and spans,
    are added to ``made``.  ``offset`` is where each one begins in its word, where they are parts of words.
    """
    n, words = len(points), len(first) - 1
    word = np.repeat(np.arange(words), np.diff(first))
    place = np.arange(n) - (first[:-1] - offset)[word]
    sym = model.char[points]
    nxt = np.arange(1, n + 1)
    nxt[first[1:] - 1] = -1
    prv = np.arange(-1, n - 1)
    prv[first[:-1]] = -1
    stop = place + 1
    alive = np.ones(n, bool)
    # rank of the pair at a position, then the position: the least of a word is the leftmost best pair
    last = np.iinfo(np.int64).max
    rank, new = np.full(n, last), np.zeros(n, np.int64)

    def offer(i: np.ndarray) -> None:
        i = i[i >= 0]
        rank[i] = last
        i = i[nxt[i] >= 0]
        j = nxt[i]
        m, r = model.look_up(sym[i], sym[j])
        some = np.flatnonzero(r < NONE)
        i, j, m, r = i[some], j[some], m[some], r[some]
        if dropout > 0:
            ok = ~skipped(key[word[i]], place[i], place[j], stop[j], dropout)
            i, m, r = i[ok], m[ok], r[ok]
        rank[i], new[i] = r * n + i, m

    offer(np.arange(n))
    # positions that may still merge, word by word; finished words leave
    at, size = np.arange(n), np.diff(first)
    while len(at):
        best = np.minimum.reduceat(rank[at], np.cumsum(size) - size)
        going = best < last
        i = best[going] % n
        if not len(i):
            break
        j = nxt[i]
        if made is not None:
            made.append((word[i], place[i], place[j], stop[j]))
        sym[i], stop[i] = new[i], stop[j]
        alive[j], rank[j] = False, last
        nxt[i] = nxt[j]
        has = nxt[i] >= 0
        prv[nxt[i][has]] = i[has]
        offer(np.concatenate([prv[i], i]))
        at = at[np.repeat(going, size)]
        at = at[alive[at]]
        size = size[going] - 1
    out = np.where(sym >= 0, sym, -1 - points.astype(np.int64))[alive]
    return out, np.bincount(word[alive], minlength=words)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Concatenated ranges."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - size), size)


def _with_bytes(model: Pieces, sym: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids for symbols: characters that are no pieces become the ids of their UTF-8 bytes."""
    raw = (sym < 0) | (sym >= model.n)
    if not raw.any():
        return sym, size
    extra = sym >= model.n
    if extra.any():
        back = np.zeros(model.symbols, np.int64)
        known = np.flatnonzero(model.char >= model.n)
        back[model.char[known]] = known
        sym = np.where(extra, -1 - back[np.where(extra, sym, 0)], sym)
    c = -1 - sym
    width = np.where(raw, 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF), 1)
    owner = np.repeat(np.arange(len(size)), size)
    src = np.repeat(np.arange(len(sym)), width)
    k = _ranges(np.zeros(len(width), np.int64), width)
    cc, ww = c[src], width[src]
    tail = 0x80 | (cc >> np.maximum(6 * (ww - 1 - k), 0)) & 0x3F
    lead = np.choose(np.maximum(ww - 1, 0), [cc, 0xC0 | cc >> 6, 0xE0 | cc >> 12, 0xF0 | cc >> 18])
    ids = np.where(raw[src], model.first_byte + np.where(k == 0, lead, tail), sym[src])
    return ids, np.bincount(owner, weights=width, minlength=len(size)).astype(np.int64)


def encode_texts(model: Pieces, texts: list[str | None], streams: np.ndarray, dropout: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of whole texts, and where each text's begin.

    ``streams`` has a whole number for each text; texts with equal ones share their decisions, place by place.
    """
    chunks = [_CHUNK.findall(" " + t) if t else [] for t in texts]
    count = np.array([len(c) for c in chunks], np.int64)
    flat = [w for c in chunks for w in c]
    if not flat:
        return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    code, names = pd.factorize(np.array(flat, object))
    points = np.frombuffer("".join(names).encode("utf-32-le", "replace"), np.uint32)
    length = np.array([len(x) for x in names], np.int64)
    begin = np.concatenate([[0], np.cumsum(length)])

    def merged(name: np.ndarray, key: np.ndarray, rate: float, made: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        size = length[name]
        sym, n = merge_all(model, points[_ranges(begin[name], size)], np.concatenate([[0], np.cumsum(size)]), key, rate, made)
        return _with_bytes(model, sym, n)

    def alone(name: int, key: int) -> np.ndarray:
        sym = long_word(model, points[begin[name] : begin[name + 1]], key, dropout)
        return _with_bytes(model, sym, np.array([len(sym)]))[0]

    # every distinct word without dropout: its ids, and its merges one after another
    short = np.flatnonzero(length <= LONG)
    own_start, own_size = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
    parts, total, made = [], 0, []
    if len(short):
        ids, n = merged(short, np.zeros(len(short), U64), 0.0, made if dropout > 0 else None)
        own_size[short], own_start[short] = n, np.cumsum(n) - n
        parts, total = [ids], len(ids)
    if dropout <= 0:
        for k in np.flatnonzero(length > LONG):
            parts.append(alone(k, 0))
            own_start[k], own_size[k] = total, len(parts[-1])
            total += len(parts[-1])
    start, size = own_start[code], own_size[code]

    if dropout > 0:
        h = mix((points.astype(U64) + U64(1)) * U64(0xA24BAED4963EE407) + mix(_ranges(np.zeros(len(length), np.int64), length).astype(U64)))
        word_hash = np.add.reduceat(h, begin[:-1])
        text_key = mix(streams.astype(U64) + U64(seed * int(_HASH) & MASK))
        place = _ranges(np.zeros(len(count), np.int64), count)
        owner = np.repeat(np.arange(len(texts)), count)
        steps = np.zeros(len(names), np.int64)
        if made:
            word, *spans = (np.concatenate(x) for x in zip(*made))
            steps[short] = np.bincount(word, minlength=len(short))
            order = np.argsort(word, kind="stable")
            spans = [x[order] for x in spans]
        first_step = np.cumsum(steps) - steps
        for lo in range(0, len(code), OCCURRENCES):
            name = code[lo : lo + OCCURRENCES]
            key = mix(word_hash[name] + mix(text_key[owner[lo : lo + OCCURRENCES]] + place[lo : lo + OCCURRENCES].astype(U64)))
            differs = np.zeros(len(name), bool)
            n = steps[name]
            if n.any():
                at, who = _ranges(first_step[name], n), np.repeat(np.arange(len(name)), n)
                differs[who[skipped(key[who], *(x[at] for x in spans), dropout)]] = True
            again = np.flatnonzero(differs)
            if len(again):
                ids, n = merged(name[again], key[again], dropout)
                start[lo + again], size[lo + again] = total + np.cumsum(n) - n, n
                parts.append(ids)
                total += len(ids)
            for k in np.flatnonzero(length[name] > LONG):
                parts.append(alone(name[k], int(key[k])))
                start[lo + k], size[lo + k] = total, len(parts[-1])
                total += len(parts[-1])
    first = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(count)])]
    return np.concatenate(parts)[_ranges(start, size)], first


def decode_ids(model: Pieces, ids: np.ndarray, first: np.ndarray) -> list[str]:
    """Texts of ids; control pieces have no text, and the blank put before a text goes."""
    size = (model.begin[1:] - model.begin[:-1])[ids]
    raw = model.bytes[_ranges(model.begin[ids], size)]
    ends = np.concatenate([[0], np.cumsum(size)])[first]
    out = []
    for a, b in zip(ends[:-1], ends[1:]):
        t = raw[a:b].tobytes().decode("utf-8", "replace")
        out.append(t[1:] if t.startswith(" ") else t)
    return out


def encode(
    docs: DataFrame, path: str, dropout: float = DROPOUT, seed: int = SEED, key: str = "doc_id", check: str | None = None
) -> DataFrame:
    """``docs`` (any columns besides text) with ``ids``: array of piece ids, without control ids.

    Without dropout these are the ids that the sentencepiece library gives, but for U+2581, which is
    encoded as bytes here so that decoding returns it.  Dropout decisions are keyed by a hash of the column
    ``key`` and the text (the text alone where the key is null), and by each word's place in the text.
    Null and empty texts have no ids.  Repeated rows are encoded alike.  With ``check``, the ids are decoded in the same task, and a column of that
    name says whether this gives the text back (for a null text: an empty one).  Columns of ``docs``
    named ids or like ``check`` are replaced.
    """
    docs = docs.drop("ids", *([check] if check else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                where = batch.column("__stream").to_numpy()
                texts = batch.column("text").to_pylist()
                ids, first = encode_texts(model, texts, where, dropout, seed)
                kept = [(c, n) for c, n in zip(batch.columns, batch.schema.names) if n != "__stream"]
                kept.append((pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids.astype(np.int32))), "ids"))
                if check:
                    back = decode_ids(model, ids, first)
                    kept.append((pa.array([b == (t or "") for b, t in zip(back, texts)], pa.bool_()), check))
                yield pa.RecordBatch.from_arrays([c for c, _ in kept], names=[n for _, n in kept])

    schema = docs.withColumns({"ids": F.array().cast("array<int>")} | ({check: F.lit(True)} if check else {})).schema
    return docs.withColumn("__stream", F.xxhash64(key, "text")).mapInArrow(run, schema)


def decode(coded: DataFrame, path: str, name: str = "decoded") -> DataFrame:
    """``coded`` (any columns besides ids) with the text of its ids; null ids give a null text."""
    coded = coded.drop(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for whole in batches:
            first = np.concatenate([[0], np.cumsum([len(x) if x.is_valid else 0 for x in whole.column("ids")])])
            lo = 0
            while lo < whole.num_rows:
                hi = max(lo + 1, int(np.searchsorted(first, first[lo] + SLICE_IDS, side="right")) - 1)
                batch = whole.slice(lo, hi - lo)
                col = batch.column("ids")
                texts = decode_ids(model, col.flatten().to_numpy().astype(np.int64), first[lo : hi + 1] - first[lo])
                texts = pa.array([None if null else t for t, null in zip(texts, col.is_null().to_pylist())], pa.string())
                yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, name])
                lo = hi
            release()

    return coded.mapInArrow(run, coded.withColumn(name, F.lit(None).cast("string")).schema)


def ids_crc32(ids: pa.Array) -> list[int]:
    raw = ids.flatten().to_numpy().astype("<u4").tobytes()
    off = ids.offsets.to_numpy().astype(np.int64)
    off = off - off[0]
    return [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(off[:-1], off[1:])]
