"""Token-id files: an adaptive range coder over independent, checksummed blocks.

An id is coded by three mixed predictions: what followed the last two ids before, what followed the last
id, and how often ids of the block occurred.  The first two name one id each, with a confidence;
how far they are trusted is learned for every pair of confidences.  The third divides what is left of
the range among all ids, and follows the counts in intervals.  All models start anew in each block, so
blocks can be read in any order and by any number of tasks.

A block is cut into strands, consecutive runs of its ids, which are coded side by side, one id of each per
step, with array arithmetic; they share the block's models, so what one strand learns helps all.  The coder keeps a
64-bit low end with carries and a 64-bit range for each strand, and gives out 32-bit words, which stand in the block
in the order in which its reader asks for them.

A file is a table of blocks: file and block number, how many ids a block of the file has if it is not the last, a
checksum of the ids, the coded words, and for the
documents that begin in the block their ids, starting places and lengths.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from hashlib import blake2b
from itertools import chain, compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from croploom.llm.words import FOLD, SPACED, U64, Spans, buffers, mix, release, slices
from croploom.session import materialise

BLOCK = 1 << 21  # ids in a block
TEXT = 4 << 20  # bytes of texts that are encoded at a time
STRANDS = 8192  # runs of a block that are coded side by side, at most
END = 2  # id after each document

_SLOTS = 18  # bits of an index to what followed two ids
_SHARE = 16  # bits of an id's share in the third prediction
_REST = 64  # of which at least so much is left for ids without a share
_PAUSE = 32  # steps between two times that trust and shares are worked out
_EARLY = frozenset((1, 2, 3, 4, 6, 8, 12, 16, 24, 48))  # more of them while a block begins
_TOP = U64(1 << 32)
_ALL = slice(None)
_LEAST, _MOST = 64, 3800  # bounds of a learned trust, of 4096


class _Models:
    """The state of all predictions of a block, which its strands share."""

    def __init__(self, strands: int, vocabulary: int, reading: bool = False) -> None:
        self.reading = reading
        self.after2 = np.zeros(1 << _SLOTS, np.int64)  # predicted id, times 8, plus confidence
        self.after1 = np.zeros(vocabulary, np.int64)
        kind = np.arange(128)  # both confidences, and whether both name one id
        self.seen = np.full(128, 32)
        self.right2 = 2 + 3 * (kind >> 4)
        self.right1 = np.where(kind & 1, 0, (1 + 2 * (kind >> 1 & 7)) * (32 - self.right2) // 32)
        self.kinds = np.empty((_PAUSE, strands), np.int64)
        self.count = np.zeros(vocabulary, np.int64)
        self.missed: list[np.ndarray] = []
        self.before1 = np.zeros(strands, np.int64)
        self.part2 = np.zeros(strands, np.int64)
        self.step = self.rows = 0
        self.share()

    def share(self) -> None:
        """Trust in both predictions, and the shares of ids; ids without a share use what is left."""
        k = np.bincount(self.kinds[: self.rows].ravel(), minlength=512).reshape(4, 128)
        self.seen += k.sum(axis=0)
        self.right2 += k[1]
        self.right1 += k[2]
        self.rows = 0
        w2 = np.clip((self.right2 << 12) // self.seen, _LEAST, _MOST)
        both = np.clip((self.right2 + self.right1 << 12) // self.seen, w2 + _LEAST // 2, _MOST + _LEAST)
        self.w2, self.w12 = w2.astype(U64), np.where(np.arange(128) & 1, w2, both).astype(U64)
        if self.missed:
            self.count += np.bincount(np.concatenate(self.missed), minlength=len(self.count))
            self.missed = []
        q = self.count * ((1 << _SHARE) - _REST) // max(1, int(self.count.sum()))
        ids = np.flatnonzero(q)
        q = q[ids]
        self.n = n = len(q)
        self.ids = np.append(ids, 0)
        self.cum = np.zeros(n + 2, U64)
        self.cum[1 : n + 1] = np.cumsum(q)
        self.cum[n + 1] = 1 << _SHARE
        self.width = np.diff(self.cum)
        if self.reading:
            self.at = np.repeat(np.arange(n + 1), self.width.astype(np.int64))  # what a place in the shares belongs to
        else:
            self.place = np.full(len(self.count), n)  # and what an id's place is
            self.place[ids] = np.arange(n)

    def predict(self) -> None:
        b = self.before1
        self.i2 = (b * 0x9E3779B1 + self.part2 >> 13) & ((1 << _SLOTS) - 1)
        self.e2, self.e1 = self.after2.take(self.i2), self.after1.take(b)
        self.p2, self.p1 = self.e2 >> 3, self.e1 >> 3
        self.c2, self.c1 = self.e2 & 7, self.e1 & 7
        self.kind = self.c2 << 4 | self.c1 << 1 | (self.p1 == self.p2)

    def learn(self, s: np.ndarray, hit2: np.ndarray, hit1: np.ndarray, missed: np.ndarray) -> None:
        """hit1: p1 is right and p2 was wrong; missed: the ids that neither named."""
        if self.step < _PAUSE or self.step & 3 == 0:  # trust changes little, so a part of the steps tells it
            self.kinds[self.rows] = self.kind + (hit2 * 128 + hit1 * 256)
            self.rows += 1
        self.missed.append(missed)
        fresh, e2, e1 = s << 3 | 1, self.e2, self.e1
        # of strands that meet in a slot the last one's change holds, in coding and decoding alike
        self.after2[self.i2] = np.where(hit2, np.minimum(e2 + 1, e2 | 7), np.where(self.c2 > 1, e2 - 2, fresh))
        self.after1[self.before1] = np.where(s == self.p1, np.minimum(e1 + 1, e1 | 7), np.where(self.c1 > 1, e1 - 2, fresh))
        self.part2 = self.before1 * 0x85EBCA6B
        self.before1 = s
        self.step += 1
        if self.step % _PAUSE == 0 or self.step in _EARLY:
            self.share()


class _Encoder:
    """Range coder states of all strands, and the words they have given out."""

    def __init__(self, strands: int, steps: int) -> None:
        self.words = np.zeros((strands, steps // 2 + 8), np.uint32)
        self.used = np.zeros(strands, np.int64)
        self.low, self.range = np.zeros(strands, U64), np.full(strands, (1 << 64) - 1, U64)
        self.all = np.arange(strands)
        self.given: list[np.ndarray] = []  # which strands gave out a word, when a reader needs a further one
        self.later: list[np.ndarray] = []  # and which of their words that one is

    def narrow(self, strands: np.ndarray | slice, at: np.ndarray, width: np.ndarray) -> None:
        """Narrow the ranges of some strands to their parts of ``width`` from ``at``."""
        low = self.low[strands]
        new = low + at
        over = new < low
        if over.any():
            _carry(self.words, self.used, self.all[strands][over])
        out = np.flatnonzero(width < _TOP)
        where = out if isinstance(strands, slice) else strands[out]
        first, used = new[out], self.used[where]
        self.words[where, used] = first >> U64(32)
        self.used[where] = used + 1
        self.given.append(where)
        self.later.append(used + 2)
        new[out] = first << U64(32)
        width[out] <<= U64(32)
        self.low[strands], self.range[strands] = new, width

    def room(self) -> None:
        """Room for the words of one more id, which are two at most, and the end."""
        if self.used.max() + 5 > self.words.shape[1]:
            self.words = np.concatenate([self.words, np.zeros_like(self.words)], axis=1)

    def end(self) -> bytes:
        """All words: the first two of each strand, then one whenever a strand of the reader asks for it."""
        self.words[self.all, self.used] = self.low >> U64(32)
        self.words[self.all, self.used + 1] = self.low & U64(0xFFFFFFFF)
        given = np.concatenate([self.all, self.all, *self.given])
        place = np.concatenate([self.all * 0, self.all * 0 + 1, *self.later])
        return self.words[given, place].astype("<u4").tobytes()


def _carry(words: np.ndarray, used: np.ndarray, lanes: np.ndarray) -> None:
    at = used[lanes] - 1
    while len(lanes):
        words[lanes, at] += np.uint32(1)
        on = words[lanes, at] == 0
        lanes, at = lanes[on], at[on] - 1


class _Decoder:
    def __init__(self, coded: bytes, strands: int) -> None:
        words = np.frombuffer(coded, "<u4", count=len(coded) // 4).astype(U64)
        self.words = np.concatenate([words, np.zeros(2 * strands, U64)])  # a damaged block may ask for more than there is
        self.code = self.words[:strands] << U64(32) | self.words[strands : 2 * strands]
        self.used, self.range = 2 * strands, np.full(strands, (1 << 64) - 1, U64)

    def narrow(self, strands: np.ndarray | slice, code: np.ndarray, width: np.ndarray) -> None:
        """Go on in a part of each range: ``code`` is counted from its beginning."""
        more = np.flatnonzero(width < _TOP)
        lo = min(self.used, len(self.words) - len(more))
        code[more] = code[more] << U64(32) | self.words[lo : lo + len(more)]
        self.used += len(more)
        width[more] <<= U64(32)
        self.code[strands], self.range[strands] = code, width


def _strands(n: int) -> int:
    """How many strands a block of so many ids has: consecutive runs of equal length, the last one filled up."""
    return min(max(n // 128, 1), STRANDS)


def encode_block(ids: np.ndarray, vocabulary: int) -> bytes:
    """The coded words of a block."""
    strands = _strands(len(ids))
    steps = -(-len(ids) // strands)
    m, coder = _Models(strands, vocabulary), _Encoder(strands, steps)
    bits = U64(max(1, (vocabulary - 1).bit_length()))
    padded = np.zeros(strands * steps, np.uint32)
    padded[: len(ids)] = ids
    for column in np.ascontiguousarray(padded.reshape(strands, steps).T):
        s = column.astype(np.int64)
        coder.room()
        m.predict()
        hit2 = s == m.p2
        hit1 = (s == m.p1) & ~hit2
        part = coder.range >> U64(12)
        t2, t12 = part * m.w2.take(m.kind), part * m.w12.take(m.kind)
        at = np.where(hit2, U64(0), np.where(hit1, t2, t12))
        width = np.where(hit2, t2, np.where(hit1, t12 - t2, coder.range - t12))
        missed = np.flatnonzero(~(hit2 | hit1))
        x = s[missed]
        k = m.place.take(x)
        rest = width[missed]
        part, cum = rest >> U64(_SHARE), m.cum.take(k)
        left = k == m.n
        at[missed] += part * cum
        width[missed] = np.where(left, rest - part * cum, part * m.width.take(k))
        coder.narrow(_ALL, at, width)
        if left.any():
            new = missed[left]
            part = coder.range[new] >> bits
            coder.narrow(new, part * s[new].astype(U64), part)
        m.learn(s, hit2, hit1, x)
    return coder.end()


def decode_block(coded: bytes, n: int, vocabulary: int) -> np.ndarray:
    """The n ids of a block."""
    strands = _strands(n)
    steps = -(-n // strands)
    m, coder = _Models(strands, vocabulary, reading=True), _Decoder(coded, strands)
    bits = U64(max(1, (vocabulary - 1).bit_length()))
    out = np.empty((steps, strands), np.uint32)
    for t in range(steps):
        m.predict()
        part = coder.range >> U64(12)
        t2, t12 = part * m.w2.take(m.kind), part * m.w12.take(m.kind)
        hit2, either = coder.code < t2, coder.code < t12
        hit1 = either & ~hit2
        code = coder.code - np.where(hit2, U64(0), np.where(either, t2, t12))
        width = np.where(hit2, t2, np.where(either, t12 - t2, coder.range - t12))
        s = np.where(hit2, m.p2, m.p1)
        missed = np.flatnonzero(~either)
        rest, c = width[missed], code[missed]
        part = rest >> U64(_SHARE)
        k = m.at.take(np.minimum(c // part, U64((1 << _SHARE) - 1)).astype(np.int64))
        below = part * m.cum.take(k)
        left = k == m.n
        code[missed] = c - below
        width[missed] = np.where(left, rest - below, part * m.width.take(k))
        coder.narrow(_ALL, code, width)
        x = m.ids.take(k)
        if left.any():
            new = missed[left]
            part, c = coder.range[new] >> bits, coder.code[new]
            got = np.minimum(c // part, U64(vocabulary - 1))
            coder.narrow(new, c - got * part, part)
            x[left] = got
        s[missed] = x
        out[t] = s
        m.learn(s, hit2, hit1, x)
    return np.ascontiguousarray(out.T).ravel()[:n]


def encode_blocks(ids: np.ndarray, vocabulary: int) -> list[bytes]:
    """Coded words of equally long blocks, one per row."""
    return [encode_block(row, vocabulary) for row in ids]


def decode_blocks(coded: list[bytes], steps: int, vocabulary: int) -> np.ndarray:
    """Ids of equally long blocks, one per row."""
    return np.stack([decode_block(c, steps, vocabulary) for c in coded])


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_GAP, _LETTER, _MARK, _OTHER = range(4)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_KIND[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = _MARK
_KIND[~SPACED.inside] = _GAP

# What may give a word's ASCII letters another meaning in upper and lower case: accents that a letter joins with
# (the first bytes of U+0300 to U+037F), and the beginning of a special token.
_CASED = (b"\xcc", b"\xcd", b"<|")


class Words(Spans):
    """All words of some texts, cut between an ASCII letter and an ASCII mark after it, with hashes of eight bytes at a time."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        kind = _KIND[data]
        super().__init__(data, offsets, kind != _GAP, (kind[:-1] == _LETTER) & (kind[1:] == _MARK))
        eight, size = _eights(data), self.end - self.start
        self.hash = mix((eight[self.start] & _FIRST[np.minimum(size, 8)]) * FOLD + size.astype(U64))
        more, done = np.flatnonzero((size > 8) & (size <= _LONG)), 8
        while len(more):
            part = eight[self.start[more] + done] & _FIRST[np.minimum(size[more] - done, 8)]
            self.hash[more] = mix(self.hash[more] * FOLD + part)
            done += 8
            more = more[size[more] > done]
        for i in np.flatnonzero(size > _LONG).tolist():
            self.hash[i] = int.from_bytes(blake2b(data[self.start[i] : self.end[i]], digest_size=8).digest())


_LONG = 64  # bytes of a word that are handled eight at a time
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)  # masks of the first bytes of eight


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as a number; zeros follow the last one."""
    return np.ndarray((len(data) + 1,), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (size[0] of them), first[1], and so on; no size is 0."""
    step = np.ones(int(size.sum()), np.int64)
    if len(step):
        step[0] = first[0]
        step[np.cumsum(size[:-1])] = first[1:] - first[:-1] - size[:-1] + 1
    return np.cumsum(step, out=step)


def _equal(data: np.ndarray, one: np.ndarray, two: np.ndarray, size: np.ndarray) -> bool:
    """Whether runs of bytes that begin at ``one`` are those that begin at ``two``; eight bytes are read at a time."""
    eight, long = _eights(data), size > _LONG
    if long.any():
        if np.any(data[_spread(one[long], size[long])] != data[_spread(two[long], size[long])]):
            return False
        one, two, size = one[~long], two[~long], size[~long]
    while len(one):
        differ = eight[one] ^ eight[two]
        if np.any(differ & _FIRST[np.minimum(size, 8)]):
            return False
        more = np.flatnonzero(size > 8)
        one, two, size = one[more] + 8, two[more] + 8, size[more] - 8
    return True


class _Places:
    """The place of each distinct hash among those that were added, in the order of their adding."""

    def __init__(self) -> None:
        self.hashes, self.n = np.zeros(1 << 12, U64), 0
        self.slots = np.full(1 << 13, -1, np.int32)  # places, or -1; never more than half full

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes & U64(len(self.slots) - 1)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Places of some hashes, -1 for those that were not added."""
        out, at, left = np.full(len(hashes), -1), self._slot(hashes), np.arange(len(hashes))
        while len(left):
            place = self.slots[at]
            right = (self.hashes[place] == hashes[left]) & (place >= 0)
            out[left[right]] = place[right]
            on = ~right & (place >= 0)
            left, at = left[on], at[on] + 1 & len(self.slots) - 1
        return out

    def add(self, hashes: np.ndarray) -> None:
        """Add distinct hashes that were not added before."""
        first, self.n = self.n, self.n + len(hashes)
        if self.n > len(self.hashes):
            size = 1 << self.n.bit_length()
            self.hashes = np.concatenate([self.hashes[:first], np.zeros(size - first, U64)])
            self.slots = np.full(2 * size, -1, np.int32)
            self.hashes[first : self.n] = hashes
            first, hashes = 0, self.hashes[: self.n]
        self.hashes[first : self.n] = hashes
        place, at = np.arange(first, self.n), self._slot(hashes)
        while len(place):
            free = self.slots[at] < 0
            self.slots[at[free]] = place[free]
            on = self.slots[at] != place
            place, at = place[on], at[on] + 1 & len(self.slots) - 1


class WordIds:
    """Ids of a tokenizer that never joins across white space, by distinct words.

    A word, here a run without ASCII white space, is encoded by the library when it is first met;
    at most ``MOST`` words are remembered.  The tokenizer takes no notice of case and parts letters from marks,
    so where nothing depends on case, words are lower-cased and cut before a mark: that leaves fewer distinct ones.
    Those words are found again by their hashes, and every one is compared with the word remembered for its hash.
    """

    MOST = 1_000_000

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        # a task has one core: the library's threads would only wait for each other
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.size = max(self.tokenizer.get_vocab().values()) + 1  # all ids are smaller
        special = self.tokenizer.get_added_tokens_decoder()
        #: a special token that no text without "<|" holds, to part words with
        self.between = next(((i, t.content) for i, t in sorted(special.items()) if t.content.startswith("<|") and not t.normalized), None)
        #: which ids end a run of letters, if every run has such an id and no other has
        self.closing = self._closing()
        self.ids = np.zeros(1 << 20, np.uint32)
        self.forget()

    def _closing(self) -> np.ndarray | None:
        model = self.tokenizer.model
        suffix = getattr(model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab()
        from tokenizers.pre_tokenizers import ByteLevel

        if not suffix or any(c + suffix not in vocabulary for c in ByteLevel.alphabet()):
            return None
        closing = np.zeros(max(vocabulary.values()) + 1, bool)
        closing[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        return closing

    def forget(self) -> None:
        self.first = np.ones(1, np.int64)  # where the ids of a word begin; the first place is that of the end of a text
        self.places, self.number = _Places(), np.zeros(0, np.int64)  # words that are found by hash
        self.at, self.bytes = np.zeros(1, np.int64), np.zeros(0, np.uint8)  # and what they are
        self.spelled: dict[bytes, int] = {}  # words that are not

    @property
    def known(self) -> dict[bytes, int]:
        """Numbers of all words that are remembered."""
        raw, at = self.bytes.tobytes(), self.at.tolist()
        return self.spelled | {raw[a:b]: n for a, b, n in zip(at, at[1:], self.number.tolist())}

    def _add(self, words: list[bytes]) -> np.ndarray:
        """Encode words that are not known, and number them."""
        n = len(self.first) - 1
        if words:
            new, size = self._library(words)
            start = int(self.first[-1])
            while start + len(new) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.ids[start : start + len(new)] = new
            self.first = np.concatenate([self.first, start + np.cumsum(size)])
        return np.arange(n, n + len(words))

    def _numbers(self, names: list[bytes]) -> np.ndarray:
        """Numbers of distinct words by their spelling; new ones are encoded."""
        known = self.spelled
        fresh = [w for w in names if w not in known]
        known.update(zip(fresh, self._add(fresh).tolist()))
        return np.fromiter(map(known.__getitem__, names), np.int64, len(names))

    def _found(self, words: Words, data: np.ndarray) -> np.ndarray | None:
        """Number of each word among the known ones, by its hash; None if two words of one hash differ."""
        used = len(self.bytes)
        own, hashes = pd.factorize(words.hash)
        one = np.empty(len(hashes), np.int64)
        one[own[::-1]] = np.arange(len(own))[::-1]  # the first word of each hash
        place = self.places.find(hashes)
        new = np.flatnonzero(place < 0)
        place[new] = np.arange(len(self.number), len(self.number) + len(new))
        start, end = words.start[one[new]], words.end[one[new]]
        code, size = place[own], words.end - words.start
        at = np.concatenate([self.at[:-1], start + used])
        if np.any(size != np.concatenate([np.diff(self.at), end - start])[code]):
            return None
        if not _equal(np.concatenate([self.bytes, data]), words.start + used, at[code], size):
            return None
        if not len(new):
            return self.number[code]
        raw = data.tobytes()
        names = [raw[a:b] for a, b in zip(start.tolist(), end.tolist())]
        self.number = np.concatenate([self.number, self._add(names)])
        self.places.add(hashes[new])
        self.bytes = np.concatenate([self.bytes, np.frombuffer(b"".join(names), np.uint8)])
        self.at = np.concatenate([self.at, used + np.cumsum(end - start)])
        return self.number[code]

    def _words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each word among the known ones, and how many words each text has."""
        raw = data.tobytes()
        if not any(m in raw for m in _CASED):
            data = _LOWER[data]
            words = Words(data, offsets)
            code = self._found(words, data)
            if code is not None:
                return code, np.diff(words.first)
        texts = [raw[a:b].split() for a, b in zip(offsets[:-1], offsets[1:])]
        flat = list(chain.from_iterable(texts))
        code, names = pd.factorize(np.fromiter(flat, object, len(flat)))
        return self._numbers(list(names))[code], np.array([len(t) for t in texts], np.int64)

    def _coded(self, texts: list[str]) -> np.ndarray:
        coded = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(coded), np.uint32, sum(map(len, coded)))

    def _library(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after the other, and how many each has."""
        texts = [w.decode() for w in words]
        if self.closing is not None:
            # A word of letters has one closing id or more: one each, if there are as many as words.
            plain = [t.isalpha() for t in texts]
            letters = list(compress(texts, plain))
            ids = self._coded([" ".join(letters[k : k + 64]) for k in range(0, len(letters), 64)])
            stop = np.flatnonzero(self.closing[ids])
            if len(stop) == len(letters):
                plain = np.array(plain, bool)
                other, other_size = self._parted([t for t in texts if not t.isalpha()])
                size = np.empty(len(texts), np.int64)
                size[plain], size[~plain] = np.diff(stop, prepend=-1), other_size
                out, own = np.empty(int(size.sum()), np.uint32), np.repeat(plain, size)
                out[own], out[~own] = ids, other
                return out, size
        return self._parted(texts)

    def _parted(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after the other, and how many each has: a special token stands between them, or each goes alone."""
        if self.between is None or any("<|" in t for t in texts):
            coded = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            size = np.array([len(c) for c in coded], np.int64)
            return np.fromiter(chain.from_iterable(coded), np.uint32, int(size.sum())), size
        mark, text = self.between
        ids = self._coded([f" {text} ".join([*texts[k : k + 64], ""]) for k in range(0, len(texts), 64)])
        stop = np.flatnonzero(ids == mark)
        return np.delete(ids, stop), np.diff(stop, prepend=-1) - 1

    def encode(self, data: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with ``end`` after it, and how many each text has."""
        if len(self.first) > self.MOST:
            self.forget()
        code, n = self._words(data, offsets)
        self.ids[0] = end
        sizes, stop = np.diff(self.first)[code], np.cumsum(n)
        before = np.concatenate([[0], np.cumsum(sizes)])
        total = before[stop] - before[stop - n] + 1
        first, sizes = np.insert(self.first[code], stop, 0), np.insert(sizes, stop, 1)
        some = sizes > 0
        if not some.all():
            first, sizes = first[some], sizes[some]
        return self.ids[_spread(first, sizes)], total


_tokenizers: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _tokenizers:
        _tokenizers[path] = WordIds(path)
    return _tokenizers[path]


BLOCKS = (
    "file int, block long, size int, n_ids int, vocabulary int, checksum long, words binary, "
    "docs array<struct<doc_id:bigint,place:int,n_tokens:bigint>>"
)
_DOCS = pa.list_(pa.struct([("doc_id", pa.int64()), ("place", pa.int32()), ("n_tokens", pa.int64())]))


def _row(file: int, block: int, size: int, ids: np.ndarray, vocabulary: int, docs: list[tuple[int, int | None, int]]) -> pa.RecordBatch:
    """A coded block; docs: (starting place in the block, id, length)."""
    return pa.RecordBatch.from_arrays(
        [
            pa.array([file], pa.int32()),
            pa.array([block], pa.int64()),
            pa.array([size], pa.int32()),
            pa.array([len(ids)], pa.int32()),
            pa.array([vocabulary], pa.int32()),
            pa.array([zlib.crc32(ids.astype("<u4"))], pa.int64()),
            pa.array([encode_block(ids, vocabulary)], pa.binary()),
            pa.array([[{"doc_id": d, "place": place, "n_tokens": n} for place, d, n in docs]], _DOCS),
        ],
        names=_COLUMNS,
    )


def _write(path: str, end: int, whole: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, block, docs, file, ids = [], 0, 0, [], None, word_ids(path)
        vocabulary = max(ids.size, end + 1)
        for wide in batches:
            for batch in slices(wide, "text", TEXT):
                if not batch.num_rows:
                    continue
                file = batch.column("file")[0].as_py()
                own, sizes = ids.encode(*buffers(batch.column("text")), end)
                at = n
                for d, size in zip(batch.column("doc_id").to_pylist(), sizes.tolist()):
                    docs.append((at, d, size))
                    at += size
                held.append(own)
                n += len(own)
                if n >= whole:
                    flat, lo, k = np.concatenate(held), 0, 0
                    while n - lo >= whole:
                        first = k
                        while k < len(docs) and docs[k][0] < lo + whole:
                            k += 1
                        yield _row(file, block, whole, flat[lo : lo + whole], vocabulary, [(a - lo, d, s) for a, d, s in docs[first:k]])
                        lo, block = lo + whole, block + 1
                    docs = [(a - lo, d, s) for a, d, s in docs[k:]]
                    held, n = [flat[lo:].copy()], n - lo
        if n:
            yield _row(file, block, whole, np.concatenate(held), vocabulary, docs)
        release()

    return run


def write_ids(docs: DataFrame, tokenizer: str, path: str, end: int = END, block: int = BLOCK) -> None:
    """Write the ids of all texts, in ascending order of doc_id, as files of coded blocks at ``path``.

    Null and empty texts are documents of ``end`` alone.  Null ids come first; rows of one id are
    ordered by a hash of their texts.  Other columns are ignored.  Sorting is by range over all tasks.
    """
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = keyed.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    coded = placed.select("doc_id", "text", F.spark_partition_id().alias("file")).mapInArrow(_write(tokenizer, end, block), BLOCKS)
    # a reader holds a row group at a time
    coded.write.option("parquet.block.size", 32 << 20).parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of documents: file, place in the file, length and checksum of what one block has of them."""
    for batch in batches:
        for row in range(batch.num_rows):
            file, block, size, n, vocabulary, check, words, docs = (batch.column(c)[row].as_py() for c in _COLUMNS)
            raw = memoryview(decode_block(words, n, vocabulary).astype("<u4")).cast("B")
            if zlib.crc32(raw) != check:
                raise ValueError(f"block {block} of file {file} is damaged")
            cuts, before = [d["place"] for d in docs], block * size
            rows = []
            if not cuts or cuts[0] > 0:  # the rest of a document that began in an earlier block
                stop = cuts[0] if cuts else n
                rows.append((file, block, size, before, None, None, stop, zlib.crc32(raw[: 4 * stop])))
            for d, stop in zip(docs, [*cuts[1:], n]):
                at = d["place"]
                rows.append((file, block, size, before + at, d["doc_id"], d["n_tokens"], stop - at, zlib.crc32(raw[4 * at : 4 * stop])))
            kinds = [pa.int32(), pa.int64(), pa.int32(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=_PIECES)
    release()


_COLUMNS = ["file", "block", "size", "n_ids", "vocabulary", "checksum", "words", "docs"]
_PIECES = ["file", "block", "size", "place", "doc_id", "n_tokens", "n", "crc"]


def _appending() -> list[list[int]]:
    """Bit matrices of what appending 2**k zero bytes does to a checksum."""
    now = [0xEDB88320] + [1 << i for i in range(31)]  # one zero bit
    out = []
    for k in range(3 + 40):
        if k >= 3:
            out.append(now)
        now = [_times(now, c) for c in now]
    return out


def _times(matrix: list[int], v: int) -> int:
    out, i = 0, 0
    while v:
        if v & 1:
            out ^= matrix[i]
        v, i = v >> 1, i + 1
    return out


_APPENDING = _appending()


def crc32_join(first: int, second: int, size: int) -> int:
    """Checksum of two byte strings one after the other, from theirs and the second's size."""
    k = 0
    while size:
        if size & 1:
            first = _times(_APPENDING[k], first)
        size, k = size >> 1, k + 1
    return first ^ second


def _join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sums = []
        for parts in batch.column("parts").to_pylist():
            crc = parts[0]["crc"]
            for p in parts[1:]:
                crc = crc32_join(crc, p["crc"], 4 * p["n"])
            sums.append(crc)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "start", "n_tokens")), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_digests(blocks: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of each document in the files.

    Blocks are decoded independently and checked; a damaged one raises an error.  A document that
    reaches over several blocks is put together from what each says of it.
    """
    pieces = materialise(blocks.mapInArrow(_read, "file int, block long, size int, place long, doc_id long, n_tokens long, n long, crc long"), "id-pieces")
    heads = pieces.filter("n_tokens is not null").select("file", "block", "size", "place", "doc_id", "n_tokens", "n", "crc")
    later = F.explode(F.expr("sequence(block + 1, (place + n_tokens - 1) div size)"))
    long = heads.filter("n < n_tokens").select("file", "place", "doc_id", "n_tokens", later.alias("block"))
    rest = pieces.filter("n_tokens is null").select("file", "block", "n", "crc")
    parts = long.join(rest, ["file", "block"]).unionByName(heads.filter("n < n_tokens").drop("size"))
    # one row for each block that a document fills
    parts = parts.groupBy("file", "place").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_tokens").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("block", "n", "crc"))).alias("parts")
    )
    one = heads.filter("n = n_tokens").select("file", "place", "doc_id", "n_tokens", F.array(F.struct("block", "n", "crc")).alias("parts"))
    sizes = blocks.groupBy("file").agg(F.sum("n_ids").alias("ids"))
    # one row per file, and there are as many files as the writer had tasks
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    found = one.unionByName(parts).join(bases, "file").select("doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "parts")
    return found.mapInArrow(_join, "doc_id long, start long, n_tokens long, ids_crc32 long")
