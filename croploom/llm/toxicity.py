"""Toxicity: misspelled terms of a learned lexicon, weighed by where they stand.

The lexicon holds words, and stems that any ending may follow.  It is kept as a trie, and its intersection
with the Levenshtein automata of all its terms is worked out once as a table of states: a state is the set of
trie nodes that a word's letters so far can have led to, with the edits spent on each.  A transposition of
neighbours is one edit, the first letter must be right, digits that look like letters are read as these, and
short terms allow no edit.  Words of whole batches then run through the table together.

A hit counts with its term's log-odds, times a factor of its context window: little in a quotation, still less
where the window also reports speech, more where somebody is addressed.  A logistic model of a document's
hits gives the score.  Lexicon, odds and model are learned from labelled documents.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from croploom.llm.words import ALNUM, Words, buffers, slices
from croploom.session import materialise, scratch

TRAIN_TOXIC, TRAIN_CLEAN = 5_000, 10_000  # most labelled documents of each kind that are learned from
TERMS = 100  # most terms taken from labelled documents
LEAST_DOCS = 5  # toxic documents that a learned term must occur in
EVIDENCE = 18.0  # natural log of the likelihood ratio from which a term is taken: a million candidates are tried
STEMS = range(4, 8)  # letters of stems
WINDOW, REACH = 8, 2_000  # words and characters around a hit that are its context
PIECE = 1 << 20  # characters handled at a time
QUOTED, REPORTED, ADDRESSED = 0.35, 0.4, 1.3  # factors of a hit's context
DEFAULT, FUZZY = 3.0, 0.7  # log-odds of a term without evidence, and share of it left for each edit
PRIOR = (-2.5, 1.0, 0.5, 0.3, 0.3)  # what the model is drawn to where there is little evidence
RIDGE = 2.0

#: Terms that are known without labels.
SEEDS = (
    "idiot idiots moron morons imbecile imbecil imbécile stupid scum loser losers pathetic worthless disgusting bastard "
    "abschaum trottel arschloch dummkopf crétin connard débile estúpido gilipollas cabrón"
).split()
#: Words around a quotation that report what somebody else said, and words that address a reader.
REPORT = (
    "said says wrote writes called calls quoted quote quotes alleged reported according word term "
    "sagte schrieb nannte zitat dit écrit appelé cité dijo escribió llamó cita"
).split()
ADDRESS = "you your you're youre du dich dein ihr tu toi vous votre tú usted ustedes".split()
LOOKS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t"}

HIT, REPORTS, ADDRESSES = 0, 1, 2


@dataclass(frozen=True)
class Term:
    text: str
    stem: bool = False
    kind: int = HIT

    @property
    def edits(self) -> int:
        """Edits that a word may be away: none for short terms."""
        if self.kind != HIT:
            return 0
        n = len(self.text) - (2 if self.stem else 0)
        return 0 if n < 5 else 1 if n < 9 else 2


@dataclass
class Automaton:
    """States over classes of characters; state 0 is dead, state 1 the start."""

    table: np.ndarray  # (states, classes) -> state
    found: np.ndarray  # (states, 2): term and edits if a word ends here, -1 for none
    settled: np.ndarray  # whether nothing that follows can change what was found
    classes: dict[str, int]


def _trie(terms: list[Term]) -> tuple[list[dict[str, int]], list[list[int]], list[int]]:
    """Children, terms that end at, and most edits below each node."""
    kids, ends, most = [{}], [[]], [0]
    for t, term in enumerate(terms):
        at, most[0] = 0, max(most[0], term.edits)
        for ch in term.text:
            if ch not in kids[at]:
                kids[at][ch] = len(kids)
                kids.append({})
                ends.append([])
                most.append(0)
            at = kids[at][ch]
            most[at] = max(most[at], term.edits)
        ends[at].append(t)
    return kids, ends, most


def compile_terms(terms: list[Term]) -> Automaton:
    """The intersection of the terms' Levenshtein automata with the trie that they form.

    Of several terms that a word may be, the one with the fewest edits is found, then the longest, then the
    first in the list.
    """
    kids, ends, most = _trie(terms)
    letters = sorted({c for t in terms for c in t.text})
    classes = {c: i + 2 for i, c in enumerate(letters)}  # 0: no letter, 1: a letter of no term

    def put(out: dict, node: int, spent: int, want: str) -> None:
        if spent > most[node] or out.get((node, want), 99) <= spent:
            return
        out[node, want] = spent
        if not want and node:
            for child in kids[node].values():  # a letter that the word lacks
                put(out, child, spent + 1, "")

    def step(state: tuple, ch: str) -> tuple:
        out: dict[tuple[int, str], int] = {}
        for (node, want), spent in state:
            if want:
                if ch == want:
                    put(out, node, spent, "")
                continue
            if ch in kids[node]:
                put(out, kids[node][ch], spent, "")
            if not node:
                continue
            put(out, node, spent + 1, "")  # a letter too many
            for other, child in kids[node].items():
                if other != ch:
                    put(out, child, spent + 1, "")  # a wrong letter
                    if ch in kids[child]:
                        put(out, kids[child][ch], spent + 1, other)  # two letters in the wrong order
        return tuple(sorted(out.items()))

    def rank(hit):
        term, spent = hit
        return spent, -len(terms[term].text), term

    def hits(state: tuple, stem: bool):
        return [(t, spent) for (node, want), spent in state if not want for t in ends[node] if terms[t].stem == stem and spent <= terms[t].edits]

    start = ((((0, ""), 0),), None)
    number, todo = {start: 1}, [start]
    rows, found, settled = [[0] * (len(classes) + 2), None], [(-1, -1)], [True]
    while todo:
        grown = []
        for state, stem in todo:
            row = [0] * (len(classes) + 2)
            for ch, k in [("\0", 1), *classes.items()]:
                after = step(state, ch)
                best = min([h for h in (stem, *hits(after, True)) if h], key=rank, default=None)
                key = (after, best)
                if not after and best is None:
                    continue
                if key not in number:
                    number[key] = len(number) + 1
                    grown.append(key)
                row[k] = number[key]
            n = number[state, stem]
            while len(rows) <= n:
                rows.append(None)
            rows[n] = row
            best = min([h for h in (stem, *hits(state, False)) if h], key=rank, default=None)
            while len(found) <= n:
                found.append((-1, -1))
                settled.append(False)
            found[n] = best or (-1, -1)
            settled[n] = not state
        todo = grown
    return Automaton(np.array(rows, np.int32), np.array(found, np.int32), np.array(settled), classes)


_kinds: np.ndarray | None = None


def _characters() -> np.ndarray:
    """For each code point: -1 if no letter, else that of its lower case; digits may stand for letters."""
    global _kinds
    if _kinds is None:
        out = np.full(0x110000, -1, np.int32)
        for c in range(0x20000):
            ch = chr(c)
            if unicodedata.category(ch)[0] in "LM":
                low = ch.lower()
                out[c] = ord(low) if len(low) == 1 else c
        for d in "0123456789":
            out[ord(d)] = ord(LOOKS.get(d, d))
        out[0x20000:0x32000] = np.arange(0x20000, 0x32000)  # ideographs beyond the first planes
        _kinds = out
    return _kinds


@dataclass
class Model:
    terms: list[Term]
    odds: dict[tuple[int, int], float]  # of term and edits
    weights: tuple[float, ...] = PRIOR
    automaton: Automaton = field(init=False)

    def __post_init__(self) -> None:
        self.automaton = compile_terms(self.terms)
        self.lookup = np.zeros((len(self.terms), 3))
        for t, term in enumerate(self.terms):
            for e in range(term.edits + 1):
                self.lookup[t, e] = max(0.0, self.odds.get((t, e), DEFAULT * FUZZY**e))

    def classes(self) -> np.ndarray:
        """The automaton's class of each code point."""
        of = np.zeros(0x110000, np.int16)
        low = _characters()
        of[low >= 0] = 1
        for ch, k in self.automaton.classes.items():
            of[low == ord(ch)] = k
        return of


def run_words(auto: Automaton, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words of classed characters, and the state that each ends in."""
    inside = cls > 0
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    state = np.ones(len(start), np.int32)
    live, at = np.arange(len(start)), start.copy()
    now = state
    while len(live):
        now = auto.table[now, cls[at]]
        state[live] = now
        at = at + 1
        go = (now > 0) & ~auto.settled[now] & (at < end[live])
        live, at, now = live[go], at[go], now[go]
    return start, end, state


@dataclass
class Hits:
    """Hits of some texts, ordered by text and place."""

    doc: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    term: np.ndarray
    edits: np.ndarray
    quoted: np.ndarray
    value: np.ndarray
    words: np.ndarray  # of each text


def _between(places: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """How many of the ascending places are in [lo, hi)."""
    return np.searchsorted(places, hi) - np.searchsorted(places, lo)


def _segments(texts: list[str | None]) -> Iterator[list[tuple[int, int, int, int, np.ndarray]]]:
    """Groups of (text, first, core from, core to, code points): whole texts, or parts with margins.

    A part's core ends between words; what lies around it is context only.
    """
    held, n = [], 0
    low = _characters()
    for i, text in enumerate(texts):
        x = np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)
        lo = 0
        while lo < len(x):
            hi = min(lo + PIECE, len(x))
            while hi < len(x) and low[x[hi]] >= 0 and low[x[hi - 1]] >= 0:
                stop = np.flatnonzero(low[x[hi : hi + PIECE]] < 0)
                hi = hi + int(stop[0]) if len(stop) else min(hi + PIECE, len(x))
            a, b = max(0, lo - REACH), min(len(x), hi + REACH)
            held.append((i, a, lo, hi, x[a:b]))
            n += b - a
            lo = hi
            if n >= PIECE:
                yield held
                held, n = [], 0
    if held:
        yield held


def find(texts: list[str | None], model: Model, classes: np.ndarray) -> Hits:
    """All hits in whole texts."""
    auto, kinds = model.automaton, np.array([t.kind for t in model.terms], np.int8)
    words = np.zeros(len(texts), np.int64)
    parts: list[list[np.ndarray]] = []
    gap = np.zeros(REACH + 1, np.uint32)
    for group in _segments(texts):
        sizes = np.array([len(s[4]) for s in group])
        base = np.concatenate([[0], np.cumsum(sizes + len(gap))[:-1]])  # parts are further apart than any context
        x = np.concatenate([p for s in group for p in (s[4], gap)])
        start, end, state = run_words(auto, classes[x])
        seg = np.searchsorted(base, start, side="right") - 1
        lo, hi = np.array([s[2] - s[1] for s in group])[seg] + base[seg], np.array([s[3] - s[1] for s in group])[seg] + base[seg]
        core = (start >= lo) & (start < hi)
        words += np.bincount(np.array([s[0] for s in group])[seg[core]], minlength=len(texts))
        term, edits = auto.found[state, 0], auto.found[state, 1]
        marked = np.flatnonzero(term >= 0)
        kind = kinds[term[marked]]
        hit = marked[(kind == HIT) & core[marked]]
        if not len(hit):
            continue
        at = start[hit]

        def near(which: int) -> np.ndarray:
            own = marked[kind == which]  # word numbers, and so ascending
            close = (start[own] if len(own) else own).astype(np.int64)
            a, b = np.maximum(hit - WINDOW, 0), np.minimum(hit + WINDOW, len(start) - 1)
            return _between(close, np.maximum(start[a], at - REACH), np.minimum(start[b] + 1, at + REACH)) > 0

        line = np.flatnonzero(x == 10)
        before = np.searchsorted(line, at)
        from_ = np.maximum(at - REACH, np.where(before > 0, line[np.maximum(before - 1, 0)] if len(line) else 0, 0))
        to = np.minimum(at + REACH, np.where(before < len(line), line[np.minimum(before, max(len(line) - 1, 0))] if len(line) else len(x), len(x)))
        straight = np.flatnonzero(x == 0x22)
        opens, closes = np.flatnonzero(np.isin(x, (0x201C, 0x201E, 0xAB))), np.flatnonzero(np.isin(x, (0x201D, 0xBB)))
        quoted = (_between(straight, from_, at) % 2 == 1) & (_between(straight, at, to) > 0)
        quoted |= (_between(opens, from_, at) > _between(closes, from_, at)) & (_between(closes, at, to) > 0)
        factor = np.where(quoted, QUOTED * np.where(near(REPORTS), REPORTED, 1.0), np.where(near(ADDRESSES), ADDRESSED, 1.0))
        value = model.lookup[term[hit], edits[hit]] * factor
        shift = np.array([s[1] for s in group])[seg[hit]] - base[seg[hit]]
        doc = np.array([s[0] for s in group])[seg[hit]]
        parts.append([doc, at + shift, end[hit] + shift, term[hit], edits[hit], quoted, value])
    cols = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 5 + [np.zeros(0, bool), np.zeros(0)]
    return Hits(*cols, words)


def features(h: Hits) -> np.ndarray:
    """For each text: one, sum of values, largest value, different terms, and sum per hundred words."""
    n = len(h.words)
    total = np.bincount(h.doc, h.value, minlength=n)
    top = np.zeros(n)
    np.maximum.at(top, h.doc, h.value)
    some = h.value > 0
    pairs = np.unique(np.stack([h.doc[some], h.term[some]]), axis=1)
    kinds = np.bincount(pairs[0], minlength=n) if pairs.size else np.zeros(n)
    rate = 100 * total / np.maximum(h.words, 1)
    return np.stack([np.ones(n), np.log1p(total), top, np.log1p(kinds), np.log1p(rate)], axis=1)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, prior: tuple[float, ...] = PRIOR, ridge: float = RIDGE) -> tuple[float, ...]:
    """Weights of a logistic model, drawn to ``prior``; by Newton's method."""
    centre, b = np.array(prior), np.array(prior)
    pull = np.full(len(prior), ridge)
    pull[0] = ridge / 10
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -35, 35)))
        slope = x.T @ (weight * (y - p)) - pull * (b - centre)
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(pull)
        move = np.linalg.solve(curve, slope)
        b = b + np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return tuple(float(v) for v in b)


def labelled(docs: DataFrame, labels: DataFrame, toxic: int = TRAIN_TOXIC, clean: int = TRAIN_CLEAN) -> tuple[DataFrame, dict[int, int]]:
    """Documents to learn from (text, toxic) and how many labelled ids there are of each kind.

    Of the ids with a label 0 or 1 whose crc32 mod 4 is not 2, those with the smallest hashes are taken, at
    most ``toxic`` and ``clean`` of them.  An id with several labels counts as toxic if one says so; one with
    several texts teaches one of them.  Of copies and near copies one counts.
    """
    usable = labels.filter("doc_id is not null and toxic in (0, 1) and crc32(cast(doc_id as string)) % 4 <> 2")
    ids = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    held = ids.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    held = materialise(held, "toxic-ids")
    counts = {r.toxic: r["count"] for r in held.groupBy("toxic").count().collect()}
    order = F.xxhash64(F.lit(13), "doc_id")
    taken = held.filter("toxic = 1").orderBy(order, "doc_id").limit(toxic).unionByName(held.filter("toxic = 0").orderBy(order, "doc_id").limit(clean))
    # at most toxic + clean rows of two numbers
    own = docs.select("doc_id", "text").join(F.broadcast(taken), "doc_id")
    own = own.groupBy("doc_id", "toxic").agg(F.min_by(F.coalesce("text", F.lit("")), F.xxhash64("text")).alias("text"))
    own = own.select("text", "toxic").mapInArrow(_signed, "text string, toxic int, low long, high long")
    # copies say what their original says: one of each group that shares its smallest or its largest window
    own = own.groupBy("toxic", "low").agg(F.min_by(F.struct("text", "high"), F.struct("high", F.xxhash64("text"))).alias("o"))
    own = own.groupBy("toxic", "o.high").agg(F.min_by("o.text", F.xxhash64("o.text")).alias("text"))
    return materialise(own.select("text", "toxic"), "toxic-sample"), counts


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The smallest and the largest hash of five words of each text; of fewer words that of all."""
    for whole in batches:
        for batch in slices(whole, "text"):
            data, off = buffers(batch.column("text"))
            words = Words(data, off, ALNUM)
            at, h = words.windows(5)
            h = h.view(np.int64)
            cut = np.searchsorted(at, words.first)
            low, high = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for i, (a, b) in enumerate(zip(cut, cut[1:])):
                own = h[a:b] if b > a else words.hash[words.first[i] : words.first[i + 1]].view(np.int64)
                if len(own):
                    low[i], high[i] = own.min(), own.max()
            yield pa.RecordBatch.from_arrays(
                [batch.column("text"), batch.column("toxic"), pa.array(low), pa.array(high)], names=["text", "toxic", "low", "high"]
            )


_WORD = re.compile(r"[^\W\d_]+")


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many toxic and clean texts of a task hold each word and stem."""
    n: tuple[Counter, Counter] = Counter(), Counter()
    for whole in batches:
        for batch in slices(whole, "text"):
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                words = set(_WORD.findall(text.lower()))
                own = {w for w in words if len(w) <= 40}
                for k in STEMS:
                    own |= {w[:k] + "*" for w in words if len(w) > k}
                n[toxic].update(own)
    tokens = list(n[0].keys() | n[1].keys())
    yield pa.RecordBatch.from_arrays(
        [pa.array(tokens, pa.string()), pa.array([n[1][t] for t in tokens], pa.int64()), pa.array([n[0][t] for t in tokens], pa.int64())],
        names=["token", "bad", "good"],
    )


def lexicon(sample: DataFrame, n_toxic: int, n_clean: int, most: int = TERMS) -> list[Term]:
    """Words and stems that toxic texts hold far more often than others, best first, without nested ones.

    A stem stands for all words that begin with it, so a shorter or longer one of the same words adds
    nothing; of nested ones that with more evidence stays, of equal ones the word, then the longer stem.
    """
    if not n_toxic or not n_clean:
        return []
    share = n_toxic / (n_toxic + n_clean)
    counts = sample.mapInArrow(_tokens, "token string, bad long, good long").groupBy("token").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    rate = F.col("bad") / (F.col("bad") + F.col("good"))
    evidence = F.col("bad") * F.log(rate / share) + F.when(F.col("good") > 0, F.col("good") * F.log((1 - rate) / (1 - share))).otherwise(0.0)
    seen = counts.filter(F.col("bad") >= LEAST_DOCS).withColumn("rate", rate).filter(F.col("rate") > min(0.9, 2 * share))
    seen = seen.withColumn("evidence", F.round(evidence, 6)).filter(F.col("evidence") >= EVIDENCE)
    stem = F.col("token").endswith("*")
    best = seen.orderBy(F.desc("evidence"), stem, F.desc(F.length("token")), "token").limit(20 * most).collect()
    out: list[Term] = []
    for r in best:
        text = r.token.rstrip("*")
        if not any(text.startswith(t.text) or t.text.startswith(text) for t in out):
            out.append(Term(text, r.token.endswith("*")))
        if len(out) == most:
            break
    return out


def _evidence(model: Model):
    """For each text of the sample: its label, and term * 3 + edits of its hits with how often each is there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = model.classes()
        n: tuple[Counter, Counter] = Counter(), Counter()
        for whole in batches:
            for batch in slices(whole, "text"):
                labels = np.array(batch.column("toxic").to_pylist(), np.int64)
                h = find(batch.column("text").to_pylist(), model, classes)
                for d, code in np.unique(np.stack([h.doc, h.term * 3 + h.edits]), axis=1).T.tolist() if len(h.doc) else ():
                    n[labels[d]][code] += 1
        codes = sorted(n[0].keys() | n[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(codes, pa.int64()), pa.array([n[1][c] for c in codes], pa.int64()), pa.array([n[0][c] for c in codes], pa.int64())],
            names=["code", "bad", "good"],
        )

    return run


def _rows(model: Model):
    """Features of each text of the sample, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = model.classes()
        for whole in batches:
            for batch in slices(whole, "text"):
                x = features(find(batch.column("text").to_pylist(), model, classes))
                yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array([r.tobytes() for r in x], pa.binary())], names=["toxic", "x"])

    return run


def learn(docs: DataFrame, labels: DataFrame, toxic: int = TRAIN_TOXIC, clean: int = TRAIN_CLEAN) -> Model:
    """A model from documents (doc_id, text) and labels (doc_id, toxic).

    At most ``toxic`` and ``clean`` documents are learned from, so what reaches the driver is bounded: counts of
    candidate terms and five numbers of each such document.  Without labels the seeds count alone.
    """
    with scratch(docs.sparkSession):
        sample, counts = labelled(docs, labels, toxic, clean)
        taken = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
        n_toxic, n_clean = taken.get(1, 0), taken.get(0, 0)
        own = lexicon(sample, n_toxic, n_clean)
        more = [Term(s) for s in SEEDS if not any(s == t.text or (t.stem and s.startswith(t.text)) for t in own)]
        terms = own + more + [Term(w, kind=REPORTS) for w in REPORT] + [Term(w, kind=ADDRESSES) for w in ADDRESS]
        model = Model(terms, {})
        if not n_toxic + n_clean:
            return model
        seen = sample.mapInArrow(_evidence(model), "code long, bad long, good long").groupBy("code").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).collect()
        odds = {}
        for r in seen:
            term, edits = divmod(r.code, 3)
            expected = DEFAULT * FUZZY**edits
            ratio = ((r.bad + 0.5) / (n_toxic + 1)) / ((r.good + 0.5) / (n_clean + 1))
            n = r.bad + r.good
            odds[term, edits] = max(-2.0, min(6.0, (n * math.log(ratio) + 2 * expected) / (n + 2)))
        model = Model(terms, odds)
        rows = sample.mapInArrow(_rows(model), "toxic int, x binary").collect()
        x = np.array([np.frombuffer(r.x) for r in rows])
        y = np.array([r.toxic for r in rows], float)
        # the sample holds more toxic documents than the corpus: weights give each kind its share back
        share = {k: counts.get(k, 0) / max(taken.get(k, 0), 1) for k in (0, 1)}
        weight = np.array([share[int(v)] for v in y])
        weight *= len(y) / weight.sum()
        model.weights = logistic(x, y, weight)
        return model


SPANS = "array<struct<start:bigint,stop:bigint,term:string,edits:int,quoted:boolean,value:double>>"


def score(docs: DataFrame, model: Model, spans: bool = True) -> DataFrame:
    """``docs`` (any columns besides text) with score, 0 to 1, and the ``toxic_spans`` it rests on.

    A span has code points (stop exclusive), the term, its edits, whether it is quoted, and its value.  Whole
    texts count.  Null, empty and wordless texts have no span and all get one score, that of no hit; repeated
    rows and equal texts get equal scores; an empty table gives no rows.  Columns of ``docs`` named score or
    toxic_spans are replaced.
    """
    docs = docs.drop("score", "toxic_spans")
    weights = np.array(model.weights)
    names = [t.text + ("*" if t.stem else "") for t in model.terms]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = model.classes()
        for whole in batches:
            for batch in slices(whole, "text"):
                h = find(batch.column("text").to_pylist(), model, classes)
                p = 1 / (1 + np.exp(-np.clip(features(h) @ weights, -35, 35)))
                cols, heads = [*batch.columns, pa.array(p)], [*batch.schema.names, "score"]
                if spans:
                    order = np.argsort(h.doc, kind="stable")
                    cuts = np.searchsorted(h.doc[order], np.arange(batch.num_rows + 1)).astype(np.int32)
                    fields = {
                        "start": pa.array(h.start[order].astype(np.int64)),
                        "stop": pa.array(h.stop[order].astype(np.int64)),
                        "term": pa.array([names[t] for t in h.term[order]], pa.string()),
                        "edits": pa.array(h.edits[order].astype(np.int32)),
                        "quoted": pa.array(h.quoted[order]),
                        "value": pa.array(h.value[order]),
                    }
                    found = pa.StructArray.from_arrays(list(fields.values()), names=list(fields))
                    cols.append(pa.ListArray.from_arrays(pa.array(cuts), found))
                    heads.append("toxic_spans")
                yield pa.RecordBatch.from_arrays(cols, names=heads)

    more = ["0d score"] + ([f"cast(array() as {SPANS}) toxic_spans"] if spans else [])
    return docs.mapInArrow(run, docs.selectExpr("*", *more).schema)
