"""Secret scans: three fixed patterns, and character Markov models for everything that has no pattern.

Two first-order models of character pairs, one of random strings and one of ordinary identifiers, are
compared by their log-likelihood ratio.  Both are learned from labelled samples by counting.  All work
on texts is done by built-in functions.  Positions come from the lengths of what lies between matches,
summed in runs of ``RUN`` matches, so a text with very many matches costs little more than its length.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from croploom.llm.langid import taken

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")
TRAIN_DOCS = 5_000  # expected number of documents whose words and secrets the models are learned from
LEAST = 20  # characters of a string that the models judge
RATIO = 12.0  # log-likelihood ratio from which a string counts as random
RUN = 256
BACK_OFF = 20.0

#: Symbols of the models, numbered from 1; everything else is symbol 0.
SYMBOLS = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}"
_N = len(SYMBOLS) + 1
_SPAN = "array<struct<start:bigint,stop:bigint,found:string>>"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def matches(text: str, pattern: str) -> Column:
    """All matches of a pattern in a column: start and stop in code points, and what was found."""
    p = _quoted(pattern)
    one = "named_struct('at', s.at + m.gap + length(m.found), 'out', concat(s.out, array(named_struct('start', s.at + m.gap, 'stop', s.at + m.gap + length(m.found), 'found', m.found))))"
    run = f"aggregate(r, named_struct('at', t.at, 'out', cast(array() as {_SPAN})), (s, m) -> {one})"
    whole = (
        f"aggregate(transform(sequence(0, cast((size(z) - 1) div {RUN} as int)), c -> slice(z, c * {RUN} + 1, {RUN})), "
        f"named_struct('at', 0L, 'out', cast(array() as {_SPAN})), "
        f"(t, r) -> named_struct('at', t.at + aggregate(r, 0L, (n, m) -> n + m.gap + length(m.found)), 'out', concat(t.out, {run}.out))).out"
    )
    zipped = f"zip_with(slice(split({text}, {p}, -1), 1, size(regexp_extract_all({text}, {p}, 0))), regexp_extract_all({text}, {p}, 0), (g, f) -> named_struct('gap', cast(length(g) as bigint), 'found', f))"
    # the one-element transform names the zipped array, which is used several times
    return F.expr(f"case when {text} rlike {p} then transform(array({zipped}), z -> {whole})[0] else cast(array() as {_SPAN}) end")


@dataclass(frozen=True)
class Models:
    """Log-likelihood ratio of each pair of symbols, row by row."""

    ratios: tuple[float, ...]


def learn(samples: DataFrame) -> Models:
    """Models from labelled samples (text, random); rows with a null in either teach nothing.

    A symbol's frequency after another is smoothed with its frequency at large, as if BACK_OFF more pairs
    had been seen; without any samples all ratios are 0.
    """
    pairs = (
        samples.filter("text is not null and random is not null and length(text) > 1")
        .selectExpr("random", "explode(transform(sequence(1, length(text) - 1), i -> substring(text, i, 2))) pair")
        .groupBy("random", "pair")
        .count()
        .withColumns({"a": F.expr(_symbol("substring(pair, 1, 1)")), "b": F.expr(_symbol("substring(pair, 2, 1)"))})
        .groupBy("random", "a", "b")
        .agg(F.sum("count").alias("n"))
    )
    logs = {}
    rows = pairs.collect()
    for kind in (True, False):
        n = [0.0] * (_N * _N)
        for r in rows:
            if r.random == kind:
                n[r.a * _N + r.b] += r.n
        total = sum(n)
        alone = [(sum(n[b::_N]) + 1) / (total + _N) for b in range(_N)]
        after = [sum(n[a * _N : (a + 1) * _N]) for a in range(_N)]
        logs[kind] = [math.log((x + BACK_OFF * alone[i % _N]) / (after[i // _N] + BACK_OFF)) for i, x in enumerate(n)]
    return Models(tuple(round(x - y, 6) for x, y in zip(logs[True], logs[False])))


def _symbol(char: str) -> str:
    return f"locate({char}, '{SYMBOLS}')"


def samples_of(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """Labelled samples (text, random) from a corpus.

    Random: what the fixed patterns find, and digests of the texts in base 16, 64 and 36.  Ordinary:
    words without digits, alone and joined as identifiers.  Rows are taken by a hash of their id (where
    there is one) and text, ``train_docs`` in expectation, so a text that many rows have counts by its
    share of them; every word of those counts.
    """
    texts = docs.filter("text is not null")
    n = F.lit(float(max(texts.count(), 1)))
    own = texts.filter(taken(n, train_docs, *(F.col(c) for c in ("doc_id", "text") if c in docs.columns))).select("text")
    a, c, h = (_quoted(p) for p in (ASSIGN, ACCESS, HEX))
    seeded = "array(sha2(text, 256), translate(base64(unhex(sha2(text, 384))), '=', ''), conv(substring(sha2(text, 224), 1, 15), 16, 36), substring(sha2(text, 512), 1, 40))"
    random = f"concat(regexp_extract_all(text, {a}, 2), regexp_extract_all(text, {c}, 0), regexp_extract_all(text, {h}, 0), {seeded})"
    words = "regexp_extract_all(text, '(?<![A-Za-z0-9])[A-Za-z]{2,}(?![0-9])', 0)"
    joined = "transform(w, (x, i) -> case i % 4 when 0 then x when 1 then concat(x, '_', w[i - 1]) when 2 then concat(x, initcap(w[i - 1])) else concat(x, '-', w[i - 1]) end)"
    good = own.select(F.expr(f"explode({random})").alias("text")).withColumn("random", F.lit(True)).filter("length(text) >= 6")
    plain = own.select(F.expr(f"explode(transform(array({words}), w -> {joined})[0])").alias("text")).withColumn("random", F.lit(False))
    return good.unionByName(plain)


def _ratio(found: str, models: Models) -> str:
    """SQL for the log-likelihood ratio of a string expression."""
    table = "array(" + ",".join(f"{x}D" for x in models.ratios) + ")"
    a, b = _symbol(f"substring({found}, i, 1)"), _symbol(f"substring({found}, i + 1, 1)")
    return f"aggregate(sequence(1, length({found}) - 1), 0D, (acc, i) -> acc + {table}[{a} * {_N} + {b}])"


def scan(docs: DataFrame, models: Models, least: int = LEAST, ratio: float = RATIO) -> DataFrame:
    """``docs`` (any columns besides text) with ``secrets``: spans (kind, start, stop), in order.

    start and stop are code points, stop exclusive; order is by start, then assign, access, hex, markov.
    Per kind, matches are leftmost and do not overlap; an assigned value needs 6 characters.  A markov
    span is a string of ``least`` characters or more whose ratio reaches ``ratio`` and that no other
    span touches.  Null and empty texts have none; repeated rows each get theirs.  A column of ``docs``
    named secrets is replaced.
    """
    kinds = {"assign": (ASSIGN, None), "access": (ACCESS, None), "hex": (HEX, None)}
    names = {k: f"__secret_{k}" for k in KINDS}
    out = docs.drop("secrets").withColumns({names[k]: matches("coalesce(text, '')", p) for k, (p, _) in kinds.items()})
    value = f"length(regexp_extract(m.found, {_quoted(ASSIGN)}, 2)) >= 6"
    out = out.withColumn(names["assign"], F.expr(f"filter({names['assign']}, m -> {value})"))
    fixed = ", ".join(f"transform({names[k]}, m -> named_struct('start', m.start, 'kind', {i}, 'stop', m.stop))" for i, k in enumerate(KINDS[:3]))
    out = out.withColumn("__secret_fixed", F.expr(f"concat({fixed})"))
    out = out.withColumn(names["markov"], matches("coalesce(text, '')", CANDIDATE % least))
    apart = "not exists(__secret_fixed, f -> f.start < m.stop and m.start < f.stop)"
    judged = f"filter({names['markov']}, m -> {apart} and {_ratio('m.found', models)} >= {ratio}D)"
    out = out.withColumn("__secret_more", F.expr(f"transform({judged}, m -> named_struct('start', m.start, 'kind', 3, 'stop', m.stop))"))
    named = "element_at(array('assign', 'access', 'hex', 'markov'), s.kind + 1)"
    order = "array_sort(concat(__secret_fixed, __secret_more))"
    out = out.withColumn("secrets", F.expr(f"transform({order}, s -> named_struct('kind', {named}, 'start', s.start, 'stop', s.stop))"))
    return out.drop(*names.values(), "__secret_fixed", "__secret_more")


def redacted(text: str = "text", secrets: str = "secrets", mark: str = "[SECRET]") -> Column:
    """The text with every run of secrets replaced by a mark."""
    step = (
        "named_struct('at', greatest(a.at, s.stop), 'out', if(s.start < a.at, a.out, "
        f"concat(a.out, array(substring({text}, cast(a.at + 1 as int), cast(s.start - a.at as int)), '{mark}'))))"
    )
    whole = f"aggregate({secrets}, named_struct('at', 0L, 'out', cast(array() as array<string>)), (a, s) -> {step}, a -> concat(array_join(a.out, ''), substring({text}, cast(a.at + 1 as int))))"
    return F.expr(f"if(size({secrets}) > 0, {whole}, {text})")


def scan_corpus(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """``scan`` with models learned from the corpus itself."""
    return scan(docs, learn(samples_of(docs, train_docs)))
