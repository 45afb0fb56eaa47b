"""Secret spans against plain regular expressions, and the models on strings they have not seen."""

import base64
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from croploom.llm import secrets as S

ASCII_ASSIGN = re.compile(
    "(%s)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    % "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "apikey", "api_key"))
)


def base(text):
    t = text or ""
    out = [("assign", m.start(), m.end()) for m in ASCII_ASSIGN.finditer(t) if len(m.group(2)) >= 6]
    out += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m.group()) >= 20]
    out += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m.group()) >= 24]
    return sorted(out, key=lambda s: (s[1], S.KINDS.index(s[0])))


@pytest.fixture(scope="module")
def models(spark):
    rnd = random.Random(5)
    syl = ["ta", "ren", "count", "er", "max", "get", "value", "list", "to", "string", "user", "name", "in", "der"]
    rows = [("_".join(rnd.choice(syl) for _ in range(5)), False) for _ in range(400)]
    rows += [("".join(rnd.choice(syl) for _ in range(6)), False) for _ in range(400)]
    rows += [(base64.b64encode(hashlib.sha256(b"%d" % i).digest()).decode(), True) for i in range(300)]
    rows += [(hashlib.sha256(b"x%d" % i).hexdigest(), True) for i in range(300)]
    return S.learn(spark.createDataFrame([*rows, (None, True), ("abc", None)], "text string, random boolean"))


def pieces(seed):
    rnd = random.Random(seed)
    parts = ["password=", "Token : '", "api_key", "APIKEY=", "secret: token = abcdef123 ", "ſecret=abcdefgh ", " ", "é字", "\n", "x" * 5]
    parts += ["AKIA" + "Z9" * 8, "AKIAKIA" + "B" * 15, "a1" * 12, "deadbeef" * 2, "=", "passwd:'ab.c/d-e'", "token==abc", '"token"="q1w2e3r4"']
    return "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60)))


def test_base_spans(spark, models):
    texts = [None, "", " ", *(pieces(i) for i in range(120)), "é password=abcdef " * 700]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, secrets string")
    rows = {r.doc_id: r for r in S.scan(df, models).collect()}
    for i, t in enumerate(texts):
        spans = [tuple(s) for s in rows[i].secrets]
        assert [s for s in spans if s[0] != "markov"] == base(t), t
        fixed = base(t)
        for kind, a, b in spans:
            if kind == "markov":
                assert all(b <= x or y <= a for _, x, y in fixed) and re.fullmatch(r"[A-Za-z0-9+/_=-]{20,}", t[a:b])


def test_models_tell_random_from_ordinary(spark, models):
    fresh = [base64.b64encode(hashlib.sha256(b"new%d" % i).digest()).decode()[:32] for i in range(200)]
    plain = ["_".join(x) for x in zip(["getUserValue", "maxCountInList", "stringRender"] * 60, ["name_to_string", "under_count_er", "value_in_user"] * 60)]
    df = spark.createDataFrame([(t, "see " + t + " there") for t in fresh + plain], "want string, text string")
    found = {r.want: [s.kind for s in r.secrets] for r in S.scan(df, models).collect()}
    assert sum(found[t] == ["markov"] for t in fresh) > 0.97 * len(fresh)
    assert not any(found[t] for t in plain)


def test_redaction_and_empty_cases(spark, models):
    key = "AKIA" + "Q7" * 8
    df = spark.createDataFrame([(1, f"é {key} and token={'ab12' * 8}."), (2, None), (3, "plain"), (3, "plain")], "doc_id long, text string")
    out = sorted((r.doc_id, r.t) for r in S.scan(df, models).select("doc_id", S.redacted().alias("t")).collect() if r.doc_id != 2)
    assert out == [(1, "é [SECRET] and [SECRET]"), (3, "plain"), (3, "plain")]
    assert S.scan(df.filter("doc_id > 5"), models).count() == 0
    assert S.scan_corpus(df.filter("doc_id > 5")).count() == 0
    flat = S.learn(spark.createDataFrame([], "text string, random boolean"))
    assert [r.secrets for r in S.scan(df.filter("doc_id = 3"), flat).collect()] == [[], []]


def test_a_text_of_very_many_rows_keeps_the_sample_bounded(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("one hot text of five words").alias("text"))
    n = S.samples_of(docs, train_docs=100).filter("not random").count()
    assert 6 * 50 < n < 6 * 160
