"""Bounded name matching against comparing everything."""

import random

import pytest

from croploom.functions import similarity as S


def test_bounds_hold_and_nothing_better_is_skipped():
    rnd = random.Random(3)
    words = ["winter", "wheat", "spring", "barley", "oats", "oat", "soft", "durum", "ab", "x", "grain maize", "maize"]

    def text():
        t = " ".join(rnd.choice(words) for _ in range(rnd.choice([1, 1, 2, 3, 9])))
        if t and rnd.random() < 0.5:
            i = rnd.randrange(len(t))
            t = t[:i] + rnd.choice("abcxyz ") + t[i + rnd.randint(0, 2) :]
        return " ".join(t.split())

    compared = []
    for _ in range(60):
        cands = [text() for _ in range(40)] + ["", "wheat", "wheat"]
        bounds = S.Bounds(cands)
        for name in (text(), text(), "zz"):
            scores = [S.weighted_ratio(name, c) for c in cands]
            assert all(s <= b for s, b in zip(scores, bounds.of(name)))
            best = max(scores)
            assert S.best_of(name, cands, bounds) == (best, scores.index(best))
            compared.append(sum(b >= best for b in bounds.of(name)) / len(cands))
    assert sum(compared) / len(compared) < 0.8
    assert S.best_of("a", [], S.Bounds([])) == (-1.0, -1)


def _edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_index_finds_what_comparing_everything_finds(spark):
    import random

    from croploom.operators import gramindex as I
    from croploom.operators.matching import best_match

    rng = random.Random(3)
    cands = ["".join(rng.choice("abcde ") for _ in range(rng.randrange(3, 16))).strip() or "x" for _ in range(150)]
    cands += [cands[0], "aaaaaaaa", "abababab", "é" * 5, "q" * 230]
    names = {c for c in cands[::4]} | {"zz", "aaaabaaa", "babababa", "q" * 229 + "r", "éééé"}
    for c in cands:
        w = list(c)
        for _ in range(rng.randrange(1, 7)):
            k = rng.randrange(len(w) + 1)
            w[k : k + rng.randrange(2)] = rng.choice(["", "a", "f"])
        names.add(" ".join("".join(w).split()))
    names = sorted(n for n in names if any(c.isalnum() for c in n))
    cands = [" ".join(c.split()) for c in cands]
    seen, plain = {}, I.materialise
    I.materialise = lambda df, label="stage": seen.setdefault(label, []).append(plain(df, label)) or seen[label][-1]
    try:
        out = best_match(spark.createDataFrame([(n,) for n in names], "n string"), spark.createDataFrame(list(enumerate(cands)), "pos long, text string"), "levenshtein", index_from=0)
        got = {r.text: (r.best, r.score) for r in out.collect()}
    finally:
        I.materialise = plain
    for n in names:
        score, rank = max((1 - _edit_distance(n, c) / max(len(n), len(c)), -k) for k, c in enumerate(cands))
        assert got[n] == (-rank, pytest.approx(score)), n
    pairs = sum(df.count() for df in seen["pairs"])
    assert 0 < seen["index-left"][-1].count() < len(names) / 2 and pairs < len(names) * len(cands) / 3
