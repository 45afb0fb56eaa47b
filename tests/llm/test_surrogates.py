"""Surrogates: form, coreference, distinctness, and nothing else touched."""

import random
import re

from croploom.llm import surrogates as S

KEY = b"test"
TEXT = (
    "Mr. John Smith and Mrs. Anna Smith wrote to john.smith@mail.example.com; JOHN.SMITH@MAIL.EXAMPLE.COM, other@mail.example.com. "
    "Call +1 (988) 555-2485 or 1 988 555 2485, card 4539 1488 0343 6467 = 4539148803436467, from 10.0.3.7 and 8.8.4.4. "
    "SSN 123-45-6789, IBAN DE89 3704 0044 0532 0130 00; г-жа Анна Петрова, version 2.0.1, 999.1.1.1 and 12 apples. Mr. Smith agreed."
)


def run(spark, texts, key=KEY):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_entities string")
    return {r.doc_id: (r.text, r.n_entities) for r in S.pseudonymise(df, key).collect()}


def test_form_and_coreference(spark):
    text, n = run(spark, [TEXT])[0]
    m = re.fullmatch(
        r"Mr\. (\w+) (\w+) and Mrs\. (\w+) (\w+) wrote to (\w{4}\.\w{5})@(\w{4}\.\w{7}\.com); ([A-Z.]+)@([A-Z.]+), (\w{5})@(\S+)\. "
        r"Call \+1 \((\d{3})\) (\d{3})-(\d{4}) or 1 (\d{3}) (\d{3}) (\d{4}), card (\d{4} \d{4} \d{4} \d{4}) = (\d{16}), from (10\.\S+) and (\S+)\. "
        r"SSN (\d{3}-\d\d-\d{4}), IBAN (DE[\d ]{25}); г-жа ([А-я]+) ([А-я]+), version 2\.0\.1, 999\.1\.1\.1 and 12 apples\. Mr\. (\w+) agreed\.",
        text,
    )
    assert m, text
    g = m.groups()
    assert g[1] == g[3] == g[24] != "Smith" and g[0] != g[2] and g[0] != "John"
    assert (g[6].lower(), g[7].lower()) == (g[4], g[5]) and g[9] == g[5] and g[8] != g[4]
    assert g[10:13] == g[13:16] and g[16].replace(" ", "") == g[17]
    assert S.luhn(g[17][:-1]) == int(g[17][-1]) and g[17][0] == "4"
    assert not S.private([int(x) for x in g[19].split(".")])
    iban = g[21].replace(" ", "")
    assert S.iban_check("DE", iban[4:]) == iban[2:4]
    assert g[2][-1] == "a" and g[0][-1] != "a" and g[22][-1] in "ая"
    assert n == 15


def test_distinct_entities_stay_distinct_and_unreal(spark, monkeypatch):
    rnd = random.Random(1)
    first = ["".join(rnd.choice("abcdefgh") for _ in range(2)).title() for _ in range(300)]
    texts = [f"Herr {a.title()}x Meier{b}" for b in "abc" for a in first] + [f"mail {c}@{d}.de" for c in "abcdefghijklmnop" for d in ("x", "y", "z")]
    out = run(spark, texts)
    seen = {}
    real = {t.split(" ")[1].lower() for t in texts}
    for i, t in enumerate(texts):
        a, b = t.split(" ")[1], out[i][0].split(" ")[1]
        assert seen.setdefault(a.lower(), b.lower()) == b.lower() and b.lower() not in real
    assert len(set(seen.values())) == len(seen)


def test_keys_and_plain_rows(spark):
    rows = ["Nothing to see in here.", None, "", "call 988-555-2485", "call 988-555-2485", "x" * 50 + " a@b.de " + "word " * 20000]
    one, two, other = run(spark, rows), run(spark, rows), run(spark, rows, b"other")
    assert one == two and one[3] == one[4] != other[3]
    assert one[0] == (rows[0], 0) and one[1] == (None, 0) and one[2] == ("", 0)
    assert one[5][1] == 1 and len(one[5][0]) == len(rows[5]) and one[5][0].endswith("word ")
    assert run(spark, []) == {}


def test_whole_names_and_later_mentions(spark):
    texts = [
        "Dr Anna Maria Schmidt spoke.",
        "Frau Schmidt-Meyer and Herr Meyer met.",
        "Mr O'Brien's car, Mr J. Smith and Mr J.R. Smith",
        "Mr John Smith came. Then Smith left; John Smith said Smith's and SMITH, not Smithers.",
        "Mr  John\tPaul\u00a0Smith, Mr\nSmith and Herr Prof. Dr. Meyer",
        "Mr John\nSmith came",
        "I met Mr Smith\nThe dog saw the cat. The end",
        "г-н Иванов сказал слово",
    ]
    out = [v[0] for _, v in sorted(run(spark, texts).items())]
    for real, o in zip(["Anna Maria Schmidt", "Schmidt Meyer", "Brien Smith", "John", "John Paul Smith Meyer", "John Smith", "Smith", "Иванов"], out):
        assert not [w for w in real.split() if re.search(rf"\b{w}\b", o)], o
    assert re.fullmatch(r"Dr \w+ \w+ \w+ spoke\.", out[0])
    m = re.fullmatch(r"Frau (\w+)-(\w+) and Herr (\w+) met\.", out[1])
    assert m and m[2] == m[3] != m[1]
    assert re.fullmatch(r"Mr \w+'s car, Mr [A-Z]\. (\w+) and Mr [A-Z]\.[A-Z]\. \1", out[2])
    m = re.fullmatch(r"Mr (\w+) (\w+) came\. Then (\w+) left; (\w+) (\w+) said (\w+)'s and (\w+), not Smithers\.", out[3])
    assert m and m[2] == m[3] == m[5] == m[6] == m[7].title() and m[1] == m[4]
    m = re.fullmatch(r"Mr  \w+\t\w+\u00a0(\w+), Mr\n(\w+) and Herr Prof\. Dr\. \w+", out[4])
    assert m and m[1] == m[2]
    assert re.fullmatch(r"I met Mr \w+\nThe dog saw the cat\. The end", out[6])
    assert re.fullmatch(r"г-н \w+ сказал слово", out[7])


def test_a_kind_with_few_values_ends(spark):
    from croploom.llm import surrogates

    found = spark.range(45_000).selectExpr("'ip' kind", "concat('192.168.', id div 256, '.', id % 256) identity")
    got = surrogates.assign(found, b"k")
    rows = got.selectExpr("count(*) n", "count(distinct surrogate) d", "count(distinct identity) i").first()
    assert tuple(rows) == (45_000, 45_000, 45_000)
    assert got.join(found.selectExpr("identity surrogate"), "surrogate").count() == 0
    assert got.filter("not (surrogate like '10.%' or surrogate like '192.168.%')").count() == 0


def test_widest_forms_keep_the_length():
    from croploom.llm import surrogates

    for kind, identity in (("ssn", "123456789"), ("phone", "2125550123"), ("card", "4111111111111111")):
        new = surrogates.draw(b"k", kind, identity, surrogates.WIDEST)
        assert len(new) == len(identity) and new.isalnum()
    assert all(int(x) > 255 for x in surrogates.draw(b"k", "ip", "8.8.8.8", surrogates.WIDEST).split("."))


def test_one_person_under_several_titles_and_by_initial(spark):
    text = "Dr Anna Schmidt came. Later Mrs Anna Schmidt left. Mr John Smith is J. Smith, that is Mr J. Smith. Mr Q. Smith is not, nor K. Smith."
    out = run(spark, [text, "Mr John Doe, Herr Anna, Mrs Smith and Frau John; plan B. Mr J.R. Smith"])
    m = re.fullmatch(
        r"Dr (\w+) (\w+) came\. Later Mrs (\w+) (\w+) left\. Mr (\w+) (\w+) is (\w)\. (\w+), that is Mr (\w)\. (\w+)\. Mr (\w)\. (\w+) is not, nor K\. (\w+)\.", out[0][0]
    )
    assert m, out[0][0]
    g = m.groups()
    assert g[:2] == g[2:4] and g[0][-1] == "a" and len({g[5], g[7], g[9], g[11], g[12]}) == 1
    assert g[6] == g[8] == g[4][0] and g[10] != "Q"
    other = re.fullmatch(r"Mr (\w+) \w+, Herr (\w+), Mrs (\w+) and Frau (\w+); plan B\. Mr (\w)\.(\w)\. (\w+)", out[1][0]).groups()
    assert other[0] == other[3] == g[4] and other[1] == g[0] and other[2] == other[6] == g[5]  # over texts and roles


def test_all_names_share_one_space(spark):
    from croploom.llm import surrogates

    rows = [(k, f"n{i}", r) for k in ("name_latin", "name_greek") for i in range(900) for r in ("family", "f", "m", "x")[: 1 + i % 4]]
    rows += [("name_latin", surrogates.draw(b"k", "name_latin", f"n{i}", 0, "f"), "m") for i in range(50)]
    found = spark.createDataFrame(rows, "kind string, identity string, role string")
    got = surrogates.assign(found, b"k").collect()
    real = {(r[0], r[1]) for r in rows}
    assert {(r.kind, r.identity) for r in got} == real and len({(r.kind, r.surrogate) for r in got}) == len(real)
    assert not real & {(r.kind, r.surrogate) for r in got}


def test_other_initials_depend_on_the_family_name():
    from croploom.llm import surrogates

    for letters in surrogates.ALPHABETS.values():
        for family in ("smith", "doe"):
            new = [surrogates.new_initial(b"k", family, c) for c in letters]
            assert sorted(new) == sorted(letters) and all(a != b for a, b in zip(new, letters))
    shifts = {(ord(surrogates.new_initial(b"k", "smith", c)) - ord(c)) % 26 for c in "abcdefghij"}
    assert len(shifts) > 3
