"""Surrogates for personal data.

Detected entities are replaced by made-up ones of the same kind and form: an address keeps the shape of
its local part and its top-level domain, a number keeps its punctuation and check digits, an IP address
stays private or public, a name keeps script and, for given names, gender; an initial becomes that of the
new name where the text has the name it stands for.  What replaces what is drawn
with a keyed hash, so a corpus can be treated in parts.

Replacement is by identity and not by spelling: a number written in two ways, or a person named in full
and by family name only, is the same before and after.  All distinct entities are drawn together, in
rounds: a draw that equals a real entity, or one that another entity keeps, is drawn again.  So different
entities stay different and no surrogate is somebody's real data.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import sys
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from croploom.session import materialise

TITLES = {
    "Mr": "m", "Sir": "m", "Herr": "m", "Sr": "m", "Don": "m", "Monsieur": "m", "г-н": "m",
    "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Sra": "f", "Doña": "f", "Madame": "f", "Mme": "f", "г-жа": "f",
    "Dr": "x", "Prof": "x",
}
_TITLE = "|".join(sorted(map(re.escape, TITLES), key=len, reverse=True))
_LOWER = "".join(map(chr, (c for c in range(sys.maxunicode + 1) if chr(c).islower())))
_LETTER = r"(?:[^\W\d_]|[\u0300-\u036f])"
_FIRST = rf"[^\W\d_{re.escape(_LOWER)}]"
_LINE = r"[^\S\r\n]"  # a blank within a line
_BLANK = rf"(?:{_LINE}+|{_LINE}*\r?\n{_LINE}*)"
_PART = rf"(?:{_FIRST}{_LETTER}*(?:['’]{_FIRST}{_LETTER}+)+|{_FIRST}{_LETTER}+)"
_WORD = rf"{_PART}(?:[-‐‑]{_PART})*(?!\w)"
_INITIALS = rf"(?:{_FIRST}(?:\.{_LINE}*|{_BLANK}))*"
_NEXT = rf"{_BLANK}(?!(?:{_TITLE})(?!\w)){_INITIALS}(?!(?:{_TITLE})(?!\w)){_WORD}"
_PERSON = rf"(?<!\w)(?:{_TITLE})(?:\.{_BLANK}?|{_BLANK})(?:(?:Prof|Dr)(?:\.{_BLANK}?|{_BLANK}))*{_INITIALS}{_WORD}(?:{_NEXT})*"
#: What of a name is replaced: parts between hyphens and blanks, and initials.
_TOKEN = re.compile(rf"(?<!\w)(?:{_PART}|{_FIRST})(?!\w)")
_HEAD = re.compile(rf"(?:(?:{_TITLE})(?:\.\s*|\s+))(?:(?:Prof|Dr)(?:\.\s*|\s+))*")
_PATTERNS = {
    "email": r"(?<![A-Za-z0-9._+-])[A-Za-z0-9][A-Za-z0-9._+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9])[3-6](?:[ -]?[0-9]){12,18}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?)?\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])",
    "person": _PERSON,
}
_ALL = re.compile("|".join(f"(?P<{k}>{p})" for k, p in _PATTERNS.items()))
#: A text without any of these holds no entity.
HINT = rf"[@0-9]|(?:{_TITLE})[^\p{{L}}\p{{N}}_]"

WIDER, WIDEST = 6, 24  # rounds from which wider forms are drawn

#: Syllables of made-up names by script: beginnings, middles, and endings of female, male and family names.
SYLLABLES = {
    "latin": ("Bo Da Fe Ga Ka Lo Mi Na Pe Ro Sa Te Vi Wo", "la mi ne ro sa ti ve do", "na ra lia", "n rd ls", "mer feld ko sson"),
    "cyrillic": ("Бо Да Ге Ка Ло Ми На По Ра Са Те Ви", "ла ми не ро са ти ве до", "на ра ля", "н р л", "мер дин кин лов"),
    "greek": ("Βα Γα Δε Κα Λο Μι Να Πε Ρο Σα Τε Φι", "λα μι νε ρο σα τι δο", "να ρα λια", "νος ρης λας", "δης κος λου"),
}

#: Letters of initials by script.
ALPHABETS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзийклмнопрстуфхцчшщъыьэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}


def digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def script(name: str) -> str:
    kind = unicodedata.name(name[0], "LATIN").split()[0].lower()
    return kind if kind in SYLLABLES else "latin"


def units(kind: str, found: str) -> list[tuple[str, str]]:
    """What of an entity is replaced, as (kind, identity)."""
    if kind == "email":
        low = found.lower()
        return [("email", low), ("domain", low.split("@")[1])]
    if kind == "iban":
        return [("iban", found.replace(" ", ""))]
    if kind in ("ssn", "card", "phone"):
        return [(kind, digits(found)[-10:] if kind == "phone" else digits(found))]  # a country code stays as it is
    if kind == "ip":
        return [("ip", ".".join(str(int(x)) for x in found.split(".")))]
    return [(k, i) for k, i, _ in name_units(found)]


def name_units(found: str) -> list[tuple[str, str, str]]:
    """The names of a person as (kind, identity, role), initials of kind ``initial``.

    A name is the same whatever its role: family, or given with the gender of the title (f, m or x).
    """
    gender, tokens = name_tokens(found)
    last = tokens[-1][1]
    family = max((m.end() for m in re.finditer(r"\s|\.", found[:last])), default=0)
    return [("initial" if len(t) == 1 else "name_" + script(t), plain(t), "family" if a >= family else gender) for t, a, _ in tokens]


def plain(name: str) -> str:
    """A name's identity; an initial is a letter of its script's alphabet."""
    if len(name) > 1:
        return unicodedata.normalize("NFC", name).lower().replace("’", "'")
    letters, c = ALPHABETS[script(name)], unicodedata.normalize("NFD", name.lower())[0]
    return c if c in letters else letters[ord(c) % len(letters)]


def name_tokens(found: str) -> tuple[str, list[tuple[str, int, int]]]:
    """Gender of a person's titles, and the (name, start, stop) of all that is replaced."""
    head = _HEAD.match(found).end()
    genders = [TITLES[t] for t in re.findall(_TITLE, found[:head])]
    return next((g for g in genders if g != "x"), "x"), [(m.group(), m.start(), m.end()) for m in _TOKEN.finditer(found, head)]


def entities(text: str) -> Iterator[tuple[str, int, int]]:
    """(kind, start, stop) of what is found, from left to right."""
    at = 0
    while m := _ALL.search(text, at):
        kind, at = m.lastgroup, m.end()
        if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
            continue
        if kind == "person" and "\n" in m.group():
            # a word in the next line belongs to the name unless the text has it in small letters as well
            _, tokens = name_tokens(m.group())
            for (_, _, before), (name, start, _) in zip(tokens, tokens[1:]):
                if "\n" in m.group()[before:start] and re.search(rf"(?<!\w){re.escape(name.lower())}(?!\w)", text):
                    at = m.start() + before
                    break
        yield kind, m.start(), at


_BEFORE = re.compile(rf"(?:(?<!\w){_FIRST}\.{_LINE}*)+$")


def abbreviations(text: str, found: list[tuple[str, int, int]]) -> dict[tuple[str, str], tuple[str, str]]:
    """(family name, letter) -> the first given name in the text, as (kind, identity), that the letter can stand for."""
    out: dict[tuple[str, str], tuple[str, str]] = {}
    for kind, a, b in found:
        if kind == "person":
            own = name_units(text[a:b])
            for k, i, role in own:
                if k != "initial" and role != "family":
                    out.setdefault((own[-1][1], plain(i[0])), (k, i))
    return out


def everything(text: str) -> list[tuple[str, int, int]]:
    """What is found and, as kind mention, each other whole-word mention of a name found in the text.

    Initials before a mention that stand for a given name of the text are found too, of kind initial.
    """
    found = list(entities(text))
    names = {i for kind, a, b in found if kind == "person" for k, i in units(kind, text[a:b]) if k != "initial"}
    if not names:
        return found
    short = abbreviations(text, found)
    out, at = [], 0
    for kind, a, b in [*found, ("", len(text), len(text))]:
        for m in _TOKEN.finditer(text, at, a):
            if plain(m.group()) in names and len(m.group()) > 1:
                before = _BEFORE.search(text, at, m.start())
                for i in _TOKEN.finditer(text, before.start(), before.end()) if before else ():
                    if (plain(m.group()), plain(i.group())) in short:
                        out.append((f"initial {plain(m.group())}", i.start(), i.end()))
                out.append(("mention", m.start(), m.end()))
        if kind:
            out.append((kind, a, b))
        at = b
    return out


class _Draw:
    """Numbers from a keyed hash."""

    def __init__(self, key: bytes, *parts: str) -> None:
        self.pool = int.from_bytes(hmac.new(key, "\0".join(parts).encode(), hashlib.sha512).digest(), "big")
        self.key, self.parts, self.more = key, parts, 0

    def below(self, n: int) -> int:
        if self.pool < n << 64:
            self.more += 1
            self.pool = _Draw(self.key, *self.parts, f"+{self.more}").pool
        self.pool, x = divmod(self.pool, n)
        return x


def shaped(text: str, d: _Draw) -> str:
    """The same shape: letters for letters, digits for digits, everything else as it is."""
    letter = lambda: "abcdefghijklmnopqrstuvwxyz"[d.below(26)]
    return "".join(str(d.below(10)) if c.isdigit() else letter() if c.isascii() and c.isalpha() else c for c in text)


def luhn(number: str) -> int:
    """The check digit after a number."""
    total = 0
    for i, c in enumerate(reversed(number)):
        x = int(c) * (2 if i % 2 == 0 else 1)
        total += x - 9 if x > 9 else x
    return -total % 10


def iban_check(country: str, rest: str) -> str:
    number = int("".join(str(int(c, 36)) for c in rest + country + "00"))
    return f"{98 - number % 97:02d}"


def private(ip: list[int]) -> int:
    """0 public, or the private block an address is in."""
    return 1 if ip[0] == 10 else 2 if ip[:2] == [192, 168] else 3 if ip[0] == 172 and 16 <= ip[1] < 32 else 4 if ip[0] == 127 else 0


def new_initial(key: bytes, family: str, letter: str) -> str:
    """The letter for an initial whose name the text does not have: for each family name another order of the alphabet."""
    letters = next((x for x in ALPHABETS.values() if letter in x), ALPHABETS["latin"])
    order = sorted(letters, key=lambda c: hmac.new(key, f"initial\0{family}\0{c}".encode(), hashlib.sha256).digest())
    at = order.index(letter)
    return order[(at + 1) % len(order)]


def draw(key: bytes, kind: str, identity: str, attempt: int, role: str = "") -> str:
    """The surrogate identity of a unit in a round.

    Where a kind has few values left, later rounds draw from a wider form: private addresses from the
    largest private block, then numbers that no address has; social-security numbers of any area, then,
    as phones and cards, letters among the digits.  So the rounds end however many entities there are.
    """
    d = _Draw(key, kind, identity, str(attempt))
    if kind == "domain":
        head, _, top = identity.rpartition(".")
        return (shaped(head, d) if attempt < 50 else shaped(head + "a" * (attempt // 50), d)) + "." + top
    if kind == "email":
        local, _, domain = identity.partition("@")
        return shaped(local + "a" * (attempt // 50), d) + "@" + domain
    if kind == "iban":
        country, rest = identity[:2], "".join(str(d.below(10)) if c.isdigit() else chr(65 + d.below(26)) for c in identity[4:])
        return country + iban_check(country, rest) + rest
    if kind in ("ssn", "phone", "card") and attempt >= WIDEST:
        return "".join("0123456789ABCDEFGHJKLMNPQRSTUVWXYZ"[d.below(34)] for _ in identity)
    if kind == "card":
        body = identity[0] + "".join(str(d.below(10)) for _ in identity[1:-1])
        last = luhn(body)
        valid = luhn(identity[:-1]) == int(identity[-1])
        return body + str(last if valid else (last + 1 + d.below(9)) % 10)
    if kind == "ssn" and attempt >= WIDER:
        return f"{d.below(1000):03d}{1 + d.below(99):02d}{1 + d.below(9999):04d}"
    if kind == "ssn":
        return f"9{d.below(100):02d}{1 + d.below(99):02d}{1 + d.below(9999):04d}"
    if kind == "phone":
        return str(2 + d.below(8)) + "".join(str(d.below(10)) for _ in identity[1:])
    if kind == "ip":
        block = private([int(x) for x in identity.split(".")])
        if attempt >= WIDEST:
            return ".".join(str(256 + d.below(744)) for _ in range(4))
        if attempt >= WIDER and block:
            block = 1
        while True:
            ip = [1 + d.below(223), d.below(256), d.below(256), 1 + d.below(254)]
            ip[: [0, 1, 2, 2, 1][block]] = [[], [10], [192, 168], [172, 16 + d.below(16)], [127]][block]
            if private(ip) == block:
                return ".".join(map(str, ip))
    begin, middle, female, male, family = (s.split(" ") for s in SYLLABLES[kind.removeprefix("name_")])
    last = {"family": family, "f": female, "m": male}.get(role, female + male)
    inner = "".join(middle[d.below(len(middle))] for _ in range(1 + d.below(2) + attempt // 4))
    return (begin[d.below(len(begin))] + inner + last[d.below(len(last))]).lower()


def cased(name: str, new: str) -> str:
    return new.upper() if name.isupper() else new[0].upper() + new[1:]


def written(kind: str, found: str, known: Callable[[str, str], str], initial: Callable[[str, str], str]) -> str:
    """A found entity's surrogate in the form in which it was found; ``initial`` is asked for those of a family name."""
    if kind == "person":
        out, at, own = [], 0, name_units(found)
        for (name, a, b), (k, i, _) in zip(name_tokens(found)[1], own):
            out += [found[at:a], cased(name, initial(own[-1][1], i) if k == "initial" else known(k, i))]
            at = b
        return "".join([*out, found[at:]])
    own = [known(k, i) for k, i in units(kind, found)]
    if kind == "email":
        local = own[0].split("@")[0]
        text = local + "@" + own[1]
        return text.upper() if found.isupper() else text[0].upper() + text[1:] if found[0].isupper() else text
    if kind == "ip":
        return own[0]
    before = digits(found)[: len(digits(found)) - len(own[0])] if kind == "phone" else ""
    chars = iter(before + own[0])
    return "".join(next(chars) if (c.isalnum() if kind == "iban" else c.isdigit() and c.isascii()) else c for c in found)


def _mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for key, text in zip(batch.column("text_key").to_pylist(), batch.column("text").to_pylist()):
            own = set()
            for kind, a, b in entities(text):
                own |= {u for u in name_units(text[a:b]) if u[0] != "initial"} if kind == "person" else {(*u, "") for u in units(kind, text[a:b])}
            rows += [(key, *u) for u in own]
        cols = list(zip(*rows)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), *(pa.array(c, pa.string()) for c in cols[1:])], names=["text_key", "kind", "identity", "role"])


def _drawn(secret: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [batch.column(c).to_pylist() for c in ("kind", "identity", "attempt", "role")]
            out = [draw(secret, k, i, n, r) for k, i, n, r in zip(*own)]
            kept = ["kind", "identity", "attempt", "role"]
            yield pa.RecordBatch.from_arrays([*batch.select(kept).columns, pa.array(out, pa.string())], names=[*kept, "surrogate"])

    return run


def assign(found: DataFrame, secret: bytes) -> DataFrame:
    """(kind, identity, surrogate) for distinct (kind, identity): no two surrogates of a kind are equal, none is an identity.

    All names of a script are one kind.  A name of several roles takes the form of the first of f, family, m and x.
    """
    roles = F.col("role") if "role" in found.columns else F.lit("")
    found = found.groupBy("kind", "identity").agg(F.min(roles).alias("role"))
    real = found.select("kind", F.col("identity").alias("surrogate"))
    kept = None
    open_ = found.select("kind", "identity", F.lit(0).alias("attempt"), "role")
    while True:
        tried = materialise(open_.mapInArrow(_drawn(secret), "kind string, identity string, attempt int, role string, surrogate string"), "surrogates-drawn")
        free = tried.join(real, ["kind", "surrogate"], "left_anti")
        if kept is not None:
            free = free.join(kept.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        own = free.groupBy("kind", "surrogate").agg(F.min("identity").alias("identity")).select("kind", "identity", "surrogate")
        kept = materialise(own if kept is None else kept.unionByName(own), "surrogates-kept")
        left = tried.join(kept.select("kind", "identity"), ["kind", "identity"], "left_anti")
        open_ = left.select("kind", "identity", (F.col("attempt") + 1).alias("attempt"), "role")
        if open_.isEmpty():
            return kept


def _replaced(secret: bytes):
    def one(text: str, names: dict[tuple[str, str], str]) -> tuple[str, int]:
        out, at, n = [], 0, 0
        found = everything(text)
        short = abbreviations(text, found)
        by_name = {i: new for (k, i), new in names.items() if k.startswith("name_")}

        def initial(family: str, letter: str) -> str:
            given = short.get((family, letter))
            return names[given][0] if given else new_initial(secret, family, letter)

        for kind, a, b in found:
            own = text[a:b]
            if kind == "mention":
                new = cased(own, by_name[plain(own)])
            elif kind.startswith("initial "):
                new = cased(own, initial(kind.removeprefix("initial "), plain(own)))
            else:
                new = written(kind, own, lambda k, i: names[k, i], initial)
            out += [text[at:a], new]
            at, n = b, n + 1
        return "".join([*out, text[at:]]), n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                one(text, {(k["kind"], k["identity"]): k["surrogate"] for k in known or ()})
                for text, known in zip(batch.column("text").to_pylist(), batch.column("__known").to_pylist())
            ]
            done = {"text": pa.array([r[0] for r in rows], pa.string()), "n_entities": pa.array([r[1] for r in rows], pa.int64())}
            names = [n for n in batch.schema.names if n != "__known" and n != "__text_key"]
            yield pa.RecordBatch.from_arrays([done.get(n, batch.column(n)) for n in names], names=names)

    return run


def pseudonymise(docs: DataFrame, secret: bytes) -> DataFrame:
    """``docs`` (any columns besides text) with surrogates in text, and n_entities.

    Emails, IBANs, IP addresses, social-security, card and phone numbers, and names after a title are
    found; names with initials, apostrophes, hyphens and any number of words, and all other capitalised
    whole-word mentions of their words in the same text.  An initial becomes the first letter of the new name
    that replaces the given name it stands for beside the same family name in the text, elsewhere a letter
    that depends on the family name; untitled initials are replaced in the first case.  Names that no title introduces in the text, and
    small words inside names (von, de), are not.  The same secret gives the same draw, but an entity's surrogate can depend on the others in
    the table, as draws that collide are repeated.  Null texts stay null, texts without entities as
    they are, n_entities 0.  Repeated rows come out alike.  A column named n_entities is replaced.
    """
    docs = docs.drop("n_entities").withColumn("n_entities", F.lit(0).cast("long"))
    hinted: Column = F.coalesce(F.col("text").rlike(HINT), F.lit(False))
    some = docs.filter(hinted).withColumn("__text_key", F.xxhash64("text"))
    mentions = some.select(F.col("__text_key").alias("text_key"), "text").mapInArrow(_mentions, "text_key long, kind string, identity string, role string")
    mentions = materialise(mentions.distinct(), "surrogates-mentions")
    names = assign(mentions.select("kind", "identity", "role"), secret)
    by_text = mentions.select("text_key", "kind", "identity").distinct().join(names, ["kind", "identity"]).groupBy("text_key").agg(F.collect_list(F.struct("kind", "identity", "surrogate")).alias("__known"))
    joined = some.join(by_text.withColumnRenamed("text_key", "__text_key"), "__text_key", "left").select(*some.columns, "__known")
    done = joined.mapInArrow(_replaced(secret), docs.schema)
    return done.unionByName(docs.filter(~hinted))
