"""Surrogates for personal data: keyed, of the same type and format.

Entities: e-mail, IPv4 and IPv6 addresses, phone, card, account (IBAN) and social
security numbers, access keys, values of eight characters or more with a digit that are
assigned to a password, secret, token or key, names of any number of words after one or
more titles, and every other mention of a word of such a name in the same document that
doesn't begin in lower case.  Every entity is read as a number in
the mixed base of its format: each character's base is its class (digit, vowel or
consonant of its script and case, accented letters; any other letter or number by its
Unicode block, category and case).  A keyed Feistel permutation P of that range
gives the surrogate as P^-1(P(x) + 1): distinct entities of a format always have
distinct surrogates, none is its own, and equal entities have equal ones in every
document without any exchange between tasks.  ``collisions`` checks that on any
result, ``checked`` on the result that is written.  Titles, separators, the case of
letters, country codes, leading zeros of phone numbers, key prefixes, card and account
check digits, octet widths, the first two digits of IPv6 addresses, combining marks,
particles of names and the endings of names that carry gender stay.  Two spellings of
one IPv6 address are two entities.

The key is the argument, else the setting ``spark.surrogates.key`` of the session, else
random for this driver process: only who sets a key gets the same surrogates again.

Nulls: a null text stays null and has no entities; an empty text stays empty.
Texts of any length are read whole.  Repeated rows get equal results; extra columns
stay.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import secrets
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commerce_marts.llm.common import shielded, text_slices, written

KEY_SETTING = "spark.surrogates.key"
#: Entities with more digits move in parts of this many, so that the work grows with their length.
PART_DIGITS = 512
#: Character classes; letters and numbers of none of them have those of ``_others``.
CLASSES = ("0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "áàâäéèêëíìîïóòôöúùûü", "çñ",
           "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ", "αεηιουω", "βγδζθκλμνξπρστφχψ")
_CLASS = {c: alphabet for alphabet in CLASSES for c in alphabet}
#: Titles before names.
TITLES = ("Mr", "Mrs", "Ms", "Miss", "Sir", "Dr", "Prof", "Herr", "Frau", "Monsieur", "Madame",
          "Mme", "Mlle", "Señor", "Señora", "Sr", "Sra", "Don", "Doña", "Господин", "Госпожа")
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Country codes of one and two digits; the others have three.
_SHORT_CODES = re.compile("1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]")
#: Combining marks, which ``isalnum`` lacks.
_MARKS = "".join(c for c in map(chr, range(0x300, 0x1F000)) if unicodedata.category(c)[0] == "M")
_WORD = rf"[^\W\d_](?:[^\W\d_]|[{_MARKS}]|['’\-](?=[^\W\d_]))*+"
_LOWER = "".join(c for c in map(chr, range(0x1F000)) if c.islower())
#: Blanks within a line.
_BLANK = r"[^\S\n-\r\x1c-\x1e\x85  ]"
#: Particles between the words of a name.
PARTICLES = ("von", "van", "de", "der", "den", "del", "della", "di", "da", "dos", "du", "la", "le",
             "bin", "al", "el", "y")
_TITLE = rf"(?:(?:{'|'.join(TITLES)})(?:\.\s*|\s+))+"
_NAMED = rf"(?![{_LOWER}]){_WORD}"
_HEX = "[0-9A-Fa-f]{1,4}"
PATTERN = re.compile("|".join((
    r"(?P<email>(?<![\w.%+\-])[\w.%+\-]++@(?:[\w\-]++\.)+[A-Za-z]{2,}(?![\w\-]))",
    r"(?P<key>(?<!\w)(?:(?:AKIA|ASIA|ghp_)[A-Za-z0-9]{16,}|sk-[A-Za-z0-9_\-]{16,})(?!\w))",
    r"(?P<assigned>(?<![A-Za-z0-9])(?i:password|passwd|secret|token|api_?key|access_?key)"
    r"""["']?\s*[:=]\s*["']?(?P<hidden>(?=[A-Za-z+/_.=\-]*[0-9])[A-Za-z0-9+/_.=\-]{7,}[A-Za-z0-9+/_=]))""",
    rf"(?P<ip>(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d))",
    rf"(?P<ip6>(?<![\w:.])(?:(?:{_HEX}:){{7}}{_HEX}|(?:[23][0-9A-Fa-f]{{3}}|[fF][cdeCDE][0-9A-Fa-f]{{2}})"
    rf"(?::{_HEX}){{0,5}}::(?:{_HEX}(?::{_HEX}){{0,5}})?)(?![\w:]))",
    r"(?P<iban>(?<!\w)[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?!\w))",
    r"(?P<ssn>(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w\-]))",
    r"(?P<card>(?<![\w+])\d(?:[ \-]?\d){12,18}(?!\w))",
    r"(?P<phone>(?<![\w+])(?:\+1(?:[ .\-]?\(?\d\)?){10}|\+[2-9](?:[ .\-]?\(?\d\)?){7,14}"
    r"|(?<!\d[ .\-])0\d(?P<sep>[ .\-])\d\d(?:(?P=sep)\d\d){3}(?![ .\-]\d)"
    r"|(?:\+\d{1,3}[ .\-]?)?(?:\(\d{2,4}\)[ .\-]?|\d{2,4}[ .\-])\d{3,4}[ .\-]\d{3,4}"
    r"|(?:\(\d{3}\)[ ]?|\d{3}[ .\-])\d{7}"
    r"|(?:(?<=[Tt]el )|(?<=[Tt]el: )|(?<=[Tt]el\. )|(?<=[Cc]all )|(?<=[Pp]hone )|(?<=[Pp]hone: ))\d{10})"
    r"(?!\w))",
    rf"(?P<name>(?<!\w){_TITLE}{_NAMED}"
    rf"(?:(?<!['’][sS])(?:{_BLANK}+(?:{'|'.join(PARTICLES)}))*{_BLANK}+{_NAMED})*(?!\w))")))
_TITLES = re.compile(_TITLE)
_NAME = re.compile(_WORD)
_POSSESSIVE = re.compile("['’][sS]$")


def _round(key: bytes, tweak: bytes, x: int, limit: int) -> int:
    size = (limit.bit_length() + 7) // 8 + 8
    digest = hmac.new(key, tweak + b"|%d" % x, hashlib.sha256).digest()
    while len(digest) < size:
        digest += hashlib.sha256(digest).digest()
    return int.from_bytes(digest[:size], "big") % limit


def permuted(x: int, size: int, key: bytes, tweak: str, back: bool = False) -> int:
    """A keyed permutation of range(size): Feistel rounds on a square, walked into the range."""
    side = 1
    while side * side < size:
        side *= 2
    rounds = range(8)[::-1] if back else range(8)
    while True:
        a, b = divmod(x, side)
        for r in rounds:
            mark = f"{tweak}|{size}|{r}".encode()
            if back:
                a, b = (b - _round(key, mark, a, side)) % side, a
            else:
                a, b = b, (a + _round(key, mark, b, side)) % side
        x = a * side + b
        if x < size:
            return x


def moved(digits: list[int], bases: list[int], key: bytes, tweak: str) -> list[int]:
    """The surrogate of a number in a mixed base; only a range of one keeps its value."""
    if len(digits) > PART_DIGITS:
        mark = f"{len(digits)}|{hashlib.sha256(tweak.encode()).hexdigest()}"
        return [d for i in range(0, len(digits), PART_DIGITS)
                for d in moved(digits[i:i + PART_DIGITS], bases[i:i + PART_DIGITS], key,
                               f"{mark}|{i}")]
    x, size = 0, 1
    for d, b in zip(digits, bases):
        x, size = x * b + d, size * b
    if size > 1:
        x = permuted((permuted(x, size, key, tweak) + 1) % size, size, key, tweak, back=True)
    out = []
    for b in reversed(bases):
        x, d = divmod(x, b)
        out.append(d)
    return out[::-1]


def _small(c: str) -> str:
    """The lower case of a letter that has one to return from; any other character itself."""
    low = c.lower()
    return low if len(low) == 1 and low.upper() == c else c


@lru_cache(1)
def _others() -> dict[str, str]:
    """The class of every letter and number outside ``CLASSES``: those of its script, category
    and case in its 128 code points, or, where these are few, in all of them."""
    fine, coarse, rest = defaultdict(list), defaultdict(list), defaultdict(list)
    for c in map(chr, range(0x80, 0x32400)):
        category = unicodedata.category(c)
        if category[0] in "LN" and c not in _CLASS and _small(c) == c:
            script = unicodedata.name(c, "").split(" ")[0].split("-")[0]
            cased = len(c.upper()) == 1 and c.upper() != c and c.upper().lower() == c
            fine[ord(c) >> 7, script, category, cased].append(c)
    for key, own in fine.items():
        if len(own) < 8:
            coarse[key[1:]] += own
    for key, own in coarse.items():
        if len(own) < 2:
            rest[key[-1]] += own
    for cased, own in rest.items():
        if len(own) == 1:  # a class of one could not move: it joins the first one of its case
            rest[cased] = []
            next(g for k, g in fine.items() if k[-1] == cased and len(g) >= 8).extend(own)
    groups = [*(g for g in fine.values() if len(g) >= 8),
              *(g for g in coarse.values() if len(g) >= 2), *rest.values()]
    return {c: "".join(g) for g in groups for c in g}


def _class(c: str) -> str | None:
    return _CLASS.get(c) or (_others().get(c) if c > "\x7f" else None)


def shaped(text: str, key: bytes, tweak: str) -> str:
    """Each character moves within its class; case and other characters stay."""
    low = [_small(c) for c in text]
    classes = [_class(c) for c in low]
    at = [i for i, a in enumerate(classes) if a]
    alphabets = [classes[i] for i in at]
    new = moved([a.index(low[i]) for i, a in zip(at, alphabets)], list(map(len, alphabets)), key,
                f"{tweak}|{''.join(a[0] if a else c for a, c in zip(classes, low))}")
    out = list(text)
    for i, a, d in zip(at, alphabets, new):
        out[i] = a[d].upper() if text[i] != low[i] else a[d]
    return "".join(out)


def _called(word: str, key: bytes) -> str:
    """The surrogate of a word of a name; the last letter carries gender in many languages."""
    last = word[-1]
    if len(word) > 1 and last.lower() != last.upper() and any(map(_class, map(_small, word[:-1]))):
        return shaped(word[:-1], key, f"name|{last.lower()}") + last
    return shaped(word, key, "name|")


def _dialled(number: list[int], key: bytes) -> list[int]:
    """A phone number without its country code; leading zeros stay, up to two."""
    zeros = min(2, next((i for i, d in enumerate(number) if d), len(number)), len(number) - 1)
    rest = number[zeros:]
    if zeros == 2 or not rest[0]:
        return number[:zeros] + moved(rest, [10] * len(rest), key, f"phone|0|{len(rest)}")
    first, *more = moved([rest[0] - 1, *rest[1:]], [9] + [10] * (len(rest) - 1), key,
                         f"phone|{len(rest)}")
    return [*number[:zeros], first + 1, *more]


def _luhn(digits: str) -> int:
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10


def _put_digits(text: str, digits: str) -> str:
    left = iter(digits)
    return "".join(next(left) if c.isdigit() else c for c in text)


def _remainder(letters: str) -> int:
    """An account number's value modulo 97, country and check digits last."""
    rest = 0
    for c in letters[4:] + letters[:4]:
        rest = (rest * (100 if c.isalpha() else 10) + int(c, 36)) % 97
    return rest


def _account(text: str, key: bytes) -> str:
    """Country and layout stay, the check digits fit the new number."""
    compact = text.replace(" ", "")
    new = shaped(compact[4:], key, f"iban{compact[:2]}")
    check = 98 - _remainder(f"{compact[:2]}00{new}")
    left = iter(f"{compact[:2]}{check:02d}{new}")
    return "".join(c if c == " " else next(left) for c in text)


def _address6(text: str, key: bytes) -> str:
    """The first two digits and the widths of the groups stay."""
    at = [i for i, c in enumerate(text) if c != ":"][2:]
    shape = re.sub("[^:]", "x", text)
    new = moved([int(text[i], 16) for i in at], [16] * len(at), key, f"ip6|{text[:2].lower()}|{shape}")
    digits = "0123456789ABCDEF" if text.upper() == text else "0123456789abcdef"
    out = list(text)
    for i, d in zip(at, new):
        out[i] = digits[d]
    return "".join(out)


_PROCESS_KEY = secrets.token_bytes(32)


def session_key(spark: SparkSession) -> bytes:
    """The key of the session's setting; without one, this driver process's random key."""
    own = spark.conf.get(KEY_SETTING, None)
    return own.encode() if own else _PROCESS_KEY


@lru_cache(200_000)
def surrogate(kind: str, text: str, key: bytes) -> str:
    """The replacement of an entity."""
    if kind == "email":
        local, domain = text.rsplit("@", 1)
        name, top = domain.rsplit(".", 1)
        return f"{shaped(local, key, kind)}@{shaped(name, key, 'domain')}.{top}"
    if kind == "ip":
        parts = text.split(".")
        low = {1: 0, 2: 10, 3: 100}
        bases = [{1: 10, 2: 90, 3: 156}[len(p)] for p in parts]
        new = moved([int(p) - low[len(p)] for p in parts], bases, key, f"ip|{bases}")
        return ".".join(str(n + low[len(p)]) for n, p in zip(new, parts))
    if kind == "key":
        head = re.match("(?:AKIA|ASIA|ghp_|sk-)?", text).group()
        return head + shaped(text[len(head):], key, f"key{head}{[c.isupper() for c in text]}")
    if kind == "name":
        title = _TITLES.match(text)
        head = title.group() if title else ""
        return head + re.sub(r"[^\s\-]+", lambda w: w.group() if w.group() in PARTICLES else
                             _called(w.group(), key), text[len(head):])
    if kind == "iban":
        return _account(text, key)
    if kind == "ip6":
        return _address6(text, key)
    digits = "".join(c for c in text if c.isdigit())
    if kind == "card":
        valid = _luhn(digits) == 0
        body = digits[1:-1] if valid else digits[1:]
        new = digits[0] + shaped(body, key, f"card{valid}{digits[0]}")
        if valid:
            new += str(-_luhn(new + "0") % 10)
        return _put_digits(text, new)
    if kind == "phone":
        if text.startswith("+"):
            values = "".join(str(unicodedata.decimal(c)) for c in digits)
            code = _SHORT_CODES.match(values)
            own = len(digits) - (code.end() if code else 3)
        else:
            own = min(len(digits), 10)
        new = _dialled([unicodedata.decimal(c) for c in digits[-own:]], key)
        return _put_digits(text, digits[:-own] + "".join(
            chr(ord(c) - unicodedata.decimal(c) + d) for c, d in zip(digits[-own:], new)))
    return _put_digits(text, shaped(digits, key, kind))


def _entities(text: str) -> Iterator[tuple[int, str, str]]:
    """Start, kind and value of what the patterns find."""
    at = 0
    while m := PATTERN.search(text, at):
        start, kind, value, at = m.start(), m.lastgroup, m.group(), m.end()
        if kind == "iban":
            compact = value.replace(" ", "")
            if _remainder(compact) != 1 or not "02" <= compact[2:4] <= "98":
                at = start + 4  # no account number; what follows may be a card
                continue
        elif kind == "assigned":
            start, kind, value = m.start("hidden"), "key", m.group("hidden")
        elif kind == "name":
            value = _POSSESSIVE.sub("", value)
        yield start, kind, value


def replaced(text: str, key: bytes | None = None) -> tuple[str, list[dict]]:
    """The text with surrogates, and (kind, start, value, surrogate) of each entity;
    start is in code points of the given text."""
    key = key or _PROCESS_KEY
    spans = list(_entities(text))
    names = {w.lower() for _, kind, value in spans if kind == "name"
             for w in re.split(r"[\s\-]+", value[_TITLES.match(value).end():])
             if w and w not in PARTICLES}
    if names:
        spans = _with_mentions(text, spans, names)
    found, out, last = [], [], 0
    for start, kind, value in spans:
        new = surrogate(kind, value, key)
        out += [text[last:start], new]
        last = start + len(value)
        found.append({"kind": kind, "start": start, "value": value, "surrogate": new})
    return "".join([*out, text[last:]]), found


def _with_mentions(text: str, spans: list[tuple], names: set[str]) -> list[tuple]:
    """``spans`` and, between them, the words of ``names`` that stand without a title."""
    out, last = [], 0
    for span in [*spans, (len(text), "", "")]:
        for m in _NAME.finditer(text, last, span[0]):
            for part in re.finditer("[^-]+", m.group()):
                at, word = m.start() + part.start(), _POSSESSIVE.sub("", part.group())
                own = [(at, word)] if word.lower() in names else [
                    (at + p.start(), p.group()) for p in re.finditer("[^'’]+", word)
                    if p.group().lower() in names]
                out += [(i, "name", w) for i, w in own if not w[0].islower()
                        and not re.match(r"\w", text[i - 1:i] if i else "")
                        and not re.match(r"\w", text[i + len(w):i + len(w) + 1])]
        out.append(span)
        last = span[0] + len(span[2])
    return out[:-1]


ENTITY = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("value", pa.string()),
                    ("surrogate", pa.string())])


def with_surrogates(docs: DataFrame, key: bytes | None = None) -> DataFrame:
    """``docs`` with replaced texts, and ``_entities`` beside its columns."""
    key = key or session_key(docs.sparkSession)
    names = docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                texts = part.column("text").to_pylist()
                both = [(None, []) if t is None else replaced(t, key) for t in texts]
                new = pa.array([b[0] for b in both], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*(new if n == "text" else part.column(n) for n in names),
                     pa.array([b[1] for b in both], pa.list_(ENTITY))], names=[*names, "_entities"])

    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(
        run, f"{schema}, _entities array<struct<kind:string,start:long,value:string,surrogate:string>>")


def collisions(replaced_docs: DataFrame) -> DataFrame:
    """Surrogates that stand for several entities, and entities that kept their value or
    have several surrogates: no rows when distinctness and coreference hold.  The case of
    a to z counts in access keys only, that of other letters always."""
    def fold(c: str) -> F.Column:
        small = F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        return F.when(F.col("e.kind") == "key", F.col(c)).otherwise(small)

    e = replaced_docs.select(F.explode("_entities").alias("e")).select(
        "e.kind", fold("e.value").alias("value"), fold("e.surrogate").alias("surrogate")).distinct()
    by = [e.groupBy("kind", F.col(a).alias("of")).agg(F.count("*").alias("n")).where("n > 1")
          for a in ("value", "surrogate")]
    same = e.where("value = surrogate").select("kind", F.col("value").alias("of"), F.lit(1).alias("n"))
    return by[0].unionByName(by[1]).unionByName(same)


def checked(docs: DataFrame, key: bytes | None = None) -> DataFrame:
    """``with_surrogates``, written, and an error if ``collisions`` finds any row in it;
    it groups the distinct entities in hash buckets of the entity and of the surrogate."""
    done = written(with_surrogates(docs, key), "surrogates")
    bad = collisions(done).agg(F.count("*").alias("n"), F.min("kind").alias("kind")).first()
    if bad["n"]:
        raise ValueError(f"{bad['n']} surrogates collide or kept their value, kind {bad['kind']} first")
    return done


def replaced_documents(docs: DataFrame, key: bytes | None = None) -> DataFrame:
    """``checked`` with the columns of ``docs`` alone, whatever they are called."""
    return shielded(docs, ("text",), lambda d: checked(d, key))
