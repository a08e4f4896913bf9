"""Personal data: detected entities get keyed surrogates of their own kind and form."""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameweir.llm.common import pieces, row_id, texts_of
from frameweir.operators.joins import lookup_join
from frameweir.session import stored

KINDS = ["email", "phone", "ip", "card", "iban", "ssn", "first", "last"]
BROADCAST_BYTES = 16 << 20

# ---- detection ----------------------------------------------------------------------

# Between the groups of a phone number decoration may stand, but no word and no line end.
LOOSE = r"[^\w\n(+]{0,8}"
EMAIL = re.compile(r"(?<![\w.+-])[\w+-]+(?:\.[\w+-]+)*@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}")
PHONE = re.compile(
    rf"(?<![\w+(])(?:\+\d{{1,3}}{LOOSE}(?:\(\d{{3}}\)|\d{{3}})|\(\d{{3}}\)|\d{{3}}(?=[.-]\d{{3}}[.-])){LOOSE}\d{{3}}[ .-]\d{{4}}(?!\w)"
)
# Three groups with blanks; a country code and groups; ten digits behind a word that says what they are.
SPACED = re.compile(r"(?<![\w+.-])[2-9]\d{2} \d{3} \d{4}(?![\w-]| \d|[.,]\d)")
ABROAD = re.compile(r"(?<![\w+])\+\d{1,3}((?:[ .-]\d{1,4}){2,5})(?![\w-]|[ .]\d)")
CUED = re.compile(r"(?<!\w)(?:tel|phone|call|mobile|cell|fax|dial)(?:ephone)?[.:]{0,2} {1,3}([2-9]\d{9})(?![\w-]|[.,]\d)", re.I)
IPV6 = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:]|\.\d)")
IP = re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)")
IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
CARD = re.compile(r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?![\w]|[.-]\d)")
SSN = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")

TITLES = {
    "m": ["Mr", "Herr", "Sir", "Señor", "Sr", "Monsieur", "Г-н", "Господин", "Κύριος"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madam", "Señora", "Sra", "Madame", "Mme", "Г-жа", "Госпожа", "Κυρία"],
    "": ["Dr", "Prof"],
}
GENDER = {title: gender for gender, titles in TITLES.items() for title in titles}
_NAME = r"[^\W\d_a-zа-яёß-öø-ÿα-ωά-ώ][^\W\d_]+(?:[-'’][^\W\d_]+)?"
PERSON = re.compile(rf"(?<!\w)({'|'.join(sorted(GENDER, key=len, reverse=True))})(\.?[ ]+)({_NAME})(?:([ ]+)({_NAME}))?")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        value = int(d) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def mentions(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, entity) without overlaps, in order; the entity is the same
    for all ways to write it."""
    found = []
    if "@" in text:
        found += [(*m.span(), "email", m[0].lower()) for m in EMAIL.finditer(text)]
    if any(d in text for d in "0123456789"):
        for m in IBAN.finditer(text):
            plain = m[0].replace(" ", "")
            if 15 <= len(plain) <= 34 and _iban_rest(plain) == 1:
                found.append((*m.span(), "iban", plain))
        found += [(*m.span(), "phone", re.sub(r"\D", "", m[0])[-10:]) for m in PHONE.finditer(text)]
        found += [(*m.span(), "phone", re.sub(r"\D", "", m[0])) for m in SPACED.finditer(text)]
        found += [(*m.span(1), "phone", m[1]) for m in CUED.finditer(text)]
        for m in ABROAD.finditer(text):
            if 7 <= len(own := re.sub(r"\D", "", m[1])) <= 12:
                found.append((*m.span(), "phone", own))
        found += [(m.start(), m.end(), "ip", whole) for m in IPV6.finditer(text) if (whole := _ipv6(m[0]))]
        found += [(*m.span(), "ssn", re.sub(r"\D", "", m[0])) for m in SSN.finditer(text)]
        for m in IP.finditer(text):
            parts = [int(x) for x in m[0].split(".")]
            if max(parts) < 256:
                found.append((*m.span(), "ip", ".".join(map(str, parts))))
        found += [(*m.span(), "card", re.sub(r"\D", "", m[0])) for m in CARD.finditer(text)]
    for m in PERSON.finditer(text):
        if m[5]:
            found.append((*m.span(3), "first", f"{_script(m[3])}:{m[3].lower()}"))
            found.append((*m.span(5), "last", f"{_script(m[5])}:{m[5].lower()}"))
        else:
            found.append((*m.span(3), "last", f"{_script(m[3])}:{m[3].lower()}"))
    named = {x[3].rpartition(":")[2]: x[2:] for x in found if x[2] in ("first", "last")}
    if named:  # the same names again, without a title
        again = re.compile(rf"(?<!\w)(?:{'|'.join(sorted(map(re.escape, named), key=len, reverse=True))})(?!\w)", re.I)
        found += [(*m.span(), *named[m[0].lower()]) for m in again.finditer(text) if m[0][0].isupper()]
    found.sort(key=lambda x: (x[0], -x[1]))
    kept, end = [], 0
    for one in found:
        if one[0] >= end:
            kept.append(one)
            end = one[1]
    return kept


def _ipv6(text: str) -> str:
    """The address in its usual form; empty if it is none, or short enough to be
    something else, as loopback or a pair of names in code."""
    if not re.search(r"[0-9A-Fa-f]{3}", text) or not re.search(r"\d", text):
        return ""
    try:
        return str(ipaddress.IPv6Address(text))
    except ValueError:
        return ""


def genders(text: str) -> dict[str, str]:
    """First names (entities) behind a title that tells a gender; "n" where titles differ."""
    told: dict[str, str] = {}
    for m in PERSON.finditer(text):
        if m[5] and GENDER[m[1]]:
            entity = f"{_script(m[3])}:{m[3].lower()}"
            told[entity] = GENDER[m[1]] if told.get(entity, GENDER[m[1]]) == GENDER[m[1]] else "n"
    return told


# ---- surrogates ---------------------------------------------------------------------


def _hash(key: bytes, *parts: object) -> int:
    data = "\x1f".join(map(str, parts)).encode()
    return int.from_bytes(hashlib.blake2b(data, key=key[:64], digest_size=16).digest(), "big")


def permute(value: int, sizes: list[int], key: bytes, *tweak: object) -> int:
    """A keyed permutation of the numbers below the product of `sizes`: the digits
    are parted into two halves, each of which is shifted by a hash of the other."""
    half = (len(sizes) + 1) // 2
    a_size, b_size = 1, 1
    for s in sizes[:half]:
        a_size *= s
    for s in sizes[half:]:
        b_size *= s
    a, b = divmod(value, b_size)
    for turn in range(8):
        if turn % 2:
            b = (b + _hash(key, *tweak, turn, a) % b_size) % b_size
        else:
            a = (a + _hash(key, *tweak, turn, b) % a_size) % a_size
    return a * b_size + b


ALPHABETS = [
    "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "äöüßéèêàâçùûîïôñóíáúëœæ",
    "абвгдежзийклмнопрстуфхцчшщъыьэюя", "αβγδεζηθικλμνξοπρσςτυφχψω",
]

# After so many attempts a name gets one more syllable and the local part of an
# address one more letter, so that no pool is ever used up.
GROWS = 2

# Attempts after which there is no hope of a free surrogate.
ROUNDS = 64


def _alphabet(char: str) -> str:
    """What a character is exchanged in: digits and letters of other scripts become
    Latin ones, signs stay."""
    own = next((a for a in ALPHABETS if char in a), "")
    return own or (ALPHABETS[0] if char.isdecimal() else ALPHABETS[1] if char.isalnum() else "")


def _same_form(text: str, key: bytes, *tweak: object) -> str:
    """Characters exchanged within their alphabets; signs stay. A permutation of
    the texts of one form, as far as all characters are in `ALPHABETS`."""
    where = [_alphabet(c) for c in text]
    value, sizes = 0, [len(a) for a in where if a]
    for c, a in zip(text, where, strict=True):
        if a:
            value = value * len(a) + (a.index(c) if c in a else ord(c) % len(a))
    value, out = permute(value, sizes, key, *tweak), []
    for c, a in zip(reversed(text), reversed(where), strict=True):
        if a:
            value, at = divmod(value, len(a))
            c = a[at]
        out.append(c)
    return "".join(reversed(out))


# Domains that say nothing about a person: reserved ones and large providers.
COMMON = ("example.com", "example.org", "example.net", "gmail.com", "outlook.com", "yahoo.com", "icloud.com")


def _email(entity: str, key: bytes, attempt: int) -> str:
    local, _, domain = entity.rpartition("@")
    if not any(domain == x or domain.endswith("." + x) for x in COMMON):
        body, _, top = domain.rpartition(".")
        domain = f"{_same_form(body, key, 'domain')}.{top}"
    made = _same_form(local, key, "email", entity.rpartition("@")[2], attempt)
    # A form with all its addresses in use, or without a character to exchange, gets longer.
    value = _hash(key, "longer", entity, attempt)
    for _ in range(attempt // GROWS + (not any(map(_alphabet, local)))):
        value, at = divmod(value, 26)
        made += ALPHABETS[1][at]
    return f"{made}@{domain}"


def _card(entity: str, key: bytes, attempt: int) -> str:
    """The first digit stays, as does whether the check digit fits."""
    if _luhn(entity):
        body = entity[0] + _same_form(entity[1:-1], key, "card", len(entity), entity[0], attempt)
        return next(body + d for d in "0123456789" if _luhn(body + d))
    found = entity
    while True:  # walk on along the permutation until the check digit is wrong again
        found = found[0] + _same_form(found[1:], key, "number", len(entity), entity[0], attempt)
        if not _luhn(found):
            return found


def _ip(entity: str, key: bytes, attempt: int) -> str:
    """Private, loopback and high addresses stay in their range. Where a range has
    no room left, the smaller private ones turn to 10.0.0.0/8, then all to the high one."""
    if ":" in entity:  # the first 16 bits say what kind of address it is
        whole = int(ipaddress.IPv6Address(entity))
        head, tail = whole >> 112, whole & ((1 << 112) - 1)
        return str(ipaddress.IPv6Address(head << 112 | permute(tail, [2] * 112, key, "ipv6", head, attempt)))
    a, b, c, d = map(int, entity.split("."))
    value = (a << 24) | (b << 16) | (c << 8) | d

    def fixed_bits(x: int) -> int:
        top = x >> 24
        if top in (0, 10, 127):
            return 8
        if x >> 20 == 0xAC1:
            return 12
        if x >> 16 == 0xC0A8:
            return 16
        return 3 if top >= 224 else 0

    own = fixed_bits(value)
    if own > 3 and attempt >= 4 * GROWS:
        value, own = 224 << 24 | _hash(key, "wide", entity, attempt) % (1 << 29), 3
    elif own > 8 and attempt >= 2 * GROWS:
        value, own = 10 << 24 | _hash(key, "wide", entity, attempt) % (1 << 24), 8
    free = 32 - own
    head, tail = value >> free << free, value & ((1 << free) - 1)
    while True:
        tail = permute(tail, [2] * free, key, "ip", own, head, attempt)
        if fixed_bits(head | tail) == own:
            value = head | tail
            return ".".join(str(value >> s & 255) for s in (24, 16, 8, 0))


def _iban(entity: str, key: bytes, attempt: int) -> str:
    body = _same_form(entity[4:], key, "iban", entity[:2], attempt)
    rest = _iban_rest(entity[:2] + "00" + body)
    return f"{entity[:2]}{98 - rest:02d}{body}"


SYLLABLES = {
    "latin": ("bdfgklmnprstv", "aeiou"),
    "cyrillic": ("бвгдзклмнпрст", "аеиоу"),
    "greek": ("βγδζκλμνπρστ", "αειου"),
}
ENDINGS = {
    "first": {
        "latin": {"f": "a", "m": "n", "n": "el"},
        "cyrillic": {"f": "а", "m": "н", "n": "ль"},
        "greek": {"f": "α", "m": "ος", "n": "ι"},
    },
    "last": {"latin": "er", "cyrillic": "ко", "greek": "ου"},
}


def _script(name: str) -> str:
    first = ord(name[0])
    return "cyrillic" if 0x400 <= first < 0x530 else "greek" if 0x370 <= first < 0x400 else "latin"


def _name(kind: str, entity: str, key: bytes, attempt: int, gender: str) -> str:
    """A made-up name of the same script, and for first names of the gender."""
    script = entity.split(":")[-2]
    consonants, vowels = SYLLABLES[script]
    value = _hash(key, kind, entity, attempt)
    made = ""
    for _ in range(3 + attempt // GROWS):
        value, c = divmod(value, len(consonants))
        value, v = divmod(value, len(vowels))
        made += consonants[c] + vowels[v]
    if kind == "last":
        return f"{script}:{made}{ENDINGS['last'][script]}"
    ending = ENDINGS["first"][script][gender or "n"]
    made = made[:-1] if ending[0] in vowels else made
    return f"{script}:{made}{ending}"


def surrogate(kind: str, entity: str, key: bytes, attempt: int = 0, gender: str = "") -> str:
    if kind == "email":
        return _email(entity, key, attempt)
    if kind == "card":
        return _card(entity, key, attempt)
    if kind == "ip":
        return _ip(entity, key, attempt)
    if kind == "iban":
        return _iban(entity, key, attempt)
    if kind in ("first", "last"):
        return _name(kind, entity, key, attempt, gender)
    return _same_form(entity, key, kind, attempt)


def written(kind: str, mention: str, entity: str) -> str:
    """The entity in the form of the mention: its signs between digits, its case."""
    if kind in ("phone", "ssn", "card"):
        places = [i for i, c in enumerate(mention) if c.isdigit()][-len(entity) :]
        chars = list(mention)
        for i, d in zip(places, entity, strict=True):
            chars[i] = d
        return "".join(chars)
    if kind == "iban":
        left = iter(entity)
        return "".join(c if c == " " else next(left) for c in mention)
    text = entity.rpartition(":")[2] if kind in ("first", "last") else entity
    letters = [c for c in mention if c.isalpha()]
    if len(letters) > 1 and all(c.isupper() for c in letters):
        return text.upper()
    return text[0].upper() + text[1:] if mention[:1].isupper() else text


# ---- the operator -------------------------------------------------------------------


def distinct_mentions(docs: DataFrame) -> DataFrame:
    """(key, kind, entity, gender): what each document row names; the gender of a first
    name where a title there tells it."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            rows = []
            for key, text in zip(batch["key"].to_pylist(), texts_of(batch), strict=True):
                named = sorted({x[2:] for x in mentions(text)})
                told = genders(text) if any(kind == "first" for kind, _ in named) else {}
                rows += [(key, kind, entity, told.get(entity) if kind == "first" else None) for kind, entity in named]
            key = pa.array([x[0] for x in rows], batch.schema.field("key").type)
            columns = [key, *(pa.array([x[i] for x in rows], pa.string()) for i in (1, 2, 3))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "kind", "entity", "gender"])

    return docs.select("key", "text").mapInArrow(scan, "key struct<a:long,b:long>, kind string, entity string, gender string")


def _attempts(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, entity, gender, attempt) to the same with the surrogate."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch[x].to_pylist() for x in ("kind", "entity", "attempt", "gender")), strict=True)
            made = pa.array([surrogate(*row[:2], key, *row[2:]) for row in rows], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, "surrogate"])

    return entities.mapInArrow(make, "kind string, entity string, gender string, attempt int, surrogate string")


def assign(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, entity, gender, attempt, surrogate) of (kind, entity, gender): different entities of a kind get different
    surrogates, and none gets what some document really names.

    First attempts are mostly free, as they come from permutations or large sets.
    Of those that meet, the first keeps its surrogate and the others try again,
    from pools that grow with the attempt. Only SSNs (10^9), phone and card numbers,
    accounts and public addresses have no larger pool: there at most half of all
    that exist can be named, and more than that end in an error after ROUNDS.
    """
    if "gender" not in entities.columns:
        entities = entities.withColumn("gender", F.lit(""))
    state = stored(_attempts(entities.select("kind", "entity", "gender", F.lit(0).alias("attempt")), key), "surrogates")
    for _ in range(ROUNDS):
        owner = state.groupBy("kind", "surrogate").agg(F.min("entity").alias("owner"), F.count("*").alias("n"))
        met = state.join(owner.where("n > 1"), ["kind", "surrogate"]).where("entity <> owner").select("kind", "entity")
        real = entities.select("kind", F.col("entity").alias("surrogate"))
        taken = state.join(real, ["kind", "surrogate"], "left_semi").select("kind", "entity")
        again = stored(met.union(taken).distinct(), "again")
        left = again.take(1)
        if not left:
            return state
        fine = state.join(again, ["kind", "entity"], "left_anti")
        more = state.join(again, ["kind", "entity"], "left_semi")
        more = _attempts(more.select("kind", "entity", "gender", (F.col("attempt") + 1).alias("attempt")), key)
        state = stored(fine.unionByName(more), "surrogates")
    raise ValueError(f"too many entities are named for each to get a surrogate, some of them of the kind {left[0].kind}")


REPLACED = (
    "text string, n_entities long, "
    + ", ".join(f"n_{kind} long" for kind in KINDS)
    + ", replaced array<struct<kind:string,start:long,end:long,surrogate:string>>"
)


def replace_entities(docs: DataFrame, key: bytes) -> DataFrame:
    """One row per row of `docs` (doc_id, text; other columns are not read): doc_id,
    text with surrogates, counts by kind, and `replaced` (places in the old text).

    Found are e-mail, phone, IP, card and account numbers, SSNs, names behind
    a title, and the same names wherever else they stand in that text. The same
    entity has the same surrogate in all documents and in all ways it is
    written, a first name also behind titles of any gender: its surrogate has
    the gender that all of its titles agree on. Whoever has `key` can undo most
    surrogates, so it is to be kept secret; different entities have different ones. Digits, case,
    separators, check digits, address ranges, script and gender stay as they
    are. A text without entities stays as it is, a null text stays null with
    counts of zero; null ids and repeated rows are kept; an empty table gives an
    empty result. Texts are searched whole.
    """
    keyed = docs.select("doc_id", "text", row_id().alias("key"))
    found = stored(distinct_mentions(keyed), "mentions")
    one = F.when(F.min("gender") == F.max("gender"), F.min("gender")).otherwise("")
    state = assign(stored(found.groupBy("kind", "entity").agg(one.alias("gender")), "entities"), key)
    # Texts compute first attempts themselves; only the others, and genders, are looked up.
    later = found.drop("gender").join(state.where("attempt > 0 or gender in ('f', 'm')"), ["kind", "entity"])
    later = later.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("kind", "entity", "attempt", "gender"))).alias("later"))
    rows = lookup_join(keyed, later, ["key"], limit=BROADCAST_BYTES)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("surrogate", pa.string())])
        for batch in pieces(batches):
            out: dict[str, list] = {k: [] for k in ("text", "n_entities", *(f"n_{k}" for k in KINDS), "replaced")}
            for text, own in zip(batch["text"].to_pylist(), batch["later"].to_pylist(), strict=True):
                again = {(x["kind"], x["entity"]): (x["attempt"], x["gender"]) for x in own or []}
                parts, spans, at = [], [], 0
                for start, end, kind, entity in mentions(text or ""):
                    made = surrogate(kind, entity, key, *again.get((kind, entity), (0, "")))
                    made = written(kind, text[start:end], made)
                    parts += [text[at:start], made]
                    spans.append({"kind": kind, "start": start, "end": end, "surrogate": made})
                    at = end
                out["text"].append("".join([*parts, text[at:]]) if spans else text)
                out["n_entities"].append(len(spans))
                for k in KINDS:
                    out[f"n_{k}"].append(sum(x["kind"] == k for x in spans))
                out["replaced"].append(spans)
            kinds = {"text": pa.string(), "replaced": pa.list_(span)}
            columns = [pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], names=["doc_id", *out])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {REPLACED}"
    return rows.select("doc_id", "text", "later").mapInArrow(rewrite, schema)
