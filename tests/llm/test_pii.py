"""Surrogates: detection, form, distinctness, coreference."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from frameweir.llm import pii

KEY = b"a key"


def rewritten(text, key=KEY):
    out, told = text, pii.genders(text)
    for start, end, kind, entity in reversed(pii.mentions(text)):
        made = pii.surrogate(kind, entity, key, 0, told.get(entity, "") if kind == "first" else "")
        out = out[:start] + pii.written(kind, text[start:end], made) + out[end:]
    return out


@pytest.mark.parametrize(
    "text, kinds",
    [
        ("mail und.34@mail7.example.com now", ["email"]),
        ("call +1 (017) 555-7713, or 017-555-7713", ["phone", "phone"]),
        ("+1%%% (017)$$$ 555-7713&&&", ["phone"]),
        ("at 97.51.17.173, not 1.2.3 nor 300.1.1.1 nor 1.2.3.4.5", ["ip"]),
        ("4111 1111 1111 1111 and 9807915762804490", ["card", "card"]),
        ("DE89 3704 0044 0532 0130 00", ["iban"]),
        ("DE00 3704 0044 0532 0130 00", ["card"]),
        ("078-05-1120", ["ssn"]),
        ("Mrs Anna Smith met Dr. Jones; Smith left", ["first", "last", "last", "last"]),
        ("token = 0b96a8c8d79c4a5085c919698889f59b72ab7bb6", []),
        ("version 3.14, in 1984, 12:30", []),
        ("ask 555 123 4567 or +44 20 7946 0958, or +33 1 42 68 53 00.", ["phone"] * 3),
        ("Phone: 5551234567; order 5551234567, 1700000000", ["phone"]),
        ("rows 555 123 4567 89 and 1 555 123", []),
        ("from 2001:db8::8a2e:370:7334, [fe80::1] and 2001:0DB8:0:0:0:0:2:1", ["ip"] * 3),
        ("std::vector, a::b, ::1, 12:30:45, AA:BB:CC, 2001:db8", []),
    ],
)
def test_detection(text, kinds):
    assert [x[2] for x in pii.mentions(text)] == kinds


def shape(text):
    return re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", text)))


def test_form_and_coreference():
    text = "UND.34@MAIL7.EXAMPLE.COM und.34@mail7.example.com +1 (017) 555-7713 017-555-7713 10.1.2.3 192.168.1.1 8.8.8.8 DE89 3704 0044 0532 0130 00"
    out = rewritten(text)
    assert out != text and re.sub(r"\d+", "9", shape(out)) == re.sub(r"\d+", "9", shape(text))
    words = out.split()
    assert words[0].lower() == words[1] and words[1].endswith("@mail7.example.com")
    assert words[3][1:4] == words[5][:3] and words[4] == words[5][4:]
    assert words[6].startswith("10.") and words[7].startswith("192.168.")
    assert pii._iban_rest("".join(words[9:])) == 1
    card = rewritten("4111 1111 1111 1111")
    assert pii._luhn(card.replace(" ", "")) and card[0] == "4" and shape(card) == "9999 9999 9999 9999"
    assert not pii._luhn(rewritten("9807915762804490"))
    assert rewritten(text, b"other") != out


def test_names():
    out = rewritten("Mrs Anna Smith and Mr SMITH; Г-жа Анна Петрова")
    first, last, upper = re.match(r"Mrs (\w+) (\w+) and Mr (\w+);", out).groups()
    assert first.endswith("a") and last.upper() == upper and "Smith" not in out
    assert re.search(r"Г-жа [А-Я][а-я]+а [А-Я][а-я]+$", out)
    assert re.match(r"Mr \w+n \w+", rewritten("Mr Paul Smith"))


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text(alphabet="abé9.", min_size=1, max_size=4), min_size=2, max_size=40), st.integers(0, 3))
def test_texts_of_a_form_are_permuted(texts, tweak):
    made = [pii._same_form(t, KEY, tweak) for t in texts]
    assert len(set(made)) == len(texts)
    assert all(len(a) == len(b) and [c.isdigit() for c in a] == [c.isdigit() for c in b] for a, b in zip(texts, made))


def test_small_domain_is_permuted():
    assert sorted(pii.permute(v, [10, 10], KEY, "x") for v in range(100)) == list(range(100))
    assert sorted(pii.permute(v, [7], KEY, "x") for v in range(7)) == list(range(7))


def test_one_name_behind_titles_of_any_gender(spark):
    rows = [(1, "Dr Anna Schmidt met Frau Anna Schmidt"), (2, "Prof Anna Maier"), (3, "Mr Kim Lee"), (4, "Mrs Kim Ray and KIM"), (5, "Dr. Robin Ray")]
    got = {r.doc_id: r for r in pii.replace_entities(spark.createDataFrame(rows, "doc_id long, text string"), KEY).collect()}
    names = {i: [x.surrogate for x in r.replaced] for i, r in got.items()}
    assert names[1][0] == names[1][2] == names[2][0] and names[1][0].endswith("a")
    assert names[3][0] == names[4][0] == names[4][2].title() and names[3][0].endswith("el")
    assert names[5][0].endswith("el") and len({names[1][0], names[3][0], names[5][0]}) == 3


def test_other_addresses_and_numbers_keep_their_form():
    out = rewritten("2001:0DB8:0:0:0:0:2:1 or 2001:db8::2:1, +44 20 7946 0958, fe80::1")
    first, _, second, code, a, b, c, last = out.replace(",", "").split()
    assert first.lower() == second and first.isupper() and first.startswith("2001:") and last.startswith("fe80:")
    assert code == "+44" and [len(x) for x in (a, b, c)] == [2, 4, 4] and (a, b, c) != ("20", "7946", "0958")


def test_no_free_surrogates_end_in_an_error(spark, monkeypatch):
    monkeypatch.setattr(pii, "ROUNDS", 2)
    monkeypatch.setattr(pii, "_attempts", lambda entities, key: entities.withColumn("surrogate", F.lit("1")))
    entities = spark.createDataFrame([("ssn", "1"), ("ssn", "2")], "kind string, entity string")
    with pytest.raises(ValueError, match="ssn"):
        pii.assign(entities, KEY)


def test_distinct_and_the_same_everywhere(spark, folder):
    """Every mention of the whole table, against the definition: one surrogate per entity,
    one entity per surrogate, and no surrogate that is an entity."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    named = spark.createDataFrame([(-1 - i, f"Dr Anna Maier{'abcdefgh'[i]} and Mrs Anna Ray, 555 123 45{i}7, 2001:db8::{i + 1}") for i in range(8)], docs.schema)
    texts = {r.doc_id: r.text for r in docs.unionByName(named).collect()}
    made: dict = {}
    for r in pii.replace_entities(docs.unionByName(named), KEY).collect():
        found = pii.mentions(texts[r.doc_id] or "")
        assert len(found) == len(r.replaced)
        for (start, end, kind, entity), x in zip(found, r.replaced, strict=True):
            text = x.surrogate if kind not in ("phone", "ssn", "card") else re.sub(r"\D", "", x.surrogate)[-len(entity) :]
            made.setdefault((kind, entity), set()).add(text.lower().replace(" ", ""))
    assert len(made) > 20 and all(len(x) == 1 for x in made.values())
    whole = [(kind, x) for (kind, _), found in made.items() for x in found]
    assert len(set(whole)) == len(whole)
    assert not set(whole) & {(kind, entity.rpartition(":")[2] if kind in ("first", "last") else entity.lower()) for kind, entity in made}


def test_collisions_are_resolved(spark, monkeypatch):
    """With few names to choose from, entities meet, and meet real ones."""
    monkeypatch.setitem(pii.SYLLABLES, "latin", ("bd", "aei"))
    names = [f"latin:{a}{b}" for a in "bdfgklm" for b in "abcdefgh"] + ["latin:bababaer", "latin:dadedier"]
    entities = spark.createDataFrame([("last", n) for n in names], "kind string, entity string")
    monkeypatch.setattr(pii, "surrogate", lambda kind, entity, key, n=0, gender="": f"latin:{pii._hash(key, entity, n) % 200:03d}" if n else "latin:bababaer")
    # The functions run in this process's workers as they are here, so what is tested is the loop.
    state = {r.entity: r for r in pii.assign(entities, KEY).collect()}
    made = [r.surrogate for r in state.values()]
    assert len(state) == len(set(made)) == len(names) and not set(made) & set(names)
    assert max(r.attempt for r in state.values()) > 0


def test_pools_grow(spark):
    """More entities than the first pools hold: names, short addresses, small ranges."""
    assert len(pii.surrogate("last", "latin:smith", KEY, 6)) > len(pii.surrogate("last", "latin:smith", KEY))
    assert len(pii.surrogate("email", "a@gmail.com", KEY, 6)) > len("a@gmail.com")
    for local in ("___", "иван", "中文", "+-+"):
        assert pii.surrogate("email", f"{local}@gmail.com", KEY) != f"{local}@gmail.com"
    assert not pii.surrogate("ip", "192.168.1.1", KEY, 6).startswith("192.168.")
    rows = [("first", f"f:latin:x{i}") for i in range(13**3 * 5**2 + 1)]
    rows += [("email", f"{c}@{d}.com") for c in "abcdefghijklmnopqrstuvwxyz0123456789_" for d in ("example", "gmail")]
    rows += [("email", f"{x}@gmail.com") for x in ("___", "иван", "中文", "文中")]
    rows += [("ip", f"192.168.{i >> 8}.{i & 255}") for i in range(40_000)]
    state = pii.assign(spark.createDataFrame(rows, "kind string, entity string"), KEY).collect()
    made = {(r.kind, r.surrogate) for r in state}
    assert len(state) == len(made) == len(rows) and not made & set(rows)


@pytest.mark.parametrize("limit", [0, 10**9])
def test_texts(spark, monkeypatch, limit):
    monkeypatch.setattr(pii, "BROADCAST_BYTES", limit)
    made = pii.surrogate("ip", "97.51.17.173", KEY)
    rows = [(1, "ip 97.51.17.173 here"), (2, f"and {made} there"), (3, "nothing here"), (4, "97.51.17.173 again")]
    got = {r.doc_id: r for r in pii.replace_entities(spark.createDataFrame(rows, "doc_id long, text string"), KEY).collect()}
    # The first surrogate is what another document really names, so it isn't used.
    assert made not in got[1].text and got[1].text.split()[1] == got[4].text.split()[0]
    assert got[2].text.split()[1] != got[1].text.split()[1]
    assert got[3].text == "nothing here" and got[3].n_entities == 0
    assert got[1].n_ip == 1 and got[1].replaced[0].start == 3


def test_nothing_is_left(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    got = pii.replace_entities(docs, KEY)
    both = got.select("doc_id", F.col("text").alias("new")).join(docs, "doc_id").collect()
    entities = {r.doc_id: {(k, e) for _, _, k, e in pii.mentions(r.text)} for r in both}
    every = {x for found in entities.values() for x in found}
    assert len(every) > 10
    for r in both:
        assert (r.new == r.text) == (not entities[r.doc_id])
        assert not {(k, e) for _, _, k, e in pii.mentions(r.new)} & every
        assert shape(r.new).count("9") == shape(r.text).count("9") or any(k == "ip" for k, _ in entities[r.doc_id])
