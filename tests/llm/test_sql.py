"""Queries against their SQL, and operators against brute force."""

import pytest
from pyspark.sql import functions as F

from frameweir.llm import decontaminate, lines, simhash
from frameweir.llm.graph import components
from frameweir.llm.queries import ORACLE, QUERIES
from tests.llm import brute
from tools.check import compare


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, folder, name):
    assert compare(spark, folder, name).startswith("ok")


def test_names():
    assert set(ORACLE) < set(QUERIES) and "pipeline" in QUERIES
    assert {int(x[2:].split("_")[0]) for x in QUERIES if x != "pipeline"} == set(range(1, 11))


@pytest.fixture(scope="module")
def texts(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 80").select("doc_id", "text").collect()
    return [(r.doc_id, r.text[:1500]) for r in rows]  # brute force is slow


def edited(rows):
    """The texts, and copies with words changed, dropped and put in."""
    out = list(rows)
    for doc_id, text in rows[:40]:
        words = text.split(" ")
        for k, step in enumerate((7, 19, 40)):
            changed = [w + "x" if i % step == 3 else w for i, w in enumerate(words)]
            out.append((1000 + 10 * doc_id + k, " ".join(changed)))
        out.append((1000 + 10 * doc_id + 5, " ".join(words[:-2])))
    return out


def test_lines_by_brute_force(spark, texts):
    rows = edited(texts)
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute.removed_lines(rows)
    assert {r.doc_id: [int(x) for x in r.removed.split(",") if x] for r in got} == want
    assert sum(map(len, want.values())) > 60
    for r in got:
        own = dict(rows)[r.doc_id].split("\n")
        assert r.text == "\n".join(x for i, x in enumerate(own) if i not in want[r.doc_id])


@pytest.mark.parametrize("limit", [0, 10**9])
def test_lines_that_fail_their_first_try(spark, monkeypatch, limit):
    """Lines between two others: close to one, a little too far from the other."""
    monkeypatch.setattr(lines, "BROADCAST_BYTES", limit)
    base = [f"t{i}" for i in range(40)]
    rows = []
    for k in range(30):
        own = [f"{w}v{k}" if (i + k) % 13 == 0 else w for i, w in enumerate(base)]
        own = own[: 40 - k % 9]
        rows.append((k, " ".join(own)))
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: [int(x) for x in r.removed.split(",") if x] for r in got} == brute.removed_lines(rows)


@pytest.mark.parametrize("limit", [0, 10**9])
def test_decontamination_by_brute_force(spark, folder, texts, limit):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").limit(20).collect()]
    items += [(100 + n, " ".join(brute.plain_words(texts[n][1])[5 : 5 + n])) for n in range(1, 14)]
    rows = texts + [(500 + i, f"before it {text} behind") for i, (_, text) in enumerate(items[:20])]
    got = decontaminate.contamination(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), limit=limit
    ).collect()
    for r in got:
        places, found = brute.hit_words(dict(rows)[r.doc_id], items)
        assert (r.n_hit, r.items) == (len(places), sorted(map(str, found)))
        assert {p for s in r.spans for p in range(s.start, s.end)} == places
    assert sum(r.contaminated for r in got) > 25


@pytest.mark.parametrize("chunk", [2, 4096])
def test_simhash_by_brute_force(spark, texts, monkeypatch, chunk):
    rows = edited(texts) + [(5000, ""), (5001, "one"), (5002, "one two")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(simhash.links, "__defaults__", (6, 3, chunk))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(table).collect()}
    rows.sort()
    roots = brute.components([t for _, t in rows])
    assert got == {i: (f"{brute.fingerprint(t):016x}", rows[root][0]) for (i, t), root in zip(rows, roots, strict=True)}
    assert len(set(roots)) < len(rows)


def test_links_of_a_large_group(spark):
    """Fingerprints along a chain: neighbours differ in three bits, the ends in many."""
    state, fps = 0, []
    for i in range(300):
        for k in range(3):
            state ^= 1 << ((7 * i + 13 * k) % 63)
        fps.append(state)
    fps = list(dict.fromkeys(fps))
    table = spark.createDataFrame([(x,) for x in fps], "fp long")
    got = {r.node: r.root for r in components(simhash.links(table, chunk=16)).collect()}
    roots = brute.groups(sorted(fps), lambda a, b: bin(a ^ b).count("1") <= 3)
    assert {x: got.get(x, x) for x in fps} == {x: sorted(fps)[r] for x, r in zip(sorted(fps), roots, strict=True)}


def test_components_of_a_long_chain(spark):
    chain = spark.range(1, 400).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    got = components(chain.unionByName(spark.createDataFrame([(1000, 1001), (7, 7)], "a long, b long"))).collect()
    assert {r.node: r.root for r in got} == {**{i: 0 for i in range(400)}, 1000: 1000, 1001: 1000}
