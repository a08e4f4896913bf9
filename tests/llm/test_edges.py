"""Every operator and stage on nulls, empty and long texts, repeats, clashing columns and empty tables."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from frameweir.llm import decontaminate, lines, lm, middle, mixing, pii, quality, rules, secrets, simhash, spelling, subwords, toxicity
from frameweir.llm.common import labelled_once, remainder, row_id

PROSE = "The quick brown fox went over the lazy dog and on to the river bank again.\n"
ROWS = [
    (1, PROSE * 3 + "One more line of its own with several words."),
    (2, None),
    (3, ""),
    (3, ""),
    (4, " \n\t\n"),
    (None, "A text without an id, but with enough words to be a text."),
    (None, None),
    (5, "same text twice and the same id, with ten words or more here"),
    (5, "same text twice and the same id, with ten words or more here"),
    (5, "the same id with another text that says something else here now"),
    (6, " ".join(f"w{i}" for i in range(60_000))),
    (7, "x" * 300_000),
    (8, "you are an idiot and a moron, said the clown to the loser in the hall"),
    (9, "ÄÖÜ \U0001f600 你好 слово été café naïve rôle zürich αβγ fin"),
]
# Names that operators use inside, on purpose.
CLASHES = ["row", "rid", "key", "label", "score", "kept", "fp", "lines", "gone", "signs", "n_tokens", "posterior", "rate", "copies", "a", "words"]


@pytest.fixture(scope="module")
def docs(spark):
    table = spark.createDataFrame(ROWS, "doc_id long, text string")
    table = table.withColumns({name: F.lit("mine") for name in CLASHES})
    return table.withColumn("n_chars", F.char_length("text").cast("long"))


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (1, 1, 0), (5, 1, 0), (7, 0, 0), (8, 1, 1), (9, None, 0), (None, 1, 1), (99, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, PROSE), (1, PROSE), (2, None), (3, "..."), (None, "with ten words or more"), (4, "another text")]
    return spark.createDataFrame(rows, "item_id long, text string")


def run(name, docs, labels, benchmark):
    return {
        "secrets": lambda: secrets.find_secrets(docs),
        "decontaminate": lambda: decontaminate.contamination(docs, benchmark),
        "rules": lambda: rules.judge(docs, rules.fit_forest(docs, labels)),
        "lm": lambda: lm.score_texts(docs, remainder(F.col("doc_id"), 5) == 1),
        "toxicity": lambda: toxicity.score_texts(docs, toxicity.fit(docs, labels)),
        "mixing": lambda: mixing.mix(docs, labels),
        "lines": lambda: lines.dedup_lines(docs),
        "simhash": lambda: simhash.near_duplicates(docs),
        "pii": lambda: pii.replace_entities(docs, b"key"),
        "quality": lambda: quality.score_texts(docs, quality.fit(docs, labels, epochs=3)),
        "subwords": lambda: subwords.encode_texts(docs, subwords.read_model(public_tokenizers.path("piece_bpe_32k.model"))),
        "middle": lambda: middle.fill_in_middle(docs),
    }[name]()


NAMES = ["secrets", "decontaminate", "rules", "lm", "toxicity", "mixing", "lines", "simhash", "pii", "quality", "subwords", "middle"]


def ids(rows):
    return sorted((r.doc_id is not None, r.doc_id or 0) for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_one_row_per_row(name, docs, labels, benchmark):
    got = run(name, docs, labels, benchmark).collect()
    assert ids(got) == ids(docs.collect())
    three = [r.asDict(recursive=True) for r in got if r.doc_id == 3]
    assert three[0] == three[1]  # repeated rows


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(name, docs, labels, benchmark):
    none = run(name, docs.limit(0), labels.limit(0), benchmark.limit(0))
    assert none.count() == 0 and none.columns[0] == "doc_id"


@pytest.mark.parametrize("name", NAMES)
def test_without_labels_or_items(name, docs, labels, benchmark):
    assert run(name, docs, labels.limit(0), benchmark.limit(0)).count() == len(ROWS)


@pytest.mark.parametrize("stage", range(5))
def test_stages_keep_columns(spark, stage, docs, labels, benchmark, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    name, function = corpus_pipeline.STAGES[stage]
    got = function(spark, docs, str(tmp_path))
    if name == "mixing":
        assert set(got.columns) == set(docs.columns) and got.schema["copies"].dataType.simpleString() == "int"
        assert got.where("copies < 1").count() == 0
    else:
        assert got.columns == docs.columns and got.schema == docs.schema
        assert all(r.row == "mine" and r.gone == "mine" for r in got.collect())
    empty = function(spark, docs.limit(0), str(tmp_path))
    assert empty.columns == got.columns and empty.count() == 0


def test_results_of_edge_rows(docs, labels, benchmark):
    got = {(r.doc_id, r.n_removed, r.text) for r in run("lines", docs, labels, benchmark).collect()}
    assert (2, 0, None) in got and (4, 0, " \n\t\n") in got
    # neither copy of a row is earlier than the other
    assert sum(r[0] == 5 and r[1] == 0 for r in got) == 2
    found = {r.doc_id: r for r in run("decontaminate", docs, labels, benchmark).collect() if r.doc_id != 5}
    assert found[1].n_hit == 48 and found[1].items == ["1"] and found[1].spans[0].end == 48
    assert (found[2].n_words, found[2].contaminated, found[6].n_words) == (0, False, 60_000)
    five = sorted((r.n_hit, r.n_items) for r in run("decontaminate", docs, labels, benchmark).collect() if r.doc_id == 5)
    assert five == [(2, 1), (5, 0), (5, 0)]  # an item without an id hits but isn't named
    names = {r.doc_id: r for r in run("simhash", docs, labels, benchmark).collect()}
    assert names[2].fingerprint == "0" * 16 and names[2].component_id == names[3].component_id == names[4].component_id == 2


def test_spelling_on_edge_rows(docs):
    got = spelling.spelling_groups(docs)
    assert got.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    assert all(r.n >= 2 and len(r.word) >= 7 and r.root for r in got.collect())


def test_null_id_and_null_text_are_different_rows(spark):
    """An id that equals the text of a row without an id, all four users of the row key."""
    text = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame([(text, None), (None, text), ("b", "Hans Meier: a@b.org")], "doc_id string, text string")
    assert docs.select(row_id()).distinct().count() == 3
    items = spark.createDataFrame([(1, text)], "item_id long, text string")
    kept = simhash.without_near_duplicates(docs).collect()
    assert {(r.doc_id, r.text) for r in kept} == {(r.doc_id, r.text) for r in docs.collect()}
    assert {(r.doc_id, r.text) for r in decontaminate.without_contaminated(docs, items).collect()} == {(text, None), ("b", "Hans Meier: a@b.org")}
    assert {(r.doc_id, r.n_removed) for r in lines.dedup_lines(docs).collect()} == {(text, 0), (None, 0), ("b", 0)}
    assert {(r.doc_id, r.text is None) for r in pii.replace_entities(docs, b"key").collect()} == {(text, True), (None, False), ("b", False)}


def test_near_copies_keep_one(spark, docs, labels, tmp_path):
    got = simhash.without_near_duplicates(docs).collect()
    assert sum(r.doc_id == 5 for r in got) == 2  # the repeated row once, the other text once
    assert [r.doc_id for r in got if not (r.text or "").split()] == [2]


def test_sample_holds_each_text_once(spark):
    """An id with a third of all rows, and one with more texts than the sample holds."""
    rows = [(1, "one text again and again")] * 300 + [(2, f"text {i}") for i in range(300)] + [(10 + i, f"own {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)] + [(10 + i, i % 2) for i in range(20)], "doc_id long, quality int")
    every = labelled_once(docs, labels, "quality", 1000).collect()
    assert len(every) == len(set(every)) == 321 and sum(r.doc_id == 1 for r in every) == 1
    few = labelled_once(docs, labels, "quality", 100).collect()
    assert 60 < len(few) < 140 and {r.label for r in few} == {0, 1}
    assert sorted(few) == sorted(labelled_once(docs.repartition(3), labels, "quality", 100).collect())
