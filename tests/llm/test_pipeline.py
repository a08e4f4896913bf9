"""The stages against plain versions: SQL where the operator has it, brute force elsewhere."""

import duckdb
import pytest

import corpus_pipeline
from frameweir.llm import decontaminate, lines, mixing, toxicity
from frameweir.llm.common import remainder
from frameweir.session import stored
from pyspark.sql import functions as F
from tests.llm import brute


@pytest.fixture(scope="module")
def outputs(spark, folder):
    """The input of the pipeline and what each stage makes of its predecessor's rows."""
    tables = [spark.read.parquet(f"{folder}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(stored(stage(spark, tables[-1], folder)))
    return tables


def rows(table):
    return sorted((tuple(r) for r in table.collect()), key=repr)


def sql(query, docs, folder):
    db = duckdb.connect()
    documents = docs.toPandas()
    db.register("documents", documents)
    for name in ("labels", "benchmark"):
        db.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return db.execute(query).df().set_index("doc_id")


def test_toxic_documents_go(spark, folder, outputs):
    docs, kept = outputs[0], outputs[1]
    scorer = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"), remainder(F.col("doc_id"), 4) != 2)
    clean = {r.doc_id for r in toxicity.score_texts(docs, scorer).where("predicted = 0").collect()}
    assert rows(kept) == rows(docs.where(F.col("doc_id").isin(clean))) and 0 < len(clean) < docs.count()


def test_lines_go(folder, outputs):
    docs, kept = outputs[1], {r.doc_id: r for r in outputs[2].collect()}
    wanted = sql(lines.ORACLE, docs, folder)
    for r in docs.collect():
        text, n = wanted.text[r.doc_id], wanted.n_removed[r.doc_id]
        assert (r.doc_id in kept) == (n == 0 or bool(text.split()))
        if r.doc_id in kept:
            assert kept[r.doc_id].text == text and kept[r.doc_id].lang == r.lang
            assert kept[r.doc_id].n_chars == (len(text) if n else r.n_chars)


def test_one_of_each_group_stays(outputs):
    before = sorted(outputs[2].collect(), key=lambda r: r.doc_id)
    roots = brute.components([r.text for r in before])
    assert rows(outputs[3]) == sorted((tuple(r) for i, r in enumerate(before) if roots[i] == i), key=repr)


def test_contaminated_documents_go(folder, outputs):
    wanted = sql(decontaminate.ORACLE, outputs[3], folder)
    clean = [r for r in outputs[3].collect() if not wanted.contaminated[r.doc_id]]
    assert rows(outputs[4]) == sorted(map(tuple, clean), key=repr) and len(clean) < outputs[3].count()


def test_mixed(folder, outputs):
    db = duckdb.connect()
    documents, result = outputs[4].toPandas(), outputs[5].toPandas()
    db.register("documents", documents)
    ids = set(documents.doc_id)
    labels = duckdb.sql(f"select * from '{folder}/labels.parquet'").df()
    db.register("labels", labels[labels.doc_id.isin(ids)])
    wanted = db.execute(mixing.ORACLE).df()
    wanted = wanted[wanted.copies > 0].set_index("doc_id").sort_index()
    result = result.set_index("doc_id").sort_index()
    assert list(result.index) == list(wanted.index)
    assert (result.rate == wanted.rate).all() and (result.copies == wanted.copies).all()


def test_run_is_all_stages(spark, folder, outputs):
    assert rows(corpus_pipeline.run(spark, folder)) == rows(outputs[5])
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "SimHash near-dedup", "benchmark decontamination", "mixing",
    ]


def test_left_text_is_made_once_for_the_filter(spark):
    """Documents without a word left go, and the plan holds the text that is left once
    for the filter and for each column that comes from it."""
    rows = [(1, "a b c\nd e f"), (2, "a b c\n \t"), (3, "a b c\n x"), (4, ""), (5, " \n\x0b"), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = lines.without_repeated_lines(docs)
    assert sorted(left.collect()) == [(1, "a b c\nd e f"), (3, " x"), (4, ""), (5, " \n\x0b"), (6, None)]
    plan = left._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= plan.count("array_join(") <= 3
