"""The queries of the operators, each over its whole tables, and SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from frameweir.llm import (
    decontaminate,
    lines,
    lm,
    middle,
    mixing,
    pii,
    quality,
    rules,
    secrets,
    simhash,
    spelling,
    subwords,
    toxicity,
)
from frameweir.llm.common import remainder, table


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents")).drop("confirmed")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("items", "spans")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return rules.judge(docs, rules.fit_forest(docs, table(spark, sf_dir, "labels")))


def op4_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(table(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 5) == 1)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, part = table(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 4)
    scores = toxicity.fitted_scores(docs, table(spark, sf_dir, "labels"), part != 2)
    return scores.withColumn("held_out", part == 2)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("posterior")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), length=3, max_bits=3)


def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A key of one's own goes into the session; the other one is for test tables.
    key = spark.conf.get("spark.frameweir.surrogateKey", "for test tables only").encode()
    return pii.replace_entities(table(spark, sf_dir, "documents"), key).drop("replaced")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, part = table(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 5)
    model = quality.fit(docs, table(spark, sf_dir, "labels"), part != 0)
    return quality.score_texts(docs, model).withColumn("held_out", part == 0)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


def op12_subwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = subwords.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    encoded = subwords.encode_texts(table(spark, sf_dir, "documents"), model)
    encoded = encoded.select("doc_id", "n_tokens", F.sha2("tokens", 256).alias("ids_sha256"), "tokens")
    decoded = subwords.decode_tokens(encoded, model)
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = middle.fill_in_middle(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


QUERIES = {
    "op1_secrets": op1_secrets,
    "op2_decontaminate": op2_decontaminate,
    "op3_quality_rules": op3_quality_rules,
    "op4_language_model": op4_language_model,
    "op5_toxicity": op5_toxicity,
    "op6_mixing": op6_mixing,
    "op7_line_dedup": op7_line_dedup,
    "op8_simhash": op8_simhash,
    "op9_surrogates": op9_surrogates,
    "op10_quality": op10_quality,
    "op11_spelling": op11_spelling,
    "op12_subwords": op12_subwords,
    "op13_fill_in_middle": op13_fill_in_middle,
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = {
    "op2_decontaminate": decontaminate.ORACLE,
    "op6_mixing": mixing.ORACLE,
    "op7_line_dedup": lines.ORACLE,
}
