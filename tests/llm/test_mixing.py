"""Mixing: totals against targets, rates against a plain solver."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from frameweir.llm import mixing

LARGER = "/root/testdata/sf0.01"


def test_totals_meet_the_targets(spark):
    docs, labels = (spark.read.parquet(f"{LARGER}/{x}.parquet") for x in ("documents", "labels"))
    targets = {"good": 0.8, "poor": 0.12, "toxic": 0.08}
    rows = mixing.mix(docs, labels, targets)
    sums = rows.agg(*[F.sum(F.col("n_tokens") * F.col("rate") * F.col("posterior")[k]) for k in range(3)]).first()
    share = np.array(sums) / sum(sums)
    assert share == pytest.approx([0.8, 0.12, 0.08], abs=0.01)
    own = rows.join(mixing.domain_of(labels), "doc_id").where("domain is not null").collect()
    right = np.mean([int(np.argmax(r.posterior)) == r.domain for r in own])
    assert right > 0.9
    # The domain that is kept is not thinned out.
    assert min(r.rate for r in own if r.domain == 0 and r.posterior[0] > 0.9) >= 1
    assert all(r.copies in (int(r.rate), int(r.rate) + 1) for r in own)


def test_rates_against_a_plain_solver(spark):
    rng = np.random.default_rng(4)
    p = rng.dirichlet([0.3] * 3, 12)
    tokens = rng.integers(100, 1000, 12).astype(float)
    cells = spark.createDataFrame([(float(t), x.tolist()) for t, x in zip(tokens, p)], "tokens double, posterior array<double>")
    steps = mixing.fit_rates(cells, mixing.TARGETS, "good", 1.0)
    rows = cells.select("tokens", "posterior", mixing.rate_after(steps, F.col("posterior")).alias("rate")).collect()
    start = tokens @ p
    share = np.array([mixing.TARGETS[x] for x in mixing.DOMAINS])
    wanted = start.sum() * max(1.0, start[0] / start.sum() / share[0]) * share
    rate = np.ones(12)
    for _ in range(mixing.ROUNDS):
        rate = np.clip(rate - p @ ((((rate * tokens) @ p) - wanted) / start), 0, mixing.MOST_RATE)
    got = {r.tokens: r.rate for r in rows}
    assert [got[t] for t in tokens] == pytest.approx(rate.tolist())
    assert min(rate) >= 0


def test_more_rounds_come_closer(spark, monkeypatch):
    cells = spark.createDataFrame([(100.0, [0.9, 0.1, 0.0]), (50.0, [0.2, 0.8, 0.0]), (10.0, [0.1, 0.1, 0.8])], "tokens double, posterior array<double>")

    def error(rounds):
        monkeypatch.setattr(mixing, "ROUNDS", rounds)
        steps = mixing.fit_rates(cells, {"good": 0.6, "poor": 0.3, "toxic": 0.1}, "good", 1.0)
        got = np.array(mixing.totals(cells, mixing.rate_after(steps, F.col("posterior"))))
        return np.abs(got / got.sum() - [0.6, 0.3, 0.1]).max()

    assert error(40) < 1e-3 and error(40) <= error(2)


def test_copies_follow_the_rate(spark):
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit(1.3).alias("rate"))
    got = rows.withColumn("copies", mixing.copies()).groupBy("copies").count().collect()
    count = {r.copies: r["count"] for r in got}
    assert set(count) == {1, 2} and abs(count[2] / 4000 - 0.3) < 0.03
