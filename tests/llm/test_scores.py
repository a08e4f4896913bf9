"""Rules, language model, toxicity, quality: against brute force and held-out labels."""

import collections
import math
import random
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frameweir.llm import lm, quality, queries, rules, toxicity
from frameweir.llm.common import labelled_once, remainder
from tests.llm import brute

LARGER = "/root/testdata/sf0.01"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t\x0b#|é😀A", max_size=60), min_size=1, max_size=5))
def test_rule_counts(texts):
    found, features = rules.statistics(texts)
    for i, text in enumerate(texts):
        assert {k: int(v[i]) for k, v in found.items()} == brute.rule_counts(text)
    assert np.isfinite(features).all()


def test_rules_query(spark):
    rows = {r.doc_id: r for r in queries.op3_quality_rules(spark, LARGER).collect()}
    texts = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "text").collect()
    for r in texts:
        want, got = brute.rule_counts(r.text), rows[r.doc_id]
        assert want == {k: got[k] for k in want}
        failed = want["n_words"] < 10 or 100 * want["n_repeat_words"] > 20 * want["n_words"]
        assert got.base_failed == failed and not (failed and got.kept)
    labels = spark.read.parquet(f"{LARGER}/labels.parquet").collect()
    passed = [x for x in labels if not rows[x.doc_id].base_failed]
    kept = {q: [rows[x.doc_id].kept for x in passed if x.quality == q] for q in (0, 1)}
    assert np.mean(kept[1]) > 0.97 and np.mean(kept[0]) < 0.15


def test_forest_tells_outliers():
    rng = np.random.default_rng(0)
    rows = rng.normal(size=(500, 4))
    forest = rules.grow_forest(rows, 100, 256, 1)
    scores = forest.score(np.concatenate([rows, np.full((3, 4), 8.0)]))
    assert scores[500:].min() > np.quantile(scores[:500], 0.995)
    again = rules.grow_forest(rows, 100, 256, 1)
    assert (again.score(rows) == scores[:500]).all()


def test_limit_by_labels():
    scores, good = np.array([0.9, 0.8, 0.7, 0.7, 0.2]), np.array([False, False, True, False, True])
    limit = rules.calibrate(scores, good, 4.0)
    assert 0.7 < limit < 0.8
    assert rules.calibrate(scores, np.ones(5, bool), 4.0) == 1.0


@pytest.mark.parametrize("block_bytes", [2_000, 1 << 20])
def test_language_model(spark, folder, block_bytes):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = {r.doc_id: r for r in lm.score_texts(docs, remainder(F.col("doc_id"), 5) == 1, block_bytes).collect()}
    texts = [(r.doc_id, brute.words(brute.lower(r.text)) + [None]) for r in docs.collect()]
    counts = collections.Counter()
    for doc_id, tokens in texts:
        if zlib.crc32(str(doc_id).encode()) % 5 != 1:
            counts.update(tokens)
    total, types = sum(counts.values()), len(counts)
    for doc_id, tokens in texts:
        r = rows[doc_id]
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (types + 1))) for t in tokens)
        assert r.base_score == pytest.approx(base)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(t in counts for t in tokens), total)
    held = [r for r in rows.values() if r.held_out]
    # On texts it has not seen the mixture is better than the smoothed unigrams.
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_bigram_counts(spark):
    """The model's score from plain counts, with the weights fixed."""
    rows = [(i, f"a b c a b {'d' if i % 2 else 'e'}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    weights = np.tile([0.2, 0.3, 0.5], (lm.BUCKETS, 1))
    real, lm.learn_weights = lm.learn_weights, lambda *_: weights
    try:
        got = {r.doc_id: r.score for r in lm.score_texts(docs, F.lit(False), 200).collect()}
    finally:
        lm.learn_weights = real
    one, two = collections.Counter(), collections.Counter()
    for _, text in rows:
        tokens = [*text.split(), "</s>"]
        one.update(tokens)
        two.update(zip(["</s>", *tokens], tokens))
    for i, text in rows:
        tokens = [*text.split(), "</s>"]
        want = sum(
            math.log10(0.2 / (len(one) + 1) + 0.3 * one[w] / sum(one.values()) + 0.5 * two[h, w] / one[h])
            for h, w in zip(["</s>", *tokens], tokens)
        )
        assert got[i] == pytest.approx(want)


def test_em_finds_the_mixture():
    rng = np.random.default_rng(1)
    true, rows = [0.1, 0.3, 0.6], collections.Counter()
    one, two = 2.0 ** -rng.integers(2, 12, 20000), 2.0 ** -rng.integers(0, 6, 20000)
    source = rng.choice(3, 20000, p=true)
    # an event of a component that could not have made it has probability zero there
    one, two = np.where(source == 2, one / 64, one), np.where(source == 1, 0.0, two)
    for a, b in zip(lm._bin(one), lm._bin(np.where(source == 0, 0.0, two))):
        rows[(3, int(a), int(b))] += 1
    weights = lm.learn_weights([(*k, n) for k, n in rows.items()], 1e-6)
    assert weights[3].sum() == pytest.approx(1) and weights[3, 2] > 0.5
    assert (weights[4] == [0.1, 0.5, 0.4]).all()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=50), st.booleans())
def test_packed_arrays(values, is_sorted):
    values = np.array(sorted(values) if is_sorted else values, np.uint64)
    assert (lm.unpack(lm.pack(values, is_sorted), np.uint64, is_sorted) == values).all()


@pytest.fixture(scope="module")
def letters():
    words = "the idiot stupid worthless clown moron hello there man you are and other words of text".split()
    grams = collections.Counter()
    for word in words:
        padded = f"  {word} "
        for i in range(len(word) + 1):
            grams[padded[i : i + 3]] += 10
    return toxicity.Letters(grams)


@pytest.mark.parametrize(
    "written, meant",
    [
        ("id1ot", "idiot"),
        ("1d10t", "idiot"),
        ("stuuuupid", "stupid"),
        ("st*pid", "stupid"),
        ("i-d-i-o-t", "idiot"),
        ("w0rthle$s", "worthless"),
        ("m0r0n!", "moron"),
        ("cl.own***", "clown"),
        ("hello", "hello"),
        ("(hello),", "hello"),
        ("2024", "2024"),
        ("!!!", ""),
    ],
)
def test_restored_words(letters, written, meant):
    assert toxicity.restore(written, letters) == meant


def test_restored_spacing(letters):
    known = {"idiot": 0, "clown": 1}
    assert toxicity.features_of("you i d i o t there", letters, known, {}) == {0}
    assert toxicity.features_of("a C L 0 W N", letters, known, {}) == {1}


def test_tokens_without_features_need_no_decoding(vocabulary):
    """With the tree of features the same are found as without."""
    draw = random.Random(4)
    known = {x: k for k, x in enumerate(["idiot", "idi…", "stup…", "clown", "scum", "cum", "mor…", "moron"])}
    tree = toxicity.Beginnings(known)
    words = "idiot stupid moron clown scum shit cum hello there idiots stupidity".split()
    signs = {"i": "1!|", "o": "0", "s": "$5", "t": "7+", "e": "3", "u": "*", "c": "(", "l": "1|"}

    def spoiled(word):
        out = "".join(draw.choice([c, c, c * 2, draw.choice(signs.get(c, c)), c + draw.choice(".-_")]) for c in word)
        return draw.choice(["", "(", "$", "!!"]) + out + draw.choice(["", ",", "!", "$$", "..."])

    for _ in range(1500):
        text = " ".join(spoiled(draw.choice(words)) for _ in range(3))
        plain = toxicity.features_of(text, vocabulary, known, {})
        assert toxicity.features_of(text, vocabulary, known, toxicity.Memory(), tree) == plain, text


@pytest.fixture(scope="module")
def vocabulary(letters):
    words = "idiot stupid moron clown scum shit cum hello there you are so it is the man".split()
    grams = collections.Counter()
    for word in words:
        padded = f"  {word} "
        for i in range(len(word) + 1):
            grams[padded[i : i + 3]] += 10
    return toxicity.Letters(grams, dict.fromkeys(words, 100))


@pytest.mark.parametrize(
    "written, meant",
    [
        ("stuupid", "stupid"),
        ("iidiioot", "idiot"),
        ("mooroon", "moron"),
        ("$$tupid", "stupid"),
        ("$$cum", "scum"),
        ("(lown", "clown"),
        ("$#1+", "shit"),
        ("hello!", "hello"),
        ("(hello)", "hello"),
        ("$100", "$100"),
        ("50", "50"),
    ],
)
def test_disguises_reach_the_decoder(vocabulary, written, meant):
    assert toxicity.restore(written, vocabulary) == meant


@pytest.mark.parametrize("text", ["you i  d  i  o  t there", "i\td\ti\to\tt", "so i\nd\ni\no\nt", "you id iot", "an id iot, there", "1d iot", "idio t"])
def test_split_words(vocabulary, text):
    assert 0 in toxicity.features_of(text, vocabulary, {"idiot": 0}, {})
    assert toxicity.features_of("so it is the man", vocabulary, {"idiot": 0}, {}) == set()


def test_scoring_remembers_words(vocabulary, monkeypatch):
    """Rare words of many texts are looked at once, not once per text."""
    scorer = toxicity.Scorer(vocabulary, [("idiot", 0.9)], np.zeros(5))
    asked, may_have = [], scorer.tree.may_have
    monkeypatch.setattr(scorer.tree, "may_have", lambda token: asked.append(token) or may_have(token))
    texts = [" ".join(f"w{k}0rd" for k in range(start, start + 1000)) + " 1d10t" for start in range(0, 100_000, 1000)]
    docs = pa.RecordBatch.from_pydict({"doc_id": [*range(200)], "text": [*texts, *texts]})

    class Docs:
        schema = {"doc_id": T.StructField("doc_id", T.LongType())}
        select = staticmethod(lambda *names: Docs)
        mapInArrow = staticmethod(lambda measure, schema: measure)

    scores = [x for batch in toxicity.score_texts(Docs, scorer)(iter([docs])) for x in batch["score"].to_pylist()]
    assert len(scores) == 200 and len(asked) == len(set(asked)) == 100_001


def test_viterbi_is_the_best_path(letters):
    """Against all readings of a short lattice."""

    def score(options, text):
        best = {}
        for i in range(len(text)):
            best = {
                (state + (c,), value + cost) for state, value in (best or {((), 0.0)}) for c, cost in toxicity._options(text, i)
            }
        totals = {}
        for chars, cost in best:
            out, state = "".join(chars), "  "
            for c in out:
                cost += letters.log(state, c)
                state = "  " if c == " " else state[1] + c
            totals[out] = max(totals.get(out, -1e9), cost + letters.log(state, " "))
        return max(totals.values()), totals

    for text in ("1d10t", "cl0wnn", "m*r0n", "st-up"):
        top, totals = score(None, text)
        assert totals[toxicity.decode(text, letters)] == pytest.approx(top)


def test_limit_over_all_rows(spark):
    """The limit found in slices is the one found in one place."""
    rng = np.random.default_rng(3)
    for n, digits, cost in ((400, 1, 2.0), (3000, 2, 0.5), (500, 9, 2.0)):
        scores = np.round(rng.random(n), digits)
        good = rng.random(n) > scores
        table = spark.createDataFrame(list(zip(scores.tolist(), good.tolist(), strict=True)), "score double, good boolean")
        assert rules.calibrate_all(table, cost) == pytest.approx(rules.calibrate(scores, good, cost), abs=1e-12)
        assert rules.calibrate_all(table.where("good"), cost) == rules.calibrate_all(table.limit(0), cost) == 1.0


def test_all_labels_are_learned_from(spark):
    """More labelled rows than any sample held, and repeats of a few."""
    docs = spark.range(25_000).selectExpr("id as doc_id", "concat('text ', id) as text")
    labels = spark.range(25_000).selectExpr("id as doc_id", "cast(id % 2 as int) as quality")
    every = labelled_once(docs.unionAll(docs.where("doc_id < 9")), labels, "quality")
    assert every.count() == every.distinct().count() == 25_000
    rows = rules.labelled_features(every)
    assert len(rules.to_grow_on(rows, 100)) == 100 and len(rules.to_grow_on(rows, 30_000)) == 25_000
    forest = rules.grow_forest(np.arange(40.0)[:, None] // 10, 4, 10, 1)  # each tree has rows of its own, all alike
    assert (forest.feature[:, 0] == -1).all()


def test_weights_fitted_in_spark(spark):
    """The regression in Spark tells the same texts apart as that of the driver."""
    plain = [(i, f"some words here {w} and more {i}", 1) for i, w in enumerate(["idiot", "moron", "clown"] * 30)]
    clean = [(100 + i, f"some words there and {w} of them {i}", 0) for i, w in enumerate(["house", "river", "garden"] * 60)]
    docs = spark.createDataFrame([x[:2] for x in plain + clean], "doc_id long, text string")
    labels = spark.createDataFrame([(x[0], x[2]) for x in plain + clean], "doc_id long, toxic int")
    near, spread = (toxicity.fit(docs, labels, driver_rows=n) for n in (8000, 0))
    assert near.known == spread.known and len(near.weights) == len(spread.weights)
    want, got = ({r.doc_id: r.predicted for r in toxicity.score_texts(docs, x).collect()} for x in (near, spread))
    assert got == want == {x[0]: x[2] for x in plain + clean}


def test_features_are_counted_by_text():
    """Against sets of words and beginnings of each text."""
    texts = [{"abcd", "abce", "ab", "a", "ab\0", "ab\0c", "ab\0\0"}, set(), {"abcd", "abcdefghij", "abcdefghik", "abc…"}, {"abcd"}, {"💥💥💥x", "💥💥💥"}]
    toxic = [True, True, False, False, True]
    index = {w: i for i, w in enumerate({w for x in texts for w in x})}
    words = array("q", [index[w] for x in texts for w in x])
    batches = toxicity.feature_counts(index, words, [len(x) for x in texts], toxic)
    got = {}
    for row in (row for batch in batches for row in batch.to_pylist()):
        old = got.get(row["feature"], (0, 0))
        got[row["feature"]] = old[0] + row["clean"], old[1] + row["toxic"]
    own = [[w for w in x if len(w) > 1] + [*{w[:n] + "…" for w in x for n in range(3, 9) if len(w) >= n}] for x in texts]
    kinds = [(k, x) for k, found in zip(toxic, own, strict=True) for x in found]
    assert got == {x: (kinds.count((False, x)), kinds.count((True, x))) for _, x in kinds}
    assert sum(x.num_rows for x in toxicity.feature_counts({}, array("q"), [], [])) == 0


def test_features_are_found_once(spark, monkeypatch):
    """Weights and scores come from one pass, with the scores of `fit` and `score_texts`,
    also where ids and rows repeat, or ids, texts and labels are null."""
    words = ["idiot", "moron", "clown", "house", "river", "garden"]
    rows = [(i, f"some words here {words[i % 6]} and more {i % 13}") for i in range(120)]
    rows += [(3, rows[3][1]), (3, "another text idiot"), (None, "a moron"), (7, None), (7, ""), (500, "m0ron"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = [(i, int(i % 6 < 3)) for i in range(100)] + [(3, 1), (None, 1), (110, None)]
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    want = toxicity.score_texts(docs, toxicity.fit(docs, labels, F.col("doc_id") % 7 != 2))
    passes, found_in = [], toxicity.Scorer.found_in
    monkeypatch.setattr(toxicity.Scorer, "found_in", lambda self, rows: passes.append(rows.count()) or found_in(self, rows))
    got = toxicity.fitted_scores(docs, labels, F.col("doc_id") % 7 != 2)
    order = lambda r: (str(r.doc_id), r.score)
    want, got = (sorted(x.collect(), key=order) for x in (want, got))
    assert [(r.doc_id, r.predicted) for r in got] == [(r.doc_id, r.predicted) for r in want] and passes == [len(rows)]
    assert [r.score for r in got] == pytest.approx([r.score for r in want], abs=1e-9)
    assert len({r.predicted for r in got}) == 2
    one = toxicity.fitted_scores(docs, labels.where("toxic = 0"))  # nothing to tell apart
    assert {(r.score, r.predicted) for r in one.collect()} == {(0.0, 0)}


def test_toxic_words_in_disguise(spark):
    plain = [(i, f"some words here {w} and more of them", 1) for i, w in enumerate(["idiot", "moron", "clown"] * 30)]
    clean = [(100 + i, f"some words there and {w} of them, no harm", 0) for i, w in enumerate(["house", "river", "garden"] * 60)]
    docs = spark.createDataFrame([x[:2] for x in plain + clean], "doc_id long, text string")
    labels = spark.createDataFrame([(x[0], x[2]) for x in plain + clean], "doc_id long, toxic int")
    scorer = toxicity.fit(docs, labels)
    asked = [(1, "well, 1d10t it is"), (2, "you m o r o n there"), (3, "cloooown words"), (4, "a river and a house"), (5, None)]
    got = {r.doc_id: r.predicted for r in toxicity.score_texts(spark.createDataFrame(asked, "doc_id long, text string"), scorer).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 0, 5: 0}
    kept = toxicity.without_toxic(spark.createDataFrame(asked, "doc_id long, text string"), scorer)
    assert sorted(r.doc_id for r in kept.collect()) == [4, 5]


def test_balanced_and_missing_labels(spark):
    plain = [(i, f"some words here {w} and more of them", 1) for i, w in enumerate(["idiot", "moron", "clown"] * 30)]
    clean = [(100 + i, f"some words here {w} and more of them", 0) for i, w in enumerate(["house", "river", "garden"] * 30)]
    docs = spark.createDataFrame([x[:2] for x in plain + clean], "doc_id long, text string")
    labels = spark.createDataFrame([(x[0], x[2]) for x in plain + clean], "doc_id long, toxic int")
    scorer = toxicity.fit(docs, labels)
    kept = {r.doc_id for r in toxicity.without_toxic(docs, scorer).collect()}
    assert kept == {x[0] for x in clean}
    same = spark.createDataFrame([(x[0], "one text for all") for x in plain + clean], "doc_id long, text string")
    for texts, few in ((docs, labels.limit(0)), (docs, labels.where("toxic = 1")), (docs, labels.where("toxic = 0")), (same, labels)):
        scorer = toxicity.fit(texts, few)
        assert toxicity.without_toxic(texts, scorer).count() == len(plain + clean)
        assert toxicity.score_texts(texts, scorer).where("predicted = 1").count() == 0


@pytest.mark.parametrize(
    "query, label, part, least", [("op5_toxicity", "toxic", (4, 2), 0.85), ("op10_quality", "quality", (5, 0), 0.95)]
)
def test_held_out_labels(spark, query, label, part, least):
    rows = queries.QUERIES[query](spark, LARGER)
    labels = spark.read.parquet(f"{LARGER}/labels.parquet").select("doc_id", label)
    held = rows.join(labels, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % part[0] == part[1] for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in held)
    assert np.mean([r.predicted == r[label] for r in held]) >= least


def test_attention_learns_from_one_passage():
    """Documents are bad because of one passage among many good ones."""
    rng = np.random.default_rng(2)
    x, text, label = [], [], []
    for i in range(300):
        size = int(rng.integers(1, 9))
        rows = rng.normal(0, 0.1, (size, quality.FEATURES))
        bad = i % 2
        if bad:
            rows[rng.integers(size), 0] += 3
        x.append(rows)
        text += [i] * size
        label.append(1.0 - bad)
    x, text, label = np.concatenate(x), np.array(text), np.array(label)
    model = quality.train(x, text, label, 8, 40, 0.02, 1)
    found = model.forward(x, text, 300)
    assert np.mean((found["y"] > 0.5) == (label > 0.5)) > 0.97
    marked = np.flatnonzero(x[:, 0] > 2)
    size = np.bincount(text)[text[marked]]
    assert np.mean(found["a"][marked] > 1 / size - 1e-9) > 0.9
    np.testing.assert_allclose(np.bincount(text, found["a"]), 1)


def test_gradients():
    """The slopes of the training step against differences."""
    rng = np.random.default_rng(3)
    x, text, label = rng.normal(size=(12, quality.FEATURES)), np.repeat([0, 1, 2], 4), np.array([1.0, 0.0, 1.0])
    model = quality.train(x, text, label, 4, 60, 0.05, 2)
    y = model.forward(x, text, 3)["y"]
    assert (np.abs(y - label) < 0.2).all()


def test_plain_words_need_no_lattice(letters, monkeypatch):
    """Doubled letters of plain words are judged one by one, with the result of the search
    over all readings; words with near doubles go through the lattice."""
    draw = random.Random(7)
    words = ["".join(draw.choice("idotheclw") for _ in range(draw.randrange(1, 10))) for _ in range(3000)] + ["hello", "idiiot", "thhere"]
    asked, lattice, once = [], toxicity._lattice, toxicity._once
    monkeypatch.setattr(toxicity, "_lattice", lambda text: asked.append(text) or lattice(text))
    quick = [toxicity.decode(x, letters) for x in words]
    assert "thhere" not in asked and len(asked) < 600
    monkeypatch.setattr(toxicity, "_once", lambda text, model: None)
    assert quick == [toxicity.decode(x, letters) for x in words]
    assert once("thherre", letters) == toxicity.decode("thherre", letters)
    assert once("hellloo", letters) is None and once("eell", letters) is None


def test_words_forgotten_are_found_again(vocabulary):
    """A small memory gives the words that a large one gives, with a tree and without."""
    draw = random.Random(9)
    known = {"idiot": 0, "idi…": 1, "stupid": 2}
    tree = toxicity.Beginnings(known)
    pool = ["id", "iot", "io", "t", "1d", "stuupid", "so", "it", "there,", "st-upid", *(f"w{k}" for k in range(40))]
    texts = [" ".join(draw.choice(pool) for _ in range(12)) for _ in range(400)]
    for way in (None, tree):
        small, large = toxicity.Memory(5), toxicity.Memory()
        found = [toxicity.words_of(x, vocabulary, large, way) for x in texts]
        assert any("idiot" in x for x in found)
        assert found == [toxicity.words_of(x, vocabulary, small, way) for x in texts]


def test_feature_counts_are_of_documents(spark, vocabulary, monkeypatch):
    """Counts of features: documents, not occurrences, in any number of pieces."""
    texts = [("idiot idiot hello", 1), ("IDIOT, there", 1), ("hello there", 0), ("hello there you", 0), ("so it is", 0)] * 3
    sample = spark.createDataFrame(texts, "text string, label int")
    found = dict(toxicity.choose_features(sample, vocabulary, 50))
    share = 6 / 15
    assert found["idiot"] == found["idi…"] == pytest.approx((6 + 5 * share) / 11) and "hello" not in found
