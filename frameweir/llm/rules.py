"""Quality rules: rule statistics of each document, judged by an isolation forest."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frameweir.llm.common import id_and, labelled_once, pieces, texts_of
from frameweir.llm.words import Words
from frameweir.session import stored

WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20  # per cent of the words

_KIND = np.zeros(256, np.int8)  # 1 symbol, 2 upper case, 3 lower case, 4 call or question mark
_KIND[list(b"#*$%&|<>")] = 1
_KIND[ord("A") : ord("Z") + 1] = 2
_KIND[ord("a") : ord("z") + 1] = 3
_KIND[list(b"!?")] = 4

# Shares, so that the length of a text doesn't count. Digits and punctuation are
# left out, as they vary in short clean texts as much as in junk, and repeated
# words, as the base rules judge them.
FEATURES = [
    "symbols per word",
    "symbol words",
    "repeated lines",
    "capitals",
    "calls per word",
    "one-character words",
]


def statistics(texts: list[str]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The counts of each text, and the features the forest looks at (one row each).

    A text without words has zeros throughout.
    """
    raw = [x.encode() for x in texts]
    words = Words(raw)
    kind = _KIND[words.raw]
    points = (words.raw & 0xC0) != 0x80
    counts = {k: words.per_text(kind == i) for i, k in enumerate(("symbol", "upper", "lower", "call"), 1)}
    n_words = np.diff(words.first)
    word_chars = words.per_text(points & ~words.blank)
    repeated = words.per_text_words(words.repeated(WINDOW))
    lines, dup = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for i, text in enumerate(raw):
        own = [x for x in text.split(b"\n") if x and not x.isspace()]  # bytes: isspace means the six blanks
        lines[i], dup[i] = len(own), len(own) - len(set(own))
    symbol_sums = np.concatenate([[0], np.cumsum(kind == 1)])
    odd = words.per_text_words(symbol_sums[words.ends] > symbol_sums[words.starts])
    point_sums = np.concatenate([[0], np.cumsum(points)])
    single = words.per_text_words(point_sums[words.ends] - point_sums[words.starts] == 1)

    def per(value, total):
        return value / np.maximum(total, 1)

    features = np.stack(
        [
            per(counts["symbol"], n_words),
            per(odd, n_words),
            per(dup, lines + 4),  # two equal lines of a few are no sign yet
            per(counts["upper"], counts["upper"] + counts["lower"]),
            per(counts["call"], n_words),
            per(single, n_words),
        ],
        axis=1,
    )
    found = {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": counts["symbol"],
        "n_dup_lines": dup,
        "n_repeat_words": repeated,
    }
    return {k: v.astype(np.int64) for k, v in found.items()}, features


def base_failed(found: dict[str, np.ndarray]) -> np.ndarray:
    n_words = found["n_words"]
    return (n_words < LEAST_WORDS) | (100 * found["n_repeat_words"] > MOST_REPEATED * n_words)


# ---- isolation forest ---------------------------------------------------------------


def _usual_depth(n: np.ndarray) -> np.ndarray:
    """Mean path length of a search that fails in a random tree of n rows."""
    n = np.asarray(n, float)
    safe = np.maximum(n, 2)
    mean = 2 * (np.log(safe - 1) + 0.5772156649015329) - 2 * (safe - 1) / safe
    return np.where(n > 2, mean, np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Random trees as arrays (tree, node): the feature split on (-1: leaf), the
    value, the left child (the right one follows it), the depth of a leaf."""

    feature: np.ndarray
    value: np.ndarray
    child: np.ndarray
    depth: np.ndarray
    sample: int
    limit: float = 1.0  # scores above it are anomalous

    def score(self, rows: np.ndarray) -> np.ndarray:
        """2 ** -(mean path / usual path): near 1 for rows isolated after few splits."""
        total = np.zeros(len(rows))
        at_row = np.arange(len(rows))
        for feature, value, child, depth in zip(self.feature, self.value, self.child, self.depth, strict=True):
            node = np.zeros(len(rows), np.int64)
            while True:
                split = feature[node]
                if (split < 0).all():
                    break
                down = child[node] + (rows[at_row, split] > value[node])
                node = np.where(split < 0, node, down)
            total += depth[node]
        return 2.0 ** (-total / len(self.feature) / _usual_depth(self.sample))


def grow_forest(rows: np.ndarray, trees: int, sample: int, seed: int) -> Forest:
    """Each tree splits a sample of the rows at random features and values until
    rows stand alone or the usual depth is reached twice over. Where the rows do for
    all trees, each tree has rows of its own."""
    rng = np.random.default_rng(seed)
    sample = max(2, min(sample, len(rows)))
    deepest = 2 * int(np.ceil(np.log2(sample)))
    made = []
    apart = len(rows) >= trees * sample
    for k in range(trees):
        drawn = np.arange(k * sample, (k + 1) * sample) if apart else rng.choice(len(rows), sample, replace=False)
        feature, value, child, depth = [], [], [], []

        def add(feature=feature, value=value, child=child, depth=depth) -> int:
            for x in (feature, value, child, depth):
                x.append(-1 if x is feature else 0)
            return len(feature) - 1

        todo = [(add(), rows[drawn], 0)]
        while todo:
            node, own, level = todo.pop()
            varied = np.flatnonzero(np.ptp(own, axis=0) > 0)
            if level >= deepest or len(own) <= 1 or not len(varied):
                depth[node] = level + float(_usual_depth(len(own)))
                continue
            split = int(rng.choice(varied))
            cut = rng.uniform(own[:, split].min(), own[:, split].max())
            feature[node], value[node] = split, cut
            left, right = add(), add()
            child[node] = left
            high = own[:, split] > cut
            todo += [(left, own[~high], level + 1), (right, own[high], level + 1)]
        made.append((feature, value, child, depth))
    size = max(len(x[0]) for x in made)

    def stack(i, fill, kind):
        return np.array([x[i] + [fill] * (size - len(x[i])) for x in made], kind)

    return Forest(stack(0, -1, np.int64), stack(1, 0.0, float), stack(2, 0, np.int64), stack(3, 0.0, float), sample)


def calibrate(scores: np.ndarray, good: np.ndarray, cost: float) -> float:
    """The limit that lets the fewest errors through, one good row above it
    counting as `cost` bad rows below it. Without bad rows nothing is anomalous."""
    if good.all() or not good.any():
        return 1.0  # also without rows
    order = np.argsort(-scores, kind="stable")
    lost = np.cumsum(good[order]) * cost
    kept = (~good).sum() - np.cumsum(~good[order])
    total = np.concatenate([[(~good).sum()], lost + kept])
    edge = scores[order]
    last = np.concatenate([[True], edge[:-1] != edge[1:], [True]])  # ties stay on one side
    total = np.where(last, total, np.inf)
    best = int(np.argmin(total))
    if best == 0:
        return 1.0
    return float(edge[best - 1] + edge[best]) / 2 if best < len(edge) else float(edge[-1]) / 2


# ---- the operator -------------------------------------------------------------------

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, anomaly double"
)


def labelled_features(sample: DataFrame) -> DataFrame:
    """(label, features, failed, draw): features and base verdicts of labelled rows (a
    few numbers each), and a number by which rows are drawn."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found, features = statistics(texts_of(batch))
            lists = pa.array(list(features), pa.list_(pa.float64()))
            columns = {"label": batch["label"], "draw": batch["draw"], "features": lists, "failed": pa.array(base_failed(found))}
            yield pa.RecordBatch.from_pydict(columns)

    rows = sample.select("label", "text", F.xxhash64(F.lit(23), "doc_id", "text").alias("draw"))
    return rows.mapInArrow(measure, "label int, draw long, features array<double>, failed boolean")


def to_grow_on(rows: DataFrame, most: int) -> np.ndarray:
    """The features of all rows, or of the `most` that are drawn first, in the same
    order on every run. They are what reaches the driver."""
    drawn = rows.orderBy("draw", "features").limit(most + 1).select("features", "label", "failed").toArrow().to_pydict()
    features = np.array(drawn["features"], float).reshape(-1, len(FEATURES))
    if len(features) > most:
        return features[:most]
    return features[np.lexsort((*features.T, np.array(drawn["label"], np.int64), np.array(drawn["failed"], bool)))]


def calibrate_all(scored: DataFrame, cost: float) -> float:
    """`calibrate` over all rows of (score, good). The distinct scores are range-sorted
    into slices; sums run inside a slice, on top of those of the slices before."""
    each = scored.groupBy("score").agg(F.sum(F.col("good").cast("long")).alias("good"), F.sum((~F.col("good")).cast("long")).alias("bad"))
    each = stored(each.repartitionByRange(F.desc("score")).withColumn("slice", F.spark_partition_id()), "scores")
    slices = sorted(each.groupBy("slice").agg(F.sum("good"), F.sum("bad")).collect())
    good, bad = (sum(x[k] for x in slices) for k in (1, 2))
    if not good or not bad:
        return 1.0
    before = [(x[0], sum(y[1] for y in slices[:i]), sum(y[2] for y in slices[:i])) for i, x in enumerate(slices)]
    before = each.sparkSession.createDataFrame(before, "slice int, good_before long, bad_before long")
    down = Window.partitionBy("slice").orderBy(F.desc("score"))
    errors = (F.sum("good").over(down) + F.col("good_before")) * F.lit(cost) + bad - (F.sum("bad").over(down) + F.col("bad_before"))
    found = each.join(F.broadcast(before), "slice").select(errors.alias("errors"), (-F.col("score")).alias("edge"))
    best = found.agg(F.min(F.struct("errors", "edge")).alias("best")).first().best  # of equal ones the highest score
    if best.errors >= bad:
        return 1.0
    edge = -best.edge
    under = each.where(F.col("score") < edge).agg(F.max("score")).first()[0]
    return edge / 2 if under is None else (edge + under) / 2


def fit_forest(
    docs: DataFrame,
    labels: DataFrame,
    use: Column | None = None,
    trees: int = 100,
    sample: int = 256,
    cost: float = 2.0,
    seed: int = 11,
) -> Forest | None:
    """A forest over all labelled documents: the features of each are taken.

    A tree of an isolation forest grows on few rows by its nature: here on `sample`
    rows drawn from all, good and bad alike, other ones for each tree where there
    are enough. The labels only calibrate the limit, on all rows that pass the base
    rules. Fewer than two rows: None.
    """
    rows = stored(labelled_features(labelled_once(docs, labels, "quality", use=use)), "features")
    drawn = to_grow_on(rows, trees * sample)
    if len(drawn) < 2:
        return None
    forest = grow_forest(drawn, trees, sample, seed)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features = np.array(batch["features"].to_pylist(), float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_pydict({"score": pa.array(forest.score(features)), "good": batch["good"]})

    passed = rows.where("not failed").select("features", (F.col("label") == 1).alias("good"))
    forest.limit = calibrate_all(passed.mapInArrow(measure, "score double, good boolean"), cost)
    return forest


def judge(docs: DataFrame, forest: Forest | None) -> DataFrame:
    """One row per row of `docs` (doc_id, text; other columns are not read).

    The base rules fail a text of fewer than ten words, or with over a fifth of
    its words in repeated five-word windows. `anomaly` is the forest's score,
    null without a forest; `kept` is false if the base rules fail or the score
    is above the forest's limit. A null text has no words; null ids and repeated
    rows are kept as they are; an empty table gives an empty result.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found, features = statistics(texts_of(batch))
            failed = base_failed(found)
            scores = forest.score(features) if forest else np.full(len(failed), np.nan)
            odd = scores > forest.limit if forest else np.zeros(len(failed), bool)
            kept = ~failed & ~odd
            columns = {**found, "base_failed": failed, "kept": kept}
            anomaly = pa.array(scores, mask=np.isnan(scores))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *map(pa.array, columns.values()), anomaly], names=["doc_id", *columns, "anomaly"]
            )

    return docs.select("doc_id", "text").mapInArrow(measure, id_and(docs, SCHEMA))
