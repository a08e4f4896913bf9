"""Quality: attention over the passages of a document, learned from document labels."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from frameweir.llm.common import id_and, labelled_once, pieces, texts_of
from frameweir.llm.words import Words

PASSAGE = 48  # words; the last passage of a text may be shorter

_KIND = np.zeros(256, np.int8)
for _kind, _signs in enumerate([b"#*$%&<>@^~=+", b"|\t", b".,;:", b"!?", b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"], 1):
    _KIND[list(_signs)] = _kind
_KIND[ord("a") : ord("z") + 1] = 7

FEATURES = 14


def passages(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of each passage, and the number of its text. A text without words
    is one passage of zeros."""
    words = Words([x.encode() for x in texts])
    count = np.diff(words.first)
    own = np.maximum(1, -(-count // PASSAGE))
    first = np.concatenate([[0], np.cumsum(own)])
    place = np.arange(len(words.text)) - words.first[words.text]
    passage = first[words.text] + place // PASSAGE
    total = int(first[-1])
    n = np.bincount(passage, minlength=total).astype(float)

    def per_word(values):
        return np.bincount(passage, values, minlength=total)

    kind = _KIND[words.raw]

    def in_words(values):
        sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return sums[words.ends] - sums[words.starts]

    points = in_words((words.raw & 0xC0) != 0x80)
    signs, bars, stops, calls, digits, upper, lower = (in_words(kind == k) for k in range(1, 8))
    hashes = words.hashes()
    again = np.zeros(len(hashes))
    again[1:] = (hashes[1:] == hashes[:-1]) & (passage[1:] == passage[:-1])
    order = np.lexsort((hashes, passage))
    same = (hashes[order][1:] == hashes[order][:-1]) & (passage[order][1:] == passage[order][:-1])
    seen = np.zeros(len(hashes))
    seen[order[1:]] = same
    least, chars = np.maximum(n, 1), np.maximum(per_word(points), 1)
    features = np.stack(
        [
            per_word(signs) / least,
            per_word(signs > 0) / least,
            per_word(bars) / least,
            per_word(stops) / least,
            per_word(calls) / least,
            per_word(calls > 0) / least,
            per_word(digits) / chars,
            per_word(upper) / np.maximum(per_word(upper + lower), 1),
            per_word((upper > 1) & (lower == 0)) / least,
            per_word(points) / least / 8,
            per_word(points == 1) / least,
            per_word(words.repeated(5)) / least,
            per_word(seen) / least,
            per_word(again) / least,
        ],
        axis=1,
    )
    return features, np.repeat(np.arange(len(texts)), own)


def _softmax(value: np.ndarray, text: np.ndarray, size: int) -> np.ndarray:
    top = np.full(size, -np.inf)
    np.maximum.at(top, text, value)
    raised = np.exp(value - top[text])
    return raised / np.bincount(text, raised, minlength=size)[text]


@dataclass
class Attention:
    """Encoder h = tanh(x W + b); gated attention over the passages of a text,
    a = softmax(w . (tanh(h V) * sigmoid(h U))); score = sigmoid(c . sum(a h) + d)."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, text: np.ndarray, size: int) -> dict[str, np.ndarray]:
        p = self.weights
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        a = _softmax((t * g) @ p["w"], text, size)
        z = np.zeros((size, h.shape[1]))
        np.add.at(z, text, a[:, None] * h)
        y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "y": y}

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores, and for each text the place of the passage with most attention."""
        x, text = passages(texts)
        found = self.forward(x, text, len(texts))
        order = np.lexsort((np.arange(len(text)), -found["a"], text))
        first = np.searchsorted(text, np.arange(len(texts)))
        return found["y"], order[first] - first


def train(x: np.ndarray, text: np.ndarray, label: np.ndarray, width: int, epochs: int, rate: float, seed: int) -> Attention:
    """Adam on the cross entropy of the document labels, in batches of documents."""
    rng = np.random.default_rng(seed)
    k = x.shape[1]

    def draw(*shape):
        return rng.normal(0, shape[0] ** -0.5, shape)

    p = {"W": draw(k, width), "b": np.zeros(width), "V": draw(width, width), "U": draw(width, width)}
    p |= {"w": draw(width), "c": draw(width), "d": np.zeros(1)}
    model = Attention(x.mean(0), x.std(0) + 1e-3, p)
    first = np.searchsorted(text, np.arange(len(label) + 1))
    moment = {n: [np.zeros_like(v), np.zeros_like(v)] for n, v in p.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(label))
        for start in range(0, len(order), 64):
            docs = np.sort(order[start : start + 64])
            rows = np.concatenate([np.arange(first[i], first[i + 1]) for i in docs])
            own = np.searchsorted(docs, text[rows])
            f = model.forward(x[rows], own, len(docs))
            error = (f["y"] - label[docs]) / len(docs)
            dz = error[:, None] * p["c"]
            dh = f["a"][:, None] * dz[own]
            da = (f["h"] * dz[own]).sum(1)
            de = f["a"] * (da - np.bincount(own, f["a"] * da, minlength=len(docs))[own])
            dt = de[:, None] * p["w"] * f["g"] * (1 - f["t"] ** 2)
            dg = de[:, None] * p["w"] * f["t"] * f["g"] * (1 - f["g"])
            dh += dt @ p["V"].T + dg @ p["U"].T
            dx = dh * (1 - f["h"] ** 2)
            slope = {"W": f["x"].T @ dx, "b": dx.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ dg}
            slope |= {"w": (f["t"] * f["g"]).T @ de, "c": f["z"].T @ error, "d": np.array([error.sum()])}
            step += 1
            for n, v in p.items():
                g = slope[n] + 1e-4 * v
                m, s = moment[n]
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return model


# ---- the operator -------------------------------------------------------------------


def fit(
    docs: DataFrame,
    labels: DataFrame,
    use: Column | None = None,
    max_rows: int = 6_000,
    width: int = 16,
    epochs: int = 30,
    rate: float = 0.01,
    seed: int = 5,
) -> Attention | None:
    """Learn from at most about `max_rows` labelled documents, all passages of each.
    Only the features of the passages reach the driver. No rows: None."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            x, text = passages(texts_of(batch))
            first = np.searchsorted(text, np.arange(batch.num_rows))
            rows = [part.astype(np.float32).tobytes() for part in np.split(x, first[1:])]
            yield pa.RecordBatch.from_pydict({"label": batch["label"], "features": pa.array(rows, pa.binary())})

    sample = labelled_once(docs, labels, "quality", max_rows, use).select("label", "text")
    rows = sample.mapInArrow(measure, "label int, features binary").toArrow().to_pydict()
    pairs = sorted(zip(rows["label"], rows["features"], strict=True))
    if not pairs:
        return None
    each = [np.frombuffer(x, np.float32).reshape(-1, FEATURES) for _, x in pairs]
    label = np.array([x > 0 for x, _ in pairs], float)
    text = np.repeat(np.arange(len(each)), [len(x) for x in each])
    return train(np.concatenate(each).astype(float), text, label, width, epochs, rate, seed)


SCHEMA = "score double, predicted int, top_passage long"


def score_texts(docs: DataFrame, model: Attention | None, threshold: float = 0.3) -> DataFrame:
    """One row per row of `docs` (doc_id, text; other columns are not read).

    `score` is the probability of label 1, `predicted` is 1 from `threshold` on,
    `top_passage` the place of the passage with most attention. A null or empty
    text is one passage of zeros and gets that passage's score. Null ids and
    repeated rows are kept; an empty table gives an empty result; without a
    model every score is 0.5. Whole texts, one pass, no shuffle.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = texts_of(batch)
            score, top = model.score(texts) if model else (np.full(len(texts), 0.5), np.zeros(len(texts), np.int64))
            columns = [batch["doc_id"], pa.array(score), pa.array((score >= threshold).astype(np.int32)), pa.array(top)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "predicted", "top_passage"])

    return docs.select("doc_id", "text").mapInArrow(measure, id_and(docs, SCHEMA))
