"""Language-model scoring: bigram and unigram estimates mixed by deleted interpolation.

Counts never meet in one place. Texts are cut into blocks; a block holds its
tokens as places in its own table of words. Each block sends its distinct words
and bigrams, sorted and packed, to the ranges of the hash space they fall in. A
range adds up the counts of all blocks and sends every block the totals of what
that block asked for. So what is shuffled grows with the distinct bigrams of
a block, not with its tokens, and no word is hot: a block names it once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameweir.llm.common import pieces, texts_of
from frameweir.llm.words import Words, mix
from frameweir.session import stored

BLOCK_BYTES = 4 << 20  # text of a block
RANGE_TOKENS = 1 << 20  # tokens of the corpus for each range of hashes
END = np.uint64(0x5EED_0F_7EC7)  # the token behind a text
BUCKETS = 24  # context frequencies, by powers of two
TUNING = 20  # one in so many training documents is the held-out part of the EM
BINS = 4  # steps an octave is cut into when probabilities are counted for the EM


# ---- packed arrays ------------------------------------------------------------------


def pack(values: np.ndarray, is_sorted: bool = False) -> bytes:
    """Unsigned numbers in a few bytes each: differences where sorted, bytes of one
    rank side by side, compressed."""
    values = np.ascontiguousarray(values)
    if is_sorted and len(values):
        values = np.diff(values, prepend=np.zeros(1, values.dtype))
    ranks = values.view(np.uint8).reshape(len(values), -1).T if len(values) else np.zeros(0, np.uint8)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(ranks).tobytes())


def unpack(data: bytes, kind: type, is_sorted: bool = False) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    values = np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()
    return np.cumsum(values, dtype=kind) if is_sorted else values


# ---- blocks -------------------------------------------------------------------------

BLOCK = (
    "block string, tuning boolean, doc_ids array<{id}>, held_out array<boolean>, "
    "sizes array<int>, n_tokens long, words binary, tokens binary"
)


def make_blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Blocks of documents: (doc_id, text, held_out, tuning) to one row per block.
    Documents of the tuning part have blocks of their own."""
    schema = BLOCK.format(id=docs.schema["doc_id"].dataType.simpleString())

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        waiting: dict[bool, list] = {False: [], True: []}
        size = {False: 0, True: 0}

        def block(tuning: bool) -> pa.RecordBatch:
            nonlocal made
            hashes = np.concatenate([x[0] for x in waiting[tuning]])
            words, tokens = np.unique(hashes, return_inverse=True)
            row = {
                "block": pa.array([f"{task}-{made}"]),
                "tuning": pa.array([tuning]),
                "doc_ids": pa.ListArray.from_arrays([0, sum(len(x[1]) for x in waiting[tuning])], pa.concat_arrays([x[1] for x in waiting[tuning]])),
                "held_out": pa.array([[y for x in waiting[tuning] for y in x[2]]], pa.list_(pa.bool_())),
                "sizes": pa.array([np.concatenate([x[3] for x in waiting[tuning]])], pa.list_(pa.int32())),
                "n_tokens": pa.array([len(tokens)], pa.int64()),
                "words": pa.array([pack(words, is_sorted=True)], pa.binary()),
                "tokens": pa.array([pack(tokens.astype(np.uint32))], pa.binary()),
            }
            made += 1
            waiting[tuning], size[tuning] = [], 0
            return pa.RecordBatch.from_pydict(row)

        for batch in pieces(batches, min(1 << 20, block_bytes)):
            for tuning in (False, True):
                own = batch.filter(pc.equal(batch["tuning"], tuning))
                if not own.num_rows:
                    continue
                texts = [x.encode().lower() for x in texts_of(own)]  # bytes: only A-Z change
                words = Words(texts)
                ends = words.first[1:] + np.arange(len(texts))
                hashes = np.insert(words.hashes(), words.first[1:], END)
                sizes = np.diff(np.concatenate([[-1], ends])).astype(np.int32)
                waiting[tuning].append((hashes, own["doc_id"], own["held_out"].to_pylist(), sizes))
                size[tuning] += len(words.raw)
                if size[tuning] >= block_bytes:
                    yield block(tuning)
        for tuning in (False, True):
            if waiting[tuning]:
                yield block(tuning)

    return docs.mapInArrow(build, schema)


class Block:
    """A block in memory: its words, tokens, and distinct bigrams in the order of
    their hashes. The token before a document's first is the end."""

    def __init__(self, row: dict):
        self.words = unpack(row["words"], np.uint64, is_sorted=True)
        self.tokens = unpack(row["tokens"], np.uint32).astype(np.int64)
        self.sizes = np.array(row["sizes"], np.int64)
        self.held_out = np.array(row["held_out"], bool)
        self.learned = np.repeat(~self.held_out, self.sizes)
        end = np.searchsorted(self.words, END)
        first = np.cumsum(self.sizes) - self.sizes
        self.before = np.concatenate([[end], self.tokens[:-1]])
        self.before[first] = end
        count = len(self.words)
        pairs, place = np.unique(self.before * count + self.tokens, return_inverse=True)
        hashes = mix(self.words[pairs // count] * np.uint64(0x9E3779B97F4A7C15) + self.words[pairs % count])
        order = np.argsort(hashes, kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        self.bigrams, self.bigram = hashes[order], rank[place]

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Learned occurrences of the words and of the bigrams."""
        words = np.bincount(self.tokens[self.learned], minlength=len(self.words))
        return words, np.bincount(self.bigram[self.learned], minlength=len(self.bigrams))


def _cuts(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Where sorted hashes pass from one of `parts` equal ranges to the next."""
    edges = [(i << 64) // parts for i in range(1, parts)]
    return np.concatenate([[0], np.searchsorted(hashes, np.array(edges, np.uint64)), [len(hashes)]]).astype(int)


# ---- counting -----------------------------------------------------------------------

ASKED = "part int, block string, tuning boolean, words binary, word_counts binary, bigrams binary, bigram_counts binary"
TOLD = (
    "part int, block string, words binary, bigrams binary, tuning_words binary, tuning_bigrams binary, "
    "tokens long, types long, tuning_tokens long"
)


def ask(blocks: DataFrame, parts: int) -> DataFrame:
    """What each block has in each range of hashes, with its own counts."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                word_counts, bigram_counts = (x.astype(np.uint32) for x in block.counts())
                a, b = _cuts(block.words, parts), _cuts(block.bigrams, parts)
                own = [p for p in range(parts) if a[p + 1] > a[p] or b[p + 1] > b[p]]
                columns = [
                    pa.array(own, pa.int32()),
                    pa.array([row["block"]] * len(own)),
                    pa.array([row["tuning"]] * len(own)),
                    pa.array([pack(block.words[a[p] : a[p + 1]], True) for p in own], pa.binary()),
                    pa.array([pack(word_counts[a[p] : a[p + 1]]) for p in own], pa.binary()),
                    pa.array([pack(block.bigrams[b[p] : b[p + 1]], True) for p in own], pa.binary()),
                    pa.array([pack(bigram_counts[b[p] : b[p + 1]]) for p in own], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in ASKED.split(", ")])

    return blocks.drop("doc_ids").mapInArrow(send, ASKED)


def _totals(hashes: list, counts: list, tuning: list) -> tuple[list, list, np.ndarray, np.ndarray]:
    """For each list of hashes the total counts over all lists, and over those of the
    tuning part; then both for each distinct hash."""
    every = np.concatenate(hashes)
    distinct, place = np.unique(every, return_inverse=True)
    own = np.concatenate(counts).astype(float)
    part = own * np.repeat(tuning, [len(x) for x in hashes])
    total = np.bincount(place, own, minlength=len(distinct)).astype(np.uint64)
    held = np.bincount(place, part, minlength=len(distinct)).astype(np.uint64)
    ends = np.cumsum([len(x) for x in hashes])[:-1]
    each = np.split(place, ends)
    return [total[x] for x in each], [held[x] for x in each], total, held


def tell(asked: DataFrame) -> DataFrame:
    """The totals that each block asked for; the sums of a range stand in its first row."""

    def add(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda x: x["block"])
        tuning = [x["tuning"] for x in rows]
        out = {"part": [x["part"] for x in rows], "block": [x["block"] for x in rows]}
        for kind in ("word", "bigram"):
            hashes = [unpack(x[f"{kind}s"], np.uint64, True) for x in rows]
            counts = [unpack(x[f"{kind}_counts"], np.uint32) for x in rows]
            total, held, every, every_held = _totals(hashes, counts, tuning)
            out[f"{kind}s"] = [pack(x) for x in total]
            out[f"tuning_{kind}s"] = [pack(x) if t else None for x, t in zip(held, tuning, strict=True)]
            if kind == "word":
                sums = (every.sum(), (every > 0).sum(), every_held.sum())
        for name, value in zip(("tokens", "types", "tuning_tokens"), sums, strict=True):
            out[name] = [int(value)] + [0] * (len(rows) - 1)
        kinds = {"part": pa.int32(), "block": pa.string()}
        kinds |= dict.fromkeys(("words", "bigrams", "tuning_words", "tuning_bigrams"), pa.binary())
        kinds |= dict.fromkeys(("tokens", "types", "tuning_tokens"), pa.int64())
        return pa.table({k: pa.array(out[k], kind) for k, kind in kinds.items()})

    return asked.groupBy("part").applyInArrow(add, TOLD)


class Counts:
    """The total counts behind each token of a block: of the token, of the token
    before it, of both in a row."""

    def __init__(self, block: Block, told: list[dict], tuning: bool):
        told = sorted(told, key=lambda x: x["part"])

        def read(name: str, size: int) -> np.ndarray:
            parts = [unpack(x[name], np.uint64) for x in told]
            values = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            if len(values) != size:
                raise RuntimeError(f"{len(values)} totals for {size} {name}")
            return values.astype(np.float64)

        words, bigrams = read("words", len(block.words)), read("bigrams", len(block.bigrams))
        if tuning:  # the model must not know what it is tuned on
            words = words - read("tuning_words", len(words))
            bigrams = bigrams - read("tuning_bigrams", len(bigrams))
        self.word, self.context = words[block.tokens], words[block.before]
        self.bigram = bigrams[block.bigram]


def bucket_of(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(context + 1).astype(np.int64), BUCKETS - 1)


# ---- mixture weights ----------------------------------------------------------------


def _bin(p: np.ndarray) -> np.ndarray:
    """Zero for probability zero, else a step of the logarithm (1: certain)."""
    with np.errstate(divide="ignore"):
        steps = np.rint(-np.log2(p) * BINS)
    return np.where(p > 0, 1 + np.minimum(steps, 1e6), 0).astype(np.int64)


def learn_weights(rows: list[tuple], floor: float, rounds: int = 50) -> np.ndarray:
    """EM for the weights of floor, unigram and bigram in each bucket of context
    counts, on (bucket, unigram bin, bigram bin, n). Buckets without counts keep
    the weights they start with."""
    weights = np.tile([0.1, 0.5, 0.4], (BUCKETS, 1))
    if not rows:
        return weights
    bucket, one, two, n = np.array(sorted(rows), np.int64).T
    p = np.stack([np.full(len(n), floor), *(np.where(x > 0, 2.0 ** (-(x - 1) / BINS), 0.0) for x in (one, two))], axis=1)
    seen = np.bincount(bucket, n, minlength=BUCKETS)
    for _ in range(rounds):
        share = weights[bucket] * p
        share *= (n / share.sum(axis=1))[:, None]
        for k in range(3):
            total = np.bincount(bucket, share[:, k], minlength=BUCKETS)
            weights[:, k] = np.where(seen > 0, total / np.maximum(seen, 1), weights[:, k])
    return weights


# ---- the operator -------------------------------------------------------------------

SCORED = "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def with_totals(blocks: DataFrame, told: DataFrame, use, schema: str) -> DataFrame:
    """`use(row, totals)` for each block: its row, and the rows it was told."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        (row,) = left.to_pylist()
        return use(row, left, right.to_pylist())

    return blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(run, schema)


def score_texts(docs: DataFrame, held_out: Column, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of `docs` (doc_id, text; other columns are not read): doc_id,
    held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words between blanks, A-Z in lower case, then an end. Counts
    are those of all documents that are not `held_out`. `base_score` is the
    smoothed unigram score. `score` mixes, for each token, bigram, unigram and
    uniform probability with weights by the frequency of the token before. The
    weights are learned by EM on one in twenty training documents, whose own
    counts are taken off for that.

    A null text is the end alone; null ids and repeated rows are documents like
    others; an empty table gives an empty result; without training documents
    every estimate is the uniform one, over one type.
    """
    tuning = ~held_out & (F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(TUNING)) == 0)
    own = docs.select("doc_id", "text", held_out.alias("held_out"), tuning.alias("tuning"))
    blocks = stored(make_blocks(own, block_bytes), "blocks")
    n_tokens = blocks.agg(F.sum("n_tokens")).first()[0] or 0
    parts = 1 + n_tokens // RANGE_TOKENS  # neither blocks nor ranges get larger with the input
    told = stored(tell(ask(blocks, parts)), "told")
    tokens, types, held = (x or 0 for x in told.agg(F.sum("tokens"), F.sum("types"), F.sum("tuning_tokens")).first())
    floor = 1.0 / (types + 1)

    def count(row: dict, _: pa.Table, rows: list[dict]) -> pa.Table:
        block = Block(row)
        counts = Counts(block, rows, tuning=True)
        one = _bin(counts.word / max(1, tokens - held))
        two = _bin(counts.bigram / np.maximum(counts.context, 1))
        keys = np.stack([bucket_of(counts.context), one, two])
        distinct, n = np.unique(keys[:, block.learned], axis=1, return_counts=True)
        return pa.table({k: pa.array(v) for k, v in zip(("bucket", "one", "two", "n"), [*distinct, n], strict=True)})

    held_told = told.where("tuning_words is not null")  # of the tuning blocks
    pairs = with_totals(blocks.where("tuning").drop("doc_ids"), held_told, count, "bucket long, one long, two long, n long")
    pairs = pairs.groupBy("bucket", "one", "two").agg(F.sum("n").alias("n"))  # bounded by the bins
    weights = learn_weights([tuple(x) for x in pairs.collect()], floor)

    def score(row: dict, left: pa.Table, rows: list[dict]) -> pa.Table:
        block = Block(row)
        counts = Counts(block, rows, tuning=False)
        base = np.log10((counts.word + 0.5) / (tokens + 0.5 * (types + 1)))
        mixed = weights[bucket_of(counts.context)]
        p = mixed[:, 0] * floor + mixed[:, 1] * counts.word / max(1, tokens)
        p += mixed[:, 2] * counts.bigram / np.maximum(counts.context, 1)
        first = np.cumsum(block.sizes) - block.sizes
        total = np.full(len(first), tokens, np.int64)
        found = [block.sizes, np.add.reduceat(counts.word > 0, first, dtype=np.int64), total]
        found += [np.add.reduceat(x, first) for x in (base, np.log10(p))]
        ids = left["doc_ids"].combine_chunks().flatten()
        columns = [ids, pa.array(block.held_out), *map(pa.array, found)]
        return pa.table(columns, names=["doc_id", *(x.split()[0] for x in SCORED.split(", "))])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {SCORED}"
    return with_totals(blocks, told, score, schema)
