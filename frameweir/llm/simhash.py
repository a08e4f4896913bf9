"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check, components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameweir.llm.common import pieces, row_columns, row_id, texts_of, with_row, without
from frameweir.llm.graph import components
from frameweir.session import stored

SEED = 42
# Most fingerprints of one block that are compared in one go. A larger block is
# dealt to chunks, and every pair of chunks is compared by a task of its own.
CHUNK = 4096


# ---- fingerprints -------------------------------------------------------------------


def fingerprint(text: bytes, length: int) -> int:
    """Bit i is set if it is set in over half of the hashes of the shingles."""
    words = text.lower().split()
    if not words:
        return 0
    length = min(length, len(words))
    lines = zip(*(words[i:] for i in range(length)), strict=False)
    hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(x), SEED) for x in lines), np.uint64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    over = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(over, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, length: int = 3, keep: list[str] | None = None) -> DataFrame:
    """(doc_id, columns `keep`, fp long): the fingerprint of each text as a signed
    64-bit number."""
    keep = ["doc_id", *(keep or [])]
    schema = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = np.array([fingerprint(x.encode(), length) for x in texts_of(batch)], np.uint64)
            columns = [*(batch[c] for c in keep), pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "fp"])

    return docs.select(*keep, "text").mapInArrow(measure, f"{schema}, fp long")


# ---- links --------------------------------------------------------------------------


def block_masks(blocks: int, max_bits: int) -> list[int]:
    """One mask for each choice of `blocks - max_bits` blocks. Two fingerprints
    with at most `max_bits` differing bits agree on at least one of them."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(x) for x in combinations(masks, blocks - max_bits)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _links_in(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that join what is joined by pairs of at most `max_bits` bits: each
    fingerprint is reached once, from one that is joined already."""
    left, found = np.arange(len(fps)), []
    while len(left) > 1:
        todo, left = [left[0]], left[1:]
        root = fps[todo[0]]
        while todo and len(left):
            close = np.bitwise_count(fps[left] ^ fps[todo.pop()]) <= max_bits
            todo += left[close].tolist()
            found += [(int(root), int(x)) for x in fps[left[close]]]
            left = left[~close]
    return found


def links(fps: DataFrame, blocks: int = 6, max_bits: int = 3, chunk: int = CHUNK) -> DataFrame:
    """(a, b): links among the distinct fingerprints `fps` (fp) that join the same
    fingerprints as all pairs within `max_bits` bits do.

    Fingerprints that agree on enough blocks share a key. Keys of one
    fingerprint are left out before anything is compared; a key with more than
    `chunk` fingerprints is dealt to chunks, and pairs of chunks are compared
    apart, so no task holds more than two chunks of a key. Inside a task all
    fingerprints of a key are compared with those reached so far, and only the
    links that join something new are passed on.
    """
    masks = F.array(*[F.lit(_signed(m)) for m in block_masks(blocks, max_bits)])
    keys = fps.select("fp", F.posexplode(masks).alias("way", "mask"))
    keys = keys.select("fp", "way", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    sizes = keys.groupBy("way", "key").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / chunk).cast("int")
    mine = F.pmod(F.xxhash64(F.lit(7), "fp"), F.col("parts")).cast("int")
    shared = keys.join(sizes, ["way", "key"]).select("fp", "way", "key", parts.alias("parts"))
    shared = shared.withColumn("mine", mine)
    others = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = shared.withColumn("other", others).select(
        "fp",
        "way",
        "key",
        F.least("mine", "other").alias("low"),
        F.greatest("mine", "other").alias("high"),
    )
    own = ["way", "key", "low", "high"]
    dealt = dealt.repartition(*own).sortWithinPartitions(*own, "fp")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: np.ndarray | None = None  # rows of the last key so far, as more may follow
        for batch in batches:
            rows = np.stack([batch[x].to_numpy().astype(np.int64) for x in (*own, "fp")], axis=1)
            rows = rows if held is None else np.concatenate([held, rows])
            starts = np.flatnonzero(np.any(rows[1:, :4] != rows[:-1, :4], axis=1)) + 1
            if len(starts):
                held = rows[starts[-1] :]
                yield _compared(rows[: starts[-1]], starts[:-1], max_bits)
            else:
                held = rows
        if held is not None:
            yield _compared(held, np.zeros(0, np.int64), max_bits)

    return dealt.mapInArrow(compare, "a long, b long").distinct()


def _compared(rows: np.ndarray, starts: np.ndarray, max_bits: int) -> pa.RecordBatch:
    """Links within the groups of `rows` (the last column) that begin at 0 and `starts`."""
    fps = rows[:, 4]
    bounds = np.concatenate([[0], starts, [len(rows)]])
    sizes = np.diff(bounds)
    two = bounds[:-1][sizes == 2]
    close = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= max_bits]
    found = list(zip(fps[close].tolist(), fps[close + 1].tolist(), strict=True))
    for k in np.flatnonzero(sizes > 2):
        found += _links_in(fps[bounds[k] : bounds[k + 1]], max_bits)
    return pa.RecordBatch.from_arrays(
        [pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"]
    )


# ---- the operator -------------------------------------------------------------------


def near_duplicates(docs: DataFrame, length: int = 3, max_bits: int = 3, blocks: int = 6) -> DataFrame:
    """One row per row of `docs` (doc_id, text; other columns are not read):
    doc_id, fingerprint (16 hex digits), component_id, the smallest id that links
    lead to, its own included.

    Shingles are `length` words; a shorter text is one shingle; a text without
    words (also a null one) has fingerprint zero, linked like any other. Equal
    texts have equal fingerprints and are compared once. Rows with a null id
    belong to their component but never name it; a component of null ids only
    has a null name. Repeated rows are kept; an empty table gives an empty result.
    """
    own = stored(fingerprints(docs, length), "fingerprints")
    named = grouped(own, max_bits, blocks).select("fp", "component_id")
    return own.join(named, "fp").select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def grouped(own: DataFrame, max_bits: int, blocks: int) -> DataFrame:
    """(fp, root, component_id): for each fingerprint of `own` (doc_id, fp) its
    component, by the smallest fingerprint and by the smallest id in it."""
    distinct = stored(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(distinct.select("fp"), blocks, max_bits))
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return named.join(least, "root").select("fp", "root", "component_id")


def without_near_duplicates(docs: DataFrame, length: int = 3, max_bits: int = 3, blocks: int = 6) -> DataFrame:
    """`docs` with all its columns, and of each component one row: that of the smallest
    id, nulls last, then of the smallest row hash. A row that is there twice with
    id and text is kept once."""
    rows = with_row(docs)
    own = stored(fingerprints(docs.select("doc_id", "text", row_id().alias("rid")), length, ["rid"]), "fingerprints")
    named = grouped(own, max_bits, blocks).select("fp", "root")
    place = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("rid"))
    placed = stored(own.join(named, "fp").select("root", "rid", place.alias("place")), "placed")
    first = placed.groupBy("root").agg(F.min("place").alias("first"))
    again = placed.join(first, "root").where("place > first").select("rid").distinct()
    kept = without(rows, again).drop("doc_id", "text")
    twice = placed.groupBy("rid").count().where("count > 1").select("rid")
    if twice.take(1):
        once = without(kept, twice)
        kept = once.unionByName(kept.join(twice, "rid", "left_semi").dropDuplicates(["rid"]))
    return kept.select(*row_columns(docs))


def hex_digits(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))
