"""Helpers that several operators share: tables, splits by id, pieces of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from frameweir.operators.joins import lookup_join, table_bytes
from frameweir.session import stored

# Text that is worked on at a time inside a task. Temporary arrays take up to
# about thirty times as much; a longer text makes a piece of its own.
PIECE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`. A null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % parts


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else. Texts of ASCII only take the fast way."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def row_id() -> Column:
    """A key for one document row, from its doc_id and text: 128 bits of hash. Only
    repeats of the same id and text share it, so no key is hot where ids differ.
    A hash passes over nulls, so it is told which of both are null."""
    none = [F.col(c).isNull() for c in ("doc_id", "text")]
    return F.struct(F.xxhash64(*none, "doc_id", "text").alias("a"), F.xxhash64(F.lit(1), *none, "text", "doc_id").alias("b"))


def with_row(docs: DataFrame) -> DataFrame:
    """(row, rid, doc_id, text): all columns of `docs` inside a struct, so that they
    meet no other names."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), row_id().alias("rid"), "doc_id", "text")


def row_columns(docs: DataFrame, **other: Column) -> list[Column]:
    """The columns of `docs` out of the struct, some of them replaced."""
    return [other.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns]


def without(rows: DataFrame, keys: DataFrame, limit: int = 16 << 20) -> DataFrame:
    """The rows whose rid is not among `keys` (rid, each once). The keys are computed
    and measured; up to `limit` bytes they are broadcast, more are shuffled."""
    keys = stored(keys, "keys")
    small = table_bytes(keys) <= limit
    return rows.join(F.broadcast(keys) if small else keys.hint("merge"), "rid", "left_anti")


def labelled(docs: DataFrame, labels: DataFrame, label: str, max_rows: int | None = None, use: Column | None = None) -> DataFrame:
    """(doc_id, text, label) of the labelled documents, or of a bounded sample of them.

    Labels that are null and labels of null ids are left out; of several labels
    of an id the largest counts. With `max_rows` about as many labels are drawn by
    the hash of the id, so the sample is the same on every run; fewer stay as
    they are. `use` says which ids may be learned from.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).dropna()
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    if use is not None:
        known = known.where(use)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    if max_rows is None:
        return lookup_join(texts, known, ["doc_id"], "inner")
    share = min(1.0, max_rows / max(1, known.count()))
    drawn = known.where(F.pmod(F.xxhash64(F.lit(17), "doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    return texts.join(F.broadcast(drawn), "doc_id")  # at most about max_rows narrow rows


def labelled_once(
    docs: DataFrame, labels: DataFrame, label: str, max_rows: int | None = None, use: Column | None = None, named: bool = False
) -> DataFrame:
    """As `labelled`, with one row per id and text, and with `max_rows` about as many
    rows at most: neither repeats of a row nor an id with many texts fill the sample.

    Only the texts of rows that are there several times are shuffled, after they
    have been reduced inside each task. If more rows than `max_rows` are left,
    they are drawn by the hash of id and text. If `named` the rows have their `rid`,
    in which a null text is an empty one.
    """
    rows = labelled(docs, labels, label, max_rows, use).withColumn("rid", row_id())
    again = stored(rows.groupBy("rid").count().where("count > 1").select("rid"), "again")
    many = lookup_join(rows, again, ["rid"], "left_semi", is_stored=True)
    many = many.groupBy("rid").agg(*[F.first(x).alias(x) for x in ("doc_id", "text", "label")])
    single = lookup_join(rows, again, ["rid"], "left_anti", is_stored=True)
    once = stored(single.unionByName(many.select(*single.columns)), "labelled")
    count = once.count() if max_rows is not None else 0
    if max_rows is not None and count > max_rows:
        share = int(max_rows / count * 1_000_000)
        once = once.where(F.pmod(F.xxhash64(F.lit(19), "rid"), F.lit(1_000_000)) < share)
    return once.select("doc_id", "text", "label", *(["rid"] if named else []))


def pieces(batches: Iterator[pa.RecordBatch], most: int = PIECE_BYTES, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows again, in slices of about `most` bytes of a column, as a rule text."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch[column]), 0)
        cut = np.concatenate([[0], np.cumsum(size.to_numpy(zero_copy_only=False))]) // most
        ends = [*np.flatnonzero(np.diff(cut[:-1])) + 1, batch.num_rows]
        start = 0
        for end in ends:
            if end > start:
                yield batch.slice(start, end - start)
                start = end
    pa.default_memory_pool().release_unused()  # workers are kept for later tasks


def texts_of(batch: pa.RecordBatch) -> list[str]:
    return [x or "" for x in batch["text"].to_pylist()]


def id_and(docs: DataFrame, columns: str) -> str:
    """Schema text: the id as it is in `docs`, then `columns`."""
    return f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {columns}"
