"""A stored topic as a streaming source that reads by offsets: where to start, how
much at a time, and a ledger of what was handled."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from frameweir.schema import RECORD_SCHEMA
from frameweir.sources.ledger import Ledger, file_store

_ARROW = pa.schema(
    [
        ("key", pa.binary()),
        ("value", pa.binary()),
        ("topic", pa.string()),
        ("partition", pa.int32()),
        ("offset", pa.int64()),
        ("timestamp", pa.timestamp("us", "UTC")),
        ("timestampType", pa.int32()),
    ]
)

# Records of a megabyte that a task holds at a time.
_ROWS = 64

Ranges = dict[int, tuple[int, int]]


@dataclass
class TopicSlice(InputPartition):
    """A group of rows of a file, and the offsets wanted of each partition."""

    path: str
    group: int
    wanted: Ranges


class TopicReader(DataSourceStreamReader):
    """Micro-batches of a stored topic.

    A stream begins, in each partition, where its group has committed; only
    where nothing is, `startingOffsets` says whether at the `earliest` offset or
    at the `latest`. A partition that appears later is read from its earliest. A
    micro-batch takes at most `maxOffsetsPerTrigger` offsets, the same number
    from each partition. Each end is noted as planned before it is handed out,
    so the source knows after a restart how far the checkpoint can be.
    """

    def __init__(self, options: dict[str, str]):
        self.path, self.topic = options["path"], options["subscribe"]
        self.group, self.ledger = options["group"], Ledger(options["ledger"])
        self.reset = options.get("startingOffsets", "latest")
        self.most = int(options["maxOffsetsPerTrigger"]) if "maxOffsetsPerTrigger" in options else None
        self.known: dict[str, list[Ranges]] = {}
        self.planned: dict[int, int] | None = None

    def _groups(self) -> dict[str, list[Ranges]]:
        """For each file, for each group of its rows, the first and last offset of each
        partition: from the footers, or from two columns where these are mixed."""
        files, root = file_store(self.path)
        for entry in files.get_file_info(fs.FileSelector(root, recursive=True)):
            if entry.path in self.known or not entry.base_name.endswith(".parquet") or entry.base_name[0] in "._":
                continue
            with files.open_input_file(entry.path) as source:
                file = pq.ParquetFile(source)
                at = {file.schema_arrow.names[i]: i for i in range(len(file.schema_arrow.names))}
                found = []
                for k in range(file.num_row_groups):
                    part, offset = (file.metadata.row_group(k).column(at[c]).statistics for c in ("partition", "offset"))
                    if part is not None and offset is not None and part.has_min_max and offset.has_min_max and part.min == part.max:
                        found.append({part.min: (offset.min, offset.max)})
                    else:
                        rows = file.read_row_group(k, ["partition", "offset"]).group_by("partition").aggregate([("offset", "min"), ("offset", "max")])
                        found.append({r["partition"]: (r["offset_min"], r["offset_max"]) for r in rows.to_pylist()})
            self.known[entry.path] = found
        return self.known

    def _bounds(self) -> dict[int, tuple[int, int]]:
        """First offset and end of each partition."""
        bounds: dict[int, tuple[int, int]] = {}
        for groups in self._groups().values():
            for ranges in groups:
                for p, (low, high) in ranges.items():
                    first, end = bounds.get(p, (low, high + 1))
                    bounds[p] = min(first, low), max(end, high + 1)
        return bounds

    def initialOffset(self) -> dict:
        return _text(self.ledger.start(self.group, self.topic, self._bounds(), self.reset))

    def latestOffset(self) -> dict:
        bounds = self._bounds()
        if self.planned is None:
            start = self.ledger.start(self.group, self.topic, bounds, self.reset)
            self.planned = self.ledger.offsets(self.group, self.topic, "planned")
            if any(o > start.get(p, o) for p, o in self.planned.items()):
                return _text(self.planned)  # a checkpoint may be as far as this, so that comes first
            self.planned = start
        begin = {p: self.planned.get(p, first) for p, (first, _) in bounds.items()}
        share = max(1, self.most // max(1, len(bounds))) if self.most else None
        end = {p: max(begin[p], b[1] if share is None else min(b[1], begin[p] + share)) for p, b in bounds.items()}
        if end != self.planned:
            self.ledger.append(self.group, self.topic, end, "planned")
            self.planned = end
        return _text(end)

    def partitions(self, start: dict, end: dict) -> list[TopicSlice]:
        bounds = self._bounds()
        asked = {int(p): (int(start.get(p, bounds[int(p)][0])), int(o)) for p, o in end.items()}
        slices = []
        for path, groups in self._groups().items():
            for k, ranges in enumerate(groups):
                meets = {p: asked[p] for p, (low, high) in ranges.items() if p in asked and low < asked[p][1] and high >= asked[p][0]}
                if meets:
                    slices.append(TopicSlice(path, k, meets))
        return slices

    def read(self, partition: TopicSlice) -> Iterator[pa.RecordBatch]:
        files, _ = file_store(self.path)
        with files.open_input_file(partition.path) as source:
            file = pq.ParquetFile(source, coerce_int96_timestamp_unit="us")
            for batch in file.iter_batches(_ROWS, [partition.group], _ARROW.names):
                inside = pa.array([False] * batch.num_rows)
                for p, (low, high) in partition.wanted.items():
                    own = pc.and_(pc.equal(batch["partition"], p), pc.and_(pc.greater_equal(batch["offset"], low), pc.less(batch["offset"], high)))
                    inside = pc.or_(inside, own)
                kept = batch.filter(inside)
                if kept.num_rows:
                    yield pa.RecordBatch.from_arrays([_cast(kept[f.name], f.type) for f in _ARROW], schema=_ARROW)

    def commit(self, end: dict) -> None:
        self.ledger.append(self.group, self.topic, {int(p): o for p, o in end.items()})


def _text(offsets: dict[int, int]) -> dict[str, int]:
    return {str(p): o for p, o in sorted(offsets.items())}


def _cast(column: pa.Array, kind: pa.DataType) -> pa.Array:
    if pa.types.is_timestamp(kind) and column.type.tz is None:
        return pc.assume_timezone(column.cast(pa.timestamp("us")), "UTC")
    return column.cast(kind)


class TopicTable(DataSource):
    """Format `topic_table`. Options: `path` of Parquet files in the shape of topic
    records, `subscribe`, `group`, `ledger` (a folder), `startingOffsets`,
    `maxOffsetsPerTrigger`. Tasks read the files by themselves, so the folder is
    one that all executors reach by the same name."""

    @classmethod
    def name(cls) -> str:
        return "topic_table"

    def schema(self):
        return RECORD_SCHEMA

    def streamReader(self, schema) -> TopicReader:
        return TopicReader(self.options)


def stream_topic_table(spark: SparkSession, **options: str | int):
    """A stream of a stored topic; `options` as in `TopicTable`."""
    spark.dataSource.register(TopicTable)
    return spark.readStream.format("topic_table").options(**options).load()
