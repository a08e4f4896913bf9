"""An append-only ledger of how far each group of readers has come in a topic."""

from __future__ import annotations

import json
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ENTRY = "group string, topic string, partition int, offset bigint, entry bigint, kind string"
_DIGITS = 15


def file_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path in it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


class Ledger:
    """One small file per entry, in the order of their numbers; a file is never changed.

    An entry is `committed` (the group has handled everything before these
    offsets) or `planned` (the end of a batch that was handed out). The latest
    entry of a kind counts for each group, topic and partition, so an offset
    may also go back. `compact` writes what counts as one entry and then
    removes the files before it; readers take any state in between the same.
    """

    def __init__(self, folder: str):
        self.files, root = file_store(folder)
        self.root = root.rstrip("/")

    def _numbers(self) -> dict[int, str]:
        found = self.files.get_file_info(fs.FileSelector(self.root, allow_not_found=True))
        names = [x.base_name for x in found if x.base_name.endswith(".json")]
        return dict(sorted((int(x[:_DIGITS]), f"{self.root}/{x}") for x in names))

    def _append(self, rows: list[dict]) -> int:
        numbers = self._numbers()
        number = max(numbers, default=-1) + 1
        self.files.create_dir(self.root)
        side = f"{self.root}/.{uuid.uuid4().hex}"
        text = "".join(json.dumps({**row, "entry": number}) + "\n" for row in rows)
        with self.files.open_output_stream(side) as file:
            file.write(text.encode())
        target = f"{self.root}/{number:0{_DIGITS}d}.json"
        if self.files.get_file_info(target).type != fs.FileType.NotFound:
            raise RuntimeError(f"entry {number} was written by another reader of the group")
        self.files.move(side, target)
        return number

    def _rows(self) -> list[dict]:
        rows = []
        for path in self._numbers().values():
            with self.files.open_input_stream(path) as file:
                rows += map(json.loads, file.read().decode().splitlines())
        return rows

    def _latest(self) -> dict[tuple, dict]:
        return {(r["group"], r["topic"], r["partition"], r["kind"]): r for r in self._rows()}

    def append(self, group: str, topic: str, offsets: dict[int, int], kind: str = "committed") -> None:
        self._append([{"group": group, "topic": topic, "partition": p, "offset": o, "kind": kind} for p, o in sorted(offsets.items())])

    def offsets(self, group: str, topic: str, kind: str = "committed") -> dict[int, int]:
        return {p: r["offset"] for (g, t, p, k), r in self._latest().items() if (g, t, k) == (group, topic, kind)}

    def start(self, group: str, topic: str, bounds: dict[int, tuple[int, int]], reset: str) -> dict[int, int]:
        """Where a group begins in each partition of `bounds` (first offset, end): where
        it left off, or, only where nothing is committed, where `reset` says."""
        known = self.offsets(group, topic)
        return {p: known.get(p, first if reset == "earliest" else end) for p, (first, end) in bounds.items()}

    def compact(self) -> None:
        numbers = self._numbers()
        if len(numbers) > 1:
            self._append([{k: v for k, v in row.items() if k != "entry"} for row in self._latest().values()])
            for path in numbers.values():
                self.files.delete_file(path)


def ledger_table(spark: SparkSession, folder: str) -> DataFrame:
    """group, topic, partition, offset: what each group has committed, as a table."""
    rows = spark.read.schema(_ENTRY).json(folder).where("kind = 'committed'")
    return rows.groupBy("group", "topic", "partition").agg(F.max_by("offset", "entry").alias("offset"))
