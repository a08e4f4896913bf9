"""Images written by a data source that commits: a batch comes into sight as a whole or not at all."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from frameweir.sinks.images import file_place

MANIFEST = "manifest.parquet"
READ_BYTES = 16 << 20  # image bytes a task hands on at a time
_LINES = pa.schema([("path", pa.string()), ("file", pa.string()), ("n_bytes", pa.int64()), ("error", pa.string())])


@dataclass
class Attempt(WriterCommitMessage):
    """What one attempt of a task wrote: its folder, images and those it could not write."""

    folder: str
    images: int
    errors: int


class ImageWriter(DataSourceArrowWriter):
    """Attempts write beside each other under `_pending/<job>`, out of sight. The
    commit drops what no committed attempt wrote and renames the folder of the job to
    `batch_id=<batch>`, in one step however many images there are.

    A batch that is in sight already stays as it is, so that a repeated micro-batch
    changes nothing. An abort drops the folder of the job. Jobs whose driver was lost,
    and tasks that still ran when theirs was aborted, leave files out of sight.
    """

    def __init__(self, options: dict[str, str]):
        self.folder = options["path"].rstrip("/")
        self.prefix = options.get("prefix", "")
        self.batch = int(options.get("batchid", "0"))
        self.job = f"{self.folder}/_pending/{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Attempt:
        attempt = uuid.uuid4().hex
        system, root = file_place(f"{self.job}/{attempt}")
        images = errors = 0
        sink = None
        for batch in iterator:
            if sink is None:  # a task without rows leaves nothing
                system.create_dir(root, recursive=True)
                sink = pq.ParquetWriter(f"{root}/{MANIFEST}", _LINES, filesystem=system)
            lines = []
            for at, (path, png) in enumerate(zip(batch.column("path").to_pylist(), batch.column("png"), strict=True), images):
                file, error = f"{at:08d}.png", None
                if not png.is_valid:
                    error = "the format has no such image"
                elif not _stays(path, self.prefix):
                    error = "the name leaves the folder"
                else:
                    with system.open_output_stream(f"{root}/{file}") as out:
                        out.write(png.as_buffer())
                size = len(png.as_buffer()) if png.is_valid else None
                lines.append({"path": path, "file": None if error else f"{attempt}/{file}", "n_bytes": size, "error": error})
                errors += error is not None
            images += batch.num_rows
            sink.write_table(pa.Table.from_pylist(lines, schema=_LINES))
        if sink is not None:
            sink.close()
        return Attempt(attempt, images, errors)

    def commit(self, messages: list[Attempt | None]) -> None:
        system, job = file_place(self.job)
        _, target = file_place(f"{self.folder}/batch_id={self.batch}")
        done = {m.folder for m in messages if m is not None and m.images}
        for entry in system.get_file_info(fs.FileSelector(job, allow_not_found=True)):
            if entry.base_name not in done:  # of attempts that failed, were killed or came second
                system.delete_dir(entry.path)
        if system.get_file_info(target).type != fs.FileType.NotFound:
            self.abort(messages)
        elif done:
            system.move(job, target)

    def abort(self, messages: list[Attempt | None]) -> None:
        system, job = file_place(self.job)
        if system.get_file_info(job).type == fs.FileType.Directory:
            system.delete_dir(job)


def _stays(path: str | None, prefix: str) -> bool:
    """Whether the path is `prefix` and the name of a file."""
    name = (path or "").removeprefix(prefix)
    return path is not None and path.startswith(prefix) and not set(name) & set("/\\\0")


class CommittedImages(DataSource):
    """`df.write.format("committed_images")`, for images (`path`, `png`). Options: `path`,
    the folder; `batchId`, 0 if not given; `prefix`, what all paths begin with."""

    @classmethod
    def name(cls) -> str:
        return "committed_images"

    def writer(self, schema, overwrite: bool) -> ImageWriter:
        return ImageWriter(self.options)


def commit_images(images: DataFrame, folder: str, batch_id: int = 0, prefix: str = "") -> None:
    """Write the images (`path`, `png`) of a batch under `folder`, one that every
    executor can reach by this name and whose file system renames folders in one step.

    Files have numbers for names; `committed_images` gives the paths. Images without a
    file (no such format, or a name that would leave the folder) are in the manifest
    with the reason. If a file cannot be written the task fails and is tried again; if
    the job fails, nothing of the batch is in sight.
    """
    spark = images.sparkSession
    spark.dataSource.register(CommittedImages)
    writer = images.select("path", "png").write.format("committed_images").mode("append")
    writer.options(batchId=batch_id, prefix=prefix).save(folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(batch_id, path, file, n_bytes, error) of all committed images, the file as seen
    from `folder`; a table without rows where no batch is in sight."""
    schema = "batch_id bigint, path string, file string, n_bytes bigint, error string"
    folder = folder.rstrip("/")
    system, root = file_place(folder)
    entries = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
    batches = [x.base_name for x in entries if x.base_name.startswith("batch_id=")]
    if not batches:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", folder)
    lines = reader.parquet(*[f"{folder}/{x}/*/{MANIFEST}" for x in batches])
    file = F.concat(F.lit("batch_id="), F.col("batch_id").cast("string"), F.lit("/"), "file")
    return lines.select("batch_id", "path", file.alias("file"), "n_bytes", "error")


def committed_images(spark: SparkSession, folder: str) -> DataFrame:
    """(path, batch_id, png): of each path the image of the latest batch. Files are
    opened by the tasks that hold their lines; no image is shuffled."""
    lines = manifest(spark, folder).where("error is null")
    last = lines.groupBy("path").agg(F.max_by(F.struct("batch_id", "file"), "batch_id").alias("_last"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_place(folder.rstrip("/"))
        for batch in batches:
            start, size, files = 0, 0, []
            for at, file in enumerate(batch.column("file").to_pylist(), 1):
                with system.open_input_stream(f"{root}/{file}") as source:
                    files.append(source.read())
                size += len(files[-1])
                if size >= READ_BYTES or at == batch.num_rows:
                    kept = [batch.column(x).slice(start, at - start) for x in ("path", "batch_id")]
                    yield pa.RecordBatch.from_arrays([*kept, pa.array(files, pa.binary())], names=["path", "batch_id", "png"])
                    start, size, files = at, 0, []

    named = last.select("path", F.col("_last.batch_id").alias("batch_id"), F.col("_last.file").alias("file"))
    return named.mapInArrow(read, "path string, batch_id bigint, png binary")
