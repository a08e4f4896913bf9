"""Exporting frames as image files or as a table of image files."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameweir.functions.text import file_name, raw_file_name
from frameweir.operators.images import add_png, decode_frames
from frameweir.operators.joins import BROADCAST_BYTES, lookup_join
from frameweir.operators.positions import POSITION, rows_by_position
from frameweir.schema import HISTORY_ORDER
from frameweir.session import stored


def last_per_path(
    frames: DataFrame, order: list[str], folder: str | None = None, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Of the frames that share a `path`, the one that comes last.

    Only narrow columns are grouped. Frames of a stored table that carry their
    positions (`with_positions`) are tested in the task that reads them, and
    none is moved, however many lose; of others the losers are left out by an
    anti-join on their places.
    """
    placed = POSITION if set(POSITION) <= set(frames.columns) else []
    narrow = frames.select("path", *order, *placed)
    last = F.max(F.struct(*order)).alias("_last")
    shared = narrow.groupBy("path").agg(last, F.count(F.lit(1)).alias("_n")).where("_n > 1")
    losers = narrow.join(shared, "path").where(F.struct(*order) < F.col("_last"))
    if placed:
        return rows_by_position(frames, losers, inside=False, limit=limit, folder=folder)
    return lookup_join(frames, losers.select("path", *order), ["path", *order], "left_anti", limit=limit, folder=folder)


def export_images(
    frames: DataFrame,
    folder: str,
    raw_names: bool = False,
    order: list[str] = HISTORY_ORDER,
    keep: tuple[str, ...] = (),
    work: str | None = None,
) -> DataFrame:
    """Image table (`path`, `png`, and the columns `keep`) of the frames given.
    `folder` should end in a separator; a later frame replaces an earlier one of
    the same path. `work` is a folder for what is looked up, overwritten."""
    name = raw_file_name if raw_names else file_name
    named = frames.withColumn("path", name(folder, F.col("cameraId"), F.col("timestamp")))
    kept = last_per_path(named, order, work)
    columns = ["path", *keep, "rows", "cols", "type", "bytes"]
    return add_png(decode_frames(kept).select(*columns)).select("path", *keep, "png")


def latest_images(images: DataFrame) -> DataFrame:
    """Of images that were exported batch by batch, the latest of each path."""
    last = images.groupBy("path").agg(F.max("batch_id").alias("batch_id"))
    return lookup_join(images, last, ["path", "batch_id"], "left_semi")


def file_place(folder: str) -> tuple[fs.FileSystem, str]:
    if "://" in folder:
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder


def _write(system: fs.FileSystem, path: str, png: bytes) -> None:
    """Write to a side file and move it into place, so that a repeated or
    interrupted task leaves no half file."""
    side = f"{path}.{uuid.uuid4().hex}.part"
    with system.open_output_stream(side) as file:
        file.write(png)
    system.move(side, path)


def write_images(images: DataFrame, folder: str, report: str) -> DataFrame:
    """Write each image to its path, from the tasks. Paths are `folder` and a name;
    the folder is one that every executor can reach. The report goes to the
    folder `report`, which is overwritten: `path`, `n_bytes`, and `error` where
    the image could not be written; the other images are not affected. An
    image whose name would leave the folder is not written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent, separator, begin = folder.rpartition("/")
        system, root = file_place(parent + separator)
        root = root.rstrip("/") + separator

        def written(path: str, png: pa.BinaryScalar) -> str | None:
            name = path.removeprefix(folder)
            if not png.is_valid:
                return "the format has no such image"
            if not path.startswith(folder) or "/" in name or "\\" in name or "\0" in name:
                return "the name leaves the folder"
            try:
                _write(system, f"{root}{begin}{name}", png.as_py())
            except Exception as failure:  # reported, as a failed write is not fatal
                return str(failure)
            return None

        for batch in batches:
            paths, files = batch.column("path").to_pylist(), batch.column("png")
            columns = {
                "path": paths,
                "n_bytes": pa.array([len(x.as_buffer()) if x.is_valid else None for x in files], pa.int64()),
                "error": pa.array([written(path, x) for path, x in zip(paths, files)], pa.string()),
            }
            yield pa.RecordBatch.from_pydict(columns)

    # Stored, so that reading the report does not write the images again.
    done = images.select("path", "png").mapInArrow(run, "path string, n_bytes bigint, error string")
    return stored(done, folder=report)
