"""Operators on frame pixels. Frames here hold `rows`, `cols`, `type` and the
decoded payload `bytes`; other columns pass through."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frameweir.functions.frames import byte_at, channels
from frameweir.functions.pixels import png_bytes, png_pixels, resize_block, resize_part

# Pixel bytes a task handles at a time.
BLOCK_BYTES = 16 * 1024 * 1024

# Side of a tile of a frame that is resized in parts.
TILE = 512


def decode_frames(frames: DataFrame) -> DataFrame:
    """Replace the base64 text `data` of good frames by the payload `bytes`."""
    return frames.withColumn("bytes", F.unbase64("data")).drop("data")


def frame_pixels(frames: DataFrame, keys: list[str]) -> DataFrame:
    """One row per pixel value of each decoded frame: `y`, `x`, `channel`,
    `value`."""
    line = F.col("cols").cast("bigint") * channels(F.col("type"))
    place = F.explode(F.sequence(F.lit(0), F.octet_length("bytes") - 1)).alias("_p")
    return (
        frames.where(F.octet_length("bytes") > 0)
        .select(*keys, "cols", "type", "bytes", place)
        .select(
            *keys,
            F.floor(F.col("_p") / line).cast("int").alias("y"),
            F.floor((F.col("_p") % line) / channels(F.col("type"))).cast("int").alias("x"),
            (F.col("_p") % channels(F.col("type"))).alias("channel"),
            byte_at(F.col("bytes"), F.col("_p")).alias("value"),
        )
    )


def _geometry(batch: pa.RecordBatch) -> np.ndarray:
    """Rows, columns and channels of each frame."""
    rows, cols, code = (batch.column(name).to_numpy() for name in ("rows", "cols", "type"))
    return np.column_stack([rows, cols, (code >> 3) + 1]).astype(np.int64)


def _frame(batch: pa.RecordBatch, index: int, shape: np.ndarray) -> np.ndarray:
    payload = batch.column("bytes")[index].as_buffer()
    return np.frombuffer(payload, np.uint8).reshape(shape)


def _replace(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch with columns set, new ones at the end."""
    kept = {name: batch.column(name) for name in batch.schema.names}
    return pa.RecordBatch.from_pydict({**kept, **columns})


def _resized(batch: pa.RecordBatch, height: int, width: int) -> pa.RecordBatch:
    shapes = _geometry(batch)
    out = [None] * batch.num_rows
    for shape in np.unique(shapes, axis=0):
        same = np.flatnonzero((shapes == shape).all(axis=1))
        block = np.stack([_frame(batch, i, shape) for i in same])
        for i, frame in zip(same, resize_block(block, height, width)):
            out[i] = frame.tobytes()
    count = batch.num_rows
    return _replace(
        batch,
        {
            "rows": pa.array(np.full(count, height, np.int32)),
            "cols": pa.array(np.full(count, width, np.int32)),
            "bytes": pa.array(out, pa.binary()),
        },
    )


def resize_frames(frames: DataFrame, height: int = 480, width: int = 640) -> DataFrame:
    """Cubic resize of 8-bit frames, weights in 11-bit fixed point.

    No shuffle: each task resizes its own rows, a bounded block at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # An output frame weighs up to four bytes per pixel in, and its
            # integer sums four times that.
            step = max(1, BLOCK_BYTES // (height * width * 4))
            for start in range(0, batch.num_rows, step):
                yield _resized(batch.slice(start, step), height, width)

    return frames.mapInArrow(run, frames.schema)


def resize_tiles(
    frames: DataFrame, keys: list[str], height: int = 480, width: int = 640, side: int = TILE
) -> DataFrame:
    """The cubic resize as a table of tiles of at most `side` by `side` pixels, one row
    each: `keys`, `type`, `top`, `left` (of the tile), `tall`, `wide`, `bytes`.

    A tile is resized by itself, along its lines and then down its columns, from the
    part of the frame that lies under it and a border of two pixels, cut out before
    Python sees it; so a task holds a tile and what lies under it, however large the
    frame. Pixels equal those of `resize_frames`. Frames without pixels give no tiles.
    The tiles of a frame follow each other in the task that has the frame.
    """
    count = channels(F.col("type")).cast("bigint")
    grid = [F.sequence(F.lit(0), F.lit((n - 1) // side * side), F.lit(side)) for n in (height, width)]
    tiles = frames.where(F.octet_length("bytes") > 0).select(*keys, "rows", "cols", "type", "bytes", F.explode(grid[0]).alias("top"))
    tiles = tiles.select("*", F.explode(grid[1]).alias("left"))

    def under(at: str, source: str, target: int) -> tuple[Column, Column]:
        """First source place under a tile and the place behind its last one."""
        ratio = F.col(source).cast("double") / target
        end = F.least(F.col(at) + side, F.lit(target))
        first = F.floor((F.col(at) + F.lit(0.5)) * ratio - 0.5) - 2
        last = F.floor((end - F.lit(0.5)) * ratio - 0.5) + 4
        return F.greatest(F.lit(0), first), F.least(F.col(source), last)

    (y0, y1), (x0, x1) = under("top", "rows", height), under("left", "cols", width)
    tiles = tiles.select(*keys, "rows", "cols", "type", "top", "left", *[c.cast("bigint").alias(n) for c, n in ((y0, "y0"), (y1, "y1"), (x0, "x0"), (x1, "x1"))], "bytes")
    line = lambda y: F.substring("bytes", ((y * F.col("cols") + F.col("x0")) * count + 1).cast("int"), ((F.col("x1") - F.col("x0")) * count).cast("int"))
    tiles = tiles.withColumn("lines", F.transform(F.sequence("y0", F.col("y1") - 1), line)).drop("bytes")

    kept = [frames.schema[k] for k in keys] + [frames.schema["type"]]
    made = [("top", T.IntegerType()), ("left", T.IntegerType()), ("tall", T.IntegerType()), ("wide", T.IntegerType()), ("bytes", T.BinaryType())]
    schema = T.StructType([*kept, *[T.StructField(n, t) for n, t in made]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A block of tiles at a time, as they weigh more than what lies under them.
        step = max(1, BLOCK_BYTES // (side * side * 4))
        for batch in (whole.slice(k, step) for whole in batches for k in range(0, whole.num_rows, step)):
            rows = batch.select(["rows", "cols", "type", "top", "left", "y0", "x0", "lines"]).to_pylist()
            shapes, out = [], []
            for r in rows:
                part = np.frombuffer(b"".join(r["lines"]), np.uint8)
                part = part.reshape(len(r["lines"]), -1, (r["type"] >> 3) + 1)
                shape = min(side, height - r["top"]), min(side, width - r["left"])
                shapes.append(shape)
                begin = (r["y0"], r["x0"]), (r["top"], r["left"])
                out.append(resize_part(part, (r["rows"], r["cols"]), (height, width), *begin, shape).tobytes())
            columns = [batch.column(x) for x in [*keys, "type", "top", "left"]]
            columns += [pa.array([s[i] for s in shapes], pa.int32()) for i in (0, 1)] + [pa.array(out, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return tiles.mapInArrow(run, schema)


def assemble_frames(tiles: DataFrame, keys: list[str], height: int = 480, width: int = 640, in_turn: bool = False) -> DataFrame:
    """Frames (`keys`, `rows`, `cols`, `type`, `bytes`) out of their tiles. The keys tell
    frames apart; a frame with a tile missing fails the job. One shuffle, of the tiles;
    a task holds the tiles of the frame that it puts together, and that frame.

    With `in_turn` the tiles of a frame follow each other in one task, as `resize_tiles`
    leaves them, and are put together where they are: no pixel is shuffled or written.
    A task holds a frame and some tiles. Tiles that don't follow each other fail the job
    as missing ones do. Frames of the same keys each come out then (see `each_once`).
    """
    schema = T.StructType([*[tiles.schema[k] for k in keys], T.StructField("rows", T.IntegerType()), T.StructField("cols", T.IntegerType()), tiles.schema["type"], T.StructField("bytes", T.BinaryType())])

    def frame_row(row: pa.RecordBatch, frame: np.ndarray) -> pa.RecordBatch:
        sides = [pa.array([n], pa.int32()) for n in (height, width)]
        columns = [*[row.column(k) for k in keys], *sides, row.column("type"), pa.array([frame.tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    def lacking(filled: int) -> ValueError:
        return ValueError(f"tiles of a frame cover {filled} of {height * width} pixels")

    def run_in_turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, own, places, filled = [*keys, "type"], None, set(), 0  # of the frame at work
        for batch in batches:
            columns = [batch.column(n) for n in ("top", "left", "tall", "wide")]
            for at in range(batch.num_rows):
                key = batch.select(names).slice(at, 1)
                y, x, tall, wide = (c[at].as_py() for c in columns)
                if not places:
                    own, frame = key, np.empty((height, width, (key.column("type")[0].as_py() >> 3) + 1), np.uint8)
                elif not key.equals(own) or (y, x) in places:
                    raise lacking(filled)
                frame[y : y + tall, x : x + wide] = np.frombuffer(batch.column("bytes")[at].as_buffer(), np.uint8).reshape(tall, wide, -1)
                places.add((y, x))
                filled += tall * wide
                if filled == height * width:
                    yield frame_row(own, frame)
                    places, filled = set(), 0
        if places:
            raise lacking(filled)

    if in_turn:
        return tiles.select(*keys, "type", "top", "left", "tall", "wide", "bytes").mapInArrow(run_in_turn, schema)
    tile = F.struct("top", "left", "tall", "wide", "bytes")
    whole = tiles.groupBy(*keys, "type").agg(F.collect_list(tile).alias("tiles"))  # each knows its place

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):  # a frame at a time
                row = batch.slice(at, 1)
                code = row.column("type")[0].as_py()
                frame, filled = np.empty((height, width, (code >> 3) + 1), np.uint8), 0
                for t in row.column("tiles")[0]:
                    y, x, tall, wide = (t[n].as_py() for n in ("top", "left", "tall", "wide"))
                    frame[y : y + tall, x : x + wide] = np.frombuffer(t["bytes"].as_buffer(), np.uint8).reshape(tall, wide, -1)
                    filled += tall * wide
                if filled != height * width:
                    raise lacking(filled)
                yield frame_row(row, frame)

    return whole.mapInArrow(run, schema)


def each_once(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows; the job fails where several have the same keys (null is one, too). They
    are shuffled, so they should be narrow."""
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    return rows.withColumn("_number", number).where(F.when(F.col("_number") == 1, True).otherwise(F.raise_error(F.lit(f"rows with the same {', '.join(keys)}")).cast("boolean"))).drop("_number")


def add_png(frames: DataFrame) -> DataFrame:
    """Replace the payload `bytes` by the image file `png`; null where the
    format has no such image."""
    kept = [field for field in frames.schema.fields if field.name != "bytes"]
    names = [field.name for field in kept]
    schema = T.StructType([*kept, T.StructField("png", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shapes = _geometry(batch)
            # Input batches are bounded in bytes by Spark, and so is this one.
            files = [png_bytes(_frame(batch, i, shape)) for i, shape in enumerate(shapes)]
            png = pa.array(files, pa.binary())
            yield _replace(batch.select(names), {"png": png})

    return frames.mapInArrow(run, schema)


def png_contents(images: DataFrame) -> DataFrame:
    """Replace the image file `png` by what it shows: `width`, `height`, `channels`
    and the `pixels` in the order of the file, as hex."""
    kept = [field for field in images.schema.fields if field.name != "png"]
    names = [field.name for field in kept]
    shown = [("width", pa.int32()), ("height", pa.int32()), ("channels", pa.int32()), ("pixels", pa.string())]
    schema = T.StructType([*kept, *[T.StructField(name, T.IntegerType()) for name, _ in shown[:3]], T.StructField("pixels", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [png_pixels(file) for file in batch.column("png").to_pylist()]
            found = [(*facts, pixels.hex().upper()) for *facts, pixels in found]
            columns = {name: pa.array([x[i] for x in found], kind) for i, (name, kind) in enumerate(shown)}
            yield _replace(batch.select(names), columns)

    return images.mapInArrow(run, schema)


# The places of the second sum below count up to this prime and start again.
PLACES = 65521


def pixel_sums(frames: DataFrame, keys: list[str]) -> DataFrame:
    """Two sums over the payload of each decoded frame: `total` of the bytes, and
    `placed` of the bytes times their places. They tell frames apart that a
    query language can also compute."""
    schema = T.StructType([frames.schema[k] for k in keys]).add("total", T.LongType()).add("placed", T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = np.arange(PLACES, dtype=float)
        for batch in batches:
            total, placed = [], []
            for payload in batch.column("bytes"):
                values, sums = np.frombuffer(payload.as_buffer(), np.uint8), [0, 0]
                for start in range(0, len(values), PLACES):  # exact: far below 2**53
                    part = values[start : start + PLACES].astype(float)
                    sums[0] += int(part.sum())
                    sums[1] += int(part @ places[: len(part)])
                total.append(sums[0])
                placed.append(sums[1])
            columns = {"total": pa.array(total, pa.int64()), "placed": pa.array(placed, pa.int64())}
            yield _replace(batch.select(keys), columns)

    return frames.select(*keys, "bytes").mapInArrow(run, schema)
