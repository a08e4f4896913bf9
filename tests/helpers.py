"""Small tables for the tests."""

from __future__ import annotations

import base64
import json

from frameweir.schema import FRAME_FIELDS

RECORD = "key string, value string, topic string, partition int, offset bigint, timestamp string, timestampType int, batch_id int"


def message(camera="a", stamp="2024-01-01 00:00:00.0", rows=1, cols=2, code=0, pixels=b"xy", **changes):
    """Text of a frame message; `changes` set fields, None drops one."""
    values = dict(zip(FRAME_FIELDS, [camera, stamp, rows, cols, code, base64.b64encode(pixels).decode()]))
    values.update(changes)
    return json.dumps({k: v for k, v in values.items() if v is not None})


def records(spark, rows):
    """Topic records of (batch, offset, message) rows, partition 0."""
    full = [(None, text, "t", 0, offset, None, 0, batch) for batch, offset, text in rows]
    return spark.createDataFrame(full, RECORD).selectExpr(
        "cast(key as binary) key",
        "cast(value as binary) value",
        "topic",
        "partition",
        "offset",
        "cast(timestamp as timestamp) timestamp",
        "timestampType",
        "batch_id",
    )


def frame_rows(spark, rows):
    """Frames of (camera, batch, timestamp, offset) rows."""
    full = [
        (camera, batch, stamp, 0, offset, 1, 2, 0, base64.b64encode(f"{offset:02d}".encode()[-2:]).decode())
        for camera, batch, stamp, offset in rows
    ]
    return spark.createDataFrame(
        full,
        "cameraId string, batch_id int, timestamp string, partition int, offset bigint,"
        " rows int, cols int, type int, data string",
    )


def expected_steps(rows):
    """The per-camera step written out: emitted rows and saved offsets."""
    emitted, saved, state = {}, set(), {}
    for batch in sorted({row[1] for row in rows}):
        for camera in sorted({row[0] for row in rows if row[1] == batch}):
            mine = sorted((r for r in rows if r[0] == camera and r[1] == batch), key=lambda r: (r[2], r[3]))
            before = state.get(camera)
            saved |= {r[3] for i, r in enumerate(mine) if before is not None or i > 0}
            last = mine[-1]
            n_saved = len(mine) - (before is None)
            emitted[camera, batch] = (last[2], last[3], len(mine), before is not None, before, n_saved)
            state[camera] = last[2]
    return emitted, saved
