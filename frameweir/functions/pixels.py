"""Array helpers for blocks of 8-bit frames; they run inside tasks."""

from __future__ import annotations

import struct
import zlib
from functools import lru_cache

import numpy as np

# Fixed values of the cubic resize for 8-bit frames: the kernel parameter and
# the fraction bits of its integer weights.
CUBIC_A = -0.75
WEIGHT_BITS = 11

# Fixed values of the PNG format: the signature, and the colour type for each
# channel count.
PNG_SIGNATURE = b"\x89PNG\r\n\x1a\n"
PNG_COLOUR = {1: 0, 3: 2, 4: 6}

# Channel order of a stored frame turned into that of the image file.
PNG_ORDER = {1: [0], 3: [2, 1, 0], 4: [2, 1, 0, 3]}


# Up to this many source places on both axes the sums are products of small matrices.
SMALL = 64


@lru_cache(64)
def cubic_taps(source: int, target: int) -> tuple[np.ndarray, np.ndarray]:
    """For each target position, four source positions and integer weights."""
    place = (np.arange(target) + 0.5) * (source / target) - 0.5
    base = np.floor(place)
    t = place - base
    a = CUBIC_A

    def near(x):
        return ((a + 2) * x - (a + 3)) * x * x + 1

    def far(x):
        return ((a * x - 5 * a) * x + 8 * a) * x - 4 * a

    weights = np.stack([far(t + 1), near(t), near(1 - t)], axis=1)
    weights = np.column_stack([weights, 1 - weights[:, 0] - weights[:, 1] - weights[:, 2]])
    places = base[:, None].astype(np.int64) + np.arange(-1, 3)
    return np.clip(places, 0, source - 1), np.rint(weights * 2**WEIGHT_BITS).astype(np.int32)


def _weigh(block: np.ndarray, axis: int, target: int) -> np.ndarray:
    """Weighted sums along one axis; the integers stay below 2**31."""
    return _weighed(block, axis, *cubic_taps(block.shape[axis], target))


def _weighed(block: np.ndarray, axis: int, places: np.ndarray, weights: np.ndarray) -> np.ndarray:
    along = [1] * block.ndim
    along[axis] = len(places)
    total = 0
    for k in range(4):
        part = np.take(block, places[:, k], axis).astype(np.int32, copy=False)
        part *= weights[:, k].reshape(along)
        total = part if k == 0 else np.add(total, part, out=total)
    return total


def resize_block(block: np.ndarray, height: int, width: int) -> np.ndarray:
    """Cubic resize of frames of one geometry: (n, rows, cols, channels)."""
    if block.shape[1:3] == (height, width):
        return block
    if max(block.shape[1:3]) <= SMALL:
        rows, cols = block.shape[1:3]
        return _by_products(block, _small(rows, height, 0, 0, rows, height), _small(cols, width, 0, 0, cols, width))
    return _as_bytes(_weigh(_weigh(block, 2, width), 1, height))


@lru_cache(64)
def _small(source: int, target: int, part_at: int, tile_at: int, part: int, tile: int) -> np.ndarray:
    """The weights of `tile` target places (rows) on `part` source places, of both
    kinds those from the given first one on, as shares."""
    places, weights = cubic_taps(source, target)
    own = slice(tile_at, tile_at + tile)
    shares = np.zeros((tile, part))
    np.add.at(shares, (np.arange(tile)[:, None], places[own] - part_at), weights[own] / 2**WEIGHT_BITS)
    return shares


def _by_products(block: np.ndarray, down: np.ndarray, along: np.ndarray) -> np.ndarray:
    """Both passes over frames of few pixels. The sums are exact: whole numbers below
    2**31, here divided by a power of two."""
    planes = block.astype(float).transpose(0, 3, 1, 2)
    out = np.empty((len(block), len(down), len(along), block.shape[3]), np.uint8)
    for frame, own in zip(out, planes, strict=True):
        total = down @ (own @ along.T)
        total += 0.5
        np.clip(total, 0, 255, out=total)  # the cast below cuts the fraction off
        frame[...] = total.transpose(1, 2, 0)
    return out


def _as_bytes(total: np.ndarray) -> np.ndarray:
    """Sums of both passes rounded to eight bits."""
    total += 1 << (2 * WEIGHT_BITS - 1)
    total >>= 2 * WEIGHT_BITS
    return np.clip(total, 0, 255, out=total).astype(np.uint8)


def resize_part(
    part: np.ndarray,
    source: tuple[int, int],
    target: tuple[int, int],
    part_at: tuple[int, int],
    tile_at: tuple[int, int],
    tile: tuple[int, int],
) -> np.ndarray:
    """A tile of the cubic resize from `source` to `target` rows and columns, which
    begins at `tile_at`, out of the part of the frame (rows, cols, channels) that
    begins at `part_at` and holds all pixels the tile asks for."""
    if source == target:
        y, x = (t - p for t, p in zip(tile_at, part_at))
        return part[y : y + tile[0], x : x + tile[1]]
    if max(part.shape[:2]) <= SMALL:
        down, along = (_small(source[k], target[k], part_at[k], tile_at[k], part.shape[k], tile[k]) for k in (0, 1))
        return _by_products(part[None], down, along)[0]
    taps = []
    for axis in (0, 1):
        places, weights = cubic_taps(source[axis], target[axis])
        own = slice(tile_at[axis], tile_at[axis] + tile[axis])
        taps.append((places[own] - part_at[axis], weights[own]))
    total = _weighed(_weighed(part, 1, *taps[1]), 0, *taps[0])
    return _as_bytes(total)


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def png_bytes(frame: np.ndarray, level: int = 3) -> bytes | None:
    """PNG file of one frame (rows, cols, channels); null when the format has
    no such image."""
    rows, cols, count = frame.shape
    if count not in PNG_COLOUR or not rows or not cols:
        return None
    lines = np.zeros((rows, 1 + cols * count), np.uint8)  # first byte: no filter
    lines[:, 1:] = frame[:, :, PNG_ORDER[count]].reshape(rows, -1)
    header = struct.pack(">IIBBBBB", cols, rows, 8, PNG_COLOUR[count], 0, 0, 0)
    return (
        PNG_SIGNATURE
        + _chunk(b"IHDR", header)
        + _chunk(b"IDAT", zlib.compress(lines.tobytes(), level))
        + _chunk(b"IEND", b"")
    )


def png_pixels(file: bytes) -> tuple[int, int, int, bytes]:
    """Width, height, channels and pixels of an image file as `png_bytes` writes it:
    8 bits, lines without a filter. ValueError for anything else."""
    if file[:8] != PNG_SIGNATURE or file[12:16] != b"IHDR":
        raise ValueError("no such image")
    cols, rows, bits, colour = struct.unpack(">IIBB", file[16:26])
    count = next((n for n, code in PNG_COLOUR.items() if code == colour), 0)
    at, body = 8, b""
    while at < len(file):
        (size,) = struct.unpack(">I", file[at : at + 4])
        kind, part = file[at + 4 : at + 8], file[at + 8 : at + 8 + size]
        if struct.pack(">I", zlib.crc32(kind + part)) != file[at + 8 + size : at + 12 + size]:
            raise ValueError("bad check sum")
        body += part if kind == b"IDAT" else b""
        at += 12 + size
    lines = np.frombuffer(zlib.decompress(body), np.uint8).reshape(rows, 1 + cols * count)
    if bits != 8 or not count or lines[:, 0].any():
        raise ValueError("not written here")
    return cols, rows, count, lines[:, 1:].tobytes()
