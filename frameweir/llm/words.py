"""Words of many texts at once, as numpy arrays: bounds, hashes, repeats."""

from __future__ import annotations

import numpy as np

# Words are separated by the six ASCII blanks: \x20 and \x09-\x0D.
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True

_STEP = np.uint64(0x9E3779B97F4A7C15 | 1)
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))
_CODE = np.random.default_rng(42).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {"step": np.ones(1, np.uint64), "back": np.ones(1, np.uint64)}


def _power(name: str, base: np.uint64, size: int) -> np.ndarray:
    if len(_powers[name]) < size:
        powers = np.full(size, base, np.uint64)
        powers[0] = 1
        _powers[name] = np.multiply.accumulate(powers)
    return _powers[name][:size]


def mix(value: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; no two values become one."""
    value = value.astype(np.uint64, copy=True)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        value ^= value >> np.uint64(shift)
        value *= np.uint64(factor)
    return value ^ (value >> np.uint64(33))


class Words:
    """The words of texts that were joined by line feeds (`raw`, bytes).

    `starts` and `ends` are byte places, `text` the number of the text of each
    word, `first` the number of the first word of each text (and the total).
    """

    def __init__(self, texts: list[bytes]):
        self.raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        sizes = np.fromiter((len(x) + 1 for x in texts), np.int64, len(texts))
        self.bounds = np.concatenate([[0], np.cumsum(sizes)])
        self.blank = BLANK[self.raw]
        edges = np.flatnonzero(np.diff(np.concatenate([[True], self.blank]))).astype(np.int64)
        self.starts, self.ends = edges[0::2], edges[1::2]
        self.first = np.searchsorted(self.starts, self.bounds)
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums over each text of one value per byte."""
        total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return total[self.bounds[1:]] - total[self.bounds[:-1]]

    def per_text_words(self, values: np.ndarray) -> np.ndarray:
        """Sums over each text of one value per word."""
        total = np.concatenate([[0], np.cumsum(values)])
        return total[self.first[1:]] - total[self.first[:-1]]

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes, the same wherever the word stands."""
        size = len(self.raw)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(_CODE[self.raw] * _power("step", _STEP, size), out=sums[1:])
        return mix((sums[self.ends] - sums[self.starts]) * _power("back", _BACK, size)[self.starts])

    def repeated(self, width: int) -> np.ndarray:
        """For each word, whether it lies in a window of `width` words that its
        text holds twice or more."""
        count = len(self.starts)
        cover = np.zeros(count + 1, np.int64)
        if count >= width:
            words = self.hashes()
            last = count - width + 1
            key = mix(self.text[:last].astype(np.uint64) + np.uint64(1))
            for k in range(width):
                key = mix(key ^ words[k : k + last]) + np.uint64(k)
            inside = self.text[:last] == self.text[width - 1 :]
            places = np.flatnonzero(inside)
            order = places[np.argsort(key[places], kind="stable")]
            same = key[order[1:]] == key[order[:-1]]
            twice = np.zeros(len(order), bool)
            twice[1:] |= same
            twice[:-1] |= same
            begin = order[twice]
            np.add.at(cover, begin, 1)
            np.add.at(cover, begin + width, -1)
        return np.cumsum(cover)[:count] > 0
