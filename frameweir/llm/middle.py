"""Fill-in-middle: texts cut at two unit ends and put into another order."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameweir.llm.common import id_and, pieces

# The marks of the three parts, and the six ASCII blanks.
SENTINELS = ("<P>", "<S>", "<M>")
SPACE, TAB, RETURN = 0x20, 0x09, 0x0D

# One value in all eight bytes of a word: a factor, and masks of bits.
EACH = np.uint64(0x0101010101010101)
HIGH = np.uint64(0x8080808080808080)
REST = np.uint64(0x7F7F7F7F7F7F7F7F)


def _each(value: int) -> np.uint64:
    return np.uint64(value * int(EACH))


def blank_marks(words: np.ndarray) -> np.ndarray:
    """The high bit of each byte that holds a blank. Sums stay inside their byte, as
    the high bits are taken out before."""
    low = words & REST
    other = (low ^ _each(SPACE)) + REST
    from_tab, past = low + _each(0x80 - TAB), low + _each(0x80 - RETURN - 1)
    return (~other | (from_tab & ~past)) & ~words & HIGH


def character_marks(words: np.ndarray) -> np.ndarray:
    """The high bit of each byte that begins a code point."""
    return ~(words & ~(words << np.uint64(1))) & HIGH


class Marks:
    """Marked bytes of a row of words: how many come before a place, and where the
    k-th is. Words hold eight bytes, the lowest first; a mark is a byte's high bit."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(marks), dtype=np.int64)])

    def rank(self, place: np.ndarray) -> np.ndarray:
        """Marks in front of byte `place`."""
        word, byte = place >> 3, (place & 7).astype(np.uint64)
        inside = self.marks[word] & ((np.uint64(1) << (byte * np.uint64(8))) - np.uint64(1))
        return self.before[word] + np.bitwise_count(inside)

    def select(self, number: np.ndarray) -> np.ndarray:
        """The byte of the mark with this number, counted from 1 over all words."""
        word = np.searchsorted(self.before, number) - 1
        wanted = (number - self.before[word]).astype(np.uint64)
        upto = (self.marks[word] >> np.uint64(7)) * EACH  # each byte: the marks up to it
        reached = ((upto | HIGH) - wanted * EACH) & HIGH
        return 8 * word + 8 - np.bitwise_count(reached)


class Units:
    """The units of several texts: blanks with the word after them, or blanks at the
    end of a text. Each text begins at a word of its own and is filled up with spaces."""

    def __init__(self, texts: list[bytes]):
        self.size = np.fromiter(map(len, texts), np.int64, len(texts))
        self.first = np.concatenate([[0], np.cumsum((self.size + 7) >> 3)])
        raw = np.full(8 * (self.first[-1] + 1), SPACE, np.uint8)  # a word more, to look ahead
        for text, begin in zip(texts, self.first, strict=False):
            raw[8 * begin : 8 * begin + len(text)] = np.frombuffer(text, np.uint8)
        words = raw.view("<u8")
        blank = blank_marks(words)
        following = blank >> np.uint64(8)
        following[:-1] |= blank[1:] << np.uint64(56)
        ends = ~blank & following & HIGH
        last = 8 * self.first[:-1][self.size > 0] + self.size[self.size > 0] - 1
        ends[last >> 3] |= np.uint64(0x80) << ((last & 7) * 8).astype(np.uint64)  # a text's last byte ends a unit
        self.ends, self.characters = Marks(ends), Marks(character_marks(words))
        self.count = self.ends.before[self.first[1:]] - self.ends.before[self.first[:-1]]

    def cut(self, units: np.ndarray) -> np.ndarray:
        """The byte, from the beginning of each text, after so many units of it."""
        begin, found = 8 * self.first[:-1], np.zeros(len(units), np.int64)
        some = units > 0
        found[some] = self.ends.select(self.ends.before[self.first[:-1][some]] + units[some]) + 1 - begin[some]
        return found

    def characters_between(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        begin = 8 * self.first[:-1]
        return self.characters.rank(begin + high) - self.characters.rank(begin + low)


def draws(seed: int, doc_id: object) -> list[int]:
    """Four numbers of 32 bits for an id; a null id counts as empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[k : k + 4], "big") for k in (0, 4, 8, 12)]


def fill_in_middle(
    docs: DataFrame, seed: int = 42, percent: int = 50, suffix_first: int = 80, sentinels: tuple[str, str, str] = SENTINELS
) -> DataFrame:
    """One row per row of `docs` (doc_id, text; other columns are not read):
    doc_id, n (units), form, prefix_chars, middle_chars, output.

    A text is cut after two numbers of units drawn from its id and `seed`, so a
    repeated id is cut the same way wherever it runs. `percent` of the texts
    are rearranged, of these `suffix_first` in a hundred as form `spm` (suffix,
    prefix, middle), the others as `psm` (prefix, suffix, middle), each part
    after its sentinel. Texts that are empty or contain a sentinel stay as they
    are (form `plain`, lengths null). A null text is empty, a null id counts as
    empty text, repeated rows are kept, an empty table gives an empty result.

    Sentinels begin with a character that occurs nowhere else in them, so that
    none can arise where two parts meet. Each text is worked on by itself; a
    very long one makes a block of its own, of a few times its size.
    """
    if any(s[:1] in s[1:] + "".join(sentinels).replace(s[:1], "") or not s for s in sentinels):
        raise ValueError("sentinels must begin with a character that they hold nowhere else")
    marks = [s.encode() for s in sentinels]
    pre, suf, mid = marks

    def arranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = [x or b"" for x in batch["text"].cast(pa.binary()).to_pylist()]
            units = Units(texts)
            drawn = np.array([draws(seed, x) for x in batch["key"].to_pylist()], np.int64)
            ends = np.sort(drawn[:, :2] % (units.count[:, None] + 1), axis=1)
            low, high = units.cut(ends[:, 0]), units.cut(ends[:, 1])
            plain = (drawn[:, 2] % 100 >= percent) | np.array([not x or any(m in x for m in marks) for x in texts])
            form = np.where(plain, "plain", np.where(drawn[:, 3] % 100 < suffix_first, "spm", "psm"))

            def output(k: int) -> bytes:
                text, a, b = texts[k], low[k], high[k]
                if form[k] == "plain":
                    return text
                parts = (pre, text[:a], suf, text[b:]) if form[k] == "psm" else (suf, text[b:], pre, text[:a])
                return b"".join((*parts, mid, text[a:b]))

            none = np.zeros_like(low)
            columns = {
                "doc_id": batch["doc_id"],
                "n": pa.array(units.count),
                "form": pa.array(form.tolist(), pa.string()),
                "prefix_chars": pa.array(units.characters_between(none, low), mask=plain),
                "middle_chars": pa.array(units.characters_between(low, high), mask=plain),
                "output": pa.array(map(output, range(len(texts))), pa.binary()).cast(pa.string()),
            }
            yield pa.RecordBatch.from_pydict(columns)

    rows = docs.select("doc_id", F.col("doc_id").cast("string").alias("key"), "text")
    schema = id_and(docs, "n long, form string, prefix_chars long, middle_chars long, output string")
    return rows.mapInArrow(arranged, schema)


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that an output of `fill_in_middle` was made of."""
    parts = F.split(output, "|".join(rf"\Q{s}\E" for s in sentinels), -1)  # what is before the first sentinel is empty
    first, second, middle = (F.get(parts, F.lit(k)) for k in (1, 2, 3))
    return F.when(form == "psm", F.concat(first, middle, second)).when(form == "spm", F.concat(second, middle, first)).otherwise(output)
