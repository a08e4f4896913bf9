"""Encoding by merges with a SentencePiece model, found by backtracking, and decoding."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from frameweir.llm.common import id_and, pieces, texts_of

# Pairs of neighbours and stretches of text whose results a task keeps; both are
# forgotten oldest first. Longer stretches are not kept. A stretch takes about
# 400 bytes, so all of them about 100 MB of a worker.
PAIRS, STRETCHES, LONGEST = 1 << 17, 1 << 18, 64

# Fixed value: what stands for a space inside pieces.
SPACE = "▁"

NEVER = float("-inf")  # the score of what is no piece


class Merges:
    """The pieces of a model with their scores; the best neighbours merge first, of
    equal ones the leftmost."""

    def __init__(self, model: bytes):
        self.processor = library = sentencepiece.SentencePieceProcessor(model_proto=model)
        special = (library.is_unknown, library.is_control, library.is_byte, library.is_unused)
        known = [k for k in range(len(library)) if not any(test(k) for test in special)]
        self.score = {library.id_to_piece(k): library.get_score(k) for k in known}
        spelled = [library.piece_to_id(f"<0x{k:02X}>") for k in range(256)]
        if not all(map(library.is_byte, spelled)):
            raise ValueError("the model must spell unknown characters in bytes")
        if any(c not in self.score for x in self.score for c in x):
            raise ValueError("each character of a piece must be a piece")
        self.bytes = [k.to_bytes(4, "little") for k in spelled]
        self.begin, self.end = (k().to_bytes(4, "little") for k in (library.bos_id, library.eos_id))
        # A piece that its own characters don't merge to is in no result.
        self.ids = {library.id_to_piece(k): k for k in known}
        self.history = {x: self._history(x) for x in self.ids}
        self.ids = {x: k for x, k in self.ids.items() if self.history[x][1][-1] == x}
        self.packed = {x: k.to_bytes(4, "little") for x, k in self.ids.items()}
        self.matches = ahocorasick.Automaton()
        for piece in self.ids:
            if len(piece) > 1:
                self.matches.add_word(piece, len(piece))
        self.matches.make_automaton()
        self.shorter = {x: next((k for k in range(len(x) - 1, 1, -1) if x[:k] in self.ids), 1) for x in self.ids if len(x) > 1}
        self.fits = lru_cache(PAIRS)(self._fits)
        self.stretches = re.compile(self._stretches())
        self.encoded = lru_cache(STRETCHES)(self.encode_stretch)

    def _stretches(self) -> str:
        """A pattern for parts of text that no piece reaches out of: no piece holds a
        space after another character, and none these characters at all."""
        if any(SPACE in x.lstrip(SPACE) for x in self.score):
            return "(?s:.+)"
        inside = set().union(*self.score)
        apart = "".join(re.escape(c) for c in map(chr, range(32)) if c not in inside)
        return f"{SPACE}*[^{SPACE}{apart}]+|{SPACE}+" + f"|[{apart}]" * bool(apart)

    def _history(self, text: str) -> tuple[list[float], list[str], list[str]]:
        """Merging a short text alone: the score of each step, then the leftmost and
        the rightmost part before the first step and after each."""
        parts, steps, left, right = list(text), [], [text[0]], [text[-1]]
        while len(parts) > 1:
            pairs = [self.score.get(a + b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
            best = max(range(len(pairs)), key=pairs.__getitem__)  # the first of equal ones
            if pairs[best] == NEVER:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
            steps.append(pairs[best])
            left.append(parts[0])
            right.append(parts[-1])
        return [*steps, NEVER], left, right

    def _fits(self, a: str, b: str) -> bool:
        """Whether `a` and `b` stay apart when both are merged anew side by side: at no
        step is the pair where they meet the one to merge next."""
        if a not in self.ids or b not in self.ids:
            return True  # no piece holds a character that is no piece
        (steps_a, _, ends), (steps_b, begins, _) = self.history[a], self.history[b]
        i = j = 0
        while True:
            meet = self.score.get(ends[i] + begins[j], NEVER)
            if meet > steps_a[i] and meet >= steps_b[j]:  # of equal ones the leftmost
                return False
            if steps_a[i] == steps_b[j] == NEVER:
                return True
            if steps_a[i] >= steps_b[j]:
                i += 1
            else:
                j += 1

    def split(self, text: str) -> list[str]:
        """The pieces that merging gives for a text, found from left to right.

        Merging gives exactly the row of pieces in which each pair of neighbours,
        merged anew, comes out as that pair. At each place the longest piece is
        tried first, then shorter ones. Where none fits, the place has failed:
        only one row of pieces can lead there, so it is never tried again.
        """
        if text in self.ids:
            return [text]  # the longest piece at the first place, and nothing after it
        total = len(text)
        longest = [1] * total  # also for a character that is no piece
        for end, size in self.matches.iter(text):
            longest[end - size + 1] = size  # longer ones come later
        failed: bytearray | None = None  # a bit for each place, made when one fails
        fits, path, place, last = self.fits, [], 0, ""
        size = longest[0] if total else 0
        while place < total:
            end = place + size
            piece = text[place:end]
            if (failed is None or not failed[end >> 3] >> (end & 7) & 1) and (not last or fits(last, piece)):
                path.append(piece)
                place, last = end, piece
                size = longest[end] if end < total else 0
                continue
            while size == 1:
                if not path:
                    raise ValueError("the model's pieces have no unique order of merges")
                failed = bytearray(total // 8 + 1) if failed is None else failed
                failed[place >> 3] |= 1 << (place & 7)
                piece = path.pop()
                last = path[-1] if path else ""
                size = len(piece)
                place -= size
            size = self.shorter[piece]
        return path

    def encode_stretch(self, text: str) -> bytes:
        packed = self.packed
        return b"".join([packed.get(x) or self._spelled(x) for x in self.split(text)])

    def _spelled(self, character: str) -> bytes:
        return b"".join(self.bytes[x] for x in character.encode())

    def encode(self, text: str) -> bytes:
        """The ids, begin and end included, as 32-bit numbers, lowest byte first."""
        stretches = self.stretches.findall(self.processor.normalize(text))
        if max(map(len, stretches), default=0) <= LONGEST:
            parts = map(self.encoded, stretches)
        else:
            parts = [self.encoded(x) if len(x) <= LONGEST else self.encode_stretch(x) for x in stretches]
        return b"".join((self.begin, *parts, self.end))


@lru_cache(2)
def _merges(model: bytes) -> Merges:
    """Made once per Python worker."""
    return Merges(model)


@lru_cache(2)
def _library(model: bytes) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def read_model(path: str) -> bytes:
    """The model file, of a fixed size that grows with nothing (half a megabyte for
    32,000 pieces). Read by the driver; tasks get its contents, not its path."""
    with open(path, "rb") as file:
        return file.read()


def encode_texts(docs: DataFrame, model: bytes) -> DataFrame:
    """One row per row of `docs` (doc_id, text; other columns are not read):
    doc_id, n_tokens, tokens: the ids with begin and end, as unsigned 32-bit
    numbers, lowest byte first.

    Ids are those that the library gives for the whole text. A null text is
    empty and has begin and end only; repeated rows are kept; an empty table
    gives an empty result. No shuffle: each task works on about a megabyte of
    text at a time, or on one longer text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = _merges(shared.value)
        for batch in pieces(batches):
            tokens = [merges.encode(x) for x in texts_of(batch)]
            count = pa.array([len(x) // 4 for x in tokens], pa.int64())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], count, pa.array(tokens, pa.binary())], names=["doc_id", "n_tokens", "tokens"])

    return docs.select("doc_id", "text").mapInArrow(encode, id_and(docs, "n_tokens long, tokens binary"))


def decode_tokens(encoded: DataFrame, model: bytes) -> DataFrame:
    """`encoded` (any columns, among them `tokens` as `encode_texts` gives them) with
    the column `decoded`: the text that the library makes of the ids. Null
    tokens are none and give an empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = _library(shared.value)
        for batch in pieces(batches, column="tokens"):
            # The ids as Python numbers weigh ten times as much: those of one row at a time.
            decoded = [library.decode(np.frombuffer(x or b"", "<u4").tolist()) for x in batch["tokens"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.string())], names=[*batch.schema.names, "decoded"])

    return encoded.mapInArrow(decode, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())]))
