"""Spelling variants: words one edit apart, found by chunks that the edit leaves whole."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameweir.llm.common import pieces, texts_of
from frameweir.session import stored

# Words are counted inside a task until so many have gathered, then handed on.
GATHERED = 1 << 17

# Fixed value: characters of words, after lower-casing.
LETTERS = "a-zÀ-ÿ"


# ---- words --------------------------------------------------------------------------


def word_counts(docs: DataFrame, shortest: int, least: int, every: int) -> DataFrame:
    """(word, n): the words of at least `shortest` characters that occur `least` times.

    Words are the runs of letters of whole texts, A-Z lower-cased. A run loses a
    character where the crc32 of `<doc_id>:<run>` is a multiple of `every`.
    Each task counts its own words before they are shuffled.
    """
    run = re.compile(f"[{LETTERS}]{{{shortest},}}")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()

        def gathered() -> pa.RecordBatch:
            words, counts = list(found.keys()), list(found.values())
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64())], names=["word", "n"])

        for batch in pieces(batches):
            for key, text in zip(batch["key"].to_pylist(), texts_of(batch), strict=True):
                begin = crc32(f"{key or ''}:".encode())
                # Bytes lower-case A-Z only.
                for word, n in Counter(run.findall(text.encode().lower().decode())).items():
                    h = crc32(word.encode(), begin)
                    if h % every == 0:
                        place = h % len(word)
                        word = word[:place] + word[place + 1 :]
                        if len(word) < shortest:
                            continue
                    found[word] += n
                if len(found) >= GATHERED:
                    yield gathered()
        if found:
            yield gathered()

    rows = docs.select(F.col("doc_id").cast("string").alias("key"), "text").mapInArrow(counted, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# ---- pairs --------------------------------------------------------------------------


def _cuts(size: Column) -> list[Column]:
    """Where the chunks of a word of that size begin and end: two halves, each of them
    two chunks in turn."""
    half = F.floor(size / 2).cast("int")
    return [F.lit(0), F.floor(half / 2).cast("int"), half, half + F.floor((size - half) / 2).cast("int"), size]


def _without(word: Column, own: Column, size: Column, k: int) -> Column:
    """Key of the chunks that are whole if the edit is in chunk k: those before it from
    the word's beginning, those after it from its end. `own` is the word's
    length, `size` that of the word which is chunked."""
    cuts = _cuts(size)
    tail = size - cuts[k + 1]
    before = F.substring(word, F.lit(1), cuts[k])
    after = F.substring(word, own - tail + 1, tail)
    return F.xxhash64(size, F.lit(k), before, after)


def near_pairs(words: DataFrame) -> DataFrame:
    """(long, long_n, short, short_n): each pair of `words` (word, n; each word once) that
    differ by one inserted, deleted or replaced character, once; of two words of
    one length `short` is the one that sorts first.

    The longer word gives two disjoint chunks, its halves. One edit leaves one
    of them whole, and the other word has it among its grams: in the same
    place, or one place off if it is shorter. The half with the edit is chunked
    again the same way, so that three quarters of a word must be found in
    place: a beginning or ending that many words share doesn't bring them all
    together. Grams that are more than one place off a chunk can meet none and
    aren't made. What meets is compared letter by letter.
    """
    sized = words.withColumn("size", F.char_length("word"))
    size, word = F.col("size"), F.col("word")
    chunks = F.explode(F.array(*[_without(word, size, size, k) for k in range(4)])).alias("key")
    grams = F.explode(F.array(*[_without(word, size, size + d, k) for d in (0, 1) for k in range(4)])).alias("key")
    left = sized.select(chunks, F.col("word").alias("long"), F.col("n").alias("long_n"))
    right = sized.select(grams, F.col("word").alias("short"), F.col("n").alias("short_n"))
    shorter = F.char_length("short") < F.char_length("long")
    met = left.join(right, "key").where(shorter | (F.char_length("short") == F.char_length("long")) & (F.col("short") < F.col("long")))
    near = met.where(F.levenshtein("long", "short", 1) == 1).select("long", "long_n", "short", "short_n")
    return near.distinct()  # a pair may have more than one chunk in common


# ---- forms --------------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): for `forms` (word, form) the end of each chain of forms. Each round
    doubles the steps, so a chain of m forms takes log m rounds; each round is a
    table in the shared folder."""
    state = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = state.select(F.col("word").alias("root"), F.col("root").alias("further"))
        state = stored(state.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if not state.where("moved").take(1):
            return state.select("word", "root")
        state = state.drop("moved")


def spelling_groups(docs: DataFrame, shortest: int = 7, least: int = 2, every: int = 31, times: int = 10) -> DataFrame:
    """One row per word of `docs` (doc_id, text; other columns are not read):
    word, n, n_near, form, form_n, root.

    Words are those of `word_counts`; near words differ by one edit. A word's
    form is the most frequent of its near words, of several the first in
    code-point order, if it occurs at least `times` as often as the word; else
    null. The root is where forms lead to, the word itself if it has none.
    Null and empty texts have no words, a null id counts as empty text, repeated
    rows count each time, an empty table gives an empty result.
    """
    words = stored(word_counts(docs, shortest, least, every), "words")
    pairs = stored(near_pairs(words), "pairs")
    ends = [("long", "short"), ("short", "long")]
    both = [pairs.select(F.col(a).alias("word"), F.struct((-F.col(f"{b}_n")).alias("rank"), F.col(b).alias("other")).alias("near")) for a, b in ends]
    best = both[0].unionByName(both[1]).groupBy("word").agg(F.count("*").alias("n_near"), F.min("near").alias("best"))
    rows = words.join(best, "word", "left")
    enough = -F.col("best.rank") >= F.col("n") * times
    rows = rows.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(enough, F.col("best.other")).alias("form"),
        F.when(enough, -F.col("best.rank")).alias("form_n"),
    )
    rows = stored(rows, "forms")
    ended = roots(rows.where(F.col("form").isNotNull()))
    return rows.join(ended, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
