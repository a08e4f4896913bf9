"""Toxicity: disguised words are restored by a noisy channel, then the restored text is scored."""

from __future__ import annotations

import re
from array import array
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import count as numbers
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frameweir.llm.common import id_and, labelled_once, pieces, row_id, texts_of
from frameweir.operators.joins import lookup_join
from frameweir.session import stored

# What a writer may have meant by a character: the letters it stands for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "*": "aeiou", "#": "h", "(": "c", "£": "l",
}

# Log probabilities of the channel: a letter written as another sign, a sign or
# a blank put in, a letter written once more, and a sign that means itself.
SWAPPED, ADDED, AGAIN, ITSELF = -1.5, -1.0, -1.0, -6.0

LETTERS = "a-zß-öø-ž"
PLAIN = re.compile(f"[{LETTERS}]+")
RUN = re.compile(r"(.)\1\1")
EDGES = re.compile(r"^(?:[.,;:?\"'()\[\]]|([^\w\s])\1+)+|(?:[.,;:?\"'()\[\]]|([^\w\s])\2+|!(?=$))+$")
DOUBLED = re.compile(r"(.)\1")
NO_LETTERS = re.compile(r"^[.,;:?\"')\[\]]+|[.,;:?\"')(\[\]]+$")  # edges that stand for no letter
STANDS = set("$@€£|+#")  # signs that are no punctuation of a word
SPACED = re.compile(r"(?<!\S)[^\s.,;:?](?:\s+[^\s.,;:?]){2,}(?!\S)")
PUNCTUATION = ".,;:?\"'"  # edges that stand for no letter, whatever stands between them
PART, NEAR = 4, 2  # most characters of a part of a split word, parts looked at on each side
ALONE = b"\1\1\1"  # in the lengths of a text's tokens, where SPACED may match
PARTS, NO_PART = 100_000, ("", False)  # short tokens remembered
SEEN, FREQUENT, WORDS = 2, 20, 50_000  # a reading must be seen, a frequent word isn't read; how many are kept

PREFIXES = range(3, 9)  # lengths of the word beginnings that are features, beside whole words
LEVELS = (0.5, 0.7, 0.9)
# Words remembered where only numbers of known features are kept of each, mostly none.
SCORED = 120_000
HELD = 200_000  # counts held in a task before they are handed on
PAIRS = 1 << 18  # words of texts that are counted at a time
CACHE, LONG_RUN = 15_000, 64  # words whose features a task remembers (twice as many at most), longest run of single characters


# ---- the character model and the decoder --------------------------------------------


class Letters:
    """A character model: trigrams mixed with bigrams, characters and a floor.

    It is trained on words with two blanks before and one behind, so that
    a blank ends a word and begins another.
    """

    def __init__(self, grams: dict[str, int], words: dict[str, int] | None = None):
        self.words = words or {}  # plain words and how often the sample has them
        self.parts: dict[str, tuple[str, bool]] = {}  # short tokens: see part()
        one, two, three = Counter(), Counter(), Counter(grams)
        before2, before1 = Counter(), Counter()
        for gram, n in grams.items():
            one[gram[2]] += n
            two[gram[1:]] += n
            before2[gram[:2]] += n
            before1[gram[1]] += n
        total = max(1, sum(one.values()))
        self.cost: dict[str, float] = {}
        self.one, self.two, self.three = one, two, three
        self.before2, self.before1, self.total = before2, before1, total

    def part(self, token: str) -> tuple[str, bool]:
        """A short token without its edges, '' if it is no part of a word, and whether
        it is no frequent word of the sample."""
        found = self.parts.get(token)
        if found is None:
            core = token if PLAIN.fullmatch(token) else EDGES.sub("", token)
            if not core or len(core) > PART:
                found = NO_PART
            else:
                found = core, self.words.get(core, 0) < FREQUENT and bool(PLAIN.search(core))
            if len(self.parts) >= PARTS:
                self.parts.clear()
            self.parts[token] = found
        return found

    def plain(self, word: str) -> bool:
        """Whether the sample has the word, and not mostly with a letter once less."""
        seen = self.words.get(word, 0)
        if seen < SEEN:
            return False
        less = (word[:m.start()] + word[m.start() + 1 :] for m in DOUBLED.finditer(word))
        return seen >= FREQUENT or all(self.words.get(x, 0) < 10 * seen for x in less)

    def log(self, context: str, char: str) -> float:
        key = context + char
        if key not in self.cost:
            p = 1e-4 + 0.1 * self.one[char] / self.total
            p += 0.3 * self.two[key[1:]] / max(1, self.before1[context[1]])
            p += 0.6 * self.three[key] / max(1, self.before2[context])
            self.cost[key] = float(np.log(p))
        return self.cost[key]


@lru_cache(4096)
def _choices(char: str, again: bool) -> tuple[tuple[str, float], ...]:
    """What may have been meant by a character, `again` if it stands behind itself;
    '' means nothing."""
    if char == " ":
        return (" ", 0.0), ("", ADDED)
    if PLAIN.fullmatch(char):
        return ((char, 0.0), ("", AGAIN)) if again else ((char, 0.0),)
    found = [(x, SWAPPED) for x in LEET.get(char, "")] + [(char, ITSELF)]
    if not char.isalnum():
        found.append(("", ADDED))
    elif again:
        found.append(("", AGAIN))
    return tuple(found)


def _options(text: str, at: int) -> tuple[tuple[str, float], ...]:
    """What may have been meant by the character of `text` at a place."""
    return _choices(text[at], at > 0 and text[at - 1] == text[at])


def _lattice(text: str) -> Iterator[tuple[tuple[str, float], ...]]:
    """The options at each character of `text`."""
    return map(_choices, text, map(eq, text, "\0" + text))


def _once(text: str, model: Letters) -> str | None:
    """What `decode` makes of a plain word, where each doubled letter is judged by itself:
    none stands there three times, or so near another that both change one
    trigram. Else, or if it is a near tie, None."""
    if RUN.search(text):
        return None
    log, signs = model.log, f"  {text} "
    kept, last = signs, len(signs)
    for m in reversed([*DOUBLED.finditer(text)]):
        at = m.end() + 1  # of the second letter
        if last - at < 3:
            return None
        last = at
        a, b, c = signs[at - 2], signs[at], signs[at + 1]
        gain = log(a + b, b) + log(b + b, c) - log(a + b, c) - AGAIN
        if abs(gain) < 1e-9:
            return None
        if gain < 0:
            kept = kept[:at] + kept[at + 1 :]
    return kept[2:-1]


def decode(text: str, model: Letters) -> str:
    """The likeliest text behind `text` (lower case): Viterbi over the lattice of
    options, with the last two restored characters as state."""
    if PLAIN.fullmatch(text) and (word := _once(text, model)) is not None:
        return word
    known, log = model.cost, model.log
    best = {"  ": (0.0, None)}  # state -> score, (character, what came before)
    for options in _lattice(text):
        reached: dict[str, tuple] = {}
        for state, (score, path) in best.items():
            for char, cost in options:
                if char:
                    gain = known.get(state + char)
                    value = score + cost + (log(state, char) if gain is None else gain)
                    after, way = ("  " if char == " " else state[1] + char), (char, path)
                else:
                    value, after, way = score + cost, state, path
                held = reached.get(after)
                if held is None or value > held[0]:
                    reached[after] = (value, way)
        best = reached
    _, path = max(best.items(), key=lambda x: (x[1][0] + log(x[0], " "), x[0]))[1]
    chars = []
    while path:
        chars.append(path[0])
        path = path[1]
    return "".join(reversed(chars))


class Beginnings:
    """The known features as a tree: `whole` words, `begun` ones that any word with
    that beginning has, and all `ways` there."""

    def __init__(self, known: dict[str, int]):
        self.whole = {x for x in known if not x.endswith("…")}
        self.begun = {x[:-1] for x in known if x.endswith("…")}
        self.ways = {x[:n] for x in self.whole | self.begun for n in range(len(x) + 1)}

    def read(self, text: str) -> bool:
        """Whether a reading of `text` has a known feature, by walking tree and lattice
        side by side."""
        reached, ways = {""}, self.ways
        for options in _lattice(text):
            reached = {y for x in reached for char, _ in options if (y := x + char) in ways}
            if not reached:
                return False
            if not self.begun.isdisjoint(reached):
                return True
        return not self.whole.isdisjoint(reached)

    def features(self, word: str) -> list[str]:
        """The known features of a word."""
        if len(word) < 2 or word[:3] not in self.ways:
            return []
        ways, begun = self.ways, self.begun
        found = [word] if word in self.whole else []
        for n in range(PREFIXES[0], min(len(word), PREFIXES[-1]) + 1):
            begin = word[:n]
            if begin in begun:
                found.append(begin + "…")
            elif begin not in ways:
                break
        return found

    def has(self, word: str) -> bool:
        """Whether a word has a known feature."""
        if len(word) < 2 or word[:3] not in self.ways:
            return False
        if word in self.whole:
            return True
        ways, begun = self.ways, self.begun
        for n in range(PREFIXES[0], min(len(word), PREFIXES[-1]) + 1):
            begin = word[:n]
            if begin in begun:
                return True
            if begin not in ways:
                return False
        return False

    def may_have(self, token: str) -> bool:
        """Whether one of the readings that `restore` chooses from has a known feature.
        If none has, the token needs no decoding."""
        core, wide = EDGES.sub("", token), NO_LETTERS.sub("", token)
        if self.has(core) or self.read(wide):  # `wide` is one of its own readings
            return True
        stands = wide[:1] in STANDS or wide[-1:] in STANDS
        return stands and any(map(self.read, _edges_read(wide)))


def _edges_read(text: str) -> Iterator[str]:
    """`text` with the signs at its edges written as letters that they stand for,
    a run of them as one letter or as many."""
    head = re.match(r"([^\w\s])\1*", text)
    tail = re.search(r"([^\w\s])\1*$", text)
    fronts = [x * n for x in LEET.get(head[1], "") for n in sorted({1, len(head[0])})] if head and head[1] in STANDS else []
    backs = [x * n for x in LEET.get(tail[1], "") for n in sorted({1, len(tail[0])})] if tail and tail[1] in STANDS else []
    start, end = len(head[0]) if fronts else 0, len(text) - len(tail[0]) if backs else len(text)
    for front in fronts or [""]:
        for back in backs or [""]:
            yield front + text[start:end] + back


def restore(token: str, model: Letters) -> str:
    """A token without its disguise. Words of the sample (see `Letters.plain`) and plain words
    without a doubled letter, also between punctuation or runs of signs, are taken
    as they are; the others are decoded, with signs at the edges that may stand for
    a letter. A token without any plain letter is read only as a word of the sample,
    and one of digits only is a number."""
    if PLAIN.fullmatch(token) and (not DOUBLED.search(token) or model.plain(token)):
        return token
    core = EDGES.sub("", token)
    wide = NO_LETTERS.sub("", token)
    telling = wide != core and bool({wide[:1], wide[-1:]} & STANDS)
    if not telling and model.plain(core):
        return core
    if not PLAIN.search(core):
        if not any(c in LEET and not c.isdigit() for c in wide):
            return core
        readings = (decode(x, model) for x in (*_edges_read(wide), wide))
        return next((x for x in readings if model.words.get(x, 0) >= SEEN), core)
    if PLAIN.fullmatch(wide) and not DOUBLED.search(wide):
        return wide
    if telling:
        for text in _edges_read(wide):
            word = decode(text, model)
            if model.words.get(word, 0) >= SEEN:
                return word
    return decode(wide, model)


def _split_words(parts: list[str], rare: set, model: Letters, cache: Memory, tree: Beginnings | None) -> set:
    """Words of the sample that stand in parts among the others ('id iot'): short
    parts next to each other, one of them `rare`, decoded together. With
    a `tree` parts without any reading that has a known feature are not decoded."""
    known, words = model.parts.get, model.words
    if not rare:
        return set()

    def part(i: int) -> str:
        x = parts[i]
        return (known(x) or model.part(x))[0] if len(x) <= PART + 2 else ""

    found: set = set()
    for i in [i for i, x in enumerate(parts) if x in rare]:
        start, end = i, i + 1
        while start > max(0, i - NEAR) and part(start - 1):
            start -= 1
        while end < min(len(parts), i + NEAR + 1) and part(end):
            end += 1
        short = [part(k) for k in range(start, end)]
        for first in range(start, i + 1):
            text = "".join(short[first - start : max(i, first + 1) - start])
            for last in range(max(i, first + 1), end):
                text += short[last - start]
                if len(text) <= PART:  # mostly words that follow each other
                    continue
                if text in words:
                    found.add(text)
                elif not PLAIN.fullmatch(text):
                    word = cache.get(" " + text)
                    if word is None:
                        word = decode(text, model) if tree is None or tree.read(text) else ""
                        word = word if word in words and len(word) > PART else ""
                        cache[" " + text] = word
                    if word:
                        found.add(word)
    return found


class Memory:
    """Results by key, of which those not asked for lately are forgotten: at most
    twice `most`, the newer half is kept whenever it is full. Tokens that need no
    work are only marked as `settled`, as many again."""

    def __init__(self, most: int = CACHE):
        self.newer, self.older, self.most = {}, {}, most
        self.settled, self.before = set(), set()
        self.rare: set = set()  # of the tokens settled, those that may be parts of words

    def get(self, key: str):
        found = self.newer.get(key)
        if found is None and (found := self.older.get(key)) is not None:
            self[key] = found
        return found

    def __setitem__(self, key: str, value) -> None:
        if len(self.newer) >= self.most:
            self.newer, self.older = {}, self.newer
        self.newer[key] = value

    def settle(self, token: str, rare: bool) -> None:
        if len(self.settled) >= self.most:
            self.settled, self.before = set(), self.settled
            self.rare = {x for x in self.rare if x in self.before}
        self.settled.add(token)
        if rare:
            self.rare.add(token)

    def unsettled(self, tokens: set) -> set:
        return tokens - self.settled - self.before


def _word(token: str, model: Letters, tree: Beginnings | None) -> str:
    """A token restored; with a `tree` '' if the word has no known feature, and
    tokens that can have none aren't decoded."""
    word = token.strip(PUNCTUATION)
    if word.isascii() and word.isalpha() or PLAIN.fullmatch(word):
        if not DOUBLED.search(word):  # as `restore` takes it
            return word if tree is None or tree.has(word) else ""
        if tree is not None and not tree.has(word) and not tree.read(word):
            return ""
        word = restore(word, model)
    elif tree is None or tree.may_have(token):
        word = restore(token, model)
    else:
        return ""
    return word if tree is None or tree.has(word) else ""


def words_of(text: str, model: Letters, cache: Memory, tree: Beginnings | None = None) -> set:
    """The restored words of a text; with a `tree` those that have a known feature. A
    memory serves calls of one kind."""
    text = text.lower()
    parts = text.split()
    tokens = set(parts)
    try:
        lengths = bytes(map(len, parts))
    except ValueError:  # a token of more than 255 characters
        lengths = bytes([min(n, 255) for n in map(len, parts)])
    for run in SPACED.findall(text) if ALONE in lengths else ():
        run = " ".join(run.split())
        words = cache.get("  " + run)
        if words is None:
            words = tuple(decode(run, model).split())
            if len(run) <= LONG_RUN:
                cache["  " + run] = words
        tokens.update(words)
    rest = cache.unsettled(tokens)
    rare: set = set()
    if model.words:
        part = model.parts.get
        rare = {x for x in rest if len(x) <= PART + 2 and (part(x) or model.part(x))[1]}
        more = _split_words(parts, rare | (tokens & cache.rare), model, cache, tree)
        tokens |= more
        rest |= cache.unsettled(more)
    found = tokens - rest if tree is None else set()
    get, settled = cache.get, "" if tree is not None else None
    for token in rest:
        word = get(token)
        if word is None:
            word = _word(token, model, tree)
            if word == (token if settled is None else settled):
                cache.settle(token, token in rare)
            else:
                cache[token] = word
        if word:
            found.add(word)
    return found


def features_of(text: str, model: Letters, known: dict | None, cache: Memory | dict, tree: Beginnings | None = None) -> set:
    """The features of a text: restored words and word beginnings. With `known`
    (feature -> number) the numbers of those that are known, and with their `tree`
    tokens that can have none aren't decoded."""
    words = words_of(text, model, cache if isinstance(cache, Memory) else Memory(), tree)
    if tree is not None:
        return {known[x] for word in words for x in tree.features(word)}
    found = {word for word in words if len(word) > 1}
    for begun in beginnings(words):
        found.update([x + "…" for x in begun])
    return found if known is None else {known[x] for x in found if x in known}


def beginnings(words: set) -> Iterator[list[str]]:
    """The word beginnings of each length in PREFIXES, each once."""
    for n in reversed(PREFIXES):
        words = {x[:n] for x in words}
        yield [x for x in words if len(x) == n]


# ---- learning -----------------------------------------------------------------------


def _counted(batches: Iterator[pa.RecordBatch], cut: Callable[[str], list[str]]) -> Iterator[Counter]:
    """How often each of what `cut` finds in the lower-case texts is there, about HELD of
    them at a time."""
    counts: Counter = Counter()
    for batch in pieces(batches):
        for text in texts_of(batch):
            counts.update(cut(text.lower()))
        if len(counts) >= HELD:
            yield counts
            counts = Counter()
    yield counts


def train_letters(sample: DataFrame) -> Letters:
    """Character trigrams of the plain words of the sample, and its most frequent
    words, both from the tokens of one pass. The table is bounded by the alphabet:
    Latin letters and the blank."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens in _counted(batches, str.split):
            runs, words = Counter(), Counter()
            for token, n in tokens.items():
                word = token.strip(PUNCTUATION)
                if PLAIN.fullmatch(word):
                    runs[word] += n
                else:  # parts of disguised words are no words
                    for run in PLAIN.findall(token):
                        runs[run] += n
                    word = EDGES.sub("", token)
                    if not PLAIN.fullmatch(word):
                        continue
                if len(word) > 1 and not RUN.search(word):
                    words[word] += n
            grams: Counter = Counter()
            for run, n in runs.items():
                if not RUN.search(run):
                    padded = f"  {run} "
                    for i in range(len(run) + 1):
                        grams[padded[i : i + 3]] += n
            for counts, whole in ((grams, False), (words, True)):
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(whole, len(counts)), pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                    names=["whole", "part", "n"],
                )

    rows = sample.select("text").mapInArrow(count, "whole boolean, part string, n long")
    rows = rows.groupBy("whole", "part").agg(F.sum("n").alias("n")).where(~F.col("whole") | (F.col("n") >= SEEN))
    rows = stored(rows, "letters")
    grams = rows.where(~F.col("whole")).select("part", "n").collect()
    plain = rows.where("whole").orderBy(F.desc("n"), "part").limit(WORDS).select("part", "n")
    return Letters(dict(map(tuple, grams)), dict(map(tuple, plain.collect())))


def feature_counts(index: dict[str, int], words: array, sizes: list[int], toxic: list[bool]) -> Iterator[pa.RecordBatch]:
    """(feature, clean, toxic): in how many clean and toxic texts each word of two characters
    or more is, and each word beginning. `words` are the different words of each
    text as numbers of `index`, one text after the other, and `sizes` how many they are. In
    sorted order the words of one beginning stand together, also among those of one text."""
    known = sorted(index)
    rank = np.empty(len(known), np.int64)
    rank[np.fromiter(map(index.__getitem__, known), np.int64, len(known))] = np.arange(len(known))
    text = np.repeat(np.arange(len(sizes)), sizes)
    text, at = np.divmod(np.sort(text * len(known) + rank[np.asarray(words)]), max(1, len(known)))
    kind = np.array(toxic, bool)[text]
    length = np.fromiter(map(len, known), np.int64, len(known))
    signs = np.array(known, f"U{PREFIXES[-1]}").view(np.uint32).reshape(len(known), PREFIXES[-1])
    alike = np.logical_and.accumulate(signs[1:] == signs[:-1], axis=1).sum(axis=1)  # signs that a word begins with like the one before
    names = pa.array(known, pa.string())
    for n in (0, *PREFIXES):  # 0: the whole word
        new = np.ones(len(known), bool)
        if n:
            new[1:] = alike < n
        group = np.cumsum(new) - 1
        own = length[at] >= (n or 2)
        g, t, k = group[at[own]], text[own], kind[own]
        once = np.ones(len(g), bool)
        once[1:] = (g[1:] != g[:-1]) | (t[1:] != t[:-1])
        clean, bad = (np.bincount(g[once & x], minlength=len(known)) for x in (~k, k))
        head = np.zeros(len(known), np.int64)
        head[g] = at[own]  # any word of a group
        there = np.flatnonzero(clean + bad)
        feature = names.take(pa.array(head[there]))
        if n:
            feature = pc.binary_join_element_wise(pc.utf8_slice_codeunits(feature, 0, n), "…", "")
        yield pa.RecordBatch.from_arrays([feature, pa.array(clean[there]), pa.array(bad[there])], names=["feature", "clean", "toxic"])


def choose_features(sample: DataFrame, model: Letters, most: int) -> list[tuple[str, float]]:
    """The `most` features that tell toxic documents best, by the likelihood ratio
    of their document counts, of those more than twice as frequent in toxic
    documents as in clean ones, whatever the share of toxic labels; each with
    the share of toxic ones among its documents, drawn towards the share of all
    as if seen five times more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Memory(SCORED)

        def none() -> tuple[defaultdict, array, list, list]:
            return defaultdict(numbers().__next__), array("q"), [], []

        index, words, sizes, toxic = none()
        for batch in pieces(batches):
            for text, label in zip(texts_of(batch), batch["label"].to_pylist(), strict=True):
                own = words_of(text, model, cache)
                words.extend(map(index.__getitem__, own))
                sizes.append(len(own))
                toxic.append(label > 0)
            if len(words) >= PAIRS:
                yield from feature_counts(index, words, sizes, toxic)
                index, words, sizes, toxic = none()
        yield from feature_counts(index, words, sizes, toxic)

    rows = sample.select("text", "label").mapInArrow(count, "feature string, clean long, toxic long")
    rows = rows.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    total = sample.agg(
        F.sum((F.col("label") <= 0).cast("int")).alias("clean"), F.sum((F.col("label") > 0).cast("int")).alias("toxic")
    ).first()
    clean, toxic = total[0] or 0, total[1] or 0
    if not clean or not toxic:
        return []
    share = toxic / (clean + toxic)
    own = F.col("toxic") + F.col("clean")
    rate = F.col("toxic") / own
    gain = F.col("toxic") * F.log(rate / share) + F.when(
        F.col("clean") > 0, F.col("clean") * F.log((1 - rate) / (1 - share))
    ).otherwise(0.0)
    drawn = (F.col("toxic") + 5 * share) / (own + 5)
    told = rows.where((F.col("toxic") >= 2) & (F.col("toxic") / toxic > 2 * F.col("clean") / clean))
    told = told.select("feature", drawn.alias("rate"), gain.alias("gain"))
    top = told.orderBy(F.desc("gain"), F.length("feature"), "feature").limit(most)
    return [(x.feature, x.rate) for x in top.collect()]


def fit_weights(rows: list[list[int]], label: np.ndarray, size: int, steps: int = 800) -> np.ndarray:
    """Logistic regression on sets of features by Adam, with a small quadratic
    penalty; the last weight is the constant."""
    weights = np.zeros(size + 1)
    if not len(label):
        return weights
    at = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
    which = np.fromiter((k for x in rows for k in x), np.int64, len(at))
    weights[size] = np.log((label.sum() + 0.5) / (len(label) - label.sum() + 0.5))
    mean, square = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        value = weights[size] + np.bincount(at, weights[which], minlength=len(rows))
        error = (1 / (1 + np.exp(-np.clip(value, -30, 30))) - label) / len(label)
        slope = np.append(np.bincount(which, error[at], minlength=size), error.sum())
        slope[:size] += 1e-5 * weights[:size]
        mean += 0.1 * (slope - mean)
        square += 0.001 * (slope**2 - square)
        weights -= 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
    return weights


def fit_weights_spread(rows: DataFrame, size: int, steps: int = 200) -> np.ndarray:
    """The weights of the same regression, with the same penalty, over any number of
    rows (label, found, n): each step is a sum over all of them in Spark."""

    @F.udf(VectorUDT())
    def as_vector(found):
        return SparseVector(size, found, [1.0] * len(found))

    table = rows.select((F.col("label") > 0).cast("double").alias("label"), as_vector("found").alias("features"), F.col("n").cast("double").alias("n"))
    learner = LogisticRegression(maxIter=steps, regParam=1e-5, standardization=False, weightCol="n", family="binomial")
    model = learner.fit(table)
    return np.append(model.coefficients.toArray(), model.intercept)


class Scorer:
    """What scoring needs: the character model, the features and their weights.

    Beside each known feature, a text has a feature for each of `LEVELS` that
    the share of toxic documents of any of them reaches, so that one telling
    word is enough, also one that was mostly seen together with others.
    """

    def __init__(self, model: Letters, features: list[tuple[str, float]], weights: np.ndarray):
        self.model, self.weights = model, weights
        self.known = {x: i for i, (x, _) in enumerate(features)}
        self.tree = Beginnings(self.known)
        rates = np.array([rate for _, rate in features])
        self.levels = [[len(features) + k for k, x in enumerate(LEVELS) if rate >= x] for rate in rates]
        self.size = len(features) + len(LEVELS)
        self.learned = bool(features)  # without any, no text can be told from another

    def features(self, texts: list[str], cache: Memory) -> list[list[int]]:
        found = []
        for text in texts:
            own = features_of(text, self.model, self.known, cache, self.tree)
            found.append(sorted({*own, *(k for x in own for k in self.levels[x])}))
        return found

    def found_in(self, rows: DataFrame) -> DataFrame:
        """`rows` with the features `found` instead of `text`. Whole texts, one pass, no shuffle."""
        others = [x for x in rows.schema if x.name != "text"]
        schema = T.StructType([*others, T.StructField("found", T.ArrayType(T.IntegerType()))])

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cache = Memory(SCORED)
            for batch in pieces(batches):
                found = pa.array(self.features(texts_of(batch), cache), pa.list_(pa.int32()))
                names = [x.name for x in others]
                yield pa.RecordBatch.from_arrays([*[batch[x] for x in names], found], names=[*names, "found"])

        return rows.mapInArrow(find, schema)

    def weigh(self, rows: DataFrame, driver_rows: int) -> None:
        """Learn the weights from rows (label, found). Rows of the same label and features
        are weighed as one, and where more than `driver_rows` are left, the
        weights are fitted in Spark."""
        rows = stored(rows.groupBy("label", "found").agg(F.count(F.lit(1)).alias("n")), "found")
        # One kind of label alone has no features: the constant is all there is to fit.
        if self.learned and rows.count() > driver_rows:
            self.weights = fit_weights_spread(rows, self.size)
            return
        if not self.learned:
            rows = rows.where(F.lit(False))  # every text gets the score 0
        few = sorted((x.label, x.found, x.n) for x in rows.collect())
        each = [found for _, found, n in few for _ in range(n)]
        label = np.array([kind > 0 for kind, _, n in few for _ in range(n)], float)
        self.weights = fit_weights(each, label, self.size)

    def score_found(self, found: list[list[int]]) -> np.ndarray:
        """The scores of texts with these features."""
        if not self.learned:
            return np.zeros(len(found))
        values = np.array([self.weights[x].sum() for x in found]) + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(values, -30, 30)))

    def score(self, texts: list[str], cache: Memory) -> np.ndarray:
        return self.score_found(self.features(texts, cache) if self.learned else [[]] * len(texts))


def chosen(sample: DataFrame, max_features: int) -> Scorer:
    """A scorer with the features of the sample, and no weights yet."""
    model = train_letters(sample)
    return Scorer(model, choose_features(sample, model, max_features), np.zeros(1))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    use: Column | None = None,
    max_features: int = 4_000,
    driver_rows: int = 8_000,
) -> Scorer:
    """Learn from all labelled documents, whole texts. Counts are added up in Spark; for
    the weights see `Scorer.weigh`."""
    sample = labelled_once(docs, labels, "toxic", use=use)
    scorer = chosen(sample, max_features)
    scorer.weigh(scorer.found_in(sample.select("label", "text")), driver_rows)
    return scorer


SCHEMA = "score double, predicted int"


def _scored(doc_id: pa.Array, score: np.ndarray, threshold: float) -> pa.RecordBatch:
    predicted = (score >= threshold).astype(np.int32)
    return pa.RecordBatch.from_arrays([doc_id, pa.array(score, pa.float64()), pa.array(predicted)], names=["doc_id", "score", "predicted"])


def score_texts(docs: DataFrame, scorer: Scorer, threshold: float = 0.3) -> DataFrame:
    """One row per row of `docs` (doc_id, text; other columns are not read).

    `score` is the probability that the restored text is toxic, `predicted` is 1
    from `threshold` on. A null text is empty and gets the score of a text
    without any feature. Null ids and repeated rows are kept; an empty table
    gives an empty result. Where nothing could be learned (no labels of both
    kinds, or no feature tells them apart) every text gets the score 0. Whole texts, one pass, no shuffle.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Memory(SCORED)
        for batch in pieces(batches):
            yield _scored(batch["doc_id"], scorer.score(texts_of(batch), cache), threshold)

    return docs.select("doc_id", "text").mapInArrow(measure, id_and(docs, SCHEMA))


def fitted_scores(
    docs: DataFrame,
    labels: DataFrame,
    use: Column | None = None,
    threshold: float = 0.3,
    max_features: int = 4_000,
    driver_rows: int = 8_000,
) -> DataFrame:
    """`score_texts` of `docs` by what `fit` learns from them. The features of each text
    are found once and kept: those of labelled texts serve the weights, then all
    are scored. Labels reach them by a key made of id and text, on narrow rows."""
    sample = labelled_once(docs, labels, "toxic", use=use, named=True)
    scorer = chosen(sample, max_features)
    if not scorer.learned:
        return score_texts(docs, scorer, threshold)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = stored(scorer.found_in(texts.withColumn("rid", row_id())), "found")
    known = lookup_join(found.select("rid", "found"), sample.select("rid", "label"), ["rid"], "inner")
    once = known.groupBy("rid").agg(F.first("label").alias("label"), F.first("found").alias("found"))  # a row may be there twice
    scorer.weigh(once, driver_rows)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = scorer.score_found(batch["found"].to_pylist())
            yield _scored(batch["doc_id"], score, threshold)

    return found.select("doc_id", "found").mapInArrow(measure, id_and(docs, SCHEMA))


def without_toxic(docs: DataFrame, scorer: Scorer, threshold: float = 0.3) -> DataFrame:
    """`docs` with all its columns, without the rows whose score reaches `threshold`;
    all rows where nothing could be learned."""
    if not scorer.learned:
        return docs

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Memory(SCORED)
        for batch in pieces(batches):
            yield batch.filter(pa.array(scorer.score(texts_of(batch), cache) < threshold))

    return docs.mapInArrow(keep, docs.schema)
