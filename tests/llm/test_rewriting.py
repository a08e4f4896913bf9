"""Fill-in-middle, subwords and spelling variants against plain versions of each."""

import hashlib
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frameweir.llm import middle, queries, spelling, subwords

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def documents(spark, folder):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]


def sha(data):
    return hashlib.sha256(data).hexdigest()


# ---- fill-in-middle -----------------------------------------------------------------


def cut(doc_id, text):
    """Form, n, code points of prefix and middle, and the output."""
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return "plain", len(units), None, None, text
    if h[3] % 100 < 80:
        return "spm", len(units), len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return "psm", len(units), len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def odd_texts(count):
    draw = random.Random(5)
    parts = [" ", "\t", "\n\r", "\x0b\x0c", "a", "word", "é", "语言", "\U0001f600", "\x85", "\xa0", "\x1f", "\x00", "<", "P>", "<S", "\x7f", "!"]
    return ["".join(draw.choice(parts) for _ in range(draw.randint(0, 40))) for _ in range(count)]


def test_units_of_many_texts():
    texts = odd_texts(500) + ["", " ", "x" * 100_000, "x " * 50_000]
    units = middle.Units([x.encode() for x in texts])
    for k, text in enumerate(texts):
        found = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
        assert units.count[k] == len(found)
    for share in (0, 0.3, 0.7, 1):
        after = (units.count * share).astype(int)
        places = units.cut(after)
        chars = units.characters_between(np.zeros_like(places), places)
        for k, text in enumerate(texts):
            found = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
            head = "".join(found[: after[k]])
            assert (places[k], chars[k]) == (len(head.encode()), len(head))


def test_texts_are_cut_and_restored(spark):
    rows = list(enumerate(odd_texts(400))) + [(None, "no id here"), (1000, None), (1001, ""), (1001, ""), (1002, "a <M> b"), (1003, "w " * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"form": F.lit(1), "key": F.lit(2)})
    got = middle.fill_in_middle(docs).withColumn("back", middle.restored(F.col("output"), F.col("form"))).collect()
    plain = sorted(map(repr, [(i, *cut(i, x)) for i, x in rows]))
    assert sorted(repr((r.doc_id, r.form, r.n, r.prefix_chars, r.middle_chars, r.output)) for r in got) == plain
    assert sorted(r.back for r in got) == sorted(x or "" for _, x in rows)
    assert {r.form for r in got} == {"plain", "spm", "psm"}
    assert middle.fill_in_middle(docs.limit(0)).count() == 0


def test_other_rates_and_sentinels(spark):
    docs = spark.createDataFrame([(i, f"one two three {i}") for i in range(200)], "doc_id long, text string")
    marks = ("|pre", "|suf", "|mid")
    got = middle.fill_in_middle(docs, seed=7, percent=100, suffix_first=0, sentinels=marks)
    got = got.withColumn("back", middle.restored(F.col("output"), F.col("form"), marks)).collect()
    assert all(r.form == "psm" and r.output.startswith("|pre") and r.back == f"one two three {r.doc_id}" for r in got)
    with pytest.raises(ValueError):
        middle.fill_in_middle(docs, sentinels=("aa", "b", "c"))


def test_middle_query(spark, folder):
    got = {r.doc_id: r for r in queries.op13_fill_in_middle(spark, folder).collect()}
    for doc_id, text in documents(spark, folder):
        form, n, pre, mid, output = cut(doc_id, text)
        r = got[doc_id]
        assert (r.form, r.n, r.prefix_chars, r.middle_chars, r.output_sha256) == (form, n, pre, mid, sha(output.encode()))
        assert r.restored_sha256 == sha((text or "").encode())


# ---- subwords -----------------------------------------------------------------------


def test_decoding_holds_few_texts(monkeypatch):
    """A batch from Spark is decoded in slices, however many tokens it holds."""
    library = subwords._library(subwords.read_model(MODEL))
    texts = [f"{k} some words that are " * 40 for k in range(5000)]
    tokens = [np.array(library.encode(x), "<u4").tobytes() for x in texts] + [None]
    held = []

    class Encoded:
        sparkSession = type("S", (), {"sparkContext": type("C", (), {"broadcast": staticmethod(lambda x: type("B", (), {"value": x}))})})
        schema = T.StructType([T.StructField("tokens", T.BinaryType())])
        mapInArrow = staticmethod(lambda run, schema: held.append(run))

    subwords.decode_tokens(Encoded, subwords.read_model(MODEL))
    out = list(held[0](iter([pa.RecordBatch.from_pydict({"tokens": pa.array(tokens, pa.binary())})])))
    assert len(out) > 2 and max(b["tokens"].nbytes for b in out) < 2 << 20
    assert [x for b in out for x in b["decoded"].to_pylist()] == [*map(library.decode, map(library.encode, texts)), ""]


@pytest.fixture(scope="module")
def merges():
    return subwords.Merges(subwords.read_model(MODEL))


def test_ids_are_those_of_the_library(merges):
    draw, known = random.Random(3), list(merges.score)
    texts = ["", " ", "▁", "a▁ b", "\n\n\t", "=" * 5000, "ab" * 3000, " " * 1000 + "x", "<s></s><unk><0x41>", "\x00�　"]
    for _ in range(1500):
        size = draw.randint(1, 25)
        texts.append("".join(draw.choice(known).replace("▁", " ") for _ in range(size)))
        texts.append("".join(draw.choice("the in er") for _ in range(3 * size)))
        texts.append("".join(chr(draw.choice([draw.randint(1, 0x2FF), draw.randint(0x400, 0x9FFF), 32, 0x2581, 0x1F600])) for _ in range(size)))
        texts.append(" " * draw.randint(0, 60) + draw.choice("xe\t") + " " * draw.randint(0, 60))
    texts.append("".join(draw.choice("etaoinshr") for _ in range(50_000)))  # one stretch
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for text in texts:
        ids = np.frombuffer(merges.encode(text), "<u4").tolist()
        assert ids == library.encode(text, add_bos=True, add_eos=True), text[:80]
        # and as a whole, not stretch by stretch
        whole = merges.encode_stretch(library.normalize(text))
        assert ids[1:-1] == np.frombuffer(whole, "<u4").tolist()


def test_stretches_are_split_once(merges, monkeypatch):
    """A worker remembers the rare words of many texts; a piece needs no search."""
    words = [f"word{k}" for k in range(200_000)]
    before = merges.encoded.cache_info().misses
    first = [merges.encode(" ".join(words[k : k + 1000])) for k in range(0, len(words), 1000)]
    assert [merges.encode(" ".join(words[k : k + 1000])) for k in range(0, len(words), 1000)] == first
    assert merges.encoded.cache_info().misses - before <= len(words)
    monkeypatch.setattr(merges, "matches", None)
    assert merges.split("▁the") == ["▁the"]


def test_backtracking_meets_failed_places():
    """Pieces for which the longest match leads nowhere: `abc` and `bcd` merge late."""
    made = subwords.Merges.__new__(subwords.Merges)
    made.score = {x: -k for k, x in enumerate(["cd", "ab", "bcd", "abc", "a", "b", "c", "d"])}
    made.ids = {x: k for k, x in enumerate(made.score)}
    made.history = {x: made._history(x) for x in made.ids}
    made.ids = {x: k for x, k in made.ids.items() if made.history[x][1][-1] == x}
    made.shorter = {x: next((k for k in range(len(x) - 1, 1, -1) if x[:k] in made.ids), 1) for x in made.ids if len(x) > 1}
    made.matches = subwords.ahocorasick.Automaton()
    for x in made.ids:
        made.matches.add_word(x, len(x))
    made.matches.make_automaton()
    made.fits = made._fits

    def merged(text):
        parts = list(text)
        while True:
            pairs = [made.score.get(a + b, -99) for a, b in zip(parts, parts[1:])]
            if not pairs or max(pairs) == -99:
                return parts
            k = pairs.index(max(pairs))
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    draw = random.Random(1)
    for _ in range(3000):
        text = "".join(draw.choice("abcdx") for _ in range(draw.randint(1, 14)))
        assert made.split(text) == merged(text), text


def test_subword_rows(spark):
    rows = [(1, "Hello  world"), (2, None), (3, ""), (3, ""), (None, "no id"), (4, "长 text \U0001f600\n"), (5, "x" * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"tokens": F.lit(1), "decoded": F.lit(2)})
    model = subwords.read_model(MODEL)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = subwords.decode_tokens(subwords.encode_texts(docs, model), model).collect()
    plain = [(i, library.encode(x or "", add_bos=True, add_eos=True)) for i, x in rows]
    assert sorted(repr((r.doc_id, np.frombuffer(r.tokens, "<u4").tolist(), r.decoded)) for r in got) == sorted(repr((i, k, library.decode(k))) for i, k in plain)
    assert subwords.encode_texts(docs.limit(0), model).count() == 0


def test_subword_query(spark, folder):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = {r.doc_id: r for r in queries.op12_subwords(spark, folder).collect()}
    for doc_id, text in documents(spark, folder):
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        r = got[doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(np.array(ids, "<u4").tobytes()))
        assert r.decoded_sha256 == sha(library.decode(ids).encode())


# ---- spelling variants --------------------------------------------------------------


def spelled(rows, shortest=7, least=2):
    """The operator written out; near words are looked up among all edits of a word."""
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    n = {w: k for w, k in found.items() if len(w) >= shortest and k >= least}
    letters, near = sorted({c for w in n for c in w}), {}
    for w in n:
        cuts = [(w[:k], w[k:]) for k in range(len(w) + 1)]
        edits = {a + b[1:] for a, b in cuts if b} | {a + c + b[1:] for a, b in cuts if b for c in letters} | {a + c + b for a, b in cuts for c in letters}
        near[w] = [x for x in edits if x in n and x != w]
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root))
    return sorted(out)


def as_rows(table):
    return sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in table.collect())


def test_spelling_query(spark, folder):
    got = as_rows(queries.op11_spelling(spark, folder))
    assert got == spelled(documents(spark, folder)) and any(r[3] for r in got)


def test_every_edit_is_found(spark):
    """All words one edit from some others, of odd and even lengths, with doubled letters."""
    draw, words = random.Random(11), set()
    for size in (7, 8, 9, 12, 13):
        for alphabet in ("ab", "abcdeé"):
            word = "".join(draw.choice(alphabet) for _ in range(size))
            words |= {word, *(word[:k] + word[k + 1 :] for k in range(size)), *(word[:k] + c + word[k:] for k in range(size + 1) for c in "aéz"), *(word[:k] + c + word[k + 1 :] for k in range(size) for c in "bz")}
    rows = [(k, f"{w} {w}" + f" {w}" * draw.choice([0, 0, 0, 9, 40, 400])) for k, w in enumerate(sorted(words))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert as_rows(spelling.spelling_groups(docs)) == spelled(rows)


def test_chains_of_forms(spark):
    """a <- b <- c <- d, each ten times as frequent as the one before."""
    words = ["abcdefgh", "abcdefgx", "abcdefyx", "abcdezyx"]
    forms = spark.createDataFrame(list(zip(words, words[1:])), "word string, form string")
    assert {r.word: r.root for r in spelling.roots(forms).collect()} == dict.fromkeys(words[:3], words[3])
    rows = [(1, " ".join(w for k, w in enumerate(words) for _ in range(3 * 12**k)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert as_rows(spelling.spelling_groups(docs)) == spelled(rows)


def test_spelling_edges(spark):
    rows = [(1, None), (2, ""), (None, "Straßen STRASSEN strassen Ärzteös ärzteös"), (3, "x" * 200 + " " + "x" * 200 + " " + "x" * 199 + " " + "x" * 199), (4, "eins zwei"), (4, "eins zwei")]
    rows += [(5, "ÀÀÀÀÀÀÀ àààààà× àààààà× naïvement naïvemént naïvement")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"word": F.lit("mine"), "n": F.lit(1), "key": F.lit(2)})
    assert as_rows(spelling.spelling_groups(docs)) == spelled(rows)
    none = spelling.spelling_groups(docs.limit(0))
    assert none.count() == 0 and none.columns == ["word", "n", "n_near", "form", "form_n", "root"]
