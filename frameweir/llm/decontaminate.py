"""Benchmark decontamination by winnowing, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frameweir.llm.common import ascii_lower, row_columns, row_id, with_row, without
from frameweir.session import stored

# Fixed pattern: what stands between words after A-Z were lower-cased.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Most benchmark fingerprints that are sent to every executor; more are shuffled.
BROADCAST_ROWS = 2_000_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAP), "")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def winnowed(words: Column, window: int, gram: int) -> Column:
    """For each word place the hash of the `gram` words from there, if it is the
    minimum of some `window - gram + 1` hashes in a row, else null.

    Any `window` consecutive words hold that many hashes, so at least one of
    them is kept, and the same one wherever the same words stand.
    """
    width = window - gram + 1

    def grams(hashes: Column) -> Column:
        count = F.size(hashes) - (gram - 1)
        each = F.transform(hashes, lambda x, i: F.xxhash64(*[x, *(F.get(hashes, i + k) for k in range(1, gram))]))
        return F.when(count > 0, F.slice(each, 1, F.greatest(count, F.lit(0)))).otherwise(F.array().cast("array<bigint>"))

    def minima(own: Column) -> Column:
        count = F.size(own) - (width - 1)
        each = F.transform(own, lambda x, i: F.least(*[x, *(F.get(own, i + k) for k in range(1, width))]))
        return F.when(count > 0, F.slice(each, 1, F.greatest(count, F.lit(0)))).otherwise(F.array().cast("array<bigint>"))

    def chosen(own: Column) -> Column:
        if width == 1:
            return own
        return bound(
            minima(own),
            lambda low: F.transform(
                own,
                lambda x, i: F.when(x == F.greatest(*[F.get(low, i - k) for k in range(width)]), x),
            ),
        )

    hashes = F.transform(words, lambda x: F.xxhash64(x))
    return bound(hashes, lambda h: bound(grams(h), chosen))


def item_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """(item_id, width, content): the windows of each item as text; an item of fewer
    words is one window, an item without words has none."""
    items = benchmark.select(F.col("item_id"), words_of(F.col("text")).alias("words")).where("size(words) > 0")
    width = F.least(F.size("words"), F.lit(window))
    items = items.withColumn("width", width)
    places = F.explode(F.sequence(F.lit(1), F.size("words") - F.col("width") + 1))
    content = F.array_join(F.slice("words", F.col("at"), F.col("width")), " ")
    return items.select("item_id", "width", "words", places.alias("at")).select(
        "item_id", "width", content.alias("content")
    )


def gram_of(width: int, gram: int) -> int:
    return min(width, gram)


def hit_windows(docs: DataFrame, windows: DataFrame, widths: list[int], gram: int, limit: int) -> DataFrame:
    """(key, start, width, content): the places in documents where an item's window
    occurs. `docs` has key and text, `windows` distinct width and content."""
    found = None
    for width in widths:
        k = gram_of(width, gram)
        content = windows.where(F.col("width") == width).select("content")
        own = winnowed(F.split("content", " "), width, k)
        marks = content.select(F.explode(own).alias("mark")).where("mark is not null").distinct()
        words = docs.select("key", words_of(F.col("text")).alias("words"))
        rows = words.select("key", "words", F.posexplode(winnowed(F.col("words"), width, k)).alias("place", "mark"))
        rows = rows.where("mark is not null")
        marks = stored(marks, "marks")
        if marks.count() <= limit:
            hits = rows.join(F.broadcast(marks), "mark", "left_semi").select("key", "words", "place")
        else:  # narrow rows are shuffled; only documents with a hit are looked at again
            narrow = rows.select("key", "place", "mark").join(marks, "mark", "left_semi").select("key", "place")
            hits = words.join(stored(narrow, "hits").hint("merge"), "key")
        # extend each hit to every window around it that the item's hash may stem from
        shift = F.explode(F.sequence(F.lit(0), F.lit(width - k))).alias("shift")
        spans = hits.select("key", "words", "place", shift).withColumn("start", F.col("place") - F.col("shift"))
        spans = spans.where((F.col("start") >= 0) & (F.col("start") + width <= F.size("words")))
        text = F.array_join(F.slice("words", F.col("start") + 1, F.lit(width)), " ")
        spans = spans.select("key", "start", F.lit(width).alias("width"), text.alias("content")).distinct()
        spans = spans.join(content, "content", "left_semi").select("key", "start", "width", "content")
        found = spans if found is None else found.unionByName(spans)
    return found


def all_hits(docs: DataFrame, windows: DataFrame, gram: int, limit: int) -> DataFrame | None:
    """`hit_windows` for all windows of the items; None if the items have none."""
    widths = sorted(x[0] for x in windows.select("width").distinct().collect())  # a handful of numbers
    if not widths:
        return None
    keyed = docs.select(row_id().alias("key"), "text")
    distinct = windows.select("width", "content").distinct()
    return stored(hit_windows(keyed, distinct, widths, gram, limit), "hits").distinct()


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, gram: int = 6, limit: int = BROADCAST_ROWS
) -> DataFrame:
    """One row per row of `docs` (doc_id, text; other columns are not read):

    doc_id, n_words, n_hit (words inside an occurrence of an item's window),
    n_items, items_sha256, contaminated (n_hit > 0), and `items`, `spans` (the
    ids, sorted as text, and the ranges of hit words, end exclusive).

    Hashes only find candidates; the words of a window are compared as text.
    A null text has no words, nor do texts of blanks and signs; items without
    words never hit. Windows of items with a null id hit but are not counted in
    n_items; repeated items count once. Repeated rows get equal results, null
    ids are kept, an empty table gives an empty result.
    """
    keyed = docs.select("doc_id", row_id().alias("key"), "text")
    counted = keyed.select("doc_id", "key", F.size(words_of(F.col("text"))).cast("bigint").alias("n_words"))
    none = F.sha2(F.lit(""), 256)
    windows = stored(item_windows(benchmark, window), "windows")
    hits = all_hits(docs, windows, gram, limit)
    if hits is None:
        nothing = counted.withColumn("n_hit", F.lit(0).cast("bigint"))
        nothing = nothing.withColumn("items", F.array().cast("array<string>")).withColumn("spans", no_spans())
        return finished(nothing, none)

    # the ranges of hit words: windows that overlap or touch become one
    order = Window.partitionBy("key").orderBy("start", "end")
    ends = hits.select("key", "start", (F.col("start") + F.col("width")).alias("end")).distinct()
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    ends = ends.withColumn("fresh", F.coalesce((F.col("start") > before).cast("int"), F.lit(1)))
    ends = ends.withColumn("part", F.sum("fresh").over(order))
    ranges = ends.groupBy("key", "part").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    ranges = ranges.groupBy("key").agg(
        F.sum(F.col("end") - F.col("start")).cast("bigint").alias("n_hit"),
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"),
    )
    named = windows.select("width", "content", F.col("item_id").cast("string").alias("item")).distinct()
    items = hits.select("key", "width", "content").distinct().join(named, ["width", "content"])
    items = items.groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    found = stored(ranges.join(items, "key"), "contamination")
    result = counted.join(found, "key", "left")
    result = result.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", no_spans()).alias("spans"),
    )
    return finished(result, none)


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, gram: int = 6, limit: int = BROADCAST_ROWS
) -> DataFrame:
    """`docs` with all its columns, without the rows that `contamination` calls contaminated."""
    windows = stored(item_windows(benchmark, window), "windows")
    hits = all_hits(docs, windows, gram, limit)
    if hits is None:
        return docs
    rows = without(with_row(docs), hits.select(F.col("key").alias("rid")).distinct())
    return rows.select(*row_columns(docs))


def no_spans() -> Column:
    return F.array().cast("array<struct<start:int,end:int>>")


def finished(result: DataFrame, none: Column) -> DataFrame:
    listed = F.when(F.size("items") > 0, F.sha2(F.array_join("items", ","), 256)).otherwise(none)
    return result.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        listed.alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "items",
        "spans",
    )


# The same result in DuckDB: every window of every document, compared as text.
ORACLE = r"""
with item as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark),
part as (
  select item_id, least(len(w), 10) as width, unnest(range(1, len(w) - least(len(w), 10) + 2)) as pos, w from item where len(w) > 0),
win as (select distinct item_id, width, array_to_string(w[pos:pos + width - 1], ' ') as content from part),
doc as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
place as (
  select doc_id, l.width, unnest(range(1, len(w) - l.width + 2)) as pos, w
  from doc, (select distinct width from win) l where len(w) >= l.width),
cut as (select doc_id, width, pos, array_to_string(w[pos:pos + width - 1], ' ') as content from place),
hit as (select c.doc_id, c.width, c.pos, i.item_id from cut c join win i on c.width = i.width and c.content = i.content),
covered as (
  select doc_id, count(distinct p) as n_hit
  from (select doc_id, unnest(range(pos, pos + width)) as p from (select distinct doc_id, width, pos from hit)) group by 1),
named as (
  select doc_id, count(*) as n_items, sha256(string_agg(item, ',' order by item)) as items_sha256
  from (select distinct doc_id, item_id::varchar as item from hit) group by 1)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(c.n_hit, 0)::bigint as n_hit, coalesce(n.n_items, 0)::bigint as n_items,
       coalesce(n.items_sha256, sha256('')) as items_sha256, coalesce(c.n_hit, 0) > 0 as contaminated
from doc d left join covered c using (doc_id) left join named n using (doc_id)
"""
