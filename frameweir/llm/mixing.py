"""Mixing to target weights: soft domain membership and rates by projected gradient,
in DataFrame functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameweir.llm.common import labelled, row_columns, with_row
from frameweir.llm.decontaminate import words_of
from frameweir.session import stored

# The domains, as the labels give them, and the share of all tokens each should have.
DOMAINS = ["good", "poor", "toxic"]
TARGETS = {"good": 0.94, "poor": 0.05, "toxic": 0.01}

SIGNS = "#*$%&<>"
BINS = {"signs": 4, "bars": 4, "calls": 4, "capitals": 4, "telling": 3}

LEXICON = 200  # most words that are looked for as a sign of the domain toxic
ROUNDS = 25
MOST_RATE = 4.0  # rates stay between zero and this


def domain_of(labels: DataFrame) -> DataFrame:
    """(doc_id, domain): the place in DOMAINS that the labels say; null without a label."""
    known = F.col("toxic").isNotNull() & F.col("quality").isNotNull()
    place = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).otherwise(0)
    return labels.select("doc_id", F.when(known, place).alias("domain"))


def _count(text: Column, sign: str) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(sign), F.lit("")))


def _share_bin(count: Column, n: Column) -> Column:
    """0: none, 1: below one in twenty words, 2: below three in ten, 3: more."""
    return F.when(count == 0, 0).when(20 * count < n, 1).when(10 * count < 3 * n, 2).otherwise(3)


def binned(docs: DataFrame, lexicon: list[str], keep: list[str]) -> DataFrame:
    """The columns `keep`, n_tokens, and the bins of the traits of each text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(*keep, text.alias("_text"), words_of(text).alias("_words"))
    n, text = F.size("_words"), F.col("_text")
    told = F.size(F.filter("_words", lambda w: w.isin(lexicon))) if lexicon else F.lit(0)
    signs = sum((_count(text, x) for x in SIGNS[1:]), _count(text, SIGNS[0]))
    return base.select(
        *keep,
        n.cast("bigint").alias("n_tokens"),
        _share_bin(signs, n).alias("signs"),
        _share_bin(_count(text, "|"), n).alias("bars"),
        _share_bin(_count(text, "!"), n).alias("calls"),
        _share_bin(F.regexp_count(text, F.lit("[A-Z]{2}")), n).alias("capitals"),
        F.least(told, F.lit(2)).alias("telling"),
    )


@dataclass
class Classifier:
    """Naive Bayes over the bins: log shares of the domains, and of each bin in each domain."""

    prior: list[float]
    tables: dict[str, list[list[float]]]  # trait -> domain -> bin
    lexicon: list[str]

    def posteriors(self) -> Column:
        """Array of the probabilities of the domains, from the columns of bins."""

        def read(trait: str, k: int) -> Column:
            return F.get(F.array(*[F.lit(x) for x in self.tables[trait][k]]), F.col(trait))

        logs = [sum((read(t, k) for t in BINS), F.lit(self.prior[k])) for k in range(len(DOMAINS))]
        raised = [F.exp(x - F.greatest(*logs)) for x in logs]
        total = sum(raised[1:], raised[0])
        return F.array(*[x / total for x in raised])


def fit_classifier(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> Classifier:
    """Learn from at most about `max_rows` labelled documents, whole texts. Counts
    start at one, so without labels all domains are equally likely."""
    sample = stored(labelled(docs, domain_of(labels), "domain", max_rows), "mixing-sample")
    words = sample.select("label", F.explode(F.array_distinct(words_of(F.col("text")))).alias("word"))
    told = words.groupBy("word").agg(
        F.sum((F.col("label") == 2).cast("int")).alias("toxic"), F.count("*").alias("n")
    )
    told = told.where("toxic >= 3 and 10 * toxic >= 9 * n").orderBy(F.desc("toxic"), "word").limit(LEXICON)
    lexicon = [x.word for x in told.collect()]
    traits = list(BINS)
    rows = binned(sample, lexicon, ["label"]).groupBy("label", *traits).count().collect()  # at most 3 * 768 rows
    size = len(DOMAINS)
    docs_of = [sum(x["count"] for x in rows if x.label == k) for k in range(size)]
    tables = {}
    for trait, bins in BINS.items():
        seen = [[sum(x["count"] for x in rows if x.label == k and x[trait] == b) for b in range(bins)] for k in range(size)]
        tables[trait] = [[math.log((seen[k][b] + 1) / (docs_of[k] + bins)) for b in range(bins)] for k in range(size)]
    prior = [math.log((docs_of[k] + 1) / (sum(docs_of) + size)) for k in range(size)]
    return Classifier(prior, tables, lexicon)


def rate_after(steps: list[list[float]], posterior: Column) -> Column:
    """The rate of a document after these gradients, one number per domain each:
    from 1, a step against each and back into the allowed range."""
    if not steps:
        return F.lit(1.0)
    gradients = F.array(*[F.array(*[F.lit(x) for x in step]) for step in steps])

    def step(rate: Column, gradient: Column) -> Column:
        along = sum((F.get(gradient, F.lit(k)) * F.get(posterior, F.lit(k)) for k in range(len(DOMAINS))), F.lit(0.0))
        return F.least(F.lit(MOST_RATE), F.greatest(F.lit(0.0), rate - along))

    return F.aggregate(gradients, F.lit(1.0), step)


def totals(cells: DataFrame, rate: Column) -> list[float]:
    """Expected tokens of each domain at these rates."""
    sums = [F.sum(rate * F.col("tokens") * F.get("posterior", F.lit(k))) for k in range(len(DOMAINS))]
    return [x or 0.0 for x in cells.agg(*[x.alias(f"d{k}") for k, x in enumerate(sums)]).first()]


def fit_rates(cells: DataFrame, targets: dict[str, float], keep: str, headroom: float) -> list[list[float]]:
    """Projected gradient for rates r >= 0 that minimise the sum over the domains of
    (expected tokens - wanted tokens)**2, each domain weighed by its tokens at rate 1.

    Documents of one cell have one posterior, so they share their gradient and
    their rate, and sums over cells are sums over documents. A step of length
    one is safe: in the weighed measure the gradient's slope is at most one.
    Returns the gradient of each round, so any document's rate can be computed
    where the document is; nothing is kept per document in between.
    """
    start = totals(cells, F.lit(1.0))
    total = sum(start)
    if not total:
        return []
    weight = sum(targets.values())
    share = [targets[x] / weight for x in DOMAINS]
    k = DOMAINS.index(keep)
    wanted = total * max(1.0, headroom * start[k] / total / share[k] if share[k] else 1.0)
    scale = [max(x, 1e-6 * total) for x in start]
    steps: list[list[float]] = []
    for _ in range(ROUNDS):
        now = totals(cells, rate_after(steps, F.col("posterior")))
        steps.append([(x - wanted * w) / s for x, w, s in zip(now, share, scale, strict=True)])
    return steps


def mix(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float] = TARGETS,
    keep: str = "good",
    headroom: float = 1.1,
    max_rows: int = 20_000,
) -> DataFrame:
    """One row per row of `docs` (doc_id, text; other columns are not read):
    doc_id, n_tokens, posterior (array over DOMAINS), rate, copies.

    Rates make the expected tokens of the domains match `targets`, at a total
    that asks for `headroom` times the tokens of the domain `keep`, so that its
    documents are not thinned out. `copies` is the rate rounded up or down by
    the hash of the id, in proportion. A null text has no tokens and the
    posterior of an empty text; null ids are rounded alike; repeated rows get
    equal results; an empty table gives an empty result; without tokens, or
    where targets cannot be met, rates stay at 1 or come as near as they can.
    """
    lexicon, traits, cells = fit(docs, labels, targets, keep, headroom, max_rows)
    told = traits.join(F.broadcast(cells), [*BINS])
    return told.select("doc_id", "n_tokens", "posterior", "rate", copies().alias("copies"))


def fit(
    docs: DataFrame, labels: DataFrame, targets: dict[str, float], keep: str, headroom: float, max_rows: int
) -> tuple[list[str], DataFrame, DataFrame]:
    """The words to look for; (doc_id, n_tokens, bins) of each row; and for each
    combination of bins, of which there are at most 768, posterior and rate."""
    classifier = fit_classifier(docs, labels, max_rows)
    traits = stored(binned(docs, classifier.lexicon, ["doc_id"]), "traits")
    cells = traits.groupBy(*BINS).agg(F.sum("n_tokens").alias("tokens"))
    cells = stored(cells.withColumn("posterior", classifier.posteriors()), "cells")
    steps = fit_rates(cells, targets, keep, headroom)
    rate = F.round(rate_after(steps, F.col("posterior")), 6)
    return classifier.lexicon, traits, stored(cells.select(*BINS, "posterior", rate.alias("rate")), "rates")


def copies() -> Column:
    """The rate rounded up or down by the hash of the id, in proportion."""
    digits = F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 6)
    part = F.conv(digits, 16, 10).cast("double") / float(16**6)
    return F.floor(F.col("rate") + part).cast("int")


def mixed(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float] = TARGETS,
    keep: str = "good",
    headroom: float = 1.1,
    max_rows: int = 20_000,
) -> DataFrame:
    """`docs` with all its columns and with `rate` and `copies` as in `mix` (columns
    of these names are replaced), without the rows of which no copy is wanted."""
    lexicon, _, cells = fit(docs, labels, targets, keep, headroom, max_rows)
    rows = binned(with_row(docs), lexicon, ["row", "doc_id"]).join(F.broadcast(cells), [*BINS])
    rows = rows.withColumn("copies", copies()).where("copies > 0")
    return rows.select(*row_columns(docs.drop("rate", "copies")), "rate", "copies")


def _oracle() -> str:
    """The same in DuckDB, for tables with at most `max_rows` labels."""
    letters = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    words = rf"regexp_extract_all(translate(coalesce(text, ''), {letters}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

    def count(sign: str) -> str:
        return f"(strlen(t) - strlen(replace(t, '{sign}', '')))"

    def share(value: str) -> str:
        return f"case when {value} = 0 then 0 when 20 * {value} < n then 1 when 10 * {value} < 3 * n then 2 else 3 end"

    sizes = " union all ".join(f"select '{trait}' as trait, unnest(range({n})) as bin, {n} as bins" for trait, n in BINS.items())
    by_trait = " union all ".join(f"select domain, '{trait}' as trait, {trait} as bin from seen" for trait in BINS)
    logs = " + ".join(f"(select l from nb where nb.trait = '{t}' and nb.bin = c.{t} and nb.domain = k.domain)" for t in BINS)
    same = " and ".join(f"c.{t} = f.{t}" for t in BINS)
    wanted = ", ".join(str(TARGETS[x]) for x in DOMAINS)
    along = " + ".join(f"((s.now[{k}] - s.want[{k}]) / s.scale[{k}]) * p[{k}]" for k in (1, 2, 3))
    sums = ", ".join(f"list_sum(list_transform(range(1, len(r) + 1), lambda i: r[i] * tok[i] * ps[i][{k}]))" for k in (1, 2, 3))
    return f"""
with recursive base as (
  select doc_id, coalesce(text, '') as t, {words} as w from documents),
label as (
  select doc_id, max(case when toxic = 1 then 2 when quality = 0 then 1 else 0 end) as domain
  from labels where toxic is not null and quality is not null and doc_id is not null group by 1),
told as (
  select word, sum((domain = 2)::int) as toxic, count(*) as n
  from (select domain, unnest(list_distinct(w)) as word from base join label using (doc_id)) group by 1),
lexicon as (
  select word from told where toxic >= 3 and 10 * toxic >= 9 * n order by toxic desc, word limit {LEXICON}),
hits as (
  select doc_id, count(*) as c from (select doc_id, unnest(w) as word from base) semi join lexicon using (word) group by 1),
trait as (
  select doc_id, len(w) as n, t, {" + ".join(count(x) for x in SIGNS)} as a, {count("|")} as b, {count("!")} as c,
         len(regexp_extract_all(t, '[A-Z]{{2}}')) as d, coalesce(h.c, 0) as e
  from base left join hits h using (doc_id)),
f as (
  select doc_id, n::bigint as n_tokens, {share("a")} as signs, {share("b")} as bars, {share("c")} as calls,
         {share("d")} as capitals, least(e, 2) as telling from trait),
seen as (select domain, f.* from f join label using (doc_id)),
domains as (select unnest(range({len(DOMAINS)})) as domain),
size as (select k.domain, count(s.domain) as n from domains k left join seen s using (domain) group by 1),
flat as ({by_trait}),
nb as (
  select k.domain, z.trait, z.bin, ln((count(x.bin) + 1.0::double) / (any_value(k.n) + any_value(z.bins))) as l
  from size k cross join ({sizes}) z left join flat x on x.domain = k.domain and x.trait = z.trait and x.bin = z.bin
  group by 1, 2, 3),
prior as (select domain, ln((n + 1.0::double) / ((select sum(n) from size) + {len(DOMAINS)})) as l from size),
cell as (select {", ".join(BINS)}, sum(n_tokens)::double as tokens from f group by all),
logs as (select c.*, k.domain, k.l + {logs} as v from cell c cross join prior k),
soft as (select *, exp(v - max(v) over (partition by {", ".join(BINS)})) as x from logs),
post as (
  select {", ".join(BINS)}, any_value(tokens) as tokens, list(x / s order by domain) as p
  from (select *, sum(x) over (partition by {", ".join(BINS)}) as s from soft) group by {", ".join(BINS)}),
lists as (select list(tokens order by {", ".join(BINS)}) as tok, list(p order by {", ".join(BINS)}) as ps from post),
first as (select tok, ps, list_transform(tok, lambda x: 1.0::double) as r from lists),
begun as (select tok, ps, r, [{sums}] as now from first),
goal as (
  select tok, ps, r, now, list_transform(now, lambda x: greatest(x, 1e-6 * list_sum(now))) as scale,
         list_transform([{wanted}], lambda x: x / list_sum([{wanted}]) * list_sum(now)
           * greatest(1.0::double, 1.1 * now[1] / list_sum(now) / ([{wanted}][1] / list_sum([{wanted}])))) as want
  from begun),
go as (
  select 0 as round, tok, ps, scale, want, r, now from goal
  union all
  select round + 1, tok, ps, scale, want, r, [{sums}] from (
    select round, tok, ps, scale, want,
           list_transform(range(1, len(r) + 1), lambda i: least({MOST_RATE}, greatest(0.0, r[i] - ({along.replace("p[", "s.ps[i][")})))) as r
    from go s where round < {ROUNDS})),
final as (select unnest(r) as rate, unnest(range(1, len(r) + 1)) as at from go where round = {ROUNDS}),
cells as (select *, row_number() over (order by {", ".join(BINS)}) as at from post),
rated as (
  select f.doc_id, f.n_tokens, round(final.rate, 6) as rate
  from f join cells c on {same} join final on final.at = c.at)
select doc_id, n_tokens, rate,
       floor(rate + ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 6))::int / 16777216.0::double)::int as copies
from rated
"""


ORACLE = _oracle()
