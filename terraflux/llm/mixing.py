"""Mixing sources to target weights by hierarchical budgeting.

Weights of a domain - language - source tree share out a token budget from the root. A child can take max_epochs times
its tokens at most; what it cannot take goes to its siblings by their weights, and only what a whole subtree cannot
take goes to the subtree's siblings. Each leaf then reads whole epochs of its documents and, of one more epoch in
seeded order, the longest prefix within the rest of its budget.

The prefix needs no window over a leaf: documents fall into 65,536 ranges of their seeded hash, the sums of these
ranges tell the one in which the budget ends, and only the documents of that range are put in order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terraflux.llm.common import WHITE, cut, table, text_or_empty

LEVELS = ("domain", "lang", "source")
#: Weights of the named children; any other has weight 1.
WEIGHTS = {"domain": {"crawl": 2, "reference": 5, "community": 3}, "lang": {"en": 6, "de": 2, "fr": 1, "es": 1}, "source": {}}
#: The budget as a share of all tokens (numerator, denominator), the epochs that a leaf may be read, the seed of the order.
BUDGET, MAX_EPOCHS, SEED = (1, 2), 4, "mix-1"
#: Leaves that may be broadcast (about 100 bytes each); more are joined by a shuffle.
MAX_BROADCAST = 100_000


def domain_of(source: Column) -> Column:
    """The documents' domains: src0 is a crawl, other sources are reference (even number) or community (odd)."""
    number = F.regexp_extract(source, r"(\d+)$", 1)
    return F.when(source == "src0", "crawl").when(number == "", "community").when(F.substr(number, F.length(number)).isin("0", "2", "4", "6", "8"), "reference").otherwise("community")


def _weight(level: str, weights: dict[str, dict[str, int]]) -> Column:
    return reduce(lambda rest, w: F.when(F.col(level) == w[0], F.lit(w[1])).otherwise(rest), weights.get(level, {}).items(), F.lit(1)).cast("long")


def _share_out(children: DataFrame, parents: list[str], child: str) -> DataFrame:
    """Adds alloc: budget of the parent among its children by weight, none over its cap.

    In the order of cap / weight the children that fill up come first: one fills up if its cap is within its share of
    what those before it have left.
    """
    order = Window.partitionBy(*parents).orderBy(F.col("cap") / F.col("weight"), child)
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    left = F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    out = children.withColumn("left", left).withColumn("w", F.sum("weight").over(after))
    out = out.withColumn("full", F.col("cap").cast("decimal(38,0)") * F.col("w") <= F.col("left").cast("decimal(38,0)") * F.col("weight"))
    whole = Window.partitionBy(*parents)
    first = F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("weight"), F.col(child), F.col("left").alias("left"), F.col("w").alias("w")))).over(whole)
    out = out.withColumn("stop", first)
    part = F.floor(F.col("stop.left").cast("decimal(38,0)") * F.col("weight") / F.col("stop.w")).cast("long")
    return out.withColumn("alloc", F.when(F.col("full"), F.col("cap")).otherwise(part)).drop("left", "w", "full", "stop")


def budgets(leaves: DataFrame, budget: tuple[int, int], max_epochs: int, weights: dict[str, dict[str, int]]) -> DataFrame:
    """leaves(domain, lang, source, tokens) with alloc, the tokens that each is to give."""
    leaves = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    total = leaves.agg(F.floor(F.sum("tokens") * budget[0] / budget[1]).cast("long").alias("budget"))
    above = None
    for i, level in enumerate(LEVELS):
        nodes = leaves.groupBy(*LEVELS[: i + 1]).agg(F.sum("cap").alias("cap")).withColumn("weight", _weight(level, weights))
        nodes = nodes.crossJoin(F.broadcast(total)) if above is None else nodes.join(above, list(LEVELS[:i]))  # total is one row
        above = _share_out(nodes, list(LEVELS[:i]), level).select(*LEVELS[: i + 1], F.col("alloc").alias("budget"))
    return leaves.join(above.withColumnRenamed("budget", "alloc"), list(LEVELS)).drop("cap")


def mix(docs: DataFrame, *, domains: DataFrame | None = None, budget: tuple[int, int] = BUDGET, max_epochs: int = MAX_EPOCHS, weights: dict[str, dict[str, int]] = WEIGHTS, seed: str = SEED, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """A row for each reading of a document: doc_id, domain, lang, source, epoch (from 0), n_tokens.

    domains(source, domain) is a table of at most max_broadcast rows, each source once; sources that it lacks are of the
    domain "". Without it domain_of() tells the domains.

    Tokens are words between ASCII white space. Null languages and sources are leaves named "". A document without
    tokens costs nothing and is read where the order reaches it; a null text has none. A row without doc_id is ordered by
    a digest of its text. Repeated rows are documents of their own. A table without lang or source counts as one of nulls.
    Other columns are ignored; an empty table gives an empty result. The windows go over the sums of a leaf's ranges, at
    most 65,536 rows, and over the documents of the one range in which its budget ends.
    """
    named = lambda c: F.coalesce(F.col(c), F.lit("")) if c in docs.columns else F.lit("")
    source = named("source")
    tokens = F.regexp_count(text_or_empty(), F.lit(f"[^{WHITE[1:]}+")).cast("long")
    rows = docs.select("doc_id", domain_of(source).alias("domain"), named("lang").alias("lang"), source.alias("source"), tokens.alias("n_tokens"), F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("-"), F.md5(text_or_empty()))).alias("order"))
    if domains is not None:
        if domains.limit(max_broadcast + 1).count() > max_broadcast:
            raise ValueError(f"more than {max_broadcast} sources with a domain")
        known = domains.select(F.coalesce("source", F.lit("")).alias("source"), F.col("domain").alias("known"))
        rows = rows.join(F.broadcast(known), "source", "left").withColumn("domain", F.coalesce("known", F.lit(""))).drop("known")
    rows = cut(rows, "mix-rows")
    leaves = cut(rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")), "mix-leaves")
    plan = budgets(leaves, budget, max_epochs, weights).filter("alloc > 0")
    plan = cut(plan.withColumn("whole", F.floor(F.col("alloc") / F.col("tokens")).cast("int")).withColumn("rest", F.col("alloc") - F.col("whole") * F.col("tokens")).select(*LEVELS, "whole", "rest"), "mix-plan")
    small = plan.count() <= max_broadcast
    near = F.broadcast if small else (lambda x: x)
    keyed = rows.join(near(plan), list(LEVELS)).withColumn("place", F.md5(F.concat_ws(":", F.lit(seed), F.col("whole").cast("string"), "order")))
    keyed = keyed.withColumn("range", F.substr("place", F.lit(1), F.lit(4)))
    sums = keyed.groupBy(*LEVELS, "rest", "range").agg(F.sum("n_tokens").alias("n"))
    up_to = F.sum("n").over(Window.partitionBy(*LEVELS).orderBy("range").rowsBetween(Window.unboundedPreceding, 0))
    ends = sums.withColumn("up_to", up_to).filter("up_to > rest").groupBy(*LEVELS).agg(F.min_by(F.struct("range", (F.col("up_to") - F.col("n")).alias("before")), "range").alias("end"))
    ends = cut(ends.select(*LEVELS, F.col("end.range").alias("end"), F.col("end.before").alias("before")), "mix-ends")
    keyed = keyed.join(near(ends), list(LEVELS), "left")
    in_end = F.col("range") == F.col("end")
    order = Window.partitionBy(*LEVELS).orderBy("place", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    columns = ["doc_id", *LEVELS, "n_tokens"]
    sure = keyed.filter(F.coalesce(~in_end, F.lit(True))).select(*columns, (F.col("whole") + F.when(F.coalesce(F.col("range") < F.col("end"), F.lit(True)), 1).otherwise(0)).alias("times"))
    edge = keyed.filter(in_end).withColumn("at", F.col("before") + F.sum("n_tokens").over(order)).select(*columns, (F.col("whole") + F.when(F.col("at") <= F.col("rest"), 1).otherwise(0)).alias("times"))
    picked = sure.union(edge).filter("times > 0")
    return picked.select("doc_id", *LEVELS, F.explode(F.sequence(F.lit(0), F.col("times") - 1)).alias("epoch"), "n_tokens")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def _level_sql(name: str, above: str, parents: str, child: str, weight: str) -> str:
    """The share-out of one level: the cap of each child, its place in the order of cap / weight, and its part."""
    by = f"PARTITION BY {parents} " if parents else ""
    keys = f"{parents}, {child}" if parents else child
    budget = f"JOIN {above} USING ({parents})" if parents else f"CROSS JOIN {above}"
    return f"""
{name}0 AS (SELECT {keys}, sum(cap)::HUGEINT AS cap, ({weight})::HUGEINT AS weight FROM leaves GROUP BY ALL),
{name}1 AS (
  SELECT *, budget - coalesce(sum(cap) OVER ({by}ORDER BY cap / weight, {child} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rem,
         sum(weight) OVER ({by}ORDER BY cap / weight, {child} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w
  FROM {name}0 {budget}
),
{name}2 AS (SELECT *, cap * w <= rem * weight AS is_full, row_number() OVER ({by}ORDER BY cap / weight, {child}) AS place FROM {name}1),
{name}3 AS (SELECT *, min(CASE WHEN NOT is_full THEN place END) OVER ({by.strip()}) AS stop FROM {name}2),
{name}4 AS (SELECT *, max(CASE WHEN place = stop THEN rem END) OVER ({by.strip()}) AS srem, max(CASE WHEN place = stop THEN w END) OVER ({by.strip()}) AS sw FROM {name}3),
{name} AS (SELECT {keys}, CASE WHEN is_full THEN cap ELSE (srem * weight) // sw END AS budget FROM {name}4)"""


OP7_SQL = (
    r"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens,
         regexp_extract(coalesce(source, ''), '(\d+)$', 1) AS num FROM documents
), rows_ AS (
  SELECT doc_id, lang, source, n_tokens, CASE WHEN source = 'src0' THEN 'crawl' WHEN num = '' THEN 'community' WHEN right(num, 1) IN ('0', '2', '4', '6', '8') THEN 'reference' ELSE 'community' END AS domain FROM docs
), leaves AS (
  SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens, 4 * sum(n_tokens)::HUGEINT AS cap FROM rows_ GROUP BY ALL
), total AS (SELECT sum(tokens)::HUGEINT // 2 AS budget FROM leaves),"""
    + _level_sql("ld", "total", "", "domain", "CASE domain WHEN 'crawl' THEN 2 WHEN 'reference' THEN 5 WHEN 'community' THEN 3 ELSE 1 END")
    + ","
    + _level_sql("ll", "ld", "domain", "lang", "CASE lang WHEN 'en' THEN 6 WHEN 'de' THEN 2 ELSE 1 END")
    + ","
    + _level_sql("ls", "ll", "domain, lang", "source", "1")
    + """, plan AS (
  SELECT domain, lang, source, budget // tokens AS whole, budget % tokens AS rest FROM ls JOIN leaves USING (domain, lang, source) WHERE budget > 0
), cum AS (
  SELECT doc_id, domain, lang, source, n_tokens, whole, rest,
         sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('mix-1:' || whole || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), doc_id, n_tokens ROWS UNBOUNDED PRECEDING) AS c
  FROM rows_ JOIN plan USING (domain, lang, source)
)
SELECT doc_id, domain, lang, source, CAST(unnest(range(0, CAST(whole AS BIGINT) + CASE WHEN c <= rest THEN 1 ELSE 0 END)) AS INTEGER) AS epoch, n_tokens FROM cum
"""
)
