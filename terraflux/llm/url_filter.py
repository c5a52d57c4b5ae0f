"""URL filter: host and path rules first, then a blocked Bloom filter of listed canonical URLs and an exact join.

The filter is a table of blocks of eight 64-bit words with one bit per key and word, built by bit_or. A page reads one
block; only possible hits go on to the join with the list, which removes the false positives.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraflux.llm.common import LOWER, UPPER, cut, table

#: The contract's rules: (verdict, host and path prefix).
RULES = (
    ("block", "com/en/"),
    ("allow", "example.com/en/7"),
    ("allow", "net/de/"),
    ("block", "example.net/de/8"),
    ("block", "org/es/"),
)
WORDS, BITS_PER_KEY = 8, 16
#: Blocks that may be broadcast (72 bytes each); a larger filter is joined by a shuffle on the block.
MAX_BROADCAST = 500_000
#: URLs of the list that may be broadcast (about 100 bytes each).
MAX_LISTED = 300_000
#: The query's list: canonical URLs with one of these labels in their host, or whose md5 digest begins below this.
LISTED_LABELS, LISTED_BELOW = ("spam-farm", "cheap-pills", "casino-win"), "55"
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid)(=|$)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a null url and one without "://"."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def canonical(url: Column, host: Column, path: Column) -> Column:
    """Host without user, default port and a leading www. or m.; path without index page and closing slashes; query sorted, without
    tracking parameters; no scheme, no fragment. Null where the host is empty."""
    name = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":(80|443)$", ""), r"^(www|m)\.", "")
    page = F.regexp_replace(F.regexp_replace(path, r"/index\.html?$", "/"), r"/+$", "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.when(host != "", F.concat(name, page, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")))


def best_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; of equally long ones that with the longer host. Null if none fits."""

    def fits(rule: str) -> Column:
        at = rule.index("/")
        return ((host == rule[:at]) | host.endswith("." + rule[:at])) & path.startswith(rule[at:])

    ordered = sorted(rules, key=lambda r: (len(r[1]), r[1].index("/"), r[0] == "block"))
    pick = lambda of: reduce(lambda rest, r: F.when(fits(r[1]), F.lit(of(r))).otherwise(rest), ordered, F.lit(None).cast("string"))
    return pick(lambda r: r[1]), pick(lambda r: r[0])


def _bits(url: Column, blocks: int) -> tuple[Column, list[Column]]:
    """The block of a url and its bit in each word."""
    places = F.xxhash64(F.lit("bits"), url)
    return F.pmod(F.xxhash64(url), F.lit(blocks)), [F.call_function("shiftleft", F.lit(1).cast("long"), (F.shiftrightunsigned(places, 6 * i)).bitwiseAND(63).cast("int")) for i in range(WORDS)]


def bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """(block, w0..w7) of the urls in listed(listed_url)."""
    block, bits = _bits(F.col("listed_url"), blocks)
    return listed.select(block.alias("block"), *[b.alias(f"b{i}") for i, b in enumerate(bits)]).groupBy("block").agg(*[F.bit_or(f"b{i}").alias(f"w{i}") for i in range(WORDS)])


def filter_urls(pages: DataFrame, listed: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, *, max_blocks: int = MAX_BROADCAST, max_listed: int = MAX_LISTED) -> DataFrame:
    """One row per row of pages: page_id, host, path, rule, verdict.

    listed(listed_url) holds canonical URLs to block; nulls in it and repeats count for nothing. A url that no rule
    fits is blocked if it is listed, else allowed; a null url, or one without "://", has empty host and path, fits no
    rule and is allowed. Page rows repeat as they are; columns beside page_id and url are ignored. A list, or its
    filter, too large to broadcast is joined by a shuffle, to which only the rows go that the step before left open.
    """
    listed = cut(listed.select("listed_url").filter("listed_url IS NOT NULL").distinct(), "url-list")
    n = listed.count()
    blocks = max(1, -(-n * BITS_PER_KEY // (64 * WORDS)))
    kept = cut(bloom(listed, blocks), "url-bloom")
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = best_rule(F.col("host"), F.col("path"), rules)
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), canonical(F.col("url"), F.col("host"), F.col("path")).alias("canonical"))
    block, bits = _bits(F.col("canonical"), blocks)
    hit = reduce(Column.__and__, [F.col(f"w{i}").bitwiseAND(b) == b for i, b in enumerate(bits)])
    is_open = F.col("rule").isNull() & F.col("canonical").isNotNull()
    columns = ["page_id", "host", "path", "rule"]
    found = F.when(F.col("listed_url").isNotNull(), "block").otherwise("allow")
    if blocks <= max_blocks and n <= max_listed:
        tested = rows.withColumn("block", F.when(is_open, block)).join(F.broadcast(kept), "block", "left").withColumn("key", F.when(hit, F.col("canonical")))
        return tested.join(F.broadcast(listed), F.col("key") == F.col("listed_url"), "left").select(*columns, F.coalesce("verdict", found).alias("verdict"))
    rows = cut(rows, "url-rows")
    tested = rows.filter(is_open).withColumn("block", block).join(F.broadcast(kept) if blocks <= max_blocks else kept, "block", "left")
    tested = cut(tested.select(*columns, "canonical", F.coalesce(hit, F.lit(False)).alias("possible")), "url-tested")
    closed = rows.filter(~is_open).select(*columns, F.coalesce("verdict", F.lit("allow")).alias("verdict"))
    clear = tested.filter("NOT possible").select(*columns, F.lit("allow").alias("verdict"))
    checked = tested.filter("possible").join(listed, F.col("canonical") == F.col("listed_url"), "left").select(*columns, found.alias("verdict"))
    return closed.union(clear).union(checked)


def listed_urls(pages: DataFrame, labels: tuple[str, ...] = LISTED_LABELS, below: str = LISTED_BELOW) -> DataFrame:
    """The query's list: of the canonical URLs of all pages those with one of these labels in their host, and a third of the others, drawn by digest."""
    host, path = host_and_path(F.col("url"))
    named = pages.select("url", host.alias("host"), path.alias("path"))
    named = named.select("host", canonical(F.col("url"), F.col("host"), F.col("path")).alias("listed_url"))
    return named.filter(F.arrays_overlap(F.split("host", r"\."), F.array(*map(F.lit, labels))) | (F.md5("listed_url") < below)).select("listed_url")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, listed_urls(pages))


OP4_SQL = r"""
WITH p AS (
  SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p
), r(verdict, rule, rh, rp) AS (
  VALUES ('block', 'com/en/', 'com', '/en/'), ('allow', 'example.com/en/7', 'example.com', '/en/7'), ('allow', 'net/de/', 'net', '/de/'),
         ('block', 'example.net/de/8', 'example.net', '/de/8'), ('block', 'org/es/', 'org', '/es/')
), c AS (
  SELECT page_id, host, path, CASE WHEN host <> '' THEN
    regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':(80|443)$', ''), '^(www|m)\.', '')
    || regexp_replace(regexp_replace(path, '/index\.html?$', '/'), '/+$', '')
    || coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'),
         lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))), '&'), ''), '') END AS canonical FROM h
), l AS (
  SELECT DISTINCT canonical FROM c WHERE list_has_any(string_split(host, '.'), ['spam-farm', 'cheap-pills', 'casino-win']) OR md5(canonical) < '55'
), b AS (
  SELECT c.*, (SELECT arg_max(r, length(rule)) FROM r WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)) AS best FROM c
)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, CASE WHEN canonical IN (SELECT canonical FROM l) THEN 'block' ELSE 'allow' END) AS verdict FROM b
"""
