"""Exact dedup by deterministic block naming.

Each text, without its white space, is cut into blocks of a fixed number of characters. The distinct blocks are
sorted and numbered; adjacent numbers are paired, the distinct pairs sorted and numbered, and so on until one number
is left of each document. At each level equal content has equal names and different content different ones, so
(level, name) is an identity without collisions.

Text is shuffled once, to find the distinct blocks. Rows then refer to their blocks by a 128-bit key; that no two
distinct blocks share a key is checked on the blocks themselves, and another seed is taken if two do.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraflux.llm.common import WHITE, cut, table, text_or_empty

BLOCK_CHARS = 2048
#: Rows to drop that may be broadcast (16 bytes each); more are joined by a shuffle, which moves the texts.
MAX_BROADCAST = 1_000_000


def _key(block: Column, seed: int) -> Column:
    return F.struct(F.xxhash64(block).alias("a"), F.xxhash64(F.lit(seed), block).alias("b"))


def _named(distinct: DataFrame, order: list[str], keep: list[str], tag: str) -> DataFrame:
    """Sorted distinct rows get integer names; equal rows met in one partition, so a name is unique."""
    return cut(distinct.sortWithinPartitions(*order).select(*keep, F.monotonically_increasing_id().alias("name")), tag)


def _first_names(rows: DataFrame, seed: int) -> tuple[int, DataFrame]:
    """The seed and the name of the key of each distinct block of rows(blocks, ..)."""
    distinct = rows.select(F.explode("blocks").alias("block")).withColumn("key", _key(F.col("block"), seed)).select("key.a", "key.b", "block").distinct()
    names = _named(distinct, ["block"], ["a", "b"], "dedup-blocks")
    if names.groupBy("a", "b").count().filter("count > 1").limit(1).count():
        return _first_names(rows, seed + 1)
    return seed, names


def _judged(docs: DataFrame, block_chars: int) -> DataFrame:
    """What exact_dedup() returns, and fp, a hash of the text as it is."""
    text = text_or_empty()
    texts = docs.select("doc_id", F.xxhash64("text").alias("fp"), F.length(text).cast("long").alias("n_chars"), F.regexp_replace(text, f"{WHITE}+", "").alias("norm"))
    blocks = F.when(F.col("norm") == "", F.array(F.lit(""))).otherwise(F.regexp_extract_all("norm", F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0)))
    # texts are cut into blocks once and written; all that follows reads these
    rows = cut(texts.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "fp", "n_chars", F.sha2("norm", 256).alias("text_sha256"), blocks.alias("blocks")), "dedup-rows")
    seed, names = _first_names(rows, 1)
    n = rows.agg(F.max(F.size("blocks"))).first()[0] or 1
    now = (
        rows.select("row_id", F.size("blocks").alias("n"), F.posexplode(F.transform("blocks", lambda b: _key(b, seed))).alias("pos", "key"))
        .select("row_id", "n", "pos", "key.a", "key.b").join(names, ["a", "b"]).select("row_id", "n", "pos", "name")
    )
    done, level = [], 0
    while True:
        done.append(now.filter("n = 1").select("row_id", F.lit(level).alias("level"), "name"))
        if n == 1:
            break
        left, right = (F.max(F.when(F.col("pos") % 2 == side, F.col("name"))) for side in (0, 1))
        pairs = cut(
            now.filter("n > 1").groupBy("row_id", "n", F.floor(F.col("pos") / 2).cast("int").alias("at"))
            .agg(left.alias("l"), F.coalesce(right, F.lit(-1)).alias("r")),
            "dedup-pairs",
        )
        names = _named(pairs.select("l", "r").distinct(), ["l", "r"], ["l", "r"], "dedup-names")
        n, level = -(-n // 2), level + 1
        now = pairs.join(names, ["l", "r"]).select("row_id", F.ceil(F.col("n") / 2).cast("int").alias("n"), F.col("at").alias("pos"), "name")
    named = cut(rows.drop("blocks").join(reduce(DataFrame.union, done), "row_id"), "dedup-named")
    best = F.min(F.struct((-F.col("n_chars")).alias("fewer"), F.col("doc_id").isNull().alias("none"), "doc_id", "row_id"))
    groups = cut(named.groupBy("level", "name").agg(best.alias("best"), F.count("*").alias("group_size")), "dedup-groups")
    return named.join(groups, ["level", "name"]).select(
        "doc_id", "fp", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("row_id") == F.col("best.row_id")).alias("kept"), "text_sha256"
    )


def exact_dedup(docs: DataFrame, *, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Of rows whose texts are equal without white space, the one with the most code points in its own text stays, then
    the smallest doc_id. Null and empty texts are one group. A null doc_id comes after all others; of repeated rows
    exactly one stays. Columns beside doc_id and text are ignored. An empty table gives an empty result.
    """
    return _judged(docs, block_chars).drop("fp")


def drop_copies(docs: DataFrame, *, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """The rows of docs that exact_dedup() keeps, with all their columns.

    Rows to drop are told by doc_id and a hash of the text, so that the texts need no second shuffle while these are
    few. A row that stays and is repeated with its doc_id and text stays once. Helper columns cannot clash: the rows
    are joined by alias.
    """
    judged = cut(_judged(docs, BLOCK_CHARS).groupBy("doc_id", "fp").agg(F.max("kept").alias("kept"), F.count("*").alias("n")).filter("NOT kept OR n > 1"), "dedup-judged")
    near = F.broadcast if judged.count() <= max_broadcast else (lambda x: x)
    same = F.col("docs.doc_id").eqNullSafe(F.col("judged.doc_id")) & (F.xxhash64("docs.text") == F.col("judged.fp"))
    docs = docs.alias("docs")
    once = docs.join(near(judged.alias("judged")), same, "left_anti")
    repeated = judged.filter("kept")
    if repeated.isEmpty():
        return once
    return once.unionByName(docs.join(near(repeated.alias("judged")), same, "left_semi").dropDuplicates(["doc_id", "text"]))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS t
  FROM documents
), g AS (
  SELECT doc_id, t, first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY t) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g
"""
