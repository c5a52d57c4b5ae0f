"""Benchmark decontamination: a broadcast hash set of the benchmark's word n-grams, scanned by every document window.

Each position of a document is hashed over the next 13 words (and over each shorter length that a short item has)
and looked up in the set; hits are verified on the words themselves. Everything from the split into words to the
lookup is one generated stage without a shuffle; only hits leave it. A benchmark with too many windows to broadcast is
joined by a shuffle of the hashes alone; the words of the documents with a possible hit are then read again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraflux.llm.common import ascii_lower, cut, table, text_or_empty

N = 13
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same before A-Z are lower-cased.
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Windows that may be broadcast (about 150 bytes each); a larger benchmark is joined by a shuffle on the hash.
MAX_BROADCAST = 1_000_000


def _words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def _key(words: Column, at: Column, n: int) -> Column:
    return F.xxhash64(F.lit(n), *[F.get(words, at + k) for k in range(n)])


def _window(words: Column, at: Column, n: Column) -> Column:
    return F.array_join(F.slice(words, at + 1, n), " ")


def benchmark_windows(benchmark: DataFrame, n: int = N) -> DataFrame:
    """(item_id, n, key, window) of each distinct window of each item; an item without words has none."""
    items = benchmark.select("item_id", _words(text_or_empty()).alias("w")).filter(F.size("w") > 0)
    items = items.withColumn("n", F.least(F.size("w"), F.lit(n))).withColumn("at", F.explode(F.sequence(F.lit(0), F.size("w") - F.col("n"))))
    key = reduce(lambda rest, k: F.when(F.col("n") == k, _key(F.col("w"), F.col("at"), k)).otherwise(rest), range(1, n + 1), F.lit(0).cast("long"))
    return items.select("item_id", "n", key.alias("key"), _window(F.col("w"), F.col("at"), F.col("n")).alias("window")).distinct()


def _fingerprint() -> Column:
    return F.xxhash64(text_or_empty()).alias("fp")


def _places(read: DataFrame, lengths: list[int]) -> DataFrame:
    """read(doc_id, fp, w) at each place of its words: at, and the key of each length n of windows."""
    w, at = F.col("w"), F.col("at")
    # the outer form, as the inner one adds a filter that splits the text a second time
    places = read.select("doc_id", "fp", "w", F.explode_outer(F.sequence(F.lit(0), F.greatest(F.size("w") - 1, F.lit(0)))).alias("at"))
    if lengths in ([], [N]):
        return places.select("*", F.lit(N).alias("n"), _key(w, at, N).alias("key"))
    keys = F.array(*[F.struct(F.lit(k).alias("n"), _key(w, at, k).alias("key")) for k in lengths])
    return places.select("*", F.explode_outer(keys).alias("k")).select("doc_id", "fp", "w", "at", "k.n", "k.key")


def find_hits(docs: DataFrame, windows: DataFrame, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """(doc_id, fp, at, n, window): each place in a document where a benchmark window occurs. fp tells rows apart that share a doc_id."""
    wanted = cut(windows.select("n", "key", "window").distinct(), "decon-windows")
    lengths = sorted(r[0] for r in wanted.select("n").distinct().collect())  # at most 13 numbers
    read = docs.select("doc_id", _fingerprint(), _words(text_or_empty()).alias("w"))
    equal = _window(F.col("w"), F.col("at"), F.col("n")) == F.col("window")
    if wanted.count() <= max_broadcast:
        return _places(read, lengths).join(F.broadcast(wanted), ["n", "key"]).filter(equal).select("doc_id", "fp", "at", "n", "window")
    # hashes travel without the words; those of the documents that may have a hit are read a second time to verify it
    possible = _places(read, lengths).select("doc_id", "fp", "at", "n", "key").join(wanted, ["n", "key"]).select("doc_id", "fp", F.struct("at", "n", "window").alias("hit"))
    possible = cut(possible.groupBy("doc_id", "fp").agg(F.collect_set("hit").alias("hits")).withColumnsRenamed({"doc_id": "id", "fp": "f"}), "decon-possible")
    again = read.join(possible, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("fp") == F.col("f"))).select("doc_id", "fp", "w", F.explode("hits").alias("hit"))
    return again.select("doc_id", "fp", "w", "hit.*").filter(equal).drop("w").distinct()


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """One row per row of docs: doc_id, fp, n_words, n_hit, n_items, items_sha256, contaminated.

    A document word inside any occurrence of a benchmark window is hit; contaminated means n_hit > 0 and
    20 * n_hit >= n_words. A null or wordless text has no words and no hits; a wordless item has no windows; an
    empty benchmark hits nothing. Null doc_ids and repeated rows are kept and judged by their own text. Null
    item_ids are one item, named by the empty string. Other columns are ignored.
    """
    windows = cut(benchmark_windows(benchmark), "decon-items")
    hits = cut(find_hits(docs, windows, max_broadcast), "decon-hits")
    of_item = windows.select("window", F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"))
    if windows.count() <= max_broadcast:  # so that a passage that very many documents hold is no key of a shuffle
        of_item = F.broadcast(of_item)
    places = hits.select("doc_id", "fp", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("n") - 1)).alias("word")).distinct()
    n_hit = places.groupBy("doc_id", "fp").agg(F.count("*").alias("n_hit"))
    items = hits.select("doc_id", "fp", "window").distinct().join(of_item, "window").select("doc_id", "fp", "item").distinct()
    ids = items.groupBy("doc_id", "fp").agg(F.count("*").alias("n_items"), F.array_join(F.array_sort(F.collect_list("item")), ",").alias("items"))
    base = docs.select(F.col("doc_id").alias("id"), _fingerprint().alias("f"), F.regexp_count(text_or_empty(), F.lit(RAW_WORD)).cast("long").alias("n_words"))
    for part in (n_hit, ids):
        base = base.join(part, base["id"].eqNullSafe(part["doc_id"]) & (base["f"] == part["fp"]), "left").drop("doc_id", "fp")
    none = F.lit(0).cast("long")
    out = base.select(F.col("id").alias("doc_id"), F.col("f").alias("fp"), "n_words", F.coalesce("n_hit", none).alias("n_hit"), F.coalesce("n_items", none).alias("n_items"), F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """docs, all columns, without the contaminated documents; rows without doc_id or words and repeated rows are judged by
    their own text. Helper columns cannot clash: the rows to drop are joined by alias."""
    bad = decontaminate(docs, benchmark, max_broadcast=max_broadcast).filter("contaminated").select("doc_id", "fp").distinct()
    bad = cut(bad, "decon-bad")
    if bad.count() <= max_broadcast:
        bad = F.broadcast(bad)
    docs, bad = docs.alias("docs"), bad.alias("bad")
    same = F.col("docs.doc_id").eqNullSafe(F.col("bad.doc_id")) & (F.xxhash64(text_or_empty(F.col("docs.text"))) == F.col("bad.fp"))
    return docs.join(bad, same, "left_anti")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("fp")


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS x
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)
), n AS (
  SELECT DISTINCT n FROM bw
), dw AS (
  SELECT doc_id, i, n.n, array_to_string(w[i:i + n.n - 1], ' ') AS x
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d) p, n WHERE i + n.n - 1 <= len(w)
), h AS (
  SELECT DISTINCT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.x = bw.x
), hw AS (
  SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id
), hi AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""
