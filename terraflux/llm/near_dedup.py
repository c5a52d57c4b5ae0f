"""MinHash near-dedup: universal hash minima, banding, signature verification, full-set confirmation, components.

Documents with the same shingle set are one class from the start, so copies cost nothing further. Each band bucket has
a pivot, the member with the fullest buckets; all others are compared with it (a star, not all pairs). A compared
pair passes a signature check that a true link fails with a chance below 1e-9, then the comparison of full sets.

Links between two members x and y of a bucket that its star does not show are found by their differences from the
pivot p. Let D(x) be the symmetric difference of the sets of x and p, and c = (100 - percent) / (100 + percent). A pair
is linked if and only if its difference is at most c times the sum of its sizes, and the difference of x and y is
|D(x)| + |D(y)| - 2 |D(x) & D(y)|. If x is not linked with p, then |D(x)| > c (|x| + |p|), so a link of x and y needs

    2 |D(x) & D(y)|  >=  |D(x)| + |D(y)| - c (|x| + |y|)  >  |D(y)| - c (|y| - |p|)  >=  0,

that is, more than about half of D(y). With the elements of D(y) in order, the rarest of the group first, the pair
shares one of the first |D(y)| / 2 or so. An equi-join on (pivot, element) of these with the elements of the members
that are not linked with p therefore loses no link, and members that differ from the pivot in ways of their own never
meet. Members that the links found so far have put into one component are not compared again.

With 42 bands of 6 minima a link at the threshold itself is missed with a chance of 3e-6, one of similarity 0.85 with
5e-10, and an unrelated pair that shares a passage (similarity 0.25) is seldom a candidate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraflux.llm.common import cut, table
from terraflux.llm.components import connected_components

BANDS, ROWS = 42, 6
#: Six standard deviations below the agreement expected of a pair at the threshold.
SIGMAS = 6
#: Ids of documents that may be broadcast (16 bytes each); more are joined by a shuffle, which moves the texts.
MAX_BROADCAST = 1_000_000


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; with fewer words the whole sequence is one."""
    words = (text or "").encode().lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    of = xxhash.xxh64_intdigest
    if len(words) <= k:
        return np.array([of(b" ".join(words))], np.uint64)
    return np.unique(np.array([of(b" ".join(words[i : i + k])) for i in range(len(words) - k + 1)] if k > 2 else [of(a + b" " + b) for a, b in zip(words, words[1:])], np.uint64))


def _parameters(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of n multiply-shift hashes."""
    draw = np.random.Generator(np.random.PCG64(20240229))
    top = np.iinfo(np.uint64).max
    return draw.integers(0, top, n, np.uint64, endpoint=True) | np.uint64(1), draw.integers(0, top, n, np.uint64, endpoint=True)


def minima(found: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The minimum of each hash over the set, its high 32 bits."""
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(found), 512):
        np.minimum(least, (a[:, None] * found[None, start : start + 512] + b[:, None]).min(1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


#: Texts that a worker holds as Python strings at a time.
SLICE = 500


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, SLICE):
            yield batch.slice(begin, SLICE)


def sketches(docs: DataFrame, k: int, n_hashes: int) -> DataFrame:
    """(doc_id, fp, n_shingles, ka, kb, sig): fp is a hash of the text, ka and kb are the 128-bit digest of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _parameters(n_hashes)
        for batch in _slices(batches):
            sizes, keys, sigs = [], [], []
            for text in batch.column(2):
                found = shingles(text.as_py(), k)
                sizes.append(len(found))
                keys.append(_digest(found))
                sigs.append(minima(found, a, b) if len(found) else None)
            keys = np.array(keys, np.int64).reshape(-1, 2)
            ends = np.cumsum([0] + [0 if s is None else n_hashes for s in sigs]).astype(np.int32)
            none = pa.array([s is None for s in sigs], pa.bool_())
            sig = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([s for s in sigs if s is not None] or [np.empty(0, np.int32)])), mask=none)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(keys[:, 0]), pa.array(keys[:, 1]), sig], ["doc_id", "fp", "n_shingles", "ka", "kb", "sig"])

    read = docs.select(F.col("doc_id").cast("long"), _fingerprint().alias("fp"), "text")
    return read.mapInArrow(run, "doc_id long, fp long, n_shingles long, ka long, kb long, sig array<int>")


def shingle_sets(docs: DataFrame, k: int) -> DataFrame:
    """(ka, kb, items): the full set of each document and its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            sets = [shingles(text.as_py(), k) for text in batch.column(0)]
            keys = np.array([_digest(s) for s in sets], np.int64).reshape(-1, 2)
            items = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(keys[:, 0]), pa.array(keys[:, 1]), items], ["ka", "kb", "items"])

    return docs.select("text").mapInArrow(run, "ka long, kb long, items array<long>")


def _digest(found: np.ndarray) -> np.ndarray:
    return np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), np.int64)


def _fingerprint() -> Column:
    return F.xxhash64("text")


def _near(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """pairs(a, b, ..) with n_a, n_b and near: whether sizes and signatures allow a link."""
    for side in ("a", "b"):
        pairs = pairs.join(classes.select(F.col("id").alias(side), F.col("sig").alias(f"sig_{side}"), F.col("n").alias(f"n_{side}")), side)
    width = BANDS * ROWS
    p = percent / 100
    least = int(width * p - SIGMAS * (width * p * (1 - p)) ** 0.5)
    agree = F.size(F.filter(F.zip_with("sig_a", "sig_b", lambda x, y: x == y), lambda same: same))
    return pairs.withColumn("near", _sizes_allow("n_a", "n_b", percent) & (agree >= least)).drop("sig_a", "sig_b")


def _sizes_allow(a: str, b: str, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _allowed(a: str, b: str, percent: int) -> Column:
    """(100 + percent) times the most elements in which two linked sets of these sizes can differ."""
    return (100 - percent) * (F.col(a) + F.col(b))


def _differences(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """pairs(a, b, n_a, n_b, ..) with d, the elements of one set only, and linked."""
    for side in ("b", "a"):
        pairs = pairs.join(sets.select(F.col("id").alias(side), F.col("items").alias(f"set_{side}")), side)
    pairs = pairs.withColumn("d", F.concat(F.array_except("set_a", "set_b"), F.array_except("set_b", "set_a"))).drop("set_a", "set_b")
    return pairs.withColumn("linked", (100 + percent) * F.size("d") <= _allowed("n_a", "n_b", percent))


def _placed(links: DataFrame, open_: DataFrame) -> DataFrame:
    """open_(id, ..) with the component that the links put each id into, itself if none."""
    return open_.join(connected_components(links).withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))


def _across_pivots(open_: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components in one group that may be linked, of open_(pivot, id, n_pivot, n, d, linked, component)."""
    mixed = open_.groupBy("pivot").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.bool_and("linked").alias("all")).filter("lo <> hi AND NOT all").select("pivot")
    open_ = cut(open_.join(mixed, "pivot", "left_semi").withColumn("n_d", F.size("d")), "near-open")
    each = open_.select("pivot", "id", F.explode("d").alias("e"))
    often = each.groupBy("pivot", "e").agg(F.count("*").alias("often")).filter("often > 1")
    # an element of one member only meets nothing; it still comes before the others in the order
    shared = each.join(often, ["pivot", "e"]).groupBy("pivot", "id").agg(F.array_sort(F.collect_list(F.struct("often", "e"))).getField("e").alias("shared"))
    top = 100 + percent
    room = F.expr(f"n * {100 - percent} div {percent}")  # most elements in which a linked partner can differ
    half = F.expr(f"(n_d * {top} - {100 - percent} * (n - n_pivot)) div {2 * top}") + 1
    ordered = open_.drop("d").join(shared, ["pivot", "id"]).withColumn("alone", F.col("n_d") - F.size("shared"))
    ordered = ordered.withColumn("probe", F.col("n_d") - F.greatest(F.lit(1), F.col("n_d") - room) + 1).withColumn("head", F.col("n_d") - F.greatest(half, F.col("n_d") - room) + 1)
    ordered = cut(ordered, "near-ordered")

    def side(rows: DataFrame, length: str, name: str) -> DataFrame:
        first = F.slice("shared", 1, F.greatest(F.lit(0), F.col(length) - F.col("alone")).cast("int"))
        kept = ["id", "n", "n_d", "linked", "component", "head"]
        out = rows.select("pivot", *[F.col(c).alias(f"{c}_{name}") for c in kept], "alone", F.posexplode(first).alias("at", "e"))
        return out.withColumn(f"at_{name}", F.col("at") + F.col("alone")).drop("at", "alone")

    # a member goes to the other components of its element alone, so that members of one component never meet
    left, right = side(ordered.filter("NOT linked"), "probe", "x"), side(ordered, "head", "y")
    others = left.select("pivot", "e", "component_x").distinct().join(right.select("pivot", "e", "component_y").distinct(), ["pivot", "e"]).filter("component_x <> component_y")
    pairs = left.join(others, ["pivot", "e", "component_x"]).join(right, ["pivot", "e", "component_y"])
    enough = 2 * top * F.least(F.expr("n_d_x - at_x"), F.expr("n_d_y - at_y")) >= top * F.expr("n_d_x + n_d_y") - _allowed("n_x", "n_y", percent)
    once = F.expr("linked_y OR (id_x < id_y AND at_x < head_x)")
    found = pairs.filter(once).filter(_sizes_allow("n_x", "n_y", percent)).filter(enough)
    return found.select(F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b")).distinct()


def _components(docs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """(id, component) of each class that is linked with another."""
    bands = F.array(*[F.xxhash64(F.lit(i), *[F.get("sig", F.lit(i * ROWS + j)) for j in range(ROWS)]) for i in range(BANDS)])
    members = classes.select("id", F.explode(bands).alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    members = cut(members.join(sizes, "bucket"), "near-buckets")
    weights = members.groupBy("id").agg(F.sum("size").alias("weight"))
    pivots = members.join(weights, "id").groupBy("bucket").agg(F.max_by("id", F.struct("weight", "id")).alias("pivot"))
    star = cut(members.join(pivots, "bucket").filter("id <> pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct(), "near-star")
    groups = star.groupBy("a").agg((F.count("*") > 1).alias("many"))
    pairs = cut(_near(star.join(groups, "a"), classes, percent).filter("near OR many"), "near-pairs")

    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    wanted = cut(wanted.join(classes.select("id", "doc_id", "ka", "kb"), "id"), "near-wanted")
    ids = wanted.select("doc_id").distinct()
    if wanted.count() <= MAX_BROADCAST:
        ids = F.broadcast(ids)
    read = docs.select(F.col("doc_id").cast("long"), "text").join(ids, "doc_id", "left_semi")
    sets = cut(shingle_sets(read, k).join(wanted, ["ka", "kb"]).select("id", "items").dropDuplicates(["id"]), "near-sets")
    differ = _differences(pairs, sets, percent).withColumn("d", F.when(F.col("many"), F.col("d")))
    differ = cut(differ, "near-differences")

    links = differ.filter("linked").select("a", "b")
    open_ = differ.filter("many").select(F.col("a").alias("pivot"), F.col("b").alias("id"), F.col("n_a").alias("n_pivot"), F.col("n_b").alias("n"), "d", "linked")
    across = cut(_across_pivots(_placed(links, open_), percent), "near-across")
    across = _near(across, classes, percent).filter("near")
    more = cut(_differences(across, sets, percent).filter("linked").select("a", "b"), "near-links")
    return connected_components(links.union(more)).withColumnRenamed("node", "id")


def _judged(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """doc_id, fp, n_shingles, component_id, first of each row; first: its set is that of the component's first document."""
    rows = cut(sketches(docs, shingle, BANDS * ROWS), "near-rows")
    linked = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = linked.groupBy("ka", "kb").agg(F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n"), F.first("sig").alias("sig"))
    classes = cut(classes.withColumn("id", F.monotonically_increasing_id()), "near-classes")
    placed = cut(classes.select("id", "ka", "kb", "doc_id").join(_components(docs, classes, shingle, percent), "id"), "near-components")
    firsts = placed.groupBy("component").agg(F.min(F.struct("doc_id", "id")).alias("first"))
    of_class = placed.join(firsts, "component").select("ka", "kb", F.col("first.doc_id").alias("least"), (F.col("first.id") == F.col("id")).alias("first"))
    of_class = cut(classes.select("ka", "kb", "doc_id").join(of_class, ["ka", "kb"], "left").select("ka", "kb", F.coalesce("least", "doc_id").alias("least"), F.coalesce("first", F.lit(True)).alias("first")), "near-classes-placed")
    own = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    out = rows.drop("sig").join(of_class, ["ka", "kb"], "left")
    return out.select("doc_id", "fp", "n_shingles", F.when(own, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"), F.when(own, F.col("first")).otherwise(True).alias("first"))


def near_dedup(docs: DataFrame, *, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept (whether doc_id is component_id).

    Two texts are linked if 100 * intersection >= percent * union of their shingle sets; component_id is the smallest
    doc_id reachable. A null or wordless text has an empty set and is linked with nothing; so is a row without doc_id,
    whose component_id is null and which is kept. Rows that repeat a doc_id with its text share its component; with
    another text they are judged by that text alone. Columns beside doc_id and text are ignored; an empty table gives
    an empty result.
    """
    out = _judged(docs, shingle, percent)
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def drop_near_copies(docs: DataFrame, *, shingle: int = 5, percent: int = 80) -> DataFrame:
    """docs, all columns, with one document of each group of near copies: the one with the smallest doc_id.

    Rows without doc_id or words stay. Rows that repeat a doc_id with its text stay or go together; those that repeat
    it with another text are judged by that text. Helper columns cannot clash: the rows to drop are joined by alias.
    """
    judged = _judged(docs, shingle, percent)
    gone = cut(judged.filter("doc_id <> component_id OR NOT first").select("doc_id", "fp").distinct(), "near-gone")
    if gone.count() <= MAX_BROADCAST:
        gone = F.broadcast(gone)
    docs, gone = docs.alias("docs"), gone.alias("gone")
    same = (F.col("docs.doc_id").cast("long") == F.col("gone.doc_id")) & (F.xxhash64("docs.text") == F.col("gone.fp"))
    return docs.join(gone, same, "left_anti")


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"), shingle=2, percent=80)


OP3_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM d WHERE len(w) > 0))
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), i AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)
), e AS (
  SELECT a, b FROM l UNION SELECT b, a FROM l
), r AS (
  SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.b FROM r JOIN e ON r.y = e.a
), c AS (
  SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)
"""
