"""Merkle manifest of a dataset: digests of rows, of their sources and of the whole, and every row's proof.

Rows become leaves where they are read, so that texts never move. Leaves are numbered within their source by a range
partitioning and the counts of its partitions. At each level a run's slot-zero node computes the indices of its siblings
(XOR for pairs, slot offsets otherwise) and finds them by an equi-join of the level with itself; it then emits the
parent. Only slot-zero nodes ask, because what one of them receives, less the member itself, is every member's sibling
list; each node so moves once and not once per sibling. The runs are then handed down level by level, again by
equi-joins, until each leaf has the runs on its way to the root.

Digests travel as 32 bytes and are hashed as lower-case hexadecimal text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terraflux.llm.common import ascii_lower, cut, table

ARITY = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows of a source and partition that may be broadcast, some 60 bytes each, and the bytes of their sources' names.
MAX_BROADCAST, MAX_BROADCAST_BYTES = 200_000, 8_000_000


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _hash(digests: Column) -> Column:
    """The digest of concatenated digests."""
    return F.unhex(F.sha2(_hex(digests), 256))


def leaf(fields: list[Column]) -> Column:
    """The digest of a row's values: `-` for null, else the count of UTF-8 bytes, a colon and the value."""
    text = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in fields]
    return F.unhex(F.sha2(F.concat(*text), 256))


def _near(df: DataFrame, name: str) -> DataFrame:
    """df, marked for broadcast if its rows and the bytes of its names are few."""
    rows, size = df.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(F.col(name).cast("string"))), F.lit(0))).first()
    return F.broadcast(df) if rows <= MAX_BROADCAST and size <= MAX_BROADCAST_BYTES else df


def _numbered(rows: DataFrame, group: str, order: list[str], name: str, more: Callable[[DataFrame], DataFrame] = lambda shifts: shifts) -> DataFrame:
    """rows with idx, the place from 0 in their group (null is a group) by order, and n, the group's rows.

    A group may fill any number of range partitions; what is joined back is a row per group and partition, to which
    `more` may add columns.
    """
    keys = [group, *order]
    placed = cut(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), name)
    whole = Window.partitionBy(group)
    counted = placed.groupBy(group, "part").agg(F.min("at").alias("start"), F.count("*").alias("here"))
    before = F.coalesce(F.sum("here").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = cut(counted.select(group, "part", (before - F.col("start")).alias("shift"), F.sum("here").over(whole).alias("n")), f"{name}-shifts")
    shifts = _near(more(shifts), group)
    joined = placed.join(shifts, placed[group].eqNullSafe(shifts[group]) & (placed["part"] == shifts["part"]))
    return joined.select(*[placed[c] for c in rows.columns], (F.col("at") + F.col("shift")).alias("idx"), *[shifts[c] for c in shifts.columns if c not in (group, "part", "shift")])


def _with_trees(shifts: DataFrame) -> DataFrame:
    """shifts(source, ..) with tree, the source's place among all sources."""
    names = shifts.select("source").distinct().withColumn("one", F.lit(0))
    trees = _near(cut(_numbered(names, "one", ["source"], "merkle-sources").select("source", F.col("idx").alias("tree")), "merkle-trees"), "source")
    return shifts.join(trees, shifts["source"].eqNullSafe(trees["source"])).select(*[shifts[c] for c in shifts.columns], "tree")


def _sibling_indices(arity: int) -> Column:
    """Of a slot-zero node: the indices of the others of its run."""
    if arity == 2:
        return F.filter(F.array(F.col("idx").bitwiseXOR(F.lit(1))), lambda i: i < F.col("n"))
    return F.filter(F.transform(F.sequence(F.lit(1), F.lit(arity - 1)), lambda slot: F.col("idx") + slot), lambda i: i < F.col("n"))


def _runs(nodes: DataFrame, arity: int, name: str) -> DataFrame:
    """(tree, run, n, members, bytes) of a level's nodes(tree, idx, n, digest, about): a row per run, from its slot-zero node."""
    zero, others = nodes.filter(F.col("idx") % arity == 0), nodes.filter(F.col("idx") % arity != 0)
    asked = zero.select("tree", F.col("idx").alias("base"), F.explode(_sibling_indices(arity)).alias("idx"))
    received = asked.join(others, ["tree", "idx"]).select("tree", "base", "n", (F.col("idx") - F.col("base")).cast("int").alias("slot"), "digest", "about")
    own = zero.select("tree", F.col("idx").alias("base"), "n", F.lit(0).alias("slot"), "digest", "about")
    members = F.array_sort(F.collect_list(F.struct("slot", "digest", "about")))  # at most arity of them
    runs = own.union(received).groupBy("tree", "base").agg(F.first("n").alias("n"), members.alias("members"))
    joined = F.aggregate("members", F.lit(b""), lambda all_, m: F.concat(all_, m["digest"]))
    return cut(runs.select("tree", (F.col("base") / arity).cast("long").alias("run"), "n", "members", joined.alias("bytes")), name)


class Tree(NamedTuple):
    """runs: by level, from the leaves; roots: (tree, digest)."""

    runs: list[DataFrame]
    roots: DataFrame


def _built(nodes: DataFrame, arity: int, name: str) -> Tree:
    """The trees over nodes(tree, idx, n, digest, about), level by level, until each is one node."""
    levels, roots = [], []
    most = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        roots.append(nodes.filter("n = 1").select("tree", "digest"))
        if most <= 1:
            break
        runs = _runs(nodes.filter("n > 1"), arity, f"{name}-{len(levels)}")
        levels.append(runs)
        most = -(-most // arity)
        nodes = runs.select("tree", F.col("run").alias("idx"), F.ceil(F.col("n") / arity).cast("long").alias("n"), _hash(F.col("bytes")).alias("digest"), F.lit(None).cast("string").alias("about"))
    return Tree(levels, reduce(DataFrame.union, roots))


def _handed_down(tree: Tree, arity: int, tops: DataFrame) -> DataFrame:
    """The leaves' runs, each with path, array of (slot, bytes) from the run above it up to what tops(tree, path, ..) holds above its tree."""
    extra = [c for c in tops.columns if c not in ("tree", "path")]
    above = None
    for runs in reversed(tree.runs):
        lone = runs.filter(F.col("n") <= arity).join(tops, "tree")
        if above is not None:
            step = F.array(F.struct((F.col("run") % arity).cast("int").alias("slot"), F.col("above_bytes").alias("bytes")))
            upper = above.select("tree", F.col("run").alias("up"), F.col("bytes").alias("above_bytes"), F.col("path").alias("above_path"), *extra)
            lower = runs.filter(F.col("n") > arity).withColumn("up", F.floor(F.col("run") / arity).cast("long")).join(upper, ["tree", "up"])
            lone = lone.unionByName(lower.select(*runs.columns, F.concat(step, "above_path").alias("path"), *extra))
        above = lone
    return above


def _path(run: Column, slot: Column, rest: Column) -> Column:
    return F.concat(F.array(F.struct(slot.alias("slot"), run.alias("bytes"))), rest)


def _left(p: Column) -> Column:
    return F.substring(p["bytes"], F.lit(1), p["slot"] * 32)


def _right(p: Column) -> Column:
    return F.substring(p["bytes"], p["slot"] * 32 + 33, F.lit(2**31 - 1))


def manifest(
    docs: DataFrame, *, altered: Column | None = None, text: str = "text", fields: tuple[str, ...] = FIELDS, key: str = "doc_id", group: str = "source", arity: int = ARITY
) -> DataFrame:
    """One row per row of docs: key, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf is the digest of `fields`; leaves of one `group` ascend by `key` (null first, equal ones by their digest) and
    form its tree, of which each node is the digest of up to `arity` consecutive nodes below; the groups' roots, by the
    group's bytes and null first, form the tree above. proof_sha256 is the digest of all siblings on the way from the
    leaf to the root. folded_root is worked out from the leaf and these siblings, with the text replaced by `altered`
    where that is not null, and verified says whether it is the root.

    Null values have a digest of their own; repeated rows are leaves of their own. A group of one row has that row's
    leaf as its root, and a table of one row its leaf. Other columns are not read, whatever their names. An empty
    table gives an empty result.
    """
    if arity < 2:
        raise ValueError("a run has two members at least")
    columns = [F.col(f) for f in fields]
    other = leaf([altered if f == text else F.col(f) for f in fields]) if altered is not None else F.lit(None).cast("binary")
    read = docs.select(
        F.col(group).alias("source"), F.col(key).alias("key"), leaf(columns).alias("digest"),
        (F.when(altered.isNotNull(), other) if altered is not None else other).alias("other"), F.monotonically_increasing_id().alias("tie"),
    )
    # ties are told apart so that any number of equal rows can be spread over partitions
    numbered = _numbered(cut(read, "merkle-leaves"), "source", ["key", "digest", "tie"], "merkle-placed", _with_trees)
    about = F.struct(F.col("key"), F.col("other"))
    nodes = cut(numbered.select("tree", "idx", "n", "digest", about.alias("about")), "merkle-nodes")
    own = _built(nodes, arity, "merkle-own")
    subroots = cut(own.roots, "merkle-subroots")
    n = subroots.count()
    whole = _built(subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(n).cast("long").alias("n"), "digest", F.col("tree").alias("about")), arity, "merkle-whole")
    root = whole.roots.first()
    root = F.lit(bytes(root["digest"]) if root else b"")
    kind = "array<struct<slot:int,bytes:binary>>"
    none = F.array().cast(kind)
    if n > 1:
        runs = _handed_down(whole, arity, whole.roots.select("tree", none.alias("path")))
        tops = runs.select(F.explode("members").alias("m"), "bytes", "path").select(F.col("m.about").alias("tree"), _path(F.col("bytes"), F.col("m.slot"), F.col("path")).alias("path"), F.col("m.digest").alias("subroot"))
        tops = cut(tops, "merkle-tops")
    else:
        tops = subroots.select("tree", none.alias("path"), F.col("digest").alias("subroot"))
    found = nodes.filter("n = 1").join(tops, "tree").select("about", F.col("digest").alias("leaf"), "path", "subroot")
    if own.runs:
        runs = _handed_down(own, arity, tops).select(F.explode("members").alias("m"), "bytes", "path", "subroot")
        found = found.unionByName(runs.select(F.col("m.about").alias("about"), F.col("m.digest").alias("leaf"), _path(F.col("bytes"), F.col("m.slot"), F.col("path")).alias("path"), "subroot"))
    siblings = F.aggregate("path", F.lit(b""), lambda all_, p: F.concat(all_, _left(p), _right(p)))
    folded = F.aggregate("path", F.coalesce("about.other", "leaf"), lambda h, p: _hash(F.concat(_left(p), h, _right(p))))
    result = found.select("about.key", "leaf", "subroot", F.sha2(_hex(siblings), 256).alias("proof_sha256"), folded.alias("folded"))
    return result.select(F.col("key").alias(key), _hex(F.col("leaf")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"), _hex(root).alias("root"), "proof_sha256", _hex(F.col("folded")).alias("folded_root"), (F.col("folded") == root).alias("verified"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return manifest(table(spark, sf_dir, "documents"), altered=F.when(marked, ascii_lower(F.col("text"))))


def _crc32(text: str) -> str:
    """SQL of the CRC-32 of an ASCII text, bit by bit."""
    bits = "list_reduce(range(9), lambda a, k: CASE WHEN k = 0 THEN a WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, {})"
    codes = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS bigint))"
    return f"xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS bigint), {codes}), lambda a, c: {bits.format('xor(a, c)')}))"


def _sql_levels(name: str, levels: int) -> str:
    """CTEs: runs r0 .. and nodes l1 .. over {name}_l0(tree, idx, n, h), and the roots."""
    steps = [
        f"""{name}_r{k} AS (SELECT tree, idx // {ARITY} AS run, any_value(n) AS n, list(h ORDER BY idx) AS hs FROM {name}_l{k} WHERE n > 1 GROUP BY tree, idx // {ARITY}),
{name}_l{k + 1} AS (SELECT tree, run AS idx, (n + {ARITY - 1}) // {ARITY} AS n, sha256(array_to_string(hs, '')) AS h FROM {name}_r{k})"""
        for k in range(levels)
    ]
    roots = " UNION ALL ".join(f"SELECT tree, h FROM {name}_l{k} WHERE n = 1" for k in range(levels + 1))
    return ",\n".join([*steps, f"{name}_roots AS ({roots})"])


def _sql_fold(name: str, levels: int, first: str, tree: str, idx: str) -> tuple[str, str]:
    """CTEs that fold `first`(h, s, ..) level by level, and the name of the last."""
    steps, now = [], first
    for k in range(levels):
        slot = f"({idx} // {ARITY**k} % {ARITY})"
        steps.append(f"""{name}_f{k} AS (
  SELECT f.* EXCLUDE (h, s), CASE WHEN hs IS NULL THEN h ELSE sha256(array_to_string(hs[:{slot}] || [h] || hs[{slot} + 2:], '')) END AS h,
         s || coalesce(array_to_string(hs[:{slot}] || hs[{slot} + 2:], ''), '') AS s
  FROM {now} f LEFT JOIN {name}_r{k} r ON r.tree = {tree} AND r.run = {idx} // {ARITY ** (k + 1)}
)""")
        now = f"{name}_f{k}"
    return ",\n".join(steps), now


#: Levels that the SQL unrolls: a million rows of a source, and 4,096 sources.
_OWN, _WHOLE = 5, 3
_own_fold, _own_last = _sql_fold("own", _OWN, "start", "f.tree", "f.idx")
_whole_fold, _whole_last = _sql_fold("whole", _WHOLE, _own_last, "0", "f.tree")
_FIELD = "coalesce(strlen(CAST({0} AS varchar)) || ':' || CAST({0} AS varchar), '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format("{text}" if f == "text" else f) for f in FIELDS) + ")"
OP12_SQL = f"""
WITH d AS (
  SELECT doc_id, source, {_LEAF.format(text="text")} AS leaf,
         CASE WHEN {_crc32("CAST(doc_id AS varchar)")} % 5 = 0 THEN {_LEAF.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS other
  FROM documents
), own_l0 AS (
  SELECT doc_id, leaf AS h, other, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n
  FROM d
), {_sql_levels("own", _OWN)},
whole_l0 AS (SELECT 0 AS tree, tree AS idx, count(*) OVER () AS n, h FROM own_roots),
{_sql_levels("whole", _WHOLE)},
start AS (SELECT doc_id, tree, idx, h AS leaf, coalesce(other, h) AS h, '' AS s FROM own_l0),
{_own_fold},
{_whole_fold}
SELECT f.doc_id, f.leaf, o.h AS subroot, w.h AS root, sha256(f.s) AS proof_sha256, f.h AS folded_root, f.h = w.h AS verified
FROM {_whole_last} f JOIN own_roots o ON o.tree = f.tree CROSS JOIN whole_roots w
"""
