"""op12 against a plain Merkle tree, and its edge cases."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from terraflux.llm import merkle
from terraflux.llm.common import ascii_lower
from terraflux.llm.merkle import FIELDS, manifest

KIND = "doc_id long, source string, lang string, n_chars long, text string, tree string, leaf string, idx int, n int"
FILL = ("t", None, 7, 8)


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree_of(leaves, arity):
    """The root, and for each leaf its (siblings before, siblings after) level by level."""
    ways, nodes = [[] for _ in leaves], list(leaves)
    under = [[i] for i in range(len(leaves))]
    while len(nodes) > 1:
        runs = [range(i, min(i + arity, len(nodes))) for i in range(0, len(nodes), arity)]
        for run in runs:
            for k in run:
                for i in under[k]:
                    ways[i].append(([nodes[j] for j in run if j < k], [nodes[j] for j in run if j > k]))
        under = [sum((under[k] for k in run), []) for run in runs]
        nodes = [digest(*(nodes[k] for k in run)) for run in runs]
    return nodes[0], ways


def plain(rows, arity, marked):
    """Sorted rows (doc_id, leaf, subroot, root, proof, folded root, verified)."""
    order = lambda s: (s is not None, (s or "").encode())
    sources = sorted({r[1] for r in rows}, key=order)
    parts = []
    for s in sources:
        own = sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        parts.append((own, *tree_of([leaf_of(r) for r in own], arity)))
    root, above = tree_of([p[1] for p in parts], arity)
    out = []
    for (own, subroot, ways), top in zip(parts, above):
        for r, way in zip(own, ways):
            changed = r if not marked(r) or r[4] is None else (*r[:4], "".join(c.lower() if c.isascii() else c for c in r[4]))
            h, proof = leaf_of(changed), ""
            for left, right in way + top:
                proof += "".join(left + right)
                h = digest(*left, h, *right)
            out.append((r[0], leaf_of(r), subroot, root, digest(proof), h, h == root))
    return sorted(out, key=repr)


def marked(row):
    return row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0


def run(spark, rows, arity, partitions=7):
    docs = spark.createDataFrame([(*r, *FILL) for r in rows], KIND).repartition(partitions)
    sql = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    got = manifest(docs, arity=arity, altered=F.when(sql, ascii_lower(F.col("text"))))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def rows_of(seed, sizes):
    rng = random.Random(seed)
    out = []
    for k, size in enumerate(sizes):
        source = [None, "", "a", "é", "Z", "ﬀ", "😀"][k] if k < 7 else f"s{k}"
        for _ in range(size):
            text = rng.choice([None, "", "Text", "lower", "ÀÉ only", "A" * 300, " É Big\n"]) if rng.random() < 0.5 else f"Row {rng.random()}"
            out.append((rng.choice([rng.randrange(10**6), rng.randrange(40)]), source, rng.choice([None, "en"]), rng.choice([None, 0, -3, 12]), text))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("arity, sizes", [(16, [40, 1, 257, 16, 17, 5, 3, *[1] * 12]), (2, [9, 1, 8, 2]), (3, [28, 1, 4, 9])])
def test_whole_manifest(spark, arity, sizes):
    rows = rows_of(arity, sizes)
    got = run(spark, rows, arity)
    assert got == plain(rows, arity, marked)
    assert {r[6] for r in got} == {True, False}


def test_one_source_one_row_and_no_row(spark):
    for rows in ([(5, "s", "en", 1, "Aa")], [(i, None, None, None, None) for i in range(20)], [(i, f"s{i}", None, 2, "x") for i in range(18)]):
        assert run(spark, rows, 16) == plain(rows, 16, marked)
    assert run(spark, [], 16) == []


def test_repeated_rows_and_null_keys(spark):
    rows = [(7, "a", "en", 1, "Same")] * 50 + [(None, "a", None, None, "Q")] * 3 + [(None, None, None, None, None)] * 2 + [(7, "a", "en", 1, "Other")]
    assert run(spark, rows, 16) == plain(rows, 16, marked)


def test_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(merkle, "MAX_BROADCAST", 0)
    rows = rows_of(5, [30, 2, 18])
    assert run(spark, rows, 16) == plain(rows, 16, marked)


def test_long_text_and_own_fields(spark):
    """Fields, key and group are parameters; without alterations every row is verified."""
    docs = spark.createDataFrame([(i, "g", "x" * 500_000 + str(i)) for i in range(5)], "id int, part string, body string")
    got = manifest(docs, fields=("id", "body"), key="id", group="part", text="body", arity=4).collect()
    assert {r.id: r.leaf for r in got} == {i: leaf_of((i, "x" * 500_000 + str(i))) for i in range(5)}
    assert all(r.verified for r in got)
    with pytest.raises(ValueError):
        manifest(docs, arity=1)
    assert FIELDS[0] == "doc_id"
