"""Operators against brute force on the smallest tables, and accuracy where there is no exact answer."""

import math
import os
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from terraflux.llm import near_dedup, quality, substring_dedup
from terraflux.llm.components import connected_components

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def components_of(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {x: find(x) for x in list(parent)}


def test_connected_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1040)] + [(5000, i) for i in range(5001, 5050)] + [(7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = components_of([e for e in edges if e[0] != e[1]])
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def texts(spark, n, seed):
    """Near copies of a few bases in chains, so that links run through documents that are no links of each other."""
    rng = random.Random(seed)
    out, base = [], [f"w{rng.randrange(400)}" for _ in range(80)]
    for i in range(n):
        if i % 40 == 0:
            base = [f"w{rng.randrange(400)}" for _ in range(80)]
        words = list(base)
        for _ in range(rng.randrange(0, 7)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
        if rng.random() < 0.3:
            base = words
        out.append((i, " ".join(words)))
    return out


def wanted_components(rows, k=2):
    """Components by comparing every pair of texts."""
    sets = {i: set(zip(*(t.split()[j:] for j in range(k)))) for i, t in rows}
    return components_of([(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])])


@pytest.mark.parametrize("seed", [1, 2])
def test_near_dedup_finds_every_link(spark, seed):
    rows = texts(spark, 240, seed)
    want = wanted_components(rows)
    got = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2)
    assert {r.doc_id: r.component_id for r in got.collect()} == {i: want.get(i, i) for i, _ in rows}


@pytest.mark.parametrize("seed, k", [(3, 2), (5, 5)])
def test_near_dedup_of_a_large_group(spark, seed, k):
    """One group of near copies; a tenth of its members is far from the others, and some of those are near to each other:
    edited alike, cut down alike, or longer by one passage. Such links do not run through any pivot."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(120)]

    def edited(words, n):
        words = list(words)
        for _ in range(n):
            at = rng.randrange(len(words))
            words[at : at + 1] = rng.choice([[], [f"e{rng.randrange(10**6)}"], [words[at], f"e{rng.randrange(10**6)}"]])
        return words

    rows = [edited(base, rng.randrange(0, 4)) for _ in range(270)] + [edited(base, rng.randrange(10, 22)) for _ in range(30)]
    for _ in range(6):
        far = rng.choice([edited(base, 14), base[: 120 - rng.randrange(25, 40)], base + [f"x{rng.randrange(9)}y{i}" for i in range(rng.randrange(30, 50))]])
        rows += [edited(far, rng.randrange(0, 5)) for _ in range(4)]
    rng.shuffle(rows)
    rows = [(i, " ".join(words)) for i, words in enumerate(rows)]
    want = wanted_components(rows, k)
    assert len(set(want.values())) > 2
    got = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"), shingle=k)
    assert {r.doc_id: r.component_id for r in got.collect()} == {i: want.get(i, i) for i, _ in rows}


@pytest.mark.parametrize("hot", [False, True])
def test_substring_dedup(spark, hot, monkeypatch):
    if hot:  # every minimiser counts as frequent: windows travel one by one
        monkeypatch.setattr(substring_dedup, "_among", lambda m, hot: m == m)
        monkeypatch.setattr(substring_dedup, "plan_buckets", lambda docs: (8, __import__("numpy").zeros(1, "uint64")))
    rng = random.Random(4)
    pool = [[f"p{k}w{i}" for i in range(40)] for k in range(5)]
    rows = []
    for i in range(80):
        words = []
        for _ in range(6):
            p, a = rng.choice(pool), rng.randrange(30)
            words += p[a : a + rng.randrange(5, 25)] + [f"u{rng.randrange(10**6)}"] * rng.randrange(0, 3)
        rows.append((i, " ".join(words)))
    first = {}
    for i, t in rows:
        w = t.split()
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), i)
    want = {}
    for i, t in rows:
        w, gone = t.split(), set()
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < i:
                gone.update(range(k, k + 13))
        want[i] = " ".join(x for k, x in enumerate(w) if k not in gone)
    got = {r.doc_id: r.kept for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def plain_ftrl(examples, epochs):
    """One example at a time, sums of gradients and of their squares in dicts."""
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= quality.L1:
            return 0.0
        return -(z[i] - math.copysign(quality.L1, z[i])) / ((quality.BETA + math.sqrt(n.get(i, 0.0))) / quality.ALPHA + quality.L2)

    for _ in range(epochs):
        for slots, label in examples:
            x = {int(s): c / math.sqrt(len(slots)) for s, c in Counter(slots.tolist()).items()}
            x[-1] = 1.0
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - label) * v
                sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / quality.ALPHA
                z[i] = z.get(i, 0.0) + g - sigma * w[i]
                n[i] = n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z}


def test_training_against_plain_python():
    rng = random.Random(6)
    good, bad = [[f"{c}{i}" for i in range(60)] for c in "gb"]
    texts_ = [(" ".join(rng.choice(good if i % 2 else bad if rng.random() < 0.7 else good) for _ in range(rng.randrange(1, 40))).encode(), i % 2) for i in range(300)]
    slots, first = quality.features([t for t, _ in texts_])
    examples = [(slots[first[i] : first[i + 1]], label) for i, (_, label) in enumerate(texts_)]
    w, bias = quality.train(examples, 3)
    want = plain_ftrl(examples, 3)
    assert abs(bias - want.pop(-1)) < 1e-9
    assert {i for i, v in enumerate(w) if v} == {i for i, v in want.items() if v}
    assert max(abs(w[i] - v) for i, v in want.items()) < 1e-9


def shingled(text, k):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).split()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} if words else set()


def hits(text, windows, lengths):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    hit = {i + k for n in lengths for i in range(len(words) - n + 1) if tuple(words[i : i + n]) in windows for k in range(n)}
    return len(words), len(hit)


@needs_tables
def test_stages_against_brute_force(spark):
    """Every stage at its production parameters on the documents of a table and on the cases that tables seldom have: nulls,
    empty and repeated rows, an extra column."""
    import corpus_pipeline

    stages = dict(corpus_pipeline.STAGES)
    schema = "doc_id long, text string, lang string, source string, n_chars long, fp string"
    rows = [(*r, "x") for r in spark.read.parquet(f"{SF}/documents.parquet").select(*corpus_pipeline.COLUMNS).orderBy("doc_id").collect()]
    rows += [(None, "orphan", None, None, None, None), (10**6, None, None, "src1", 0, None), (10**6 + 1, "", "en", None, 0, None), rows[0], rows[1]]
    docs_ = spark.createDataFrame(rows, schema)
    kept = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)
    pairs = [(r[0], r[1]) for r in rows]

    w, bias = quality.fit(docs_, spark.read.parquet(f"{SF}/labels.parquet"))
    scored = {(r.doc_id, r.text) for r in docs_.join(quality.score(docs_, w, bias).filter("predicted = 1").select(F.col("doc_id").alias("d")).distinct(), F.col("doc_id").eqNullSafe(F.col("d"))).collect()}
    assert kept(stages["quality"](spark, docs_, SF)) == sorted((p for p in pairs if p in scored), key=repr)

    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    best = {}
    for i, t in pairs:
        order = (-len(t or ""), i is None, i or 0)
        best[norm(t)] = min(best.get(norm(t), (order, i, t)), (order, i, t), key=lambda b: b[0])
    exact = stages["exact_dedup"](spark, docs_, SF)
    assert exact.columns == docs_.columns and kept(exact) == sorted(((i, t) for _, i, t in best.values()), key=repr)

    sets = {i: shingled(t, 5) for i, t in pairs if i is not None and shingled(t, 5)}
    groups = components_of([(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])])
    assert len(set(groups.values())) > 3
    assert kept(stages["near_dedup"](spark, docs_, SF)) == sorted((p for p in pairs if groups.get(p[0], p[0]) == p[0]), key=repr)

    items = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r.text or "").translate({c: c + 32 for c in range(65, 91)})) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = {tuple(x[i : i + min(13, len(x))]) for x in items if x for i in range(len(x) - min(13, len(x)) + 1)}
    lengths = {len(x) for x in windows}
    clean = [p for p in pairs if not (lambda n, h: h > 0 and 20 * h >= n)(*hits(p[1], windows, lengths))]
    assert 0 < len(pairs) - len(clean) and kept(stages["decontamination"](spark, docs_, SF)) == sorted(clean, key=repr)
    assert stages["mixing"](spark, docs_, SF).count() > 0
    for name, stage in corpus_pipeline.STAGES:
        none = stage(spark, docs_.filter("false"), SF)
        assert none.count() == 0 and (name == "mixing" or none.columns == docs_.columns), name


@needs_tables
def test_quality_on_the_held_out_third(spark):
    scored = quality.op8_quality(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").filter("held_out")
    rows = scored.select("quality", "predicted").collect()
    # measured: 1.0 and 1.0 here, 0.996 and 0.974 on the table of sf0.1
    assert sum(r.quality == r.predicted for r in rows) / len(rows) > 0.98
    junk = [r for r in rows if r.quality == 0]
    assert sum(r.predicted == 0 for r in junk) / len(junk) > 0.92


@needs_tables
def test_pipeline(spark):
    import corpus_pipeline

    docs, before = spark.read.parquet(f"{SF}/documents.parquet"), None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == corpus_pipeline.COLUMNS, name
        ids = {r.doc_id for r in after.select("doc_id").collect()}
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        assert ids <= before and len(ids) > 0.5 * len(before), name
        docs = spark.createDataFrame(after.collect(), docs.schema)
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert mixed.count() > 0 and mixed.join(docs, "doc_id", "left_anti").count() == 0


@needs_tables
def test_registered_queries_agree_with_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    from terraflux.llm.registry import ORACLE_SQL, QUERIES

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    for name, sql in ORACLE_SQL.items():
        df = QUERIES[name](spark, SF)
        cur = con.execute(sql)
        names = [d[0] for d in cur.description]
        assert sorted(names) == sorted(df.columns), name
        assert sorted(map(repr, ([r[c] for c in names] for r in df.collect()))) == sorted(map(repr, map(list, cur.fetchall()))), name
    assert QUERIES["op5_html_text"](spark, SF).filter(F.length("text") == 0).count() == 0
