"""op11 against a plain eigendecomposition, its updates against direct ones, and edge cases."""

import math
import os

import numpy as np
import pytest

from terraflux.llm import whitening
from terraflux.llm.whitening import Centre, Spectrum, fit, secular, whiten

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
KIND = "vec_id long, embedding array<float>, label int, id string, deviation string, whitened string"


def integers(vectors):
    return np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100_000


def plain(vectors, k=8):
    """(eigenvalues, unit vectors, trace) of the covariance, centred in exact integers."""
    x = integers(vectors)
    n, s = len(x), x.sum(0)
    y = (n * x - s).astype(float) / n
    values, q = np.linalg.eigh(y.T @ y / n)
    return values[::-1][:k], q[:, ::-1][:, :k], values.sum(), y


@pytest.mark.parametrize("seed, k", [(0, 1), (1, 2), (2, 40), (3, 64)])
def test_secular_roots(seed, k):
    """Against eigh, for poles from far apart to nearly equal and entries from large to nearly nothing."""
    rng = np.random.default_rng(seed)
    for spread in (1.0, 1e-6, 1e-11):
        d = np.sort(np.concatenate([rng.random(k - k // 2), 0.5 + spread * rng.random(k // 2)]))
        z = rng.normal(size=k) * 10.0 ** rng.integers(-6, 1, k)
        z /= np.linalg.norm(z)
        values, turn = secular(d, z, 0.7)
        assert np.allclose(np.sort(values), np.linalg.eigvalsh(np.diag(d) + 0.7 * np.outer(z, z)), atol=1e-14)
        assert np.abs(turn.T @ turn - np.eye(k)).max() < 1e-12
        assert np.abs(turn * values @ turn.T - np.diag(d) - 0.7 * np.outer(z, z)).max() < 1e-13


@pytest.mark.parametrize("kind", ["random", "repeated", "low rank", "sparse"])
def test_updates_and_merges(kind):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 24)) * np.logspace(0, -5, 24) * 100
    if kind == "repeated":
        x[50:200] = x[3]
    if kind == "low rank":
        x = rng.integers(-3, 4, (300, 5)).astype(float) @ rng.integers(-2, 3, (5, 24))
    if kind == "sparse":
        x[np.arange(300) % 3 > 0] = 0
    parts = []
    for rows in (x[:1], x[1:90], x[90:91], x[91:]):
        parts.append(Spectrum.empty(24))
        for row in rows:
            parts[-1].add(row)
    whole = parts[0]
    for p in parts[1:]:
        whole.merge(p)
    want = (x - x.mean(0)).T @ (x - x.mean(0))
    assert whole.n == 300 and np.allclose(whole.mean, x.mean(0), atol=1e-10)
    assert np.abs(whole.vectors * whole.values @ whole.vectors.T - want).max() < 1e-10 * max(1, np.abs(want).max())
    assert np.abs(whole.vectors.T @ whole.vectors - np.eye(24)).max() < 1e-11


def check(got, vectors, k=8):
    """got: rows of the query of usable vectors, ids being places in `vectors`."""
    values, q, trace, y = plain(vectors, k)
    by = {}
    for r in got:
        by.setdefault(r.component, {})[r.vec_id] = r
    assert sorted(by) == list(range(1, k + 1))
    x, n = integers(vectors).tolist(), len(vectors)
    s = [sum(c) for c in zip(*x)]
    for c, rows in by.items():
        want = y @ q[:, c - 1] / math.sqrt(values[c - 1])
        have = np.array([rows[i].whitened for i in range(n)])
        sign = np.sign(want @ have)
        assert np.abs(have - sign * want).max() < 1e-7, c
        assert {r.explained for r in rows.values()} == {rows[0].explained} and math.isclose(rows[0].explained, values[c - 1] / trace, rel_tol=1e-9)
        assert rows[0].identity_error < 1e-9 and {r.n for r in rows.values()} == {n}
        for i in range(n):
            assert rows[i].deviation == sum((n * v - t) ** 2 for v, t in zip(x[i], s))


@needs_tables
@pytest.mark.parametrize("partitions", [1, 40])
def test_whole_table(spark, partitions, monkeypatch):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    vectors = [r.embedding for r in rows.orderBy("vec_id").collect()]
    monkeypatch.setattr(whitening, "table", lambda *a: rows.repartition(partitions))
    check(whitening.op11_whitening(spark, SF).collect(), vectors)


def test_rows_that_are_no_vectors(spark, monkeypatch):
    rng = np.random.default_rng(2)
    good = [[float(np.float32(v)) for v in rng.normal(size=10)] for _ in range(60)]
    rows = [(i, v, 1, "i", "d", "w") for i, v in enumerate(good)]
    odd = [None, [], [1.0] * 9, [1.0] * 9 + [None], [float("nan")] * 10, [1.0] * 9 + [float("inf")], [1.0] * 9 + [-float("inf")], [3e38] * 10]
    table = spark.createDataFrame(rows + [(1000 + i, v, None, None, None, None) for i, v in enumerate(odd)], KIND).repartition(5)
    monkeypatch.setattr(whitening, "table", lambda *a: table)
    got = whitening.op11_whitening(spark, "")
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(got.collect(), good)


def test_null_and_repeated_keys(spark):
    rows = spark.createDataFrame([(None, [1.0, 2.0]), (3, [2.0, 1.0]), (3, [2.0, 1.0]), (3, [0.0, 7.0])], "vec_id long, embedding array<double>")
    got = whiten(rows, fit(rows)).collect()
    assert sorted((r.id is None, r.deviation) for r in got)[-1][0] and len(got) == 4
    same = [r.whitened for r in got if r.id == 3]
    assert any(a == b for i, a in enumerate(same) for b in same[:i]) and all(len(r.whitened) == 2 for r in got)


def test_without_variance(spark, monkeypatch):
    """No row, one row, equal rows: nulls where nothing varies. Two different rows: one component varies."""
    for rows, nulls in (([], 0), ([(1, [0.5, 1.5])], 2), ([(1, [0.5, 1.5]), (2, [0.5, 1.5])], 4), ([(1, [0.5, 1.5]), (2, [0.25, 1.0])], 2)):
        table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
        monkeypatch.setattr(whitening, "table", lambda *a, table=table: table)
        got = whitening.op11_whitening(spark, "").collect()
        assert len(got) == 2 * len(rows) and sum(r.whitened is None for r in got) == nulls
        assert all(r.identity_error < 1e-9 for r in got)


def test_deviation_is_exact_or_null():
    x = np.array([[2**40, 0, 5], [0, 1, 6], [100_000, 2, 7]])
    c = Centre(3, tuple(int(v) for v in x.sum(0)))
    want = [sum((3 * int(v) - s) ** 2 for v, s in zip(row, c.sums)) for row in x]
    assert c.deviation(x) == [v if v < 2**63 else None for v in want]
    x[0, 0] = 2**20
    c = Centre(3, tuple(int(v) for v in x.sum(0)))
    assert c.deviation(x) == [sum((3 * int(v) - s) ** 2 for v, s in zip(row, c.sums)) for row in x]
