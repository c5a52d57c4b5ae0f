"""Queries over whole tables, on rows that a subset would lose."""

import datetime as dt
import hashlib
import random

import pytest

from terraflux.operators import windows as win
from terraflux.plans import QUERIES


def test_digests_of_all_documents(spark, tmp_path):
    texts = ["one", "two\nlines\n", "\x1e", "\x1f1 \x1f", "\x1f2", "", None, "one", "Forêt " * 200]
    spark.createDataFrame([(20 * i + 1, x) for i, x in enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.sha256: r.n for r in QUERIES["s15_file_digests_whole"](spark, str(tmp_path)).collect()}
    want = [x if x is None else hashlib.sha256(x.encode()).hexdigest() for x in texts]
    assert got == {x: want.count(x) for x in want}


def events(spark, tmp_path, rows):
    spark.createDataFrame(rows, "event_id long, event_type string, ts timestamp, value double").write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def test_daily_queries_read_all_events(spark, tmp_path):
    day = lambda d: dt.datetime(2024, 1, d, 6)
    # ids without a multiple of 3 or 60, flags 0 and 10, none of them failing; source f0
    path = events(spark, tmp_path, [(8, "click", day(1), 2.0), (16, "click", day(1), 4.0), (34, "click", day(3), 5.0)])
    a4 = QUERIES["a4_resample_daily_whole"](spark, path).orderBy("day").collect()
    assert [(r.day.day, r.value) for r in a4] == [(1, 3.0), (2, None), (3, 5.0)]
    c2 = QUERIES["c2_flux_observations_whole"](spark, path).orderBy("date").collect()
    amount = 1e-6 * 12.011 * 2 * 86400
    assert [(r.site, r.date.day) for r in c2] == [("HowardSprings", 1), ("HowardSprings", 3)]
    assert [r.value for r in c2] == pytest.approx([3.0 * amount, 5.0 * amount], abs=1e-6)


def test_coverage_is_that_of_all_orders(spark, tmp_path):
    spark.createDataFrame([(7, dt.date(1996, 1, 2)), (8, dt.date(1996, 1, 4))], "o_orderkey long, o_orderdate date").write.parquet(f"{tmp_path}/orders.parquet")
    items = [(1, 1, dt.date(1996, 1, d), 1.0) for d in range(1, 6)]
    spark.createDataFrame(items, "l_suppkey long, l_linenumber int, l_shipdate date, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = QUERIES["p6_clip_to_coverage_whole"](spark, str(tmp_path))
    assert sorted(r.day.day for r in got.collect()) == [2, 3, 4]


def test_days_are_completed_after_any_length(spark, tmp_path):
    start, n = dt.datetime(2024, 1, 1), 24 * 40 + 5  # far more than 710 hours, the last day has five
    path = events(spark, tmp_path, [(i, "click", start + dt.timedelta(hours=i), float(i)) for i in range(n)])
    got = {r.t: r.value for r in QUERIES["w15_complete_days_whole"](spark, path).collect()}
    assert got == {start + dt.timedelta(hours=i): float(min(i, n - 1)) for i in range(24 * 41)}


@pytest.mark.parametrize("seed", [1, 2])
def test_neighbours_at_any_distance(spark, seed):
    rng = random.Random(seed)
    values = [1.0, 2.0] + [None] * 100 + [None if rng.random() < 0.5 else rng.uniform(-5, 5) for _ in range(40)] + [None] * 60
    df = spark.createDataFrame([("a", i, x) for i, x in enumerate(values)] + [("few", i, x) for i, x in enumerate([1.0, None, 2.0, 3.0])], "site string, i int, value double")
    out = win.neighbour_mean(df, "site", "i", "value", 4)
    got = [r.value for r in out.filter("site = 'a'").orderBy("i").collect()]
    valid = [i for i, x in enumerate(values) if x is not None]
    near = lambda i: sorted(valid, key=lambda j: (abs(j - i), -j))[:4]
    assert got == pytest.approx([sum(values[j] for j in near(i)) / 4 if x is None else x for i, x in enumerate(values)])
    assert [r.value for r in out.filter("site = 'few'").orderBy("i").collect()] == [1.0, None, 2.0, 3.0]
