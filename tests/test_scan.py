"""Series operators that go block by block against windows over whole series, and their plans."""

import datetime
import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from terraflux.operators import aggregates as agg
from terraflux.operators import scan
from terraflux.operators import windows as win


def rows(n=400, seed=1):
    """Series of many lengths, one of them null, of one step and of uneven ones, with gaps longer than a block."""
    rng, out = random.Random(seed), []
    for key in ("a", "b", None, "one", "gap"):
        i, t = 0, datetime.datetime(2000, 1, 30)
        for k in range(1 if key == "one" else n if key == "a" else rng.randrange(2, n)):
            i += 1 if key == "a" else rng.choice([1, 1, 2, 30]) if key != "gap" or k % 50 else 500
            out.append((key, i, t + datetime.timedelta(hours=i), rng.random() if rng.random() < (0.05 if key == "gap" else 0.6) else None, rng.randrange(5)))
    rng.shuffle(out)
    return out


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(rows(), "k string, i long, t timestamp_ntz, v double, x int").withColumn("b", F.floor(F.col("i") / 7)).repartition(5).cache()


def same(got, want):
    assert got.columns == want.columns
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want.collect())))


@pytest.mark.parametrize("block", [None, "b"])
@pytest.mark.parametrize("order", ["i", "t"])
def test_shifted_and_counted(df, order, block):
    w = Window.partitionBy("k").orderBy(order)
    want = df.withColumns({"p": F.lag("v").over(w), "q": F.lead("x").over(w), "o": F.lag(order).over(w)})
    same(scan.shifted(df, ["k"], order, {"p": ("v", -1), "q": ("x", 1), "o": (order, -1)}, block), want)
    same(scan.counted(df, ["k"], order, "n", block=block), df.withColumn("n", F.row_number().over(w).cast("long")))
    same(scan.counted(df, ["k"], order, "n", F.col("v"), block), df.withColumn("n", F.count("v").over(w.rowsBetween(Window.unboundedPreceding, 0))))


def test_rows_of_equal_order(spark):
    """Each row is once before another, also where a block ends within equal ones."""
    df = spark.createDataFrame([("a", o, x) for o in (1, 2, 2, 2, 3) for x in (o * 10 + 1, o * 10 + 2)], "k string, o int, x int").distinct()
    got = scan.shifted(df, ["k"], "o", {"p": ("x", -1)}).collect()
    assert sorted(r.p or 0 for r in got) == [0, 11, 12, 21, 22, 31]


@pytest.mark.parametrize("block", [None, "b"])
def test_operators_equal_whole_windows(df, block):
    w = Window.partitionBy("k").orderBy("t")
    days = df.select("k", F.to_date("t").alias("day"), "b").groupBy("k", "day").agg(F.min("b").alias("b"))
    by_day = Window.partitionBy("k").orderBy("day")
    lead, lag = F.datediff(F.lead("day").over(by_day), "day"), F.datediff("day", F.lag("day").over(by_day))
    same(win.step_seconds(days, "k", "day", block), days.withColumn("step", F.coalesce(lead * 86400.0, lag * 86400.0, F.lit(0.0)).cast("double")))
    same(agg.modal_step(days, "k", "day", block), days.withColumn("step", lag).groupBy("k").agg(F.mode("step", deterministic=True).alias("step")))
    groups = df.withColumn("g", F.floor((F.row_number().over(w) - 1) / 3)).groupBy("k", "g").agg(F.min("t").alias("t"), F.count("*").alias("n"), F.max("v").alias("v"))
    same(agg.aggregate_ratio(df, "k", "t", "v", 3, "max", block), groups.filter("n = 3").select("k", "t", "v"))
    files = df.select("k", F.col("i").alias("a"), (F.col("i") + F.col("x")).alias("e"), "b")
    ok = F.coalesce(F.col("a") > F.lag("e").over(Window.partitionBy("k").orderBy("a", "e")), F.lit(True)) & (F.col("a") <= F.col("e"))
    same(win.validate_sequence(files, "k", "a", "e", block), files.withColumn("ok", ok))
    seconds = F.unix_timestamp(F.col("t").cast("timestamp"))
    steps = df.withColumn("d", seconds - F.lag(seconds).over(w)).groupBy("k").agg(F.count("*").alias("n"), F.min("d").alias("step"), (F.min("d") == F.max("d")).alias("uniform"))
    same(win.inspect_time(df, "k", "t", block).select("k", "n", "step", "uniform"), steps)


@pytest.mark.parametrize("n, reach", [(1, None), (4, None), (3, 20), (200, None)])
def test_neighbour_mean(df, n, reach):
    got = {(r.k, r.i): r.v for r in win.neighbour_mean(df, "k", "i", "v", n, reach, "b").collect()}
    series = {}
    for k, i, _, v, _ in rows():
        series.setdefault(k, []).append((i, v))
    assert len(got) == sum(map(len, series.values()))
    for k, own in series.items():
        valid = [(i, v) for i, v in own if v is not None]
        for i, v in own:
            near = sorted((abs(j - i), -j, u) for j, u in valid if reach is None or abs(j - i) <= reach)[:n]
            want = v if v is not None else sum(u for *_, u in near) / n if len(near) == n else None
            assert got[k, i] == (want if want is None else pytest.approx(want)), (k, i)


def test_no_window_over_a_series(df):
    """Windows go over blocks of a series, or over its blocks' summaries: never over its rows."""
    days = df.select("k", F.to_date("t").alias("day")).distinct()
    uniform = df.select("k", "t", "v").filter("k = 'a'")
    for out in (
        agg.aggregate_ratio(df, "k", "t", "v", 3), agg.modal_step(days, "k", "day"), win.neighbour_mean(df, "k", "i", "v", 4), win.step_seconds(days, "k", "day"), win.inspect_time(df, "k", "t"),
        win.apply_boundary(uniform, "k", "t", "v", start="pad", max_pad=10_000, pad="extrapolate"), win.pad_series(uniform, "k", "t", "v", "extrapolate", 2, 2, 3600), win.validate_sequence(df, "k", "i", "x"),
    ):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        windows = re.findall(r"Window \[.*?\], \[(.*?)\], \[(.*?)\]", plan)
        assert all("__block" in partition or "__block" in order for partition, order in windows), plan
