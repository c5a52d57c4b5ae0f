"""F7 over large tables: columns given by name stay compiled, and f7_calendars works each time out once."""

import datetime

from pyspark.sql import functions as F

from terraflux.functions import calendars as cal
from terraflux.plans import QUERIES


def test_names_and_expressions_agree_and_names_use_no_lambda(spark):
    units, to = "hours since 1582-09-01 06:00", "days since 1850-01-01"
    df = spark.createDataFrame([(x,) for x in (-30.25, 0.0, 809.9, 810.0, 1_000_000.5, None, float("nan"))], "v double")
    for c in ("360_day", "standard"):
        named = df.select("v", cal.decode("v", units, c).alias("p")).select("v", "p", cal.encode("p", to, "standard").alias("x"), cal.is_valid("p", "noleap").alias("ok"))
        whole = df.select("v", cal.decode(F.col("v"), units, c).alias("p"), cal.rebase(F.col("v"), units, c, to, "standard").alias("x"), cal.is_valid(cal.decode(F.col("v"), units, c), "noleap").alias("ok"))
        assert "lambda" not in named._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(map(repr, named.collect())) == sorted(map(repr, whole.collect()))


def test_each_time_once_and_rows_without_one(spark, tmp_path):
    day = datetime.datetime(1996, 2, 29)
    rows = [(24 * i, day) for i in range(50)] + [(7, None), (8, None)]
    spark.createDataFrame(rows, "o_orderkey long, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    df = QUERIES["f7_calendars"](spark, str(tmp_path))
    got = df.collect()
    assert len(got) == 5 * len(rows) and len({(r.o_orderkey, r.calendar) for r in got}) == len(got)
    assert all((r.year is None and r.own_days is None and r.doy is None) == (r.o_orderkey in (7, 8)) for r in got)
    assert {(r.year, r.month, r.day) for r in got if r.calendar == "standard" and r.year} == {(1996, 2, 29)}
    assert "Aggregate [hours" in df._jdf.queryExecution().optimizedPlan().toString()
