"""every calendar against a walk through all its days, and numeric times back and forth."""

import datetime

import pytest
from pyspark.sql import functions as F

from terraflux.functions import calendars as cal

LENGTHS = [31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31]


def length(calendar, y, m):
    if calendar == "360_day":
        return 30
    julian = y % 4 == 0
    civil = julian and (y % 100 != 0 or y % 400 == 0)
    leap = {"noleap": False, "all_leap": True, "julian": julian, "proleptic_gregorian": civil, "standard": julian if y <= 1582 else civil}[calendar]
    return 29 if m == 2 and leap else LENGTHS[m - 1]


def walk(calendar, first, last):
    for y in range(first, last):
        for m in range(1, 13):
            for d in range(1, length(calendar, y, m) + 1):
                if not (calendar == "standard" and (y, m) == (1582, 10) and 4 < d < 15):
                    yield y, m, d


@pytest.mark.parametrize("first, last", [(-3, 6), (1490, 2110)])
@pytest.mark.parametrize("calendar", list(cal.CALENDARS))
def test_every_day(spark, calendar, first, last):
    """In order and without gaps, both ways."""
    days = list(walk(calendar, first, last))
    units = f"days since {first}-01-01"
    df = spark.range(len(days)).select("id", cal.decode(F.col("id"), units, calendar).alias("p"))
    back = cal.encode(F.col("p"), units, calendar)
    got = df.select("id", "p.year", "p.month", "p.day", cal.is_valid(F.col("p"), calendar).alias("ok"), (back == F.col("id")).alias("same"), cal.day_of_year(F.col("p"), calendar).alias("doy"), cal.days_in_year(F.col("p.year"), calendar).alias("size")).toArrow().to_pandas()
    assert list(zip(got.year, got.month, got.day)) == days
    assert got.ok.all() and got.same.all() and (got.doy[(got.month == 1) & (got.day == 1)] == 1).all()
    sizes = got.groupby("year").agg(n=("doy", "max"), size=("size", "first"), rows=("id", "count"))
    assert (sizes.n == sizes["rows"]).all() or calendar == "standard"
    assert (sizes["size"] == sizes["rows"]).all()


def one(spark, column, kind="double", value=0.0):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column.alias("x")).first().x


@pytest.mark.parametrize("units, value, want", [
    ("days since 1850-01-01", 0.25, (1850, 1, 1, 6, 0, 0, 0)), ("hours since 2000-02-28 23:00", 2.0, (2000, 2, 29, 1, 0, 0, 0)),
    ("seconds since 1970-01-01T00:00:00Z", -0.000001, (1969, 12, 31, 23, 59, 59, 999999)), ("minutes since 2001-03-01 00:00:00 +10:00", 0.0, (2001, 2, 28, 14, 0, 0, 0)),
    ("milliseconds since 1582-10-15", -1.0, (1582, 10, 4, 23, 59, 59, 999000)), ("days since 1582-10-04 12:00:30.5", 0.5, (1582, 10, 15, 0, 0, 30, 500000)),
    ("Days since 1-1-1", 738_156.25, (2021, 12, 31, 6, 0, 0, 0)),
])
def test_units(spark, units, value, want):
    got = one(spark, cal.decode(F.col("v"), units), value=value)
    assert tuple(got) == want
    assert abs(one(spark, cal.encode(cal.decode(F.col("v"), units), units), value=value) - value) < 1e-9


def test_dates_that_a_calendar_lacks(spark):
    parts = lambda y, m, d: F.struct(*[F.lit(x).alias(p) for x, p in zip((y, m, d, 12, 0, 0, 0), cal.PARTS)])
    units = "days since 2000-01-01"
    thirty = "30 February"
    assert one(spark, cal.rebase(F.col("v"), units, "360_day", units, "noleap"), value=59.0) is None, thirty
    assert one(spark, cal.rebase(F.col("v"), units, "360_day", units, "360_day"), value=59.0) == 59.0
    assert one(spark, cal.encode(parts(2001, 2, 29), units, "all_leap")) == 366 + 59.5
    assert one(spark, cal.encode(parts(2001, 2, 29), units, "julian")) is None and one(spark, cal.encode(parts(1900, 2, 29), "days since 1900-02-28", "julian")) == 1.5
    assert one(spark, cal.to_timestamp(parts(2001, 2, 29))) is None and one(spark, cal.to_timestamp(parts(2004, 2, 29))) == datetime.datetime(2004, 2, 29, 12)
    with pytest.raises(Exception, match="has no 2001-02-29"):
        one(spark, cal.encode(parts(2001, 2, 29), units, "noleap", strict=True))
    for odd in (None, float("nan"), float("inf")):
        assert one(spark, cal.decode(F.col("v"), units, "noleap"), value=odd) is None
    for wrong in ("fortnights since 2000-01-01", "days after 2000-01-01", "days since tomorrow"):
        with pytest.raises(ValueError):
            cal.parse_units(wrong)
    with pytest.raises(ValueError):
        cal.calendar_name("mayan")


def test_civil_timestamps_agree(spark):
    times = [datetime.datetime(1600, 2, 29, 1, 2, 3, 4), datetime.datetime(1999, 12, 31, 23, 59, 59, 999999), datetime.datetime(2100, 3, 1)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    got = df.select(cal.encode(cal.from_timestamp(F.col("t")), "microseconds since 1582-10-15", "proleptic_gregorian").alias("us"), cal.to_timestamp(cal.from_timestamp(F.col("t"))).alias("t")).collect()
    assert [r.t for r in got] == times
    assert [r.us for r in got] == [(t - datetime.datetime(1582, 10, 15)) / datetime.timedelta(microseconds=1) for t in times]
