"""A22, W10, W17, S10 and the first days of a year in C11, on the cases that whole tables do not show."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from terraflux.functions.scalars import grass_leaf_area, leaf_area
from terraflux.operators import windows as win
from terraflux.plans.pipelines import land_surface_table
from terraflux.sources import scans, sinks


def test_leaf_area_of_any_cover(spark):
    covers = [0.0, 0.01, 0.4, 0.5, 0.9, 0.99, 0.9999, 1.0, 1.2, None]
    got = spark.createDataFrame([(c,) for c in covers], "c double").select(leaf_area(F.col("c")).alias("wood"), grass_leaf_area(F.col("c")).alias("grass")).collect()
    for c, r in zip(covers, got):
        if c is None:
            assert r.wood is None and r.grass is None
            continue
        wood = 12.0 if c >= 1 else min(max(-2 * math.log(1 - c), 0.01), 12.0)
        grass = -2 * math.log(0.01) if c >= 1 else max(-2 * math.log(max(1 - c / (1 - c), 0.01)), 0.01)
        assert r.wood == pytest.approx(wood) and r.grass == pytest.approx(grass)


def test_axis_bounds(spark):
    rows = spark.createDataFrame(list(enumerate([170.0, 175.0, 180.0, -175.0, -170.0, -160.0])), "i int, lon double")
    bounds = lambda **k: [(r.lon, r.low, r.high) for r in sorted(win.axis_bounds(rows, "lon", "i", **k).collect(), key=lambda r: [170, 175, 180, -175, -170, -160].index(r.lon))]
    assert bounds() == [(170, 167.5, 172.5), (175, 172.5, 177.5), (180, 177.5, 182.5), (-175, -177.5, -172.5), (-170, -175, -165), (-160, -165, -155)]
    assert bounds(midpoint=True) == [(170, 167.5, 172.5), (175, 172.5, 177.5), (180, 177.5, 182.5), (-175, 182.5, -172.5), (-170, -172.5, -165), (-160, -165, -155)]
    assert win.axis_bounds(rows.limit(1), "lon").first().low is None


@pytest.mark.parametrize("leap, days", [(None, (366, 365)), (True, (366, 366)), (False, (365, 365))])
def test_spline_by_leap_year(spark, leap, days):
    """The middles of February to March are a day further apart in a leap year; knots are met exactly."""
    rows = [(1, y, m, float(m * m % 7 + 1)) for y in (2000, 2001) for m in range(1, 13)]
    got = win.spline_monthly(spark.createDataFrame(rows, "k int, y int, m int, v double"), "k", "y", "m", "v", leap).collect()
    by = {(r.y, r.step): r.v for r in got}
    assert [sum(y == year for y, _ in by) for year in (2000, 2001)] == list(days)
    for year, n in zip((2000, 2001), days):
        assert by[year, 0] == pytest.approx(2.0)
        starts = [0, 31, 59 + n - 365]  # the steps of mid-January, and 31 and 59 or 60 days later those of the next middles
        assert by[year, starts[1] - 0] == pytest.approx(5.0, abs=2.0)


def test_spline_of_half_hours(spark):
    rows = spark.createDataFrame([(1, 2001, m, 3.0) for m in range(1, 13)], "k int, y int, m int, v double")
    got = win.spline_monthly(rows, "k", "y", "m", "v", step_days=1 / 48)
    assert got.count() == 365 * 48 and {round(r.v, 9) for r in got.select("v").distinct().collect()} == {3.0}


def test_first_days_of_a_year(spark):
    """1 to 15 January have the leaf area of the spline before, which 16 January takes on from the new year's."""
    days = [datetime.datetime(2000, 1, 1) + datetime.timedelta(n) for n in range(366 + 365 + 365)]
    met = spark.createDataFrame([(1, d, 1.0) for d in days], "cell int, t timestamp_ntz, value double")
    cover = spark.createDataFrame([(1, y, m, (m + 2 * (y - 2000)) / 40, 0.1, 0.7) for y in (2000, 2001, 2002) for m in range(1, 13)], "cell int, year int, month int, wood double, grass double, forest double")
    got = {r.t: r.lai for r in land_surface_table(met, cover, 86_400).collect()}
    assert len(got) == len(days) and all(v is not None for v in got.values())
    from terraflux.operators.aggregates import lai_from_cover

    lai = lai_from_cover(cover, ["cell", "year", "month"], "wood", "grass", "forest").select("cell", "year", "month", "lai")
    spline = {(r.year, r.step): r.lai for r in win.spline_monthly(lai, "cell", "year", "month", "lai").collect()}
    at = lambda *d: got[datetime.datetime(*d)]
    assert at(2001, 1, 16) == spline[2001, 0] and at(2000, 12, 31) == spline[2000, 350] and at(2001, 1, 1) == spline[2000, 351] and at(2001, 1, 15) == spline[2000, 365]
    assert at(2002, 1, 1) == spline[2001, 350] and at(2002, 1, 15) == spline[2001, 364]
    assert at(2000, 1, 1) == spline[2000, 351] and at(2000, 1, 15) == spline[2000, 365]  # no year before


def test_year_and_day_of_text(spark, tmp_path):
    rows = spark.createDataFrame([(1.234, 2.0, datetime.date(2000, 12, 31), 5.0), (1.0, 2.0, datetime.date(2001, 1, 1), None), (1.0, 2.0, datetime.date(2001, 3, 1), 7.5)], "lon double, lat double, time date, v double")
    sinks.write_long(rows, str(tmp_path / "x"), ["v"], sep="\t", year_day="time")
    back = scans.scan_csv(spark, str(tmp_path / "x"), "lon double, lat double, year int, day int, v double", sep="\t")
    assert sorted(map(tuple, back.collect())) == [(1.0, 2.0, 2001, 60, 7.5), (1.23, 2.0, 2000, 366, 5.0)]
