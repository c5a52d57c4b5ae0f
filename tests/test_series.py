"""Series operators against numpy and stated expectations."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from terraflux.operators import aggregates as agg
from terraflux.operators import joins, regrid
from terraflux.operators import windows as win

NAN = float("nan")


def series(spark, values, key="a"):
    return spark.createDataFrame([(key, i, i // 3, x) for i, x in enumerate(values)], "site string, i int, block int, value double")


def filled(values):
    y = np.array([NAN if v is None else v for v in values], float)
    known = np.isfinite(y)
    gaps = np.array([v is None for v in values])
    y[gaps] = np.interp(np.flatnonzero(gaps), np.flatnonzero(known), y[known])
    return y


@pytest.mark.parametrize("values", [[None, 2.0, None, 8.0, None], [2.0, 2.0, None, 8.0, 9.0, NAN, 11.0, None, 12.0], [None, None, 5.0], [1.0]])
@pytest.mark.parametrize("block", [None, "block"])
def test_interpolation(spark, values, block):
    got = [r.value for r in win.interpolate_gaps(series(spark, values), "site", "i", "value", block).orderBy("i").collect()]
    np.testing.assert_allclose(got, filled(values))


def test_interpolation_of_random_series_in_blocks(spark):
    rng = random.Random(3)
    values = [None if rng.random() < 0.6 else rng.uniform(-5, 5) for _ in range(200)]
    got = [r.value for r in win.interpolate_gaps(series(spark, values), "site", "i", "value", "block").orderBy("i").collect()]
    np.testing.assert_allclose(got, filled(values))
    none = win.interpolate_gaps(series(spark, [None, NAN, None]), "site", "i", "value", "block", empty="keep").orderBy("i").collect()
    assert none[0].value is None and math.isnan(none[1].value)


@pytest.mark.parametrize("block", [None, "block"])
def test_interpolation_without_any_value_stops_the_job(spark, block):
    with pytest.raises(PySparkException, match="no valid value"):
        win.interpolate_gaps(series(spark, [None, NAN, None, None]), "site", "i", "value", block).collect()
    assert win.interpolate_gaps(series(spark, [NAN, NAN]), "site", "i", "value", block).count() == 2


def test_time_gaps_and_conflicts(spark):
    rows = hourly(spark, [1.0, 2.0]).union(hourly(spark, [9.0], "2001-01-01 05:00:00"))
    got = win.fill_time_gaps(rows.union(rows), "site", "t", "value", 3600).orderBy("t").collect()
    assert [r.value for r in got] == pytest.approx([1, 2, 3.75, 5.5, 7.25, 9])
    for other in ([1.5], [None]):
        clash = rows.union(hourly(spark, other).selectExpr("site", "t", "CAST(value AS DOUBLE) AS value") if other[0] else hourly(spark, [0.0]).withColumn("value", F.lit(None).cast("double")))
        with pytest.raises((PySparkException, Py4JError), match="different values"):  # the latter if two tasks stop at once
            win.fill_time_gaps(clash, "site", "t", "value", 3600).collect()


def planned(spark, values, begin, minutes, step=60, **modes):
    first = dt.datetime.fromisoformat(begin)
    df = spark.createDataFrame([("a", first + dt.timedelta(minutes=step * i), float(x)) for i, x in enumerate(values)], "site string, t timestamp_ntz, value double")
    plan = win.time_plan(df, "site", "t", minutes, **modes)
    return plan.first(), [(r.t, r.value) for r in win.apply_plan(df, plan, "site", "t", {"value": ("nearest", 0.0)}).orderBy("t").collect()]


def test_time_plan(spark):
    row, got = planned(spark, [5, 6], "2000-01-01 01:05:00", 60)
    assert row.n0 == 1 and row.begin == dt.datetime(2000, 1, 1, 0, 5) and got == [(dt.datetime(2000, 1, 1, h, 5), v) for h, v in ((0, 5), (1, 5), (2, 6))]
    row, got = planned(spark, [1, 2, 3], "2000-12-31 22:05:00", 60, start="trim")
    assert row.begin == dt.datetime(2001, 1, 1, 0, 5) and got == [(dt.datetime(2001, 1, 1, 0, 5), 3.0)]
    row, got = planned(spark, [1, 2], "2000-12-31 21:05:00", 60, start="ignore", end="pad")
    assert row.n1 == 1 and got[-1] == (dt.datetime(2000, 12, 31, 23, 5), 2.0)
    row, got = planned(spark, [1, 2, 3], "2000-12-31 22:05:00", 60, start="ignore", end="trim")
    assert [t.year for t, _ in got] == [2000, 2000]
    row, _ = planned(spark, range(4), "2000-01-01 00:05:00", 60, step=30)
    assert row.ratio == 2 and row.begin == dt.datetime(2000, 1, 1, 0, 5)


@pytest.mark.parametrize("values, start, step, minutes, modes, message", [
    ([1, 2], "2000-01-01 02:05:00", 60, 60, {}, "more missing steps at the start"), ([1, 2], "2000-01-01 01:05:00", 60, 60, {"start": "error"}, "missing steps at the start"),
    ([1, 2], "2000-12-31 21:05:00", 60, 60, {"start": "ignore", "end": "error"}, "missing steps at the end"), ([1, 2], "2000-01-01 00:00:00", 60, 90, {}, "no multiple"),
    ([1], "2000-01-01 00:00:00", 60, 60, {}, "single step"), ([1, 2], "2000-01-01 00:00:00", 7, 70, {}, "does not divide a day"), ([1, 2], "2000-01-01 00:00:00", 0, 60, {}, "repeated time"),
])
def test_time_plan_refuses(spark, values, start, step, minutes, modes, message):
    with pytest.raises(PySparkException, match=message):
        planned(spark, values, start, minutes, step, **modes)


def test_uneven_and_empty_axes_are_refused(spark):
    uneven = hourly(spark, [1.0, 2.0]).union(hourly(spark, [3.0], "2001-01-01 09:00:00"))
    with pytest.raises(PySparkException, match="uneven"):
        win.time_plan(uneven, "site", "t", 60).collect()
    with pytest.raises(PySparkException, match="uneven"):
        win.apply_boundary(uneven, "site", "t", "value").collect()
    with pytest.raises(ValueError):
        win.time_plan(uneven.filter("false"), "site", "t", 60)


def test_inspection_of_series_with_gaps(spark):
    gaps = hourly(spark, [1.0, 2.0], "2000-01-01 01:05:00").union(hourly(spark, [3.0], "2000-01-01 09:05:00"))
    row = win.inspect_grid(gaps, "site", "t", 3600).first()
    assert (row.n, row.step, row.uniform, row.divides_day, row.missing_start) == (9, 3600, True, True, 1)
    assert not win.inspect_grid(gaps.union(hourly(spark, [3.0], "2000-01-01 05:20:00")), "site", "t", 3600).first().uniform


def at_minutes(spark, minutes):
    return spark.createDataFrame([("a", dt.datetime(2000, 1, 1) + dt.timedelta(minutes=m), 1.0) for m in minutes], "site string, t timestamp_ntz, value double")


def test_alignment_of_series(spark):
    times = lambda df: [r.t for r in df.orderBy("t").collect()]
    assert times(win.align_series(at_minutes(spark, [5, 35]), "site", "t", "half_hour", 30)) == [dt.datetime(2000, 1, 1), dt.datetime(2000, 1, 1, 0, 30)]
    assert times(win.align_series(at_minutes(spark, [5, 65, 125]), "site", "t", "strict_hour", 60)) == [dt.datetime(2000, 1, 1, h) for h in range(3)]
    assert times(win.align_series(at_minutes(spark, [5, 65]), "site", "t", "none", 60)) == [dt.datetime(2000, 1, 1, 0, 5), dt.datetime(2000, 1, 1, 1, 5)]
    with pytest.raises(PySparkException, match="repeats"):
        win.align_series(at_minutes(spark, [5, 15]), "site", "t", "half_hour", 10).collect()
    with pytest.raises(PySparkException, match="uneven"):
        win.align_series(at_minutes(spark, [5, 25, 45]), "site", "t", "half_hour", 20).collect()
    with pytest.raises(ValueError):
        win.align_series(at_minutes(spark, [5, 35]), "site", "t", "strict_hour", 30)
    with pytest.raises(ValueError):
        win.align_series(at_minutes(spark, [5]), "site", "t", "bad", 60)


def test_nearest_value_on_an_axis_with_a_far_value(spark):
    rng = random.Random(9)
    axis = [rng.uniform(0, 1) for _ in range(600)] + [1e9]
    points = [rng.uniform(-0.5, 1.5) for _ in range(200)] + [4e8, 6e8, None]
    got = joins.nearest_on_axis(spark.createDataFrame([(i, x) for i, x in enumerate(points)], "site int, lon double"), "site", "lon", spark.createDataFrame([(v,) for v in axis], "lon double"), "x")
    assert {r.site: r.x for r in got.collect()} == {i: None if x is None else min(axis, key=lambda v: (abs(v - x), v)) for i, x in enumerate(points)}


def hourly(spark, values, start="2001-01-01 00:00:00"):
    first = dt.datetime.fromisoformat(start)
    return spark.createDataFrame([("a", first + dt.timedelta(hours=i), x) for i, x in enumerate(values)], "site string, t timestamp_ntz, value double")


@pytest.mark.parametrize("how, n0, n1, want", [("extrapolate", 2, 2, [-20, -10, 0, 10, 20, 30, 40]), ("nearest", 2, 1, [0, 0, 0, 10, 20, 20]), ("constant", 1, 2, [7, 0, 10, 20, 7, 7])])
def test_padding(spark, how, n0, n1, want):
    got = win.pad_series(hourly(spark, [0.0, 10.0, 20.0]), "site", "t", "value", how, n0, n1, 3600, 7.0)
    assert [r.value for r in got.orderBy("t").collect()] == want


def test_boundary_trim_pad_error(spark):
    late = hourly(spark, [float(i) for i in range(24 * 366)], "2000-12-31 01:00:00")
    trimmed = win.apply_boundary(late, "site", "t", "value", start="trim")
    assert trimmed.agg(F.min("t")).first()[0] == dt.datetime(2001, 1, 1)
    short = hourly(spark, [5.0, 6.0, 7.0], "2001-01-01 01:00:00")
    padded = win.apply_boundary(short, "site", "t", "value", start="pad")
    assert [r.value for r in padded.orderBy("t").collect()] == [5, 5, 6, 7]
    with pytest.raises(PySparkException):
        win.apply_boundary(short, "site", "t", "value", end="pad").collect()
    with pytest.raises(PySparkException):
        win.apply_boundary(short, "site", "t", "value", start="error").collect()


def test_inspection(spark):
    row = win.inspect_time(hourly(spark, [1.0, 2.0, 3.0], "2000-01-01 01:05:00"), "site", "t").first()
    assert (row.step, row.uniform, row.divides_day, row.missing_start) == (3600, True, True, 1)
    uneven = hourly(spark, [1.0, 2.0]).union(hourly(spark, [3.0], "2001-01-01 09:00:00"))
    assert not win.inspect_time(uneven, "site", "t").first().uniform
    lone = win.inspect_time(hourly(spark, [1.0]), "site", "t").first()
    assert lone.step is None and lone.missing_start is None


def test_ratio_groups(spark):
    got = agg.aggregate_ratio(series(spark, [1.0, 2.0, 3.0, 4.0, 5.0]), "site", "i", "value", 2)
    assert [(r.i, r.value) for r in got.orderBy("i").collect()] == [(0, 1.5), (2, 3.5)]


def test_conservative_regrid_keeps_the_area_mean(spark):
    rng = np.random.default_rng(5)
    cells = [(0.25 + 0.5 * i, 10.25 + 0.5 * j, float(rng.normal())) for i in range(4) for j in range(4)]
    out = regrid.regrid_conservative(spark.createDataFrame(cells, "lon double, lat double, v double"), [], "v", 0.5, 1.0, 2.0, 11.0, 2.0).collect()
    w = lambda lat: math.sin(math.radians(lat + 0.25)) - math.sin(math.radians(lat - 0.25))
    assert len(out) == 1 and out[0].v == pytest.approx(sum(w(y) * v for _, y, v in cells) / sum(w(y) for _, y, _ in cells))


def test_spline_reproduces_a_cubic():
    x = [float(i * i + i) for i in range(8)]
    f = lambda t: 2 + t - 0.3 * t**2 + 0.01 * t**3
    at = [0.5, 7.0, 30.0, 55.5]
    got = [0.0] * 4
    for k, s, w in win.spline_weights(x, at):
        got[s] += w * f(x[k])
    np.testing.assert_allclose(got, [f(t) for t in at])


def test_nearest_value_ties_and_ends(spark):
    axis = spark.createDataFrame([(0.0,), (1.0,), (7.0,)], "lon double")
    points = spark.createDataFrame([("a", 0.5), ("b", 3.9), ("c", 4.1), ("d", -50.0), ("e", 99.0), ("f", 4.0)], "site string, lon double")
    got = {r.site: r.x for r in joins.nearest_on_axis(points, "site", "lon", axis, "x").collect()}
    assert got == {"a": 0, "b": 1, "c": 7, "d": 0, "e": 7, "f": 1}


def test_polygon_with_a_notch(spark):
    ring = [(0, 0), (4, 0), (4, 4), (2, 2), (0, 4)]
    edges = [(1, float(a[0]), float(a[1]), float(b[0]), float(b[1])) for a, b in zip(ring, ring[1:] + ring[:1])]
    points = spark.createDataFrame([(0, 1.0, 1.0), (1, 2.0, 3.5), (2, 3.5, 3.0), (3, 9.0, 1.0), (4, 0.5, 3.0)], "id int, lon double, lat double")
    got = joins.points_in_polygons(points, ["id"], spark.createDataFrame(edges, "poly int, x1 double, y1 double, x2 double, y2 double"))
    assert sorted(r.id for r in got.collect()) == [0, 2, 4]


def test_checks_stop_the_job(spark):
    a, b = series(spark, [1.0, 2.0]), series(spark, [1.0, 2.0, 3.0])
    with pytest.raises(PySparkException):
        joins.join_aligned(["site", "i"], "site", "i", a.select("site", "i", F.col("value").alias("x")), b.select("site", "i", F.col("value").alias("y"))).collect()
    sites = spark.createDataFrame([("a", 1.0), ("a", 2.0)], "site string, lon double")
    with pytest.raises(PySparkException):
        joins.resolve_sites(a, sites).collect()


def test_warmest_month_counts_missing_months_as_zero(spark):
    df = spark.createDataFrame([("c", dt.date(2001, m, 1), float(v)) for m, v in ((1, -5), (2, -3))], "cell string, d date, v double")
    assert agg.warmest_month_max(df, "cell", "d", "v").first().v == 0


def test_plot_statistics_percentile(spark):
    rows = [(1, dt.date(2001, 1, 1), dt.date(2001, 1, 15), 100.0, 5.0, None, h, h) for h in (1.0, 2.0, 10.0)]
    r = agg.plot_statistics(spark.createDataFrame(rows, "plot int, start_visit date, end_visit date, area_m2 double, live_kg double, dead_kg double, height_m double, diameter_cm double")).first()
    assert r.height_90 == pytest.approx(8.4) and r.dead is None and r.live == pytest.approx(0.15) and r.date == dt.date(2001, 1, 8)
    assert r.diameter == pytest.approx(math.sqrt(105 / 3) / 100)


def test_plot_statistics_of_keys_with_nulls(spark):
    schema = "plot int, start_visit date, end_visit date, area_m2 double, live_kg double, dead_kg double, height_m double, diameter_cm double"
    day = lambda d: dt.date(2001, 1, d)
    stem = (100.0, 5.0, None, 2.0, 2.0)
    open_end = agg.plot_statistics(spark.createDataFrame([(1, day(1), day(9), *stem), (1, day(1), None, *stem), (1, day(3), day(5), *stem)], schema)).orderBy("date").collect()
    assert [(r.date, r.live) for r in open_end] == [(day(1), pytest.approx(0.1)), (day(3), pytest.approx(0.05))]
    open_start = agg.plot_statistics(spark.createDataFrame([(1, None, day(9), *stem), (1, day(2), day(9), *stem)], schema)).collect()
    assert [(r.date, r.live) for r in open_start] == [(day(9), pytest.approx(0.1))]
    assert agg.plot_statistics(spark.createDataFrame([(None, None, None, *stem)], schema)).count() == 0
    assert agg.plot_statistics(spark.createDataFrame([], schema)).count() == 0
