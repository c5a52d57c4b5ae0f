"""Filters and column functions on tiny tables: nulls, NaN, flags, bounds, names, lengths, times."""

import math

import pytest
from pyspark.sql import functions as F

from terraflux.functions import scalars
from terraflux.operators import filters, tables
from terraflux.sources import scans


def series(spark, values):
    return spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i int, value double")


def column(df, name="value", order="i"):
    return [r[name] for r in df.orderBy(order).collect()]


def test_qc_mask_and_drop(spark):
    df = spark.createDataFrame([(0, 1.0, 0), (1, 2.0, 1), (2, 3.0, 10), (3, 4.0, 50), (4, None, 0), (5, 6.0, 999), (6, 7.0, -1), (7, 8.0, None)], "i int, value double, qc int")
    assert column(filters.qc_mask(df, "value", "qc")) == [1.0, None, 3.0, None, None, 6.0, 7.0, 8.0]
    assert column(filters.qc_drop(df, "qc"), "i") == [0, 2, 4, 5, 6, 7]


def test_flags_of_other_types(spark):
    text = spark.createDataFrame([(0, "x"), (1, "1"), (2, "0")], "i int, qc string")
    assert column(filters.qc_drop(text, "qc"), "i") == [0, 2]
    real = spark.createDataFrame([(0, 1.0), (1, 0.9), (2, 40.0)], "i int, qc double")
    assert column(filters.qc_drop(real, "qc"), "i") == [1]


def test_clamp_keeps_nan_and_null(spark):
    got = column(filters.clamp(series(spark, [-2.0, 0.0, -1.5, 3.0, float("nan"), None, 9.0]), "value", 5, -1))
    assert got[:4] == [-1, 0, -1, 3] and math.isnan(got[4]) and got[5] is None and got[6] == 5
    assert column(filters.clamp(series(spark, [-2.0, 9.0]), "value", None, 5)) == [-2, 5]
    assert filters.clamp(series(spark, []), "value", 0, 1).count() == 0


def test_bounds_report(spark):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(50)] + [("a", 99, float("nan")), ("a", 98, None)], "site string, i int, value double")
    rows = {r.direction: r for r in filters.bounds_report(df, "site", ["i"], "value", 5, 10, 3).collect()}
    assert rows["below"].n == 5 and rows["below"].first == "0=0.00;1=1.00;2=2.00"
    assert rows["above"].n == 39 and rows["above"].first == "11=11.00;12=12.00;13=13.00"


def test_bitflags_and_constants(spark):
    df = spark.createDataFrame([(b,) for b in (0, 1, 2, 4, 8, 16, 32, 64, 128)] + [(None,)], "qc int")
    assert sorted(r.qc for r in filters.bitflag_filter(df, "qc").collect()) == [0, 1, 2, 16, 32]
    with pytest.raises(ValueError):
        filters.with_constants(df, {"qc": 1})


def test_valid_only_and_years(spark):
    df = spark.createDataFrame([(0, 1.0, None), (1, float("nan"), 1.0), (2, 1.0, 1.0)], "i int, a double, b double")
    assert column(filters.valid_only(df, ["a", "b"]), "i") == [2]
    assert column(filters.valid_only(df, ["a", "b"], "any"), "i") == [0, 1, 2]
    days = spark.sql("SELECT date'2001-05-01' AS d UNION ALL SELECT date'2003-01-01'")
    assert filters.select_years(days, "d", 2002, 2003, validate=True).count() == 1
    with pytest.raises(ValueError):
        filters.select_years(days, "d", 1990, 2003, validate=True)


def one(spark, expression, *values):
    names = [f"c{i}" for i in range(len(values))]
    row = spark.range(1).select(*[F.lit(v).alias(n) for n, v in zip(names, values)]).select(expression(*map(F.col, names)).alias("x")).first()
    return row.x


@pytest.mark.parametrize(
    "raw, site",
    [("AU-How", "HowardSprings"), ("alice Springs  mulga", "AliceSpringsMulga"), ("Loxton", "Loxton"), ("Wallaby", "WallabyCreek"), ("Tum", "Tumbarumba"), ("nowhere at all", "nowhere at all"), ("", "")],
)
def test_site_names(spark, raw, site):
    assert one(spark, scalars.normalise_site, raw) == site


@pytest.mark.parametrize("text, metres", [("5m", [5.0]), ("1.024 km", [1024.0]), ("-100 to -500 cm", [1.0, 5.0]), ("30 - 50m", [30.0, 50.0]), ("5 mm", [0.005])])
def test_lengths(spark, text, metres):
    assert one(spark, scalars.parse_lengths, text) == pytest.approx(metres)


def test_lengths_legacy_and_area(spark):
    assert one(spark, lambda c: scalars.parse_lengths(c, legacy=True), "5 mm") == [5.0]
    assert one(spark, scalars.parse_area, "20 m x 1000 cm") == 200
    assert one(spark, scalars.parse_area, "20 by 10") is None
    assert one(spark, scalars.parse_height, "85cm") == 0.85 and one(spark, scalars.parse_height, " ") is None


def test_units(spark):
    assert one(spark, lambda c: scalars.convert(c, "hPa", "kPa"), 1000.0) == 100
    assert one(spark, lambda c: scalars.convert(c, "kg m-2", "mm"), 3.0) == 3
    assert one(spark, lambda c: scalars.convert(c, "mm", "kg/m2/s", 10.0), 5.0) == 0.5
    with pytest.raises(ValueError):
        scalars.convert(F.lit(1.0), "K", "mm")


def test_times_and_places(spark):
    ntz = lambda s: F.expr(f"timestamp_ntz'{s}'")
    got = spark.range(1).select(scalars.align_time(ntz("2000-01-01 00:15:00"), 30).alias("a"), scalars.align_time(ntz("2000-01-01 00:45:00"), 30).alias("b"), scalars.cf_decode(F.lit(1.5), "hours", "2000-01-01").alias("c"), scalars.location_key(F.lit(150.5), F.lit(-33.6)).alias("k")).first()
    assert (got.a.minute, got.b.hour, got.c.minute, got.k) == (0, 1, 30, "150500E_033600S.nc")
    x, y = scalars.derotate(F.lit(0.0), F.lit(0.0), 180.0, 90.0)
    assert spark.range(1).select(x.alias("x"), y.alias("y")).first() == pytest.approx((0.0, 0.0), abs=1e-9)


def test_made_times(spark):
    i = lambda *x: [F.lit(v) for v in x]
    y, m, d, h, n, sec = i(2004, 2, 29, 7, 5, 9)
    row = spark.range(1).select(
        scalars.make_time(year=y, doy=F.lit(366)).alias("a"), scalars.make_time(year=y, doy=F.lit(59), base=0).alias("b"), scalars.make_time(year=y, month=m, day=d, hour=h).alias("c"),
        scalars.make_time(year=y, month=m, day=d, hour=h, minute=n, second=sec).alias("d"), scalars.make_time(text=F.lit("29/02/2004 07:05"), pattern="dd/MM/yyyy HH:mm").alias("e"),
        scalars.make_time(text=F.lit("x"), pattern="dd/MM/yyyy").alias("f"), scalars.make_time(year=y, month=F.lit(13), day=d).alias("g"), scalars.steps_between(F.lit("2004-02-28 00:00:00"), F.lit("2004-02-29 00:50:00"), 30).alias("n"),
    ).first()
    assert [str(x) for x in (row.a, row.b, row.c, row.d, row.e)] == ["2004-12-31 00:00:00", "2004-02-29 00:00:00", "2004-02-29 07:00:00", "2004-02-29 07:05:09", "2004-02-29 07:05:00"]
    assert row.f is None and row.g is None and row.n == 49
    with pytest.raises(ValueError):
        scalars.make_time(year=y)


def test_dates_of_names(spark):
    names = ["GPP_2000057_Mean.tif", "x_20040229.csv", "tas_199501-199501.nc", "Site_L6_2001365.csv", ""]
    got = spark.createDataFrame([(n,) for n in names], "name string").select(scans.date_of_name(F.col("name")).alias("d"))
    assert [str(r.d) for r in got.collect()] == ["2000-02-26", "2004-02-29", "None", "2001-12-31", "None"]


def test_plot_area_falls_back_on_its_plot(spark):
    df = spark.createDataFrame([(1, "20 m", "10 m"), (1, None, "10 m"), (2, "5 m", None), (2, "5 m", "100 cm")], "plot int, length string, width string")
    assert sorted(r.area_m2 for r in tables.plot_area(df, "plot", "length", "width").collect()) == [5, 5, 200, 200]


def test_scratch_files_of_a_step_go_with_it(spark):
    import os

    from terraflux.sources.scratch import once, scratch, step_scratch

    kept = once(spark.range(3), "kept")
    with step_scratch(spark, "outer"):
        outer = scratch(spark, "a")
        spark.range(1).write.parquet(outer)
        with step_scratch(spark, "inner"):
            inner = once(spark.range(5), "b")
            assert inner.count() == 5 and scratch(spark, "c").startswith(os.path.dirname(outer))
        assert os.path.exists(outer)
    assert kept.count() == 3 and not os.path.exists(os.path.dirname(outer))
    assert os.path.dirname(scratch(spark, "d")) == os.path.dirname(os.path.dirname(outer))
