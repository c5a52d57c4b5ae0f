"""Queries of aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraflux.operators import aggregates as agg
from terraflux.operators.filters import flag_fails
from terraflux.plans.filters import FAILING
from terraflux.plans.registry import Views, duck, query


@query("a1_aggregate_period", duck("v_raw", "SELECT site, CAST(ts AS DATE) AS date, avg(value) AS value, CAST(sum(event_id) AS BIGINT) AS event_id FROM v_raw GROUP BY ALL", "value"))
def a1(v: Views) -> DataFrame:
    return agg.aggregate_period(v.v_raw.withColumn("event_id", F.col("event_id").cast("double")), ["site"], "ts", "day", {"value": "mean", "event_id": "sum"}).withColumn("event_id", F.col("event_id").cast("long"))


@query("a2_aggregate_ratio", duck("v_series", "SELECT site, min(t) AS t, avg(value) AS value FROM (SELECT *, i // 7 AS g, count(*) OVER (PARTITION BY site, i // 7) AS n FROM v_series) WHERE n = 7 GROUP BY site, g", "value"))
def a2(v: Views) -> DataFrame:
    return agg.aggregate_ratio(v.v_series, "site", "t", "value", 7)


@query("a3_aggregate_multi", duck("v_series", "SELECT site, date_trunc('day', t)::TIMESTAMP AS t, avg(value / 7) AS tas, sum(value / 7) AS pr, min(value / 7) AS tasmin, max(value / 7) AS tasmax FROM v_series GROUP BY 1, 2", "tas pr tasmin tasmax"))
def a3(v: Views) -> DataFrame:
    return agg.aggregate_multi(v.v_series.withColumn("value", F.col("value") / 7), ["site"], "t", "day", {"tas": ("value", "mean"), "pr": ("value", "sum"), "tasmin": ("value", "min"), "tasmax": ("value", "max")})


@query("a4_resample_daily", duck("v_raw", """SELECT d.site, d.day, avg(value) AS value FROM (SELECT site, CAST(unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS DATE) AS day FROM v_raw GROUP BY site) d
  LEFT JOIN v_raw r ON r.site = d.site AND CAST(r.ts AS DATE) = d.day GROUP BY ALL""", "value"), also="a4_resample_daily_whole")
def a4(v: Views) -> DataFrame:
    return agg.resample_daily(v.v_raw, "site", "ts", "value")


@query("a5_temporal_mean", duck("v_daily", "SELECT cell, avg(value) AS value FROM v_daily GROUP BY cell", "value"))
def a5(v: Views) -> DataFrame:
    return agg.temporal_mean(v.v_daily, "cell", "value")


@query("a6_mean_of_annual_means", duck("v_daily", "SELECT cell, avg(y) AS value FROM (SELECT cell, year(day), avg(value) AS y FROM v_daily GROUP BY ALL) GROUP BY cell", "value"))
def a6(v: Views) -> DataFrame:
    return agg.mean_of_annual(v.v_daily, "cell", "day", "value", "mean")


@query("a7_mean_of_annual_sums", duck("v_daily", "SELECT cell, avg(y) AS value FROM (SELECT cell, year(day), sum(value) AS y FROM v_daily GROUP BY ALL) GROUP BY cell", "value"))
def a7(v: Views) -> DataFrame:
    return agg.mean_of_annual(v.v_daily, "cell", "day", "value", "sum")


@query("a8_monthly_climatology", duck("v_daily", "SELECT month(day) AS month, avg(value) AS value FROM v_daily GROUP BY 1", "value"))
def a8(v: Views) -> DataFrame:
    return agg.monthly_climatology(v.v_daily, "day", "value")


@query("a9_warmest_month_max", duck("v_daily", "SELECT cell, CASE WHEN count(*) < 12 THEN greatest(max(x), 0) ELSE max(x) END AS value FROM (SELECT cell, month(day), avg(value) AS x FROM v_daily GROUP BY ALL) GROUP BY cell", "value"))
def a9(v: Views) -> DataFrame:
    return agg.warmest_month_max(v.v_daily, "cell", "day", "value")


@query("a10_annual_mean", duck("v_daily", "SELECT year(day) AS year, avg(value) AS value FROM v_daily GROUP BY 1", "value"))
def a10(v: Views) -> DataFrame:
    return agg.annual_mean(v.v_daily, "day", "value")


@query("a11_plot_statistics", duck("v_stems", """SELECT plot, start_visit + 7 AS date, nullif(sum(live_kg) / 400, 0) AS live, nullif(coalesce(sum(dead_kg), 0) / 400, 0) AS dead, avg(height_m) AS height, sqrt(avg(diameter_cm * diameter_cm)) / 100 AS diameter,
  quantile_cont(height_m, 0.9) AS height_90, quantile_cont(diameter_cm, 0.9) / 100 AS diameter_90, sum(pi() * pow(diameter_cm / 200, 2)) * 10000 / 400 AS basal FROM v_stems GROUP BY plot, start_visit, end_visit""", "live dead height diameter height_90 diameter_90 basal"))
def a11(v: Views) -> DataFrame:
    return agg.plot_statistics(v.v_stems.withColumn("area_m2", F.lit(400.0)))


@query("a11_open_visits", duck("v_stems", """SELECT plot, start_visit AS date, nullif(sum(live_kg) / 400, 0) AS live, nullif(coalesce(sum(dead_kg), 0) / 400, 0) AS dead, avg(height_m) AS height, sqrt(avg(diameter_cm * diameter_cm)) / 100 AS diameter,
  quantile_cont(height_m, 0.9) AS height_90, quantile_cont(diameter_cm, 0.9) / 100 AS diameter_90, sum(pi() * pow(diameter_cm / 200, 2)) * 10000 / 400 AS basal FROM v_stems GROUP BY plot, start_visit""", "live dead height diameter height_90 diameter_90 basal"))
def a11_open(v: Views) -> DataFrame:
    """Visits of which some have no end: the end is no part of the key, and the date is the start."""
    return agg.plot_statistics(v.v_stems.withColumn("area_m2", F.lit(400.0)).withColumn("end_visit", F.when(F.col("transect") != 2, F.col("end_visit"))))


@query("a12_transect_biomass", duck("v_stems", "SELECT start_visit, coalesce(sum(live_kg / 400), 0) / count(DISTINCT transect) AS live_kg, coalesce(sum(dead_kg / 400), 0) / count(DISTINCT transect) AS dead_kg FROM v_stems GROUP BY start_visit", "live_kg dead_kg"))
def a12(v: Views) -> DataFrame:
    return agg.transect_biomass(v.v_stems.withColumn("area", F.lit(400.0)), "start_visit", "transect", "area", ["live_kg", "dead_kg"])


@query("a13_mean_by_date", duck("v_modis", "SELECT id, date, avg(lai) AS lai FROM v_modis GROUP BY id, date", "lai"))
def a13(v: Views) -> DataFrame:
    return agg.mean_by_date(v.v_modis, ["id", "date"], "lai")


@query("a14_depth_weighted", duck("v_layers", "SELECT cell, sum(value * (d1 - d0)) / sum(d1 - d0) AS value FROM v_layers GROUP BY cell", "value"))
def a14(v: Views) -> DataFrame:
    return agg.depth_weighted(v.v_layers.withColumns({c: F.col(c).cast("double") for c in ("d0", "d1")}), "cell", "d0", "d1", "value")


@query("a15_coverage_counts", duck("v_raw", f"SELECT site, count(*) AS rows, count(DISTINCT CAST(ts AS DATE)) AS days, count(*) FILTER (qc IN ({FAILING})) AS dropped, count(*) / count(DISTINCT CAST(ts AS DATE)) AS per_day FROM v_raw GROUP BY site", "per_day"))
def a15(v: Views) -> DataFrame:
    return agg.coverage_counts(v.v_raw, "site", "ts", flag_fails(F.col("qc")))


@query("a15_failing_flags", duck("v_raw", f"SELECT site, qc, count(*) AS n, 100.0 * count(*) / max(total) AS percent FROM (SELECT *, count(*) OVER (PARTITION BY site) AS total FROM v_raw) WHERE qc IN ({FAILING}) GROUP BY site, qc", "percent"))
def a15_flags(v: Views) -> DataFrame:
    return agg.failing_counts(v.v_raw, "site", "qc")


@query("a15_gridpoints", duck("v_grid", "SELECT month, count(DISTINCT lon) * count(DISTINCT lat) AS gridpoints FROM v_grid GROUP BY month"))
def a15_grid(v: Views) -> DataFrame:
    return agg.gridpoints(v.v_grid, ["month"])


@query("a16_coverage", duck("v_daily", "SELECT cell, min(day) AS first, max(day) AS last FROM v_daily GROUP BY cell"))
def a16(v: Views) -> DataFrame:
    return agg.coverage(v.v_daily, "cell", "day")


@query("a17_modal_step", duck("v_daily", """SELECT cell, CAST(arg_min(step, (-n, step)) AS INTEGER) AS step FROM (SELECT cell, step, count(*) AS n FROM (SELECT cell, date_diff('day', lag(day) OVER (PARTITION BY cell ORDER BY day), day) AS step FROM v_daily) WHERE step IS NOT NULL GROUP BY ALL) GROUP BY cell"""))
def a17(v: Views) -> DataFrame:
    return agg.modal_step(v.v_daily, "cell", "day")


@query("a18_step_climatology", duck("v_daily", "SELECT cell, dayofyear(day) AS step, avg(value) AS mean, stddev_pop(value) AS sd FROM v_daily GROUP BY ALL", "mean sd"))
def a18(v: Views) -> DataFrame:
    return agg.step_climatology(v.v_daily, "cell", "day", "value")


_GAPS = "CASE WHEN day >= DATE '2001-08-01' OR dayofyear(day) % 11 = 0 AND year(day) % 2 = 0 THEN NULL ELSE value END"


@query("a19_fill_from_other_years", duck("v_daily", f"SELECT cell, day, coalesce(value, avg(value) OVER (PARTITION BY cell, dayofyear(day))) AS value FROM (SELECT cell, day, {_GAPS} AS value FROM v_daily)", "value"))
def a19(v: Views) -> DataFrame:
    return agg.fill_from_other_years(v.v_daily.withColumn("value", F.expr(_GAPS)), "cell", "day", "value").select("cell", "day", "value")


@query("a22_lai_from_cover", duck("v_grid", "SELECT lon, lat, month, greatest(-ln(greatest(1 - w, exp(-6))) / 0.5, 0.01) AS lai_wood, greatest(-ln(greatest(1 - g / (1 - g), 0.01)) / 0.5, 0.01) AS lai_grass, greatest(-ln(greatest(1 - w, exp(-6))) / 0.5, 0.01) * least(f, 1) + greatest(-ln(greatest(1 - g / (1 - g), 0.01)) / 0.5, 0.01) * (1 - least(f, 1)) AS lai FROM (SELECT lon, lat, month, huss * 90 AS w, (tas + 10) / 60 AS g, huss * 150 AS f FROM v_grid)", "lai_wood lai_grass lai"))
def a22(v: Views) -> DataFrame:
    cover = v.v_grid.select("lon", "lat", "month", (F.col("huss") * 90).alias("w"), ((F.col("tas") + 10) / 60).alias("g"), (F.col("huss") * 150).alias("f"))
    return agg.lai_from_cover(cover, ["lon", "lat", "month"], "w", "g", "f")


@query("a23_axes", duck("v_grid", "SELECT 'lon' AS axis, lon AS value, count(*) OVER () AS size FROM (SELECT DISTINCT lon FROM v_grid) UNION ALL SELECT 'lat', lat, count(*) OVER () FROM (SELECT DISTINCT lat FROM v_grid)", "value"))
def a23(v: Views) -> DataFrame:
    return agg.axes(v.v_grid, ["lon", "lat"])


@query("d1_aggregators", duck("v_daily", "SELECT cell, sqrt(avg(value * value)) AS quadratic_mean, count(value) AS n, max(value) - min(value) AS span FROM v_daily GROUP BY cell", "quadratic_mean span"))
def d1(v: Views) -> DataFrame:
    agg.register_aggregator("span", lambda c: F.max(c) - F.min(c))
    return v.v_daily.groupBy("cell").agg(*[agg.AGGREGATORS[how](F.col("value")).alias(name) for name, how in (("quadratic_mean", "quadratic_mean"), ("n", "count"), ("span", "span"))])
