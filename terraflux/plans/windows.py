"""Queries of window operators and generators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraflux import model
from terraflux.functions import generators as gen
from terraflux.operators import windows as win
from terraflux.plans.registry import Views, duck, query

#: Linear interpolation over nulls of q(key, x, y), as SQL.
FILLED = """SELECT k, x, coalesce(y, py + (ny - py) / nullif(nx - px, 0) * (x - px), py, ny) AS y FROM (SELECT *,
  last_value(y IGNORE NULLS) OVER b AS py, last_value(CASE WHEN y IS NOT NULL THEN x END IGNORE NULLS) OVER b AS px,
  first_value(y IGNORE NULLS) OVER a AS ny, first_value(CASE WHEN y IS NOT NULL THEN x END IGNORE NULLS) OVER a AS nx FROM {q}
  WINDOW b AS (PARTITION BY k ORDER BY x ROWS UNBOUNDED PRECEDING), a AS (PARTITION BY k ORDER BY x ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


@query("w1_interpolate_gaps", duck("v_series", "SELECT k AS site, x AS i, y AS value FROM (" + FILLED.format(q="(SELECT site AS k, i AS x, value AS y FROM v_series)") + ")", "value"))
def w1(v: Views) -> DataFrame:
    series = v.v_series.withColumn("day", F.to_date("t"))
    return win.interpolate_gaps(series, "site", "i", "value", block="day").select("site", "i", "value")


@query("w2_fill_time_gaps", duck("v_hours", "SELECT k AS site, t, y AS value FROM (SELECT site AS k, unnest(generate_series(min(t), max(t), INTERVAL 1 HOUR)) AS t FROM v_hours GROUP BY site) g JOIN (" + FILLED.format(q="(SELECT g.site AS k, epoch(g.t) AS x, h.value AS y FROM (SELECT site, unnest(generate_series(min(t), max(t), INTERVAL 1 HOUR)) AS t FROM v_hours GROUP BY site) g LEFT JOIN v_hours h ON g.site = h.site AND g.t = h.t)") + ") f USING (k) WHERE epoch(t) = x", "value"))
def w2(v: Views) -> DataFrame:
    hours = v.v_hours.withColumn("t", F.col("t").cast("timestamp_ntz"))
    return win.fill_time_gaps(hours.union(hours), "site", "t", "value", 3600)


_MONTHLY = "SELECT cell AS k, CAST(date_trunc('month', day) AS DATE) AS d, avg(value) AS y FROM v_daily WHERE month(day) <> 5 GROUP BY ALL"
_DAYS = f"(SELECT k, CAST(unnest(generate_series(min(d), last_day(max(d)), INTERVAL 1 DAY)) AS DATE) AS day FROM ({_MONTHLY}) GROUP BY k)"


@query("w3_monthly_to_daily", duck("v_daily", "SELECT k AS cell, CAST(DATE '1970-01-01' + CAST(x AS INTEGER) AS DATE) AS day, y AS value FROM (" + FILLED.format(q=f"(SELECT g.k, date_diff('day', DATE '1970-01-01', g.day) AS x, m.y FROM {_DAYS} g LEFT JOIN ({_MONTHLY}) m ON g.k = m.k AND g.day = m.d)") + ")", "value"))
def w3(v: Views) -> DataFrame:
    monthly = v.v_daily.filter("month(day) <> 5").groupBy("cell", F.trunc("day", "month").alias("month")).agg(F.avg("value").alias("value"))
    return win.monthly_to_daily(monthly, "cell", "month", "value")


@query("w4_neighbour_mean", duck("v_series", """SELECT site, i, coalesce(value, CASE WHEN len(near) >= 4 THEN list_avg(list_transform(near[1:4], lambda s: s.v)) END) AS value FROM (
  SELECT a.site, a.i, a.value, list({'v': b.value} ORDER BY abs(b.i - a.i), -b.i) FILTER (b.value IS NOT NULL) AS near FROM v_series a JOIN v_series b ON a.site = b.site GROUP BY a.site, a.i, a.value)""", "value"), also="w4_neighbour_mean_whole")
def w4(v: Views) -> DataFrame:
    return win.neighbour_mean(v.v_series, "site", "i", "value", 4).select("site", "i", "value")


@query("w5_step_seconds", duck("v_daily", "SELECT cell, day, coalesce(step, lag(step) OVER (PARTITION BY cell ORDER BY day), 0) AS step FROM (SELECT cell, day, CAST(date_diff('day', day, lead(day) OVER (PARTITION BY cell ORDER BY day)) * 86400 AS DOUBLE) AS step FROM v_daily)"))
def w5(v: Views) -> DataFrame:
    return win.step_seconds(v.v_daily, "cell", "day").select("cell", "day", "step")


@query("w6_inspect_time", duck("v_series", """SELECT site, min(t) AS first, max(t) AS last, count(*) AS n, min(d) AS step, min(d) = max(d) AS uniform, min(d) > 0 AS positive, min(d) > 0 AND 86400 % min(d) = 0 AS divides_day,
  CAST(floor((epoch(min(t)) - epoch(date_trunc('year', min(t)))) / min(d)) AS BIGINT) AS missing_start, CAST(ceil((epoch(date_trunc('year', max(t)) + INTERVAL 1 YEAR) - epoch(max(t))) / min(d)) - 1 AS BIGINT) AS missing_end
  FROM (SELECT site, t, CAST(epoch(t) - epoch(lag(t) OVER (PARTITION BY site ORDER BY t)) AS BIGINT) AS d FROM v_series) GROUP BY site"""))
def w6(v: Views) -> DataFrame:
    return win.inspect_time(v.v_series, "site", "t")


@query("w7_apply_boundary", duck("v_series", """SELECT site, t, value FROM v_series WHERE i > 0 UNION ALL SELECT site, TIMESTAMP '2024-01-01', arg_min(value, i) FROM v_series WHERE i = 1 GROUP BY site
  UNION ALL SELECT * FROM (SELECT site, unnest(generate_series(max(t) + INTERVAL 1 HOUR, TIMESTAMP '2024-12-31 23:00:00', INTERVAL 1 HOUR)) AS t, max(CASE WHEN i = 719 THEN value END) AS value FROM v_series GROUP BY site)""", "value"))
def w7(v: Views) -> DataFrame:
    late = v.v_series.withColumn("t", F.col("t").cast("timestamp_ntz")).filter("i > 0").select("site", "t", "value")
    return win.apply_boundary(late, "site", "t", "value", start="pad", end="pad", max_pad=10_000)


@query("w8_pad_series", duck("v_series", """SELECT site, t, value FROM v_series UNION ALL
  SELECT site, a + INTERVAL 1 HOUR * -k, v0 + (v0 - coalesce(v1, v0)) * k FROM (SELECT site, min(t) AS a, max(CASE WHEN i = 0 THEN value END) AS v0, max(CASE WHEN i = 1 THEN value END) AS v1 FROM v_series GROUP BY site), range(1, 4) r(k)
  UNION ALL SELECT site, b + INTERVAL 1 HOUR * k, v0 + (v0 - coalesce(v1, v0)) * k FROM (SELECT site, max(t) AS b, max(CASE WHEN i = n THEN value END) AS v0, max(CASE WHEN i = n - 1 THEN value END) AS v1 FROM (SELECT *, max(i) OVER (PARTITION BY site) AS n FROM v_series) GROUP BY site), range(1, 3) r(k)""", "value"))
def w8(v: Views) -> DataFrame:
    return win.pad_series(v.v_series.withColumn("t", F.col("t").cast("timestamp_ntz")), "site", "t", "value", "extrapolate", 3, 2, 3600)


@query("w9_slice_series", duck("v_series", "SELECT g.site, g.k AS i, s.value FROM (SELECT site, max(i) AS n, unnest(range(-5, 731)) AS k FROM v_series GROUP BY site) g LEFT JOIN v_series s ON s.site = g.site AND s.i = CASE WHEN k < 0 THEN -k WHEN k > n THEN 2 * n - k ELSE k END", "value"))
def w9(v: Views) -> DataFrame:
    return win.slice_series(v.v_series, "site", "i", "value", -5, 730, "mirror")


@query("w10_axis_bounds", duck("v_grid", "SELECT lon, lon - d / 2 AS low, lon + d / 2 AS high FROM (SELECT lon, coalesce(d, lag(d) OVER (ORDER BY lon)) AS d FROM (SELECT lon, lead(lon) OVER (ORDER BY lon) - lon AS d FROM (SELECT DISTINCT lon FROM v_grid)))", "lon low high"))
def w10(v: Views) -> DataFrame:
    return win.axis_bounds(v.v_grid.select("lon").distinct(), "lon")


#: An axis over the date line, in its own order: 175, 175.5, .. 179.5, -180, .. -175.5.
_ROUND = "SELECT CAST((lon - 110) / 0.5 AS INTEGER) AS i, CASE WHEN lon >= 115 THEN lon - 295 ELSE lon + 65 END AS lon FROM (SELECT DISTINCT lon FROM v_grid)"
_ROUND_STEPS = f"SELECT *, coalesce(d, lag(d) OVER (ORDER BY i)) / 2 AS up, coalesce(lag(d) OVER (ORDER BY i), d) / 2 AS down, lag(lon) OVER (ORDER BY i) AS before FROM (SELECT *, (lead(lon) OVER (ORDER BY i) - lon + 540) % 360 - 180 AS d FROM ({_ROUND}))"


@query("w10_axis_over_date_line", duck("v_grid", f"SELECT 'half' AS form, lon, lon - up AS low, lon + up AS high FROM ({_ROUND_STEPS}) UNION ALL SELECT 'midpoint', lon, coalesce(before + down, lon - up), lon + up FROM ({_ROUND_STEPS})", "lon low high"))
def w10_round(v: Views) -> DataFrame:
    lon = F.when(F.col("lon") >= 115, F.col("lon") - 295).otherwise(F.col("lon") + 65)
    axis = v.v_grid.select(((F.col("lon") - 110) / 0.5).cast("int").alias("i"), lon.alias("lon")).distinct()
    forms = [win.axis_bounds(axis, "lon", "i", midpoint=m).select(F.lit(name).alias("form"), "*") for name, m in (("half", False), ("midpoint", True))]
    return forms[0].union(forms[1])


@query("w11_cell_corners", duck("v_grid", """SELECT CAST(r AS INTEGER) AS r, CAST(c AS INTEGER) AS c, [round(lon - x, 6), round(lon + x, 6), round(lon + x, 6), round(lon - x, 6)] AS lons, [round(lat - y, 6), round(lat - y, 6), round(lat + y, 6), round(lat + y, 6)] AS lats FROM (
  SELECT *, coalesce(dx, lag(dx) OVER (PARTITION BY r ORDER BY c)) / 2 AS x, coalesce(dy, lag(dy) OVER (PARTITION BY c ORDER BY r)) / 2 AS y FROM (SELECT *, lead(lon) OVER (PARTITION BY r ORDER BY c) - lon AS dx, lead(lat) OVER (PARTITION BY c ORDER BY r) - lat AS dy FROM (
  SELECT DISTINCT (lat + 40) / 0.5 AS r, (lon - 110) / 0.5 AS c, lon + lat / 100 AS lon, lat FROM v_grid)))"""))
def w11(v: Views) -> DataFrame:
    grid = v.v_grid.select(((F.col("lat") + 40) / 0.5).cast("int").alias("r"), ((F.col("lon") - 110) / 0.5).cast("int").alias("c"), (F.col("lon") + F.col("lat") / 100).alias("lon"), "lat").distinct()
    corners = win.cell_corners(grid, "r", "c", "lon", "lat")
    return corners.withColumns({n: F.transform(n, lambda x: F.round(x, 6)) for n in ("lons", "lats")})


@query("w12_layer_thickness", duck("v_layers", "SELECT cell, layer, coalesce(lead(d0 / 100.0) OVER (PARTITION BY cell ORDER BY layer), 1.5) - d0 / 100.0 AS thickness FROM v_layers", "thickness"))
def w12(v: Views) -> DataFrame:
    return win.layer_thickness(v.v_layers.withColumn("top", F.col("d0").cast("double") / 100), "cell", "layer", "top").select("cell", "layer", "thickness")


@query("w13_validate_sequence", duck("v_files", "SELECT var, a, b, coalesce(a > lag(b) OVER (PARTITION BY var ORDER BY a, b), TRUE) AND a <= b AS ok FROM (SELECT var, CAST(name[19:24] AS INTEGER) AS a, CAST(name[19:24] AS INTEGER) + CASE WHEN CAST(name[19:24] AS INTEGER) % 5 = 0 THEN 1 ELSE 0 END AS b FROM v_files)"))
def w13(v: Views) -> DataFrame:
    a = F.regexp_extract("name", r"_(\d{6})-(\d{6})\.nc$", 1).cast("int")
    files = v.v_files.select("var", a.alias("a")).withColumn("b", F.col("a") + F.when(F.col("a") % 5 == 0, 1).otherwise(0))
    return win.validate_sequence(files, "var", "a", "b")


@query("w14_full_years_only", duck("v_daily", "SELECT cell, day, value FROM v_daily JOIN (SELECT cell, min(day) AS a, max(day) AS b FROM v_daily GROUP BY cell) USING (cell) WHERE a <= make_date(CAST(year(day) AS BIGINT), 1, 1) AND b >= make_date(CAST(year(day) AS BIGINT), 12, 31)", "value"))
def w14(v: Views) -> DataFrame:
    return win.full_years_only(v.v_daily, "cell", "day")


@query("w15_complete_days", duck("v_hours", "SELECT site, t, value FROM v_hours UNION ALL SELECT site, t + INTERVAL 1 HOUR * k, value FROM (SELECT *, unnest(range(1, 24 - CAST(hour(t) AS INTEGER))) AS k FROM (SELECT *, max(t) OVER (PARTITION BY site) AS last FROM v_hours) WHERE t = last)", "value"), also="w15_complete_days_whole")
def w15(v: Views) -> DataFrame:
    """All hours with data; each site's last one is where its own events end."""
    return win.complete_days(v.v_hours.withColumn("t", F.col("t").cast("timestamp_ntz")), "site", "t", "value", 3600)


@query("w16_dedupe_sources", duck("v_raw", "SELECT site, source, event_id FROM (SELECT *, min(source) OVER (PARTITION BY site) AS first FROM (SELECT site, event_id, 'file' || (event_id % 3) AS source FROM v_raw)) WHERE source = first OR site = 'click'"))
def w16(v: Views) -> DataFrame:
    raw = v.v_raw.select("site", F.concat(F.lit("file"), (F.col("event_id") % 3).cast("string")).alias("source"), "event_id")
    return win.dedupe_sources(raw, "site", "source", (*model.DUPLICATE_SITES_ALLOWED, "click"))


def spline_sql(monthly: str, key: str, value: str) -> str:
    """DuckDB: (key, year, step, value) of spline_monthly() on monthly(key, year, month, value), its weights as a table."""
    weights = ", ".join(f"({leap}, {k}, {s}, {w!r})" for leap in (False, True) for k, s, w in win.monthly_weights(leap))
    return f"""SELECT {key}, year, step, least(greatest(sum(w * {value}), 0.01), 12.0) AS {value} FROM (SELECT *, unnest([month + 2, month - 10, month + 14]) AS knot FROM {monthly}) JOIN (VALUES {weights}) w(leap, knot, step, w) USING (knot) WHERE leap = (year % 4 = 0 AND (year % 100 <> 0 OR year % 400 = 0)) GROUP BY {key}, year, step"""


@query("w17_spline_monthly", duck("v_daily", spline_sql("(SELECT cell, year(day) AS year, month(day) AS month, avg(value) / 10 AS lai FROM v_daily GROUP BY ALL)", "cell", "lai"), "lai"))
def w17(v: Views) -> DataFrame:
    monthly = v.v_daily.groupBy("cell", F.year("day").alias("year"), F.month("day").alias("month")).agg((F.avg("value") / 10).alias("lai"))
    return win.spline_monthly(monthly, "cell", "year", "month", "lai")


@query("g1_time_grid", duck("v_raw", "SELECT site, unnest(generate_series(min(date_trunc('day', ts)), max(date_trunc('day', ts)), INTERVAL 30 MINUTE)) AS t FROM v_raw GROUP BY site"))
def g1(v: Views) -> DataFrame:
    day = lambda c: F.date_trunc("day", c).cast("timestamp_ntz")
    spans = v.v_raw.groupBy("site").agg(day(F.min("ts")).alias("a"), day(F.max("ts")).alias("b"))
    return gen.time_grid(spans, ["site"], "a", "b", "30 minutes")


@query("g2_month_grid", duck("v_daily", "SELECT CAST(unnest(generate_series(date_trunc('month', min(day)), date_trunc('month', max(day)), INTERVAL 1 MONTH)) AS DATE) AS month FROM v_daily"))
def g2(v: Views) -> DataFrame:
    return gen.month_grid(v.v_daily, "day")


@query("g3_lonlat_grid", duck("v_grid", "SELECT c AS cell, 110 + 0.5 * (c % 20) AS lon, -40 + 0.5 * (c // 20) AS lat, n FROM range(400) r(c) LEFT JOIN (SELECT lon AS x, lat AS y, count(*) AS n FROM v_grid GROUP BY ALL) ON x = 110 + 0.5 * (c % 20) AND y = -40 + 0.5 * (c // 20)", "lon lat"))
def g3(v: Views) -> DataFrame:
    return gen.lonlat_grid(v.spark, 110, 0.5, 20, -40, 0.5, 20).join(v.v_grid.groupBy("lon", "lat").agg(F.count("*").alias("n")), ["lon", "lat"], "left")


@query("g4_repeat_first_year", duck("v_daily", "SELECT cell, day, value FROM v_daily UNION ALL SELECT cell, CAST(day - INTERVAL 1 YEAR * k AS DATE), value FROM v_daily, range(1, 4) r(k) WHERE year(day) = (SELECT min(year(b.day)) FROM v_daily b WHERE b.cell = v_daily.cell)", "value"))
def g4(v: Views) -> DataFrame:
    return gen.repeat_first_year(v.v_daily, "cell", "day", 3)


_DRAWN = "sqrt(-2 * ln(u1)) * cos(2 * pi() * u2)"


@query("g5_synthetic_years", duck("v_daily", f"""SELECT cell, day, value FROM v_daily UNION ALL SELECT cell, CAST(make_date(CAST(y AS BIGINT), 1, 1) + CAST(doy - 1 AS INTEGER) AS DATE), greatest(least(mean + sd * {_DRAWN}, 50.0), 0.0)
  FROM (SELECT *, (CAST('0x' || m[1:13] AS BIGINT) + 0.5) / 4503599627370496 AS u1, (CAST('0x' || m[17:29] AS BIGINT) + 0.5) / 4503599627370496 AS u2 FROM (SELECT *, md5('7|' || cell || '|' || y || '|' || doy) AS m
  FROM (SELECT cell, dayofyear(day) AS doy, avg(value) AS mean, coalesce(stddev_pop(value), 0) AS sd FROM v_daily GROUP BY 1, 2 HAVING doy <= 365) JOIN (SELECT cell, unnest(range(min(year(day)) - 3, min(year(day)))) AS y FROM v_daily GROUP BY cell) USING (cell)))""", "value"))
def g5(v: Views) -> DataFrame:
    return gen.synthetic_years(v.v_daily, "cell", "day", "value", 3, 7, 0, 50)


_ENDS = "SELECT cell, min(day) AS a, max(day) AS b, arg_min(value, day) AS x, arg_max(value, day) AS y FROM v_daily GROUP BY cell"


@query("d2_padders", duck("v_daily", f"SELECT cell, 'constant' AS how, a::TIMESTAMP - INTERVAL 1 DAY AS t, 0.0 AS value FROM ({_ENDS}) UNION ALL SELECT cell, 'constant', b::TIMESTAMP + INTERVAL 1 DAY, 0.0 FROM ({_ENDS}) UNION ALL SELECT cell, 'nearest', a::TIMESTAMP - INTERVAL 1 DAY, x FROM ({_ENDS}) UNION ALL SELECT cell, 'nearest', b::TIMESTAMP + INTERVAL 1 DAY, y FROM ({_ENDS})", "value"))
def d2(v: Views) -> DataFrame:
    daily = v.v_daily.select("cell", F.col("day").cast("timestamp_ntz").alias("t"), "value")
    span = daily.groupBy("cell").agg(F.min("t").alias("a"), F.max("t").alias("b"))
    padded = [win.pad_series(daily, "cell", "t", "value", how, 1, 1, 86400).withColumn("how", F.lit(how)) for how in ("constant", "nearest")]
    return padded[0].union(padded[1]).join(span, "cell").filter("t < a OR t > b").select("cell", "how", "t", "value")
