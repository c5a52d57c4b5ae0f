"""Queries of joins, sorts, set operations and regridding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraflux import model
from terraflux.functions import generators as gen
from terraflux.functions import scalars
from terraflux.operators import joins, nearest, regrid, sets
from terraflux.operators import windows as win
from terraflux.plans.fixtures import BOX  # noqa: F401
from terraflux.plans.registry import Views, duck, query
from terraflux.sources.scratch import scratch


@query("j1_merge_variables", duck("v_grid", "SELECT lon, lat, month, tas, huss, ps FROM (SELECT lon, lat, month, tas FROM v_grid WHERE tas > 5) FULL JOIN (SELECT lon, lat, month, huss FROM v_grid WHERE month(month) < 9) USING (lon, lat, month) FULL JOIN (SELECT lon, lat, month, ps FROM v_grid) USING (lon, lat, month)", "tas huss ps"))
def j1(v: Views) -> DataFrame:
    grid, keys = v.v_grid, ["lon", "lat", "month"]
    return joins.merge_variables(keys, grid.filter("tas > 5").select(*keys, "tas"), grid.filter("month(month) < 9").select(*keys, "huss"), grid.select(*keys, "ps"))


@query("j2_join_aligned", duck("v_grid", "SELECT lon || '/' || lat AS cell, month, tas, huss, ps FROM v_grid", "tas huss ps").replace("lon || '/' || lat", "printf('%.1f/%.1f', lon, lat)"))
def j2(v: Views) -> DataFrame:
    grid = v.v_grid.withColumn("cell", F.format_string("%.1f/%.1f", "lon", "lat"))
    return joins.join_aligned(["cell", "month"], "cell", "month", *[grid.select("cell", "month", c) for c in ("tas", "huss", "ps")])


@query("j3_resolve_sites", duck("v_sites", "SELECT l_orderkey, l_linenumber, site, lon, lat FROM lineitem JOIN v_sites ON l_suppkey = s_suppkey", "lon lat"))
def j3(v: Views) -> DataFrame:
    rows = v.lineitem.select("l_orderkey", "l_linenumber", F.format_string("Supplier#%09d", "l_suppkey").alias("site"))
    return joins.resolve_sites(rows, v.v_sites.select("site", "lon", "lat"))


@query("j4_attach_attributes", duck("v_sites", "SELECT site, lon, kind FROM v_sites LEFT JOIN (SELECT s_suppkey AS k, 'forest' AS kind FROM supplier WHERE s_suppkey % 3 = 0) ON k = s_suppkey", "lon"))
def j4(v: Views) -> DataFrame:
    kinds = v.supplier.filter("s_suppkey % 3 = 0").select("s_suppkey", F.lit("forest").alias("kind"))
    return joins.attach_attributes(v.v_sites, kinds, ["s_suppkey"]).select("site", "lon", "kind")


_NEAREST = """SELECT site, arg_min(x, (abs(x - lon), x)) AS cell_lon, arg_min(y, (abs(y - lat), y)) AS cell_lat FROM v_sites, (SELECT DISTINCT lon AS x FROM v_grid) a, (SELECT DISTINCT lat AS y FROM v_grid) b GROUP BY site"""


@query("j5_nearest_cell", duck("v_sites v_grid", _NEAREST, "cell_lon cell_lat"))
def j5(v: Views) -> DataFrame:
    return joins.nearest_cell(v.v_sites, "site", v.v_grid.select("lon", "lat").distinct()).select("site", "cell_lon", "cell_lat")


@query("j6_coord_join", duck("v_grid", "SELECT lon, lat, month, tas, cell FROM v_grid JOIN (SELECT DISTINCT lon AS x, lat AS y, CAST(lon * 10 + lat AS BIGINT) AS cell FROM v_grid WHERE lon > 115) ON abs(lon - x) < 1e-16 AND abs(lat - y) < 1e-16", "tas"))
def j6(v: Views) -> DataFrame:
    cells = v.v_grid.filter("lon > 115").select("lon", "lat", F.rint(F.col("lon") * 10 + F.col("lat")).cast("long").alias("cell")).distinct()
    return joins.coord_join(v.v_grid, cells).select("lon", "lat", "month", "tas", "cell")


@query("j7_points_in_polygons", duck("v_grid", "SELECT DISTINCT lon, lat, 1 AS poly FROM v_grid WHERE lon > 112 AND lon < 118 AND lat > -38 AND lat < -32"))
def j7(v: Views) -> DataFrame:
    return joins.points_in_polygons(v.v_grid.select("lon", "lat").distinct().withColumns({"x": F.col("lon"), "y": F.col("lat")}), ["x", "y"], v.v_box).select(F.col("x").alias("lon"), F.col("y").alias("lat"), "poly")


#: v_grid's coordinates read as those of a rotated pole.
_ROTATED = """SELECT month, tas, lon, lat, round(pmod_lon, 9) AS glon, round(degrees(asin(sz)), 9) AS glat FROM (
  SELECT *, (141.38 + degrees(atan2(cos(b) * sin(a), sp * cos(b) * cos(a) - cp * sin(b))) + 540) % 360 - 180 AS pmod_lon, sp * sin(b) + cp * cos(b) * cos(a) AS sz
  FROM (SELECT *, radians(lon - 115 + 180) AS a, radians(lat + 35) AS b, sin(radians(-60.31)) AS sp, cos(radians(-60.31)) AS cp FROM v_grid))"""


def _rotated(v: Views) -> DataFrame:
    lon, lat = scalars.derotate(F.col("lon") - 115 + 180, F.col("lat") + 35, 321.38, -60.31)
    return v.v_grid.select("month", "tas", "lon", "lat", F.round(lon, 9).alias("glon"), F.round(lat, 9).alias("glat"))


_CHORD = "pow(cos(radians(b.{1})) * cos(radians(b.{0})) - cos(radians(a.lat)) * cos(radians(a.lon)), 2) + pow(cos(radians(b.{1})) * sin(radians(b.{0})) - cos(radians(a.lat)) * sin(radians(a.lon)), 2) + pow(sin(radians(b.{1})) - sin(radians(a.lat)), 2)"
_SPHERE = f"""SELECT site, arg_min(glon, o) AS cell_lon, arg_min(glat, o) AS cell_lat, degrees(min(o[1])) AS distance FROM (
  SELECT a.site, glon, glat, [round(2 * asin(least(sqrt({_CHORD.format("glon", "glat")}) / 2, 1)), 10), glat, glon] AS o FROM v_sites a, (SELECT DISTINCT glon, glat FROM ({_ROTATED})) b) GROUP BY site"""


@query("j5_nearest_on_sphere", duck("v_sites v_grid", _SPHERE, "cell_lon cell_lat distance"))
def j5_sphere(v: Views) -> DataFrame:
    """The nearest cells of a rotated grid, which has no axes in longitude and latitude."""
    cells = _rotated(v).select(F.col("glon").alias("lon"), F.col("glat").alias("lat")).distinct()
    return nearest.nearest_on_sphere(v.v_sites.select("site", "lon", "lat"), cells).select("site", "cell_lon", "cell_lat", F.degrees("distance").alias("distance"))


@query("j8_align_to_grid", duck("v_series v_raw", "SELECT s.site, s.t, purchase, other FROM v_series s LEFT JOIN (SELECT site, date_trunc('hour', ts) AS t, avg(value) FILTER (qc = 0) AS purchase, avg(value) FILTER (qc = 10) AS other FROM v_raw WHERE qc IN (0, 10) GROUP BY 1, 2) r ON s.site = r.site AND s.t = r.t", "purchase other"))
def j8(v: Views) -> DataFrame:
    seen = v.v_raw.filter("qc IN (0, 10)").select("site", F.date_trunc("hour", "ts").alias("t"), F.when(F.col("qc") == 0, "purchase").otherwise("other").alias("variable"), "value")
    return joins.align_to_grid(v.v_series.select("site", "t"), seen, ["site", "t"], "variable", "value", ["purchase", "other"])


@query("j9_on_axis", duck("v_hours", "SELECT site, t, value FROM v_hours WHERE t IN (SELECT DISTINCT date_trunc('day', ts) + INTERVAL 12 HOUR FROM events)", "value"))
def j9(v: Views) -> DataFrame:
    noon = v.events.select((F.date_trunc("day", "ts") + F.expr("interval 12 hours")).alias("t"))
    return joins.on_axis(v.v_hours, noon, ["t"]).select("site", "t", "value")


@query("j9_off_axis", duck("v_hours", "SELECT site, t, value FROM v_hours WHERE t NOT IN (SELECT DISTINCT date_trunc('day', ts) + INTERVAL 12 HOUR FROM events)", "value"))
def j9_off(v: Views) -> DataFrame:
    noon = v.events.select((F.date_trunc("day", "ts") + F.expr("interval 12 hours")).alias("t"))
    return joins.off_axis(v.v_hours, noon, ["t"]).select("site", "t", "value")


@query("j10_missing_steps", duck("v_series v_hours", "SELECT g.site, g.t FROM (SELECT site, unnest(generate_series(min(t), max(t), INTERVAL 1 HOUR)) AS t FROM v_hours GROUP BY site) g ANTI JOIN v_hours h ON g.site = h.site AND g.t = h.t"))
def j10(v: Views) -> DataFrame:
    return joins.missing_steps(v.v_hours, "site", "t", "1 hour")


@query("j11_missing_periods", duck("v_files", "SELECT var, y * 100 + m AS period FROM (SELECT DISTINCT var FROM v_files), range(1995, 2003) a(y), range(1, 13) b(m) WHERE (var, y * 100 + m) NOT IN (SELECT var, CAST(name[19:24] AS BIGINT) FROM v_files)"))
def j11(v: Views) -> DataFrame:
    files = v.v_files.select("var", F.regexp_extract("name", r"_(\d{6})-", 1).alias("period"))
    return joins.missing_periods(files, "var", "period", 1995, 2002)


_FLAGS = "(VALUES " + ", ".join("({}, {}, '{}')".format(flag, passed, said.replace("'", "''")) for flag, (passed, said) in model.QC_FLAGS.items()) + ") f(qc, passed, description)"


@query("j12_qc_explain", duck("v_raw", f"SELECT r.qc, n, coalesce(passed, TRUE) AS passed, description FROM (SELECT qc, count(*) AS n FROM v_raw GROUP BY qc) r LEFT JOIN {_FLAGS} ON r.qc = f.qc"))
def j12(v: Views) -> DataFrame:
    return joins.qc_explain(v.v_raw, "qc")


@query("j13_merge_points", duck("v_grid", "SELECT lon, lat, month, tas, CASE WHEN lon >= 115 THEN huss END AS huss FROM v_grid", "tas huss"))
def j13(v: Views) -> DataFrame:
    west, east = v.v_grid.filter("lon < 115"), v.v_grid.filter("lon >= 115")
    return joins.merge_points(west.select("lon", "lat", "month", "tas"), east.select("lon", "lat", "month", "huss", "tas"))


@query("t1_order_observations", duck("v_modis", "SELECT id, date, lai FROM v_modis ORDER BY id, date", "lai"))
def t1(v: Views) -> DataFrame:
    return sets.order_observations(v.v_modis.drop("qc"), "id", "date")


@query("t2_first_k", duck("v_series", "SELECT site, CAST(t AS DATE) AS day, count(*) AS n, string_agg(CASE WHEN p <= 5 THEN i END, ',' ORDER BY i) AS first FROM (SELECT *, row_number() OVER (PARTITION BY site, CAST(t AS DATE) ORDER BY t, i) AS p FROM v_series WHERE value IS NULL OR value > 60) GROUP BY 1, 2"))
def t2(v: Views) -> DataFrame:
    odd = v.v_series.filter("value IS NULL OR value > 60").withColumn("day", F.to_date("t"))
    return sets.first_k(odd, ["site", "day"], ["t", "i"], 5, "first")


@query("t3_duplicate_keys", duck("v_raw", "SELECT site, date_trunc('minute', ts) AS t, count(*) AS n FROM v_raw GROUP BY 1, 2 HAVING count(*) > 1"))
def t3(v: Views) -> DataFrame:
    return sets.duplicate_keys(v.v_raw.select("site", F.date_trunc("minute", "ts").alias("t")), ["site", "t"])


@query("t4_at_step", duck("v_grid", "SELECT lon, lat, month, tas FROM v_grid WHERE month = (SELECT DISTINCT month FROM v_grid ORDER BY month LIMIT 1 OFFSET 7)", "tas"))
def t4(v: Views) -> DataFrame:
    return sets.at_step(v.v_grid, "month", 7).select("lon", "lat", "month", "tas")


@query("u1_concat_time", duck("v_daily", "SELECT cell, day, CASE WHEN year(day) < 1998 THEN value ELSE value - 273.15 END AS value FROM v_daily", "value"))
def u1(v: Views) -> DataFrame:
    return sets.concat_time([(v.v_daily.filter("year(day) < 1998"), "degC"), (v.v_daily.filter("year(day) >= 1998"), "K")], "value")


@query("u2_union_sites", duck("v_raw", "SELECT site, ts, CASE WHEN site < 'd' THEN value END AS a, CASE WHEN site >= 'd' THEN value END AS b FROM v_raw", "a b"))
def u2(v: Views) -> DataFrame:
    low, high = v.v_raw.filter("site < 'd'"), v.v_raw.filter("site >= 'd'")
    return sets.union_sites([low.select("site", "ts", F.col("value").alias("a")), high.select("site", F.col("value").alias("b"), "ts")])


@query("u3_intersect_keys", duck("v_series", "SELECT site, CAST(t AS DATE) AS day FROM v_series WHERE value > 70 INTERSECT SELECT site, CAST(t AS DATE) FROM v_series WHERE value < 30"))
def u3(v: Views) -> DataFrame:
    days = lambda condition: v.v_series.filter(condition).select("site", F.to_date("t").alias("day"))
    return sets.intersect_keys(days("value > 70"), days("value < 30"))


@query("u4_pending", duck("v_files", "SELECT var, name FROM v_files WHERE CAST(name[19:24] AS INTEGER) % 4 <> 0"))
def u4(v: Views) -> DataFrame:
    done = v.v_files.filter(F.regexp_extract("name", r"_(\d{6})-", 1).cast("int") % 4 == 0)
    return sets.pending(v.v_files, done, ["var", "name"])


@query("u5_split_by_year", duck("v_daily", "SELECT cell, day, value, year(day) AS year FROM v_daily", "value"))
def u5(v: Views) -> DataFrame:
    """Written by year and read back; the year comes from the folders."""
    path = scratch(v.spark, "years")
    sets.split_by_year(v.v_daily, "day", path)
    return v.spark.read.parquet(path).select("cell", "day", "value", F.col("year").cast("int").alias("year"))


_CONSERVATIVE = """SELECT month, x AS lon, y AS lat, sum(w * tas) / sum(w) AS tas FROM (SELECT month, tas, x, y, (least(lon + 0.25, x + 0.6) - greatest(lon - 0.25, x - 0.6)) * (sin(radians(least(lat + 0.25, y + 0.6))) - sin(radians(greatest(lat - 0.25, y - 0.6)))) AS w
  FROM v_grid JOIN (SELECT 110 + 1.2 * i AS x FROM range(-2, 12) r(i)) ON least(lon + 0.25, x + 0.6) - greatest(lon - 0.25, x - 0.6) > 1e-9 JOIN (SELECT -40 + 1.2 * j AS y FROM range(-2, 12) r(j)) ON least(lat + 0.25, y + 0.6) - greatest(lat - 0.25, y - 0.6) > 1e-9) GROUP BY ALL"""


@query("a20_regrid_conservative", duck("v_grid", _CONSERVATIVE, "lon lat tas"))
def a20(v: Views) -> DataFrame:
    return regrid.regrid_conservative(v.v_grid, ["month"], "tas", 0.5, 110, 1.2, -40, 1.2)


_BILINEAR = """SELECT month, x AS lon, y AS lat, sum(tas * (1 - abs(lon - x) / 0.5) * (1 - abs(lat - y) / 0.5)) AS tas FROM v_grid JOIN (SELECT 110.2 + 0.7 * i AS x FROM range(14) r(i)) ON abs(lon - x) < 0.5 - 1e-9 JOIN (SELECT -39.9 + 0.7 * j AS y FROM range(14) r(j)) ON abs(lat - y) < 0.5 - 1e-9
  GROUP BY ALL HAVING sum((1 - abs(lon - x) / 0.5) * (1 - abs(lat - y) / 0.5)) > 1 - 1e-6"""


@query("a21_regrid_bilinear", duck("v_grid", _BILINEAR, "lon lat tas"))
def a21(v: Views) -> DataFrame:
    targets = gen.lonlat_grid(v.spark, 110.2, 0.7, 14, -39.9, 0.7, 14)
    return regrid.regrid_bilinear(v.v_grid, ["month"], "tas", 110, 0.5, -40, 0.5, targets)


#: v_grid moved over the date line: longitudes 175 to 184.5 of a circle counted from 0.
_EAST = "lon + 65"
_TO_LON = ((-179.5, -181.5, -178.0), (-176.75, -178.0, -175.5), (172.0, 170.0, 174.0), (176.25, 174.0, 178.5))
_TO_LAT = ((-39.0, -40.5, -37.6), (-35.5, -37.6, -33.1), (-31.0, -33.1, -30.0))
_VALUES = lambda rows: "(VALUES " + ", ".join(f"({', '.join(f'CAST({x} AS DOUBLE)' for x in r)})" for r in rows) + ")"
_BOUNDS = f"""SELECT month, x AS lon, y AS lat, sum(w * tas) / sum(w) AS tas, sum(w * huss) / sum(w) AS huss FROM (
  SELECT month, tas, huss, x, y, greatest(least(lon + 65.25 + k, xb) - greatest(lon + 64.75 + k, xa), 0) * greatest(sin(radians(least(lat + 0.25, yb))) - sin(radians(greatest(lat - 0.25, ya))), 0) AS w
  FROM v_grid, {_VALUES(_TO_LON)} a(x, xa, xb), {_VALUES(_TO_LAT)} b(y, ya, yb), (VALUES (-360), (0), (360)) c(k)) WHERE w > 1e-12 GROUP BY ALL"""


def _axis(v: Views, rows: tuple) -> DataFrame:
    return v.spark.createDataFrame(list(rows), "value double, low double, high double")


@query("a20_regrid_bounds", duck("v_grid", _BOUNDS, "lon lat tas huss"))
def a20_bounds(v: Views) -> DataFrame:
    """A source in 0..360 on a target in -180..180 with cells of any width, both over the date line."""
    grid = v.v_grid.withColumn("lon", F.col("lon") + 65)
    axis = lambda c: win.axis_bounds(grid.select(c).distinct(), c).withColumnRenamed(c, "value")
    return regrid.regrid_bounds(grid, ["month"], ["tas", "huss"], axis("lon"), axis("lat"), _axis(v, _TO_LON), _axis(v, _TO_LAT))


#: The grid lines on either side of each target's, whatever lines the data have, and their weights.
_SIDES = "SELECT t, own, CASE WHEN a = b THEN 1.0 WHEN s = b THEN (a - t) / (a - b) ELSE (t - b) / (a - b) END AS w FROM (SELECT t, max(s) FILTER (s <= t) AS b, min(s) FILTER (s >= t) AS a FROM {targets}, {lines} l GROUP BY t) JOIN {lines} l ON s = a OR s = b"
_AXES = f"""SELECT month, x.t AS lon, y.t AS lat, sum(tas * x.w * y.w) AS tas FROM v_grid
  JOIN ({_SIDES.format(targets="(SELECT -184.8 + 0.7 * i AS t FROM range(14) r(i))", lines="(SELECT DISTINCT lon + 65 + k AS s, lon AS own FROM v_grid, (VALUES (-360), (0), (360)) c(k))")}) x ON x.own = lon
  JOIN ({_SIDES.format(targets="(SELECT -39.9 + 0.7 * j AS t FROM range(14) r(j))", lines="(SELECT DISTINCT lat AS s, lat AS own FROM v_grid)")}) y ON y.own = lat
GROUP BY ALL HAVING sum(x.w * y.w) > 1 - 1e-6"""


@query("a21_regrid_axes", duck("v_grid", _AXES, "lon lat tas"))
def a21_axes(v: Views) -> DataFrame:
    """Bilinear over the date line: targets run from -184.8, sources from 175."""
    targets = gen.lonlat_grid(v.spark, -184.8, 0.7, 14, -39.9, 0.7, 14)
    return regrid.regrid_axes(v.v_grid.withColumn("lon", F.col("lon") + 65), ["month"], "tas", targets)


#: The area below an edge within a box, by cutting the edge at the box's sides; see regrid.corner_weights().
_CORNERS = f"""
g AS (SELECT DISTINCT CAST(round((lon - 110) / 0.5) AS INTEGER) AS c, CAST(round((lat + 40) / 0.5) AS INTEGER) AS r, glon, glat FROM ({_ROTATED})),
d AS (SELECT *, coalesce(dx, lag(dx) OVER (PARTITION BY r ORDER BY c)) / 2 AS hx, coalesce(dy, lag(dy) OVER (PARTITION BY c ORDER BY r)) / 2 AS hy
  FROM (SELECT *, lead(glon) OVER (PARTITION BY r ORDER BY c) - glon AS dx, lead(glat) OVER (PARTITION BY c ORDER BY r) - glat AS dy FROM g)),
t AS (SELECT x, y, x - 0.75 AS x0, x + 0.75 AS x1, sin(radians(y - 0.75)) AS y0, sin(radians(y + 0.75)) AS y1 FROM (SELECT 130 + 1.5 * i AS x FROM range(20) a(i)), (SELECT -40 + 1.5 * j AS y FROM range(14) b(j))),
p AS (SELECT c, r, x, y, x0, x1, y0, y1, sin(radians(glat - hy)) AS low, sin(radians(glat + hy)) AS high, greatest(least(glon + abs(hx), x1) - greatest(glon - abs(hx), x0), 0) AS wide FROM d, t),
w AS (SELECT c, r, x, y, wide * greatest(least(greatest(low, high), y1) - greatest(least(low, high), y0), 0) AS w FROM p)
"""


@query("a20_regrid_corners", duck("v_grid", "SELECT 1").replace(" SELECT 1", f", {_CORNERS}, q_ AS (SELECT month, x AS lon, y AS lat, sum(w * tas) / sum(w) AS tas FROM ({_ROTATED}) v JOIN w ON w.c = CAST(round((v.lon - 110) / 0.5) AS INTEGER) AND w.r = CAST(round((v.lat + 40) / 0.5) AS INTEGER) WHERE w > 1e-13 GROUP BY ALL) SELECT * REPLACE (round(lon + 1e-9, 6) + 0.0 AS lon, round(lat + 1e-9, 6) + 0.0 AS lat, round(tas + 1e-9, 6) + 0.0 AS tas) FROM q_"))
def a20_corners(v: Views) -> DataFrame:
    """A rotated grid, whose cells have W11's corners, onto a regular one."""
    place = lambda c, x0: F.rint((F.col(c) - x0) / 0.5).cast("int")
    grid = _rotated(v).withColumns({"c": place("lon", 110), "r": place("lat", -40)})
    corners = win.cell_corners(grid.select("r", "c", "glon", "glat").distinct(), "r", "c", "glon", "glat")
    axis = lambda x0, n: v.spark.range(n).select((x0 + F.col("id") * 1.5).alias("value"), (x0 - 0.75 + F.col("id") * 1.5).alias("low"), (x0 + 0.75 + F.col("id") * 1.5).alias("high"))
    return regrid.regrid_corners(grid.select("month", "r", "c", "tas"), ["month"], ["tas"], ["r", "c"], corners, axis(130.0, 20), axis(-40.0, 14))
