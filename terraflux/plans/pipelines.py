"""Composite jobs: site forcing, flux observations, remote sensing, inventories, gridded climate, soil, benchmark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraflux import model
from terraflux.functions import generators, scalars
from terraflux.operators import aggregates as agg
from terraflux.operators import filters, joins, regrid, sets, tables
from terraflux.operators import windows as win
from terraflux.plans.filters import FAILING
from terraflux.plans.fixtures import CELLS
from terraflux.plans.registry import Views, duck, query
from terraflux.plans.windows import FILLED, spline_sql
from terraflux.sources import scans, sinks
from terraflux.sources.scratch import once, scratch

#: Forcing variables: aggregator, padding and its constant, units in and out, bounds in the units out.
FORCING = {
    "tav": ("mean", "nearest", 0.0, "degC", "K", 173.15, 373.15),
    "prec": ("sum", "constant", 0.0, "mm", "kg m-2", 0.0, 1e4),
    "insol": ("mean", "nearest", 0.0, "W/m2", "W m-2", 0.0, 1e5),
}


def site_forcing(raw: DataFrame, step: int, minutes: int, variables: dict[str, tuple] = FORCING, *, start: str = "pad", end: str = "ignore", max_pad: int = 1, align: str = "none") -> DataFrame:
    """(site, t, a column per variable) in steps of some minutes.

    raw is (site, ts, value, qc) with times on a grid of step minutes; a site with others stops the job. W6 inspects each
    site's times by aggregates, P8 masks failing values, W1 fills gaps day by day, W7 and W8 trim or pad to whole years
    (each variable in its own way), A2 groups steps by their place after the beginning, P14 converts units, P12 clamps,
    F8 aligns. No task needs a whole site.
    """
    masked = filters.qc_mask(raw, "value", "qc")
    seen = once(masked.groupBy("site", F.col("ts").alias("t")).agg(F.avg("value").alias("value")), "forcing-seen")  # inspected, and filled
    found = win.inspect_grid(seen, "site", "t", step * 60)
    plan = win.plan_of(found, "site", minutes, start, end, max_pad)
    series = generators.time_grid(found, ["site"], "first", "last", f"{step} minutes").join(seen, ["site", "t"], "left")
    placed = series.withColumn("i", F.unix_timestamp(F.col("t").cast("timestamp"))).withColumn("day", F.to_date("t"))
    filled = win.interpolate_gaps(placed, "site", "i", "value", block="day").select("site", "t", *[F.col("value").alias(name) for name in variables])
    whole = win.apply_plan(filled, plan, "site", "t", {name: (v[1], v[2]) for name, v in variables.items()})
    begun = whole.join(plan.select("site", "begin", "ratio", "step"), "site")
    place = F.floor(F.timestamp_diff("SECOND", "begin", "t") / (F.col("step") * F.col("ratio")))
    grouped = begun.groupBy("site", "ratio", place.alias("g")).agg(F.min("t").alias("t"), F.count("*").alias("n"), *[agg.AGGREGATORS[v[0]](F.col(name)).alias(name) for name, v in variables.items()])
    out = grouped.filter("n = ratio").select("site", "t", *variables)
    out = out.withColumns({name: scalars.clamp(scalars.convert(F.col(name), v[3], v[4], minutes * 60.0), v[5], v[6]) for name, v in variables.items()})
    return win.align_series(once(out, "forcing"), "site", "t", align, minutes)  # checked, and passed on


#: Times ten days earlier and five minutes late, so that a year begins within the data and alignment has work to do.
_SHIFTED = "date_trunc('hour', ts) - INTERVAL 10 DAY + INTERVAL 5 MINUTE"
_MASKED = f"(SELECT site, {_SHIFTED} AS t, avg(CASE WHEN NOT coalesce(qc IN ({FAILING}), FALSE) THEN value END) AS value FROM v_raw GROUP BY 1, 2)"
_AXIS = f"(SELECT site, unnest(generate_series(min(t), max(t), INTERVAL 1 HOUR)) AS t FROM {_MASKED} GROUP BY site)"
_FILLED = FILLED.format(q=f"(SELECT s.site AS k, epoch(s.t) AS x, m.value AS y FROM {_AXIS} s LEFT JOIN {_MASKED} m ON s.site = m.site AND s.t = m.t)")
_WHOLE = f"""f_ AS (SELECT k AS site, make_timestamp(CAST(x * 1000000 AS BIGINT)) AS t, y, y AS p FROM ({_FILLED})), e_ AS (SELECT site, min(t) AS a, max(t) AS b, arg_max(y, t) AS last FROM f_ GROUP BY site),
  k_ AS (SELECT f_.* FROM f_ JOIN e_ USING (site) WHERE year(t) > year(a) OR a < date_trunc('year', a) + INTERVAL 1 HOUR
    UNION ALL SELECT site, unnest(generate_series(b + INTERVAL 1 HOUR, date_trunc('year', b) + INTERVAL 1 YEAR - INTERVAL 55 MINUTE, INTERVAL 1 HOUR)) AS t, last, 0.0 FROM e_),
  g_ AS (SELECT *, floor((epoch(t) - min(epoch(t)) OVER (PARTITION BY site)) / 10800) AS g FROM k_)"""


@query("c1_site_forcing", duck("v_raw", "SELECT site, min(t) - INTERVAL 5 MINUTE AS t, greatest(least(avg(y) + 273.15, 373.15), 173.15) AS tav, greatest(least(sum(p), 1e4), 0.0) AS prec, greatest(least(avg(y), 1e5), 0.0) AS insol FROM g_ GROUP BY site, g HAVING count(*) = 3", "tav prec insol").replace(", q_ AS (", f", {_WHOLE}, q_ AS (", 1))
def c1(v: Views) -> DataFrame:
    """Three-hourly forcing: the incomplete first year trimmed, the last one padded."""
    raw = v.v_raw.withColumn("ts", F.expr(_SHIFTED).cast("timestamp_ntz"))
    return site_forcing(raw, 60, 180, start="trim", end="pad", align="half_hour")


def flux_observations(sources: list[DataFrame], source: str, source_units: str, target_units: str) -> DataFrame:
    """Daily means of rows that pass, as amounts over the time to the next day, under canonical site names.

    Each source table is worked on alone (P9, A1, W5, P14, F1); of their union (U2) a site keeps its first source (W16).
    """

    def daily(raw: DataFrame) -> DataFrame:
        means = agg.aggregate_period(filters.qc_drop(raw, "qc"), ["site", source], "ts", "day", {"value": "mean"})
        stepped = win.step_seconds(means.withColumn("__series", F.concat_ws("/", "site", source)), "__series", "date")
        return filters.convert_units(stepped, "value", source_units, target_units, F.col("step")).withColumn("site", scalars.normalise_site(F.col("site")))

    return win.dedupe_sources(sets.union_sites([daily(raw) for raw in sources]), "site", source, model.DUPLICATE_SITES_ALLOWED).select("site", source, "date", "value")


_SITE_OF = "CASE site WHEN 'click' THEN 'AU-How' WHEN 'view' THEN 'Tum' WHEN 'error' THEN 'wallaby creek' ELSE site END"
_NAME_OF = "CASE site WHEN 'click' THEN 'HowardSprings' WHEN 'view' THEN 'Tumbarumba' WHEN 'error' THEN 'WallabyCreek' ELSE site END"
_FLUXES = f"""SELECT site, source, date, value * (1e-6 * 12.011) * coalesce(step, prev, 0) AS value FROM (SELECT *, min(source) OVER (PARTITION BY site) AS first, lag(step) OVER (PARTITION BY site, source ORDER BY date) AS prev FROM (
  SELECT *, date_diff('day', date, lead(date) OVER (PARTITION BY site, source ORDER BY date)) * 86400 AS step FROM (SELECT {_NAME_OF} AS site, 'f' || (event_id % 2) AS source, CAST(ts AS DATE) AS date, avg(value) AS value FROM v_raw WHERE NOT coalesce(qc IN ({FAILING}), FALSE) GROUP BY 1, 2, 3))) WHERE source = first"""


def _flux_tables(v: Views) -> list[DataFrame]:
    raw = v.v_raw.withColumn("source", F.concat(F.lit("f"), (F.col("event_id") % 2).cast("string"))).withColumn("site", F.expr(_SITE_OF))
    return [raw.filter(F.col("source") == name) for name in ("f0", "f1")]


@query("c2_flux_observations", duck("v_raw", _FLUXES, "value"), also="c2_flux_observations_whole")
def c2(v: Views) -> DataFrame:
    return flux_observations(_flux_tables(v), "source", "umol/m2/s", "gC/m2")


def leaf_area_observations(modis: DataFrame) -> DataFrame:
    """Good and plausible leaf areas of canonical site names; order_observations() puts them in order."""
    good = filters.range_guard(filters.bitflag_filter(modis, "qc"), "lai", 0, 10)
    named = good.withColumn("site", scalars.normalise_site(F.col("id").cast("string")))
    return filters.select_variables(named, {"site": "site", "date": "date", "lai": "lai"})


@query("c3_leaf_area", duck("v_modis", "SELECT CAST(id AS VARCHAR) AS site, date, lai FROM v_modis WHERE qc & 204 = 0 AND lai BETWEEN 0 AND 10", "lai"))
def c3(v: Views) -> DataFrame:
    return sets.order_observations(leaf_area_observations(v.v_modis), "site", "date")


def raster_samples(sites: DataFrame, raster: DataFrame, axes: tuple[DataFrame, DataFrame], value: str, scale: float, fills: tuple) -> DataFrame:
    """C4: the scaled value of each site's nearest cell at all times, fill codes missing and left out.

    axes are the rasters' own longitudes and latitudes, given once, so that no raster is read to find them.
    """
    near = joins.nearest_on_axis(sites, "site", "lon", axes[0], "lon").join(joins.nearest_on_axis(sites, "site", "lat", axes[1], "lat"), "site")
    sampled = raster.join(joins.small_once(near, "near"), ["lon", "lat"])
    return filters.valid_only(filters.unpack(sampled, value, scale, 0.0, fills), [value]).select("site", "date", value)


_NEAR = "(SELECT site, arg_min(x, (abs(x - lon), x)) AS x, arg_min(y, (abs(y - lat), y)) AS y FROM v_sites, (SELECT DISTINCT lon AS x FROM v_grid) a, (SELECT DISTINCT lat AS y FROM v_grid) b GROUP BY site)"


@query("c4_raster_samples", duck("v_sites v_grid", f"SELECT site, month AS date, code * 0.01 AS gpp FROM {_NEAR} JOIN (SELECT *, CASE WHEN tas < 0 THEN 65535.0 ELSE round(tas * 100) END AS code FROM v_grid) ON lon = x AND lat = y WHERE code <> 65535", "gpp"))
def c4(v: Views) -> DataFrame:
    """Rasters of one month each, whose date stands in the name alone."""
    path = scratch(v.spark, "rasters")
    name = F.concat(F.lit("GPP_"), F.date_format("month", "yyyy"), F.lpad(F.dayofyear("month").cast("string"), 3, "0"), F.lit("_Mean"))
    rows = v.v_grid.select("lon", "lat", F.when(F.col("tas") < 0, 65535.0).otherwise(F.round(F.col("tas") * 100)).alias("gpp"), name.alias("name"))
    rows.repartition("name").write.partitionBy("name").parquet(path)
    raster = v.spark.read.schema("lon double, lat double, gpp double").parquet(path).select("lon", "lat", "gpp", scans.date_of_name(scans.scanned_name(1)).alias("date"))
    cells = once(v.spark.read.parquet(path).select("lon", "lat").distinct(), "cells")
    axes = (cells.select("lon").distinct(), cells.select("lat").distinct())
    return sets.order_observations(raster_samples(v.v_sites, raster, axes, "gpp", 0.01, (65535.0, 65534.0)), "site", "date")


METRICS = ["live", "dead", "height", "height_90", "diameter", "diameter_90", "basal"]


def inventory(stems: DataFrame) -> DataFrame:
    """Plot-visit statistics of stems with their own or their plot's dimensions; visits without any metric are left out."""
    stats = agg.plot_statistics(tables.plot_area(stems, "plot", "length", "width"))
    return sinks.metric_frame(stats, ["plot", "date"], METRICS)


@query("c5_inventory", duck("v_stems", "SELECT plot, start_visit + 7 AS date, nullif(sum(live_kg) / 500, 0) AS live, nullif(coalesce(sum(dead_kg), 0) / 500, 0) AS dead, avg(height_m) AS height, quantile_cont(height_m, 0.9) AS height_90, sqrt(avg(diameter_cm * diameter_cm)) / 100 AS diameter, quantile_cont(diameter_cm, 0.9) / 100 AS diameter_90, sum(pi() * pow(diameter_cm / 200, 2)) * 20 AS basal FROM v_stems GROUP BY plot, start_visit, end_visit", " ".join(METRICS)))
def c5(v: Views) -> DataFrame:
    return inventory(v.v_stems.withColumn("length", F.when(F.col("transect") % 2 == 0, F.lit("50 m"))).withColumn("width", F.lit("1000 cm")))


def gridded_site_climate(parts: list[tuple[DataFrame, str]], sites: DataFrame, scale: float, fills: tuple) -> DataFrame:
    """(site, month, tas in K, vpd) at the nearest cell of a grid of 1.2 degrees.

    parts are the grids of consecutive periods with their units of temperature, humidity packed. P16 unpacks it, U1 puts
    the parts one after another, A20 regrids all variables at once, J5 finds the cells from the target grid's own axes.
    """
    unpacked = [(filters.unpack(df, "huss", scale, 0.0, fills), units) for df, units in parts]
    grid = sets.concat_time(unpacked, "tas")
    cells = once(grid.select("lon", "lat").distinct(), "cells")  # the one other reading of the grid
    axes = [regrid.target_axis(cells, c, 0.5, x0, 1.2).select(F.round(c, 6).alias(c)) for c, x0 in (("lon", 110), ("lat", -40))]
    near = joins.small_once(joins.nearest_on_axis(sites, "site", "lon", axes[0], "lon").join(joins.nearest_on_axis(sites, "site", "lat", axes[1], "lat"), "site"), "near")
    wide = regrid.regrid_conservative(grid, ["month"], ["tas", "huss", "ps"], 0.5, 110, 1.2, -40, 1.2).withColumns({"lon": F.round("lon", 6), "lat": F.round("lat", 6)})
    out = wide.join(near, ["lon", "lat"])
    kelvin = filters.convert_units(out, "tas", "degC", "K").select("site", "month", "tas")
    vpd = out.select("site", "month", scalars.vpd(F.col("tas"), F.col("huss"), F.col("ps")).alias("vpd"))
    return joins.merge_variables(["site", "month"], kelvin, vpd)


_REGRID = """(SELECT month, round(x, 6) AS x, round(y, 6) AS y, sum(w * tas) / sum(w) AS tas, sum(w * huss) / sum(w) AS huss, sum(w * ps) / sum(w) AS ps FROM (SELECT month, tas, huss, ps, x, y, (least(lon + 0.25, x + 0.6) - greatest(lon - 0.25, x - 0.6)) * (sin(radians(least(lat + 0.25, y + 0.6))) - sin(radians(greatest(lat - 0.25, y - 0.6)))) AS w
  FROM v_grid JOIN (SELECT 110 + 1.2 * i AS x FROM range(-2, 12) r(i)) ON least(lon + 0.25, x + 0.6) - greatest(lon - 0.25, x - 0.6) > 1e-9 JOIN (SELECT -40 + 1.2 * j AS y FROM range(-2, 12) r(j)) ON least(lat + 0.25, y + 0.6) - greatest(lat - 0.25, y - 0.6) > 1e-9) GROUP BY ALL)"""


@query("c6_gridded_site_climate", duck("v_sites v_grid", f"""SELECT site, month, tas + 273.15 AS tas, 611.2 * exp(17.62 * tas / (243.12 + tas)) / 1000 - huss * ps / ((1 - 0.622) * huss + 0.622) AS vpd FROM {_REGRID} g
  JOIN (SELECT site, arg_min(x, (abs(x - lon), x)) AS sx, arg_min(y, (abs(y - lat), y)) AS sy FROM v_sites, (SELECT DISTINCT x FROM {_REGRID}) a, (SELECT DISTINCT y FROM {_REGRID}) b GROUP BY site) ON g.x = sx AND g.y = sy""", "tas vpd"))
def c6(v: Views) -> DataFrame:
    """Two periods, the second in K; the site table is written cell by cell (S12) and read back."""
    grid = v.v_grid.withColumn("huss", F.col("huss") * 1000)
    parts = [(grid.filter("year(month) < 1998"), "degC"), (grid.filter("year(month) >= 1998").withColumn("tas", F.col("tas") + 273.15), "K")]
    path = scratch(v.spark, "climate")
    sinks.write_cell_major(gridded_site_climate(parts, v.v_sites, 0.001, (-9999.0,)), path, "site", "month")
    return scans.scan_series(v.spark, path, ["site", "month", "tas", "vpd"])


def region_statistics(grid: DataFrame, edges: DataFrame, time: str, value: str) -> DataFrame:
    """Per cell within a polygon the mean, the mean of annual means and the mean of annual sums."""
    cells = grid.select("lon", "lat").distinct().withColumns({"x": F.col("lon"), "y": F.col("lat")})
    inside = joins.points_in_polygons(cells, ["x", "y"], edges).select(F.col("x").alias("lon"), F.col("y").alias("lat")).distinct()
    rows = grid.join(inside, ["lon", "lat"], "left_semi").withColumn("cell", F.struct("lon", "lat"))
    parts = [agg.temporal_mean(rows, "cell", value), agg.mean_of_annual(rows, "cell", time, value, "mean"), agg.mean_of_annual(rows, "cell", time, value, "sum")]
    named = [p.withColumnRenamed(value, n) for p, n in zip(parts, ("mean", "annual_mean", "annual_sum"))]
    return joins.merge_variables(["cell"], *named).select("cell.lon", "cell.lat", "mean", "annual_mean", "annual_sum")


@query("c7_region_statistics", duck("v_grid", "SELECT lon, lat, sum(s) / sum(n) AS mean, avg(s / n) AS annual_mean, avg(s) AS annual_sum FROM (SELECT lon, lat, year(month), sum(tas) AS s, count(tas) AS n FROM v_grid WHERE lon > 112 AND lon < 118 AND lat > -38 AND lat < -32 GROUP BY ALL) GROUP BY lon, lat", "mean annual_mean annual_sum"))
def c7(v: Views) -> DataFrame:
    return region_statistics(v.v_grid, v.v_box, "month", "tas")


def soil_cells(layers: DataFrame) -> DataFrame:
    """Depth-weighted sand of 0.5-degree cells, closed with silt and clay, on 1-degree cells within a box."""
    profile = agg.depth_weighted(layers, "cell", "d0", "d1", "value")
    closed = tables.close_texture(profile.select("cell", F.col("value").alias("sand"), F.lit(30.0).alias("silt"), F.lit(15.0).alias("clay")), "sand", "silt", "clay")
    placed = closed.withColumns({"lon": 110.25 + 0.5 * (F.col("cell") % 5), "lat": -39.75 + 0.5 * F.floor(F.col("cell") / 5)})
    parts = [regrid.regrid_conservative(placed, [], c, 0.5, 110.5, 1.0, -39.5, 1.0) for c in ("sand", "silt", "clay")]
    return filters.valid_only(filters.bbox(joins.merge_variables(["lon", "lat"], *parts), 110, 112, -40, -38), ["sand", "silt", "clay"])


_SHARE = lambda x: f"({x} - {x} / (v + 45) * (v + 45 - 100)) / 100"
_AREA = "(sin(radians(-39.75 + 0.5 * (cell // 5) + 0.25)) - sin(radians(-39.75 + 0.5 * (cell // 5) - 0.25)))"


@query("c8_soil_cells", duck("v_layers", f"SELECT 110.5 + (cell % 5) // 2 AS lon, -39.5 + (cell // 5) // 2 AS lat, sum({_AREA} * {_SHARE('v')}) / sum({_AREA}) AS sand, sum({_AREA} * {_SHARE('30.0')}) / sum({_AREA}) AS silt, sum({_AREA} * {_SHARE('15.0')}) / sum({_AREA}) AS clay FROM (SELECT cell, sum(value * (d1 - d0)) / sum(d1 - d0) AS v FROM v_layers GROUP BY cell) GROUP BY 1, 2 HAVING lon <= 112 AND lat <= -38", "lon lat sand silt clay"))
def c8(v: Views) -> DataFrame:
    return soil_cells(v.v_layers.withColumns({c: F.col(c).cast("double") for c in ("d0", "d1")}))


def benchmark_table(fluxes: DataFrame, leaves: DataFrame, greenness: DataFrame, layers: DataFrame, water: DataFrame, inventories: DataFrame) -> DataFrame:
    """All observations on one axis: a row for each site and day between a site's first and last flux, a column per variable.

    Inputs are (site, day, ..): fluxes nee, leaves lai, greenness ndvi (replicates are averaged, A13), layers the soil
    layers of each site as an array (F20 names their columns), water (site, day, name, value) by layer, inventories
    (site, date and metrics, C5). J8 puts them on the axis; what lies outside is left out.
    """
    fluxes = once(fluxes, "fluxes")  # spans, and values
    names = once(tables.explode_layers(layers, "site", "layers").select("site", "name", F.col("column").alias("variable")), "layers")
    soil = water.join(joins.small(names), ["site", "name"])
    columns = [r[0] for r in names.select("variable").distinct().orderBy("variable").collect()]  # the few depths of all sites
    long = lambda df, day, value, name: df.select("site", F.col(day).alias("day"), F.lit(name).alias("variable"), F.col(value).alias("value"))
    parts = [
        long(fluxes, "date", "value", "nee"), long(agg.mean_by_date(leaves, ["site", "date"], "lai"), "date", "lai", "lai"),
        long(agg.mean_by_date(greenness, ["site", "date"], "ndvi"), "date", "ndvi", "ndvi"), soil.select("site", "day", "variable", "value"),
    ]
    metrics = ["height", "diameter", "live", "dead"]
    parts += [scans.wide_to_long(inventories.select("site", F.col("date").alias("day"), *metrics), ["site", "day"], metrics, "variable", "value")]
    spans = fluxes.groupBy("site").agg(F.min("date").alias("a"), F.max("date").alias("b"))
    axis = generators.time_grid(spans, ["site"], "a", "b", "1 day", "day")
    return joins.align_to_grid(axis, sets.union_sites(parts), ["site", "day"], "variable", "value", ["nee", "lai", "ndvi", *columns, *metrics])


#: The sites of other tables' rows by number, and what the library calls them.
_CODE = lambda x: f"CASE {x} % 3 WHEN 0 THEN 'AU-How' WHEN 1 THEN 'AU-Tum' ELSE 'AU-Wac' END"
_SITE = lambda x: f"CASE {x} % 3 WHEN 0 THEN 'HowardSprings' WHEN 1 THEN 'Tumbarumba' ELSE 'WallabyCreek' END"
_VISIT = "DATE '2024-01-03' + CAST(plot % 20 AS INTEGER)"
_DEPTHS = {"Sws_0": 5.0, "Sws_1": 15.0, "Sws_2": 100.0}
_COLUMN = "CASE event_id % 3 WHEN 0 THEN 'swvol_5' WHEN 1 THEN 'swvol_15' ELSE 'swvol_100' END"


@query("c9_benchmark_table", duck("v_raw v_modis v_stems", f"""SELECT a.site, a.day, nee, lai, ndvi, swvol_100, swvol_15, swvol_5, height, diameter, live, dead
  FROM (SELECT site, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS day FROM ({_FLUXES}) GROUP BY site) a
  LEFT JOIN (SELECT site, date AS day, avg(value) AS nee FROM ({_FLUXES}) GROUP BY 1, 2) n USING (site, day)
  LEFT JOIN (SELECT {_SITE('id')} AS site, date AS day, avg(lai) FILTER (qc & 204 = 0 AND lai BETWEEN 0 AND 10) AS lai, avg(lai / 10) AS ndvi FROM v_modis GROUP BY 1, 2) l USING (site, day)
  LEFT JOIN (SELECT site, day, avg(value) FILTER (c = 'swvol_100') AS swvol_100, avg(value) FILTER (c = 'swvol_15') AS swvol_15, avg(value) FILTER (c = 'swvol_5') AS swvol_5
    FROM (SELECT {_NAME_OF} AS site, CAST(ts AS DATE) AS day, {_COLUMN} AS c, avg(value / 200) AS value FROM v_raw GROUP BY 1, 2, 3) GROUP BY 1, 2) s USING (site, day)
  LEFT JOIN (SELECT {_SITE('plot')} AS site, day, avg(height) AS height, avg(diameter) AS diameter, avg(live) AS live, avg(dead) AS dead FROM (
    SELECT plot, {_VISIT} + 2 AS day, nullif(sum(live_kg) / 500, 0) AS live, nullif(coalesce(sum(dead_kg), 0) / 500, 0) AS dead, avg(height_m) AS height, sqrt(avg(diameter_cm * diameter_cm)) / 100 AS diameter
    FROM v_stems GROUP BY plot) GROUP BY 1, 2) i USING (site, day)""", "nee lai ndvi swvol_100 swvol_15 swvol_5 height diameter live dead"))
def c9(v: Views) -> DataFrame:
    """Stems are taken as visited in the month of the events, so that the axis meets them."""
    modis = v.v_modis.withColumn("id", F.expr(_CODE("id")))
    leaves = leaf_area_observations(modis)
    green = modis.select(scalars.normalise_site(F.col("id")).alias("site"), "date", (F.col("lai") / 10).alias("ndvi"))
    layer = F.concat(F.lit("Sws_"), (F.col("event_id") % 3).cast("string"))
    daily = v.v_raw.groupBy(F.expr(_SITE_OF).alias("site"), F.to_date("ts").alias("day"), layer.alias("name")).agg(F.avg(F.col("value") / 200).alias("value"))
    water = once(daily.withColumn("site", scalars.normalise_site(F.col("site"))), "water")  # values, and their sites
    own = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(depth).alias("depth")) for name, depth in _DEPTHS.items()])
    stems = v.v_stems.withColumns({"start_visit": F.expr(_VISIT), "end_visit": F.expr(f"{_VISIT} + 4"), "length": F.lit("50 m"), "width": F.lit("1000 cm")})
    plots = inventory(stems).withColumn("site", scalars.normalise_site(F.expr(_CODE("plot"))))
    return benchmark_table(flux_observations(_flux_tables(v), "source", "umol/m2/s", "gC/m2"), leaves, green, water.select("site").distinct().withColumn("layers", own), water, plots)


def wide_site_met(temperature: DataFrame, humidity: DataFrame, rain: DataFrame, names: list[str], pressure_pa: float, step: float) -> DataFrame:
    """Site met from a wide table per variable: long rows, constant pressure, deficit, K to degrees Celsius, rate to amount."""
    parts = [scans.wide_to_long(df, ["day"], names, "site", name) for df, name in ((temperature, "tas"), (humidity, "huss"), (rain, "pr"))]
    out = filters.with_constants(joins.merge_variables(["day", "site"], *parts), {"ps": pressure_pa})
    out = filters.convert_units(filters.convert_units(out, "tas", "K", "degC"), "pr", "kg m-2 s-1", "mm", step)
    return out.withColumn("vpd", scalars.vpd(F.col("tas"), F.col("huss"), F.col("ps") / 1000, "mixed"))


_LONG = " UNION ALL ".join(f"SELECT day, 'site{c}' AS site, site{c} AS x FROM v_wide" for c in CELLS)


@query("c10_wide_site_met", duck("v_wide", f"SELECT day, site, x + 250 - 273.15 AS tas, x / 10000 AS huss, x / 1e6 * 10800 AS pr, CAST(101300 AS DOUBLE) AS ps, 611.2 * exp(17.62 * (x + 250 - 273.15) / (243.04 + (x + 250 - 273.15))) / 1000 - x / 10000 * 101.3 / ((1 - 0.622) * x / 10000 + 0.622) AS vpd FROM ({_LONG})", "tas huss pr vpd"))
def c10(v: Views) -> DataFrame:
    names = [f"site{c}" for c in CELLS]
    each = lambda f: v.v_wide.select("day", *[f(F.col(n)).alias(n) for n in names])
    return wide_site_met(each(lambda x: x + 250), each(lambda x: x / 10_000), each(lambda x: x / 1e6), names, 101_300.0, 10_800.0)


def land_surface_table(met: DataFrame, cover: DataFrame, seconds: int) -> DataFrame:
    """C11: (cell, t, tas, lai): temperature in K with the day's leaf area, splined from monthly cover.

    met is (cell, t, value) in steps of some seconds. W15 completes the last day, W14 keeps whole years, P14 converts;
    A22 and W17 make daily leaf areas of the cover, and J1 merges the two tables.
    """
    whole = win.complete_days(met, "cell", "t", "value", seconds)
    years = filters.convert_units(win.full_years_only(whole.withColumn("day", F.to_date("t")), "cell", "day"), "value", "degC", "K")
    monthly = agg.lai_from_cover(cover, ["cell", "year", "month"], "wood", "grass", "forest").select("cell", "year", "month", "lai")
    leaves = win.spline_monthly(monthly, "cell", "year", "month", "lai")
    # the first 15 days of a year are on the spline of the year before; where a cell has none, on the end of their own year's
    year, step = win.on_spline(F.col("day"))
    own, length = F.year("day"), F.when(win.is_leap(F.year("day")), 366).otherwise(365)
    first = joins.small(monthly.groupBy("cell").agg(F.min("year").alias("first")))
    placed = years.join(first, "cell", "left").withColumn("early", (year < F.col("first")) & (own == F.col("first"))).select(
        "cell", "t", F.col("value").alias("tas"), F.when(F.col("early"), own).otherwise(year).alias("year"), F.when(F.col("early"), F.dayofyear("day") - 16 + length).otherwise(step).alias("step")
    )
    return placed.join(leaves, ["cell", "year", "step"], "left").select("cell", "t", "tas", "lai")


_MET = "SELECT cell, CAST(day AS TIMESTAMP) AS t, value FROM v_daily UNION ALL SELECT cell, CAST(day AS TIMESTAMP) + INTERVAL 12 HOUR, value * 1.1 FROM (SELECT *, max(day) OVER (PARTITION BY cell) AS last FROM v_daily) WHERE day < last"
_COVER = "SELECT cell, year(day) AS year, month(day) AS month, greatest(-ln(greatest(1 - avg(value) / 60, exp(-6))) / 0.5, 0.01) * 0.6 + greatest(-ln(greatest(1 - (avg(value) / 100) / (1 - avg(value) / 100), 0.01)) / 0.5, 0.01) * 0.4 AS lai FROM v_daily GROUP BY ALL"


_LSM = f"""SELECT m.cell, m.t, m.value + 273.15 AS tas, s.lai FROM (
  SELECT *, CAST(t AS DATE) AS day, CASE WHEN t >= make_date(y, 1, 16) OR y = first THEN y ELSE y - 1 END AS sy,
         CASE WHEN t >= make_date(y, 1, 16) OR y > first THEN 0 WHEN y % 4 = 0 AND (y % 100 <> 0 OR y % 400 = 0) THEN 366 ELSE 365 END AS later
  FROM (SELECT *, year(t) AS y, min(year(t)) OVER (PARTITION BY cell) AS first, min(t) OVER (PARTITION BY cell) AS a, max(t) OVER (PARTITION BY cell) AS b
        FROM ({_MET} UNION ALL SELECT cell, CAST(max(day) AS TIMESTAMP) + INTERVAL 12 HOUR, arg_max(value, day) FROM v_daily GROUP BY cell))) m
  LEFT JOIN ({spline_sql(f"({_COVER})", "cell", "lai")}) s ON s.cell = m.cell AND s.year = sy AND s.step = date_diff('day', make_date(sy, 1, 16), day) + later
  WHERE CAST(a AS DATE) <= make_date(year(t), 1, 1) AND CAST(b AS DATE) >= make_date(year(t), 12, 31)"""


@query("c11_land_surface_table", duck("v_daily", _LSM, "tas lai"))
def c11(v: Views) -> DataFrame:
    """Half-days; each cell's last day lacks its second half."""
    daily = v.v_daily
    last = daily.groupBy("cell").agg(F.max("day").alias("last"))
    morning = daily.select("cell", F.col("day").cast("timestamp_ntz").alias("t"), "value")
    evening = daily.join(last, "cell").filter("day < last").select("cell", (F.col("day").cast("timestamp_ntz") + F.expr("INTERVAL 12 HOUR")).alias("t"), F.col("value") * 1.1)
    cover = daily.groupBy("cell", F.year("day").alias("year"), F.month("day").alias("month")).agg((F.avg("value") / 60).alias("wood"), (F.avg("value") / 100).alias("grass"), F.lit(0.6).alias("forest"))
    return land_surface_table(morning.union(evening), cover, 43_200)
