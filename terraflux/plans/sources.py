"""Queries of scans, sinks, table forms and the streaming append; files go to the shared scratch folder and are read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraflux.operators import tables
from terraflux.plans.fixtures import CELLS
from terraflux.plans.registry import Views, duck, query
from terraflux.sources import scans, sinks
from terraflux.sources.scratch import scratch
from terraflux.streaming.append import append_in_order, append_new_files


@query("s1_scan_series", duck("", "SELECT l_suppkey, l_shipdate, l_quantity FROM lineitem", "l_quantity"))
def s1(v: Views) -> DataFrame:
    return scans.scan_series(v.spark, f"{v.sf_dir}/lineitem.parquet", ["l_suppkey", "l_shipdate", "l_quantity"])


_MODIS = "SELECT id, date, CASE WHEN qc % 5 = 0 THEN NULL ELSE lai END AS lai, qc FROM v_modis"


@query("s2_scan_csv", duck("v_modis", _MODIS, "lai"))
def s2(v: Views) -> DataFrame:
    path = scratch(v.spark, "csv")
    lai = F.when(F.col("qc") % 5 == 0, F.when(F.col("qc") % 2 == 0, "Na").otherwise(" NA ")).otherwise(F.col("lai").cast("string"))
    v.v_modis.select("id", F.date_format("date", "MM/dd/yyyy").alias("date"), lai.alias("lai"), "qc").write.csv(path, sep=";", header=True)
    return scans.scan_csv(v.spark, path, "id bigint, date date, lai double, qc int", sep=";", date_format="MM/dd/yyyy")


@query("s3_scan_encoding", duck("v_modis", "SELECT id, 'Forêt ' || id AS site, lai FROM v_modis", "lai"))
def s3(v: Views) -> DataFrame:
    path = scratch(v.spark, "latin")
    v.v_modis.select("id", F.concat(F.lit("Forêt "), F.col("id").cast("string")).alias("site"), "lai").write.csv(path, header=True, encoding="ISO-8859-1")
    return scans.scan_csv(v.spark, path, "id bigint, site string, lai double", encoding="ISO-8859-1")


@query("s3_scan_mixed_encodings", duck("v_modis", "SELECT id, 'Forêt ' || id AS site, lai FROM v_modis", "lai"))
def s3_mixed(v: Views) -> DataFrame:
    """A folder of files in UTF-8 and in ISO-8859-1."""
    path = scratch(v.spark, "mixed")
    rows = v.v_modis.select("id", F.concat(F.lit("Forêt "), F.col("id").cast("string")).alias("site"), "lai")
    for encoding, half in (("UTF-8", 0), ("ISO-8859-1", 1)):
        rows.filter(F.col("id") % 2 == half).write.mode("append").csv(path, header=True, encoding=encoding)
    return scans.scan_csv(v.spark, path, "id bigint, site string, lai double", fallback="ISO-8859-1")


@query("s4_scan_fixed_width", duck("v_modis", "SELECT id, round(lai, 4) AS lai, qc FROM v_modis", "lai"))
def s4(v: Views) -> DataFrame:
    path = scratch(v.spark, "fixed")
    lines = v.v_modis.select(F.format_string("%8d  %12s %5d", F.col("id"), F.round("lai", 4).cast("string"), F.col("qc")).alias("value"))
    v.spark.range(1).select(F.lit("    id           lai    qc").alias("value")).union(lines).write.text(path)
    return scans.scan_fixed_width(v.spark, path, "id bigint, lai double, qc int")


_CO2 = "SELECT year(day) AS year, round(300 + avg(value), 3) AS co2 FROM v_daily GROUP BY 1"


@query("s5_scan_after_header", duck("v_daily", _CO2, "co2"))
def s5(v: Views) -> DataFrame:
    path = scratch(v.spark, "co2")
    rows = v.v_daily.groupBy(F.year("day").alias("year")).agg(F.round(300 + F.avg("value"), 3).alias("co2"))
    head = v.spark.createDataFrame([("COLUMNS: 4",), ("NOTE 12 of 1995",), ("  YEARS A B CO2EQ",)], "value string")
    head.union(rows.select(F.concat(F.lit("  "), F.col("year").cast("string"), F.lit("   1.5  2.5   "), F.col("co2").cast("string")))).coalesce(1).write.text(path)
    return scans.scan_after_header(v.spark, path, r"^\s*\d{4}\s", {"year": (1, "int"), "co2": (4, "double")})


@query("s6_scan_sites", duck("v_sites", "SELECT lon, lat, replace(site, '#', '') AS site FROM v_sites", "lon lat"))
def s6(v: Views) -> DataFrame:
    path = scratch(v.spark, "sites")
    lines = v.v_sites.select(F.concat(F.col("lon").cast("string"), F.lit(","), F.col("lat").cast("string"), F.lit(',"'), F.replace("site", F.lit("#"), F.lit(" ")), F.lit('"\r')).alias("value"))
    v.spark.createDataFrame([("lon,lat,site",), ("",)], "value string").union(lines).write.text(path)
    return scans.scan_sites(v.spark, path)


@query("s7_file_facts", duck("v_files", """SELECT var, name, 'tas' AS variable, name[19:24] AS start, name[26:31] AS "end", CAST(NULL AS VARCHAR) AS site, CAST(NULL AS DATE) AS date FROM v_files
  UNION ALL SELECT event_type, n, split_part(n, '_', 1), NULL, NULL, event_type, CAST(d AS DATE) FROM (SELECT DISTINCT event_type, CAST(ts AS DATE) AS d, event_type || '_L6_' || strftime(ts, '%Y%j') || '.csv' AS n FROM events)
  UNION ALL SELECT 'all', n, NULL, NULL, NULL, NULL, CAST(d AS DATE) FROM (SELECT DISTINCT CAST(ts AS DATE) AS d, 'x-' || strftime(ts, '%Y%m%d') || '.csv' AS n FROM events)"""))
def s7(v: Views) -> DataFrame:
    """Names of three kinds, as folders that rows are written to; the facts come from the scan's own paths."""
    path = scratch(v.spark, "named")
    days = v.events.select(F.col("event_type").alias("var"), F.col("ts").cast("date").alias("d")).distinct()
    yearly = days.select("var", F.concat("var", F.lit("_L6_"), F.date_format("d", "yyyyDDD"), F.lit(".csv")).alias("name"))
    daily = days.select(F.lit("all").alias("var"), F.concat(F.lit("x-"), F.date_format("d", "yyyyMMdd"), F.lit(".csv")).alias("name")).distinct()
    files = reduce(DataFrame.union, [yearly, daily], v.v_files.select("var", "name"))
    files.repartition("name").write.partitionBy("name").text(path)
    seen = v.spark.read.schema("value string").text(path).select(F.col("value").alias("var"), scans.scanned_name(1).alias("name"))
    return scans.with_file_facts(seen, "name", scans.FILE_FACTS | {"site": scans.SITE_FACT}).withColumn("date", scans.date_of_name(F.col("name")))


@query("s8_add_time_column", duck("v_files", "SELECT var, name, make_date(CAST(name[19:22] AS BIGINT), CAST(name[23:24] AS BIGINT), 1) AS time FROM v_files"))
def s8(v: Views) -> DataFrame:
    return scans.add_time_column(v.v_files, "name", r"_(\d{6})-", "yyyyMM")


@query("s9_file_metadata", duck("v_sites", "SELECT site AS file, 'K' AS units, printf('%.1f', lon) AS lon, printf('%.1f', lat) AS lat FROM v_sites"))
def s9(v: Views) -> DataFrame:
    attributes = v.v_sites.select(F.col("site").alias("file"), F.explode(F.create_map(F.lit("units"), F.lit("K"), F.lit("lon"), F.format_string("%.1f", "lon"), F.lit("lat"), F.format_string("%.1f", "lat"))).alias("name", "value"))
    return scans.file_metadata(attributes, "file", "name", "value", ["units", "lon", "lat"])


@query("s10_write_long", duck("v_grid", "SELECT round(lon, 1) AS lon, round(lat, 1) AS lat, month, tas FROM v_grid WHERE tas > 8", "lon lat tas"))
def s10(v: Views) -> DataFrame:
    path = scratch(v.spark, "long")
    sinks.write_long(v.v_grid.select("lon", "lat", "month", F.when(F.col("tas") > 8, F.col("tas")).alias("tas")), path, ["tas"], sep="\t", decimals=1)
    return scans.scan_csv(v.spark, path, "lon double, lat double, month date, tas double", sep="\t")


@query("s10_write_year_day", duck("v_grid", "SELECT round(lon, 1) AS lon, round(lat, 1) AS lat, CAST(year(month) AS INTEGER) AS year, CAST(dayofyear(month) AS INTEGER) AS day, tas FROM v_grid WHERE tas > 8", "lon lat tas"))
def s10_year_day(v: Views) -> DataFrame:
    path = scratch(v.spark, "long")
    sinks.write_long(v.v_grid.select("lon", "lat", "month", F.when(F.col("tas") > 8, F.col("tas")).alias("tas")), path, ["tas"], decimals=1, year_day="month")
    return scans.scan_csv(v.spark, path, "lon double, lat double, year int, day int, tas double")


_METRICS = "SELECT 'dead_height' AS file, start_visit AS date, plot, dead_kg, CASE WHEN height_m > 10 THEN height_m END AS height_m FROM v_stems WHERE dead_kg IS NOT NULL OR height_m > 10 UNION ALL SELECT 'dead', start_visit, plot, dead_kg, NULL FROM v_stems WHERE dead_kg IS NOT NULL"


@query("s11_metric_tables", duck("v_stems", _METRICS, "dead_kg height_m"))
def s11(v: Views) -> DataFrame:
    path = scratch(v.spark, "metrics")
    stems = v.v_stems.select(F.col("start_visit").alias("date"), "plot", "dead_kg", F.when(F.col("height_m") > 10, F.col("height_m")).alias("height_m"))
    sinks.write_metric_tables(stems, ["date", "plot"], {"dead_height": ["dead_kg", "height_m"], "dead": ["dead_kg"]}, path)
    both = scans.scan_csv(v.spark, f"{path}/dead_height", "date date, plot bigint, dead_kg double, height_m double").withColumn("file", F.lit("dead_height"))
    return both.unionByName(scans.scan_csv(v.spark, f"{path}/dead", "date date, plot bigint, dead_kg double").withColumn("file", F.lit("dead")), allowMissingColumns=True)


@query("s12_write_cell_major", duck("v_series", "SELECT site, t, value FROM v_series", "value"))
def s12(v: Views) -> DataFrame:
    path = scratch(v.spark, "cells")
    sinks.write_cell_major(v.v_series.withColumn("t", F.col("t").cast("timestamp_ntz")), path, "site", "t")
    return scans.scan_series(v.spark, path, ["site", "t", "value"])


@query("s13_concat_runs", duck("v_daily", "SELECT cell, day, value, CASE WHEN year(day) < 1997 THEN 'spinup' ELSE 'main' END AS phase FROM v_daily", "value"))
def s13(v: Views) -> DataFrame:
    path = scratch(v.spark, "runs")
    for name, rows in (("spinup", "year(day) < 1997"), ("main", "year(day) >= 1997")):
        v.v_daily.filter(rows).write.csv(f"{path}/{name}", header=True)
    return scans.concat_runs([(n, scans.scan_csv(v.spark, f"{path}/{n}", "cell bigint, day date, value double")) for n in ("spinup", "main")])


@query("s14_annual_text", duck("v_daily", "SELECT printf('%d %.2f', CAST(year(day) AS BIGINT), round(avg(value) * 3, 4)) AS value FROM v_daily GROUP BY year(day)"))
def s14(v: Views) -> DataFrame:
    path = scratch(v.spark, "annual")
    sinks.write_annual_text(v.v_daily.groupBy(F.year("day").alias("year")).agg(F.round(F.avg("value") * 3, 4).alias("value")), "year", "value", path)
    return v.spark.read.text(path)


@query("s15_file_digests", "SELECT sha256(text) AS sha256, count(*) AS n FROM documents GROUP BY 1", also="s15_file_digests_whole")
def s15(v: Views) -> DataFrame:
    """Every document, up to a hundred in a file; each file is read as a row and in pieces, which must agree."""
    path = scratch(v.spark, "packed")
    sinks.write_packed_texts(v.documents, "text", path)
    return scans.packed_digests(v.spark, path, streamed_above=0).groupBy("sha256").agg(F.count("*").alias("n"))


@query("s16_wide_to_long", duck("v_wide", " UNION ALL ".join(f"SELECT day, 'site{c}' AS site, site{c} AS value FROM v_wide" for c in CELLS), "value"))
def s16(v: Views) -> DataFrame:
    return scans.wide_to_long(v.v_wide, ["day"], [f"site{c}" for c in CELLS], "site", "value")


@query("s17_arrays", duck("v_grid", "SELECT g.lon, g.lat, m.month AS at, CAST(dense_rank() OVER (PARTITION BY g.lon, g.lat ORDER BY m.month) - 1 AS INTEGER) AS i, v.tas FROM (SELECT DISTINCT lon, lat FROM v_grid) g CROSS JOIN (SELECT DISTINCT month FROM v_grid) m LEFT JOIN v_grid v ON v.lon = g.lon AND v.lat = g.lat AND v.month = m.month", "lon lat tas"))
def s17(v: Views) -> DataFrame:
    grid = v.v_grid.select("lon", "lat", "month", "tas")
    dense = scans.long_to_arrays(grid, ["lon", "lat"], "month", "tas", grid)
    return scans.arrays_to_long(dense, ["lon", "lat"], "month", "tas", "i", "tas")


@query("f4_plot_area", duck("v_stems", "SELECT l_orderkey, transect, plot, (plot + 20) * 10.0 AS area FROM v_stems", "area"))
def f4(v: Views) -> DataFrame:
    own = (F.col("plot") + 20).cast("string")
    rows = v.v_stems.select("l_orderkey", "transect", "plot", F.when(F.col("transect") % 2 == 0, F.concat(own, F.lit(" m"))).alias("length"), F.when(F.col("transect") % 3 == 0, F.lit("1000 cm")).alias("width"))
    return tables.plot_area(rows, "plot", "length", "width").select("l_orderkey", "transect", "plot", F.col("area_m2").alias("area"))


_CLOSED = ", ".join(f"({x} - {x} / (a + b + c) * (a + b + c - 100)) / 100 AS {n}" for x, n in (("a", "sand"), ("b", "silt"), ("c", "clay")))


@query("f12_close_texture", duck("v_layers", f"SELECT cell, layer, {_CLOSED} FROM (SELECT cell, layer, value AS a, 30 + cell AS b, 20.0 AS c FROM v_layers)", "sand silt clay"))
def f12(v: Views) -> DataFrame:
    soil = v.v_layers.select("cell", "layer", F.col("value").alias("sand"), (F.col("cell") + 30).cast("double").alias("silt"), F.lit(20.0).alias("clay"))
    return tables.close_texture(soil, "sand", "silt", "clay")


@query("f13_stand_metrics", duck("v_layers", "SELECT cell, layer, value / 10000 AS live_m2, value * 2 / 10000 AS dead_m2, value / 100 AS diameter_m, value + cell AS basal_total FROM v_layers", "live_m2 dead_m2 diameter_m basal_total"))
def f13(v: Views) -> DataFrame:
    x = F.col("value")
    stands = v.v_layers.select("cell", "layer", x.alias("agb"), (x * 2).alias("dead_b"), x.alias("d"), x.alias("ba_live"), F.col("cell").cast("double").alias("ba_dead"))
    return tables.stand_metrics(stands, "agb", ["dead_a", "dead_b"], "d", "ba_live", "ba_dead").select("cell", "layer", "live_m2", "dead_m2", "diameter_m", "basal_total")


_ATTR = "SELECT s_nationkey AS file, s_suppkey AS position, CASE WHEN s_suppkey % 5 = 0 THEN 'Air temperature' END AS long_name, CASE WHEN s_suppkey % 3 = 0 THEN 'K' ELSE 'Pa' END AS units, CASE WHEN s_suppkey % 2 = 0 THEN 'air_temperature' END AS standard_name FROM supplier"


@query("f18_find_variable", f"SELECT file, position, long_name, units, standard_name FROM (SELECT *, row_number() OVER (PARTITION BY file ORDER BY r, position) AS place FROM (SELECT *, CASE WHEN long_name = 'Air temperature' THEN 1 WHEN units = 'K' THEN 2 WHEN standard_name = 'air_temperature' THEN 3 END AS r FROM ({_ATTR})) WHERE r IS NOT NULL) WHERE place = 1")
def f18(v: Views) -> DataFrame:
    return tables.find_variable(v.spark.sql(_ATTR.replace("FROM supplier", "FROM {supplier}"), supplier=v.supplier), "file", "air_temperature", "Air temperature", "K")


@query("f20_explode_layers", duck("v_layers", "SELECT cell, 'Sws_' || layer AS name, CAST(d0 AS DOUBLE) AS depth, 'swvol_' || CAST(CAST(d0 AS INTEGER) AS VARCHAR) AS \"column\" FROM v_layers"))
def f20(v: Views) -> DataFrame:
    layer = F.struct(F.concat(F.lit("Sws_"), F.col("layer").cast("string")).alias("name"), F.col("d0").cast("double").alias("depth"))
    sites = v.v_layers.groupBy("cell").agg(F.array_sort(F.collect_list(layer)).alias("layers"))
    return tables.explode_layers(sites, "cell", "layers")


@query("f21_unpivot_parameters", duck("v_wide", "SELECT day, 'a' AS type, site0 AS value FROM v_wide UNION ALL SELECT day, 'b', site5 FROM v_wide", "value"))
def f21(v: Views) -> DataFrame:
    sheet = v.v_wide.select("day", F.col("site0").alias("a"), F.col("site5").alias("b"))
    return scans.wide_to_long(sheet, ["day"], ["a", "b"], "type", "value")


@query("x1_append_new_files", duck("v_daily", "SELECT cell, day, value FROM v_daily", "value"))
def x1(v: Views) -> DataFrame:
    base = scratch(v.spark, "append")
    schema = "cell bigint, day date, value double"
    for part in ("year(day) < 1998", "year(day) >= 1998"):  # files arrive in two lots, the job runs after each
        v.v_daily.filter(part).write.mode("append").parquet(f"{base}/in")
        out = append_new_files(v.spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", schema)
    return out


@query("x1_append_in_order", duck("v_daily", "SELECT cell, date_diff('day', DATE '1992-01-01', day) * 1.0 AS t, value FROM v_daily", "t value"))
def x1_in_order(v: Views) -> DataFrame:
    """Files of consecutive days in two lots, the second in K and in hours since another day."""
    base = scratch(v.spark, "in-order")
    days = F.datediff("day", F.lit("1992-01-01").cast("date")).cast("double")
    lots = [
        v.v_daily.filter("year(day) < 1998").select("cell", "day", days.alias("t"), "value", F.lit("degC").alias("units"), F.lit("days since 1992-01-01").alias("since")),
        v.v_daily.filter("year(day) >= 1998").select("cell", "day", (days * 24 + 48).alias("t"), (F.col("value") + 273.15).alias("value"), F.lit("K").alias("units"), F.lit("hours since 1991-12-30").alias("since")),
    ]
    for lot in lots:
        lot.repartitionByRange(4, "day").drop("day").write.mode("append").parquet(f"{base}/in")
        out = append_in_order(v.spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", "cell bigint, t double, value double, units string, since string", "cell", "t", units={"value": "units"}, time_units="since")
    return out
