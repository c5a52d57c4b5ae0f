"""Queries of projections, filters and column functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraflux import model
from terraflux.functions import calendars, scalars
from terraflux.operators import filters
from terraflux.operators import windows as win
from terraflux.plans.registry import Views, duck, query

FAILING = ", ".join(map(str, sorted(model.FAILING_FLAGS)))


def case(col: str, table: dict[str, str]) -> str:
    return f"CASE {col} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in table.items()) + " END"


@query("p1_select_variables", duck("v_wide", "SELECT day, site0 AS howard, site3 AS gingin FROM v_wide", "howard gingin"))
def p1(v: Views) -> DataFrame:
    return filters.select_variables(v.v_wide, {"day": "day", "site0": "howard", "site3": "gingin", "absent": "x"})


@query("p2_constants", duck("v_wide", "SELECT day, site1, CAST(101.3 AS DOUBLE) AS ps, 'kPa' AS units FROM v_wide", "site1"))
def p2(v: Views) -> DataFrame:
    return filters.with_constants(v.v_wide.select("day", "site1"), {"ps": 101.3, "units": "kPa"})


@query("p3_bbox", duck("v_grid", "SELECT lon, lat, month, tas FROM v_grid WHERE lon BETWEEN 112 AND 115 AND lat BETWEEN -38 AND -35", "tas"))
def p3(v: Views) -> DataFrame:
    return filters.bbox(v.v_grid, 112, 115, -38, -35).select("lon", "lat", "month", "tas")


@query("p4_select_years", duck("v_daily", "SELECT cell, day, value FROM v_daily WHERE year(day) BETWEEN 1996 AND 1998", "value"))
def p4(v: Views) -> DataFrame:
    return filters.select_years(v.v_daily, "day", 1996, 1998)


@query("p5_scale_in_years", duck("v_daily", "SELECT cell, day, CASE WHEN year(day) BETWEEN 1997 AND 1999 THEN value * 0.5 ELSE value END AS value FROM v_daily", "value"))
def p5(v: Views) -> DataFrame:
    return filters.scale_in_years(v.v_daily, "day", "value", 0.5, 1997, 1999)


@query("p6_clip_to_coverage", duck("v_daily", "SELECT cell, day, value FROM v_daily WHERE day BETWEEN (SELECT min(CAST(o_orderdate AS DATE)) FROM orders) AND (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)", "value"), also="p6_clip_to_coverage_whole")
def p6(v: Views) -> DataFrame:
    return filters.clip_to_coverage(v.v_daily, v.orders.select(F.col("o_orderdate").cast("date").alias("day")), "day")


@query("p7_valid_only", duck("v_series", "SELECT site, t, value FROM v_series WHERE value IS NOT NULL AND NOT isnan(value)", "value"))
def p7(v: Views) -> DataFrame:
    return filters.valid_only(v.v_series, ["value"]).select("site", "t", "value")


@query("p8_qc_mask", duck("v_raw", f"SELECT event_id, site, ts, CASE WHEN coalesce(qc IN ({FAILING}), FALSE) THEN NULL ELSE value END AS value, qc FROM v_raw", "value"))
def p8(v: Views) -> DataFrame:
    return filters.qc_mask(v.v_raw, "value", "qc")


@query("p9_qc_drop", duck("v_raw", f"SELECT event_id, site, ts, value FROM v_raw WHERE NOT coalesce(qc IN ({FAILING}), FALSE)", "value"))
def p9(v: Views) -> DataFrame:
    return filters.qc_drop(v.v_raw, "qc").drop("qc")


@query("p10_bitflag_filter", duck("v_modis", "SELECT id, date, lai FROM v_modis WHERE qc & 204 = 0", "lai"))
def p10(v: Views) -> DataFrame:
    return filters.bitflag_filter(v.v_modis, "qc").drop("qc")


@query("p11_range_guard", duck("v_modis", "SELECT id, date, lai FROM v_modis WHERE lai BETWEEN 0.5 AND 3", "lai"))
def p11(v: Views) -> DataFrame:
    return filters.range_guard(v.v_modis, "lai", 0.5, 3).drop("qc")


@query("p12_clamp", duck("v_raw", "SELECT event_id, greatest(least(value, 80.0), 20.0) AS value FROM v_raw", "value"))
def p12(v: Views) -> DataFrame:
    return filters.clamp(v.v_raw, "value", 80, 20).select("event_id", "value")


@query("p13_bounds_report", duck("v_raw", """SELECT site, direction, count(*) AS n, string_agg(CASE WHEN place <= 20 THEN event_id || '=' || printf('%.2f', value) END, ';' ORDER BY place) AS first
  FROM (SELECT *, row_number() OVER (PARTITION BY site, direction ORDER BY ts, event_id) AS place FROM (SELECT *, CASE WHEN value < 10 THEN 'below' WHEN value > 90 THEN 'above' END AS direction FROM v_raw) WHERE direction IS NOT NULL)
  GROUP BY site, direction"""))
def p13(v: Views) -> DataFrame:
    return filters.bounds_report(v.v_raw, "site", ["ts", "event_id"], "value", 10, 90)


@query("p14_convert_units", duck("v_series", "SELECT site, t, value + 273.15 AS kelvin, value * 1e-6 * 12.011 * 1e-3 * 3600 AS carbon, value / 1700 AS rate FROM v_series", "kelvin carbon rate"))
def p14(v: Views) -> DataFrame:
    x = F.col("value")
    return v.v_series.select("site", "t", scalars.convert(x, "degC", "K").alias("kelvin"), scalars.convert(x, "umol/m^2/s", "kgC/m2", 3600).alias("carbon"), scalars.convert(x, "kg/m2", "kg/m2/s", 1700).alias("rate"))


_UNITS = ("W/m2", "W m-2", "mm", "kg m-2", "K", "degC", "°C")
_UNITS_SQL = "[" + ", ".join(f"'{u}'" for u in _UNITS) + "]"
_GROUP_SQL = lambda x: "CASE " + " ".join(f"WHEN {x} IN ({', '.join(repr(u) for u in g)}) THEN {i}" for i, g in enumerate(model.UNIT_SYNONYMS)) + " END"


@query("p15_units_match", f"SELECT a, b, count(*) AS n, coalesce(a = b OR {_GROUP_SQL('a')} = {_GROUP_SQL('b')}, FALSE) AS same FROM (SELECT {_UNITS_SQL}[s_suppkey % 7 + 1] AS a, {_UNITS_SQL}[s_nationkey % 7 + 1] AS b FROM supplier) GROUP BY a, b")
def p15(v: Views) -> DataFrame:
    units = F.array(*map(F.lit, _UNITS))
    pairs = v.supplier.select(F.get(units, (F.col("s_suppkey") % 7).cast("int")).alias("a"), F.get(units, (F.col("s_nationkey") % 7).cast("int")).alias("b"))
    return pairs.groupBy("a", "b").agg(F.count("*").alias("n")).withColumn("same", scalars.units_match(F.col("a"), F.col("b")))


@query("p16_unpack", duck("v_raw", "SELECT event_id, CASE WHEN qc IN (999, 410) THEN NULL ELSE CAST(qc AS DOUBLE) * 0.1 + 5 END AS x FROM v_raw", "x"))
def p16(v: Views) -> DataFrame:
    return filters.unpack(v.v_raw.select("event_id", F.col("qc").cast("double").alias("x")), "x", 0.1, 5, (999.0, 410.0))


@query("p17_override_values", duck("v_sites", "SELECT s_suppkey, site, CASE WHEN s_suppkey % 10 = 3 THEN lon + 0.25 ELSE lon END AS lon, lat FROM v_sites", "lon lat"))
def p17(v: Views) -> DataFrame:
    updates = v.v_sites.filter("s_suppkey % 10 = 3").select("site", (F.col("lon") + 0.25).alias("lon"))
    return filters.override_values(v.v_sites, updates, ["site"], ["lon"]).select("s_suppkey", "site", "lon", "lat")


@query("p18_grid_index", duck("v_sites", "SELECT site, CAST(round_even((lon - 110) / 0.5, 0) AS INTEGER) AS ix, CAST(round_even((lat + 44) / 0.5, 0) AS INTEGER) AS iy FROM v_sites"))
def p18(v: Views) -> DataFrame:
    ix, iy = scalars.grid_index(F.col("lon"), F.col("lat"), 110, -44, 0.5)
    return v.v_sites.select("site", ix.alias("ix"), iy.alias("iy"))


_NAME = "CASE s_suppkey % 7 WHEN 0 THEN 'AU-How' WHEN 1 THEN 'alice Springs  mulga' WHEN 2 THEN 'Arcturus' WHEN 3 THEN 'Wallaby' WHEN 4 THEN 'Tum' WHEN 5 THEN 'great Western woodlands' ELSE s_name END"
_JOINED = "list_aggregate(list_transform(list_filter(regexp_split_to_array(raw, '\\s+'), lambda w: w <> ''), lambda w: upper(w[1]) || w[2:]), 'string_agg', '')"
_KNOWN = ", ".join(f"'{s}'" for s in sorted({*model.SITE_CODES.values(), *model.SITES_WITHOUT_CODES}))


@query("f1_normalise_site", f"SELECT s_suppkey, raw, coalesce({case('raw', model.SITE_CODES)}, CASE WHEN j IN ({_KNOWN}) THEN j END, {case('j', model.SITE_SYNONYMS)}, {case("('AU-' || j)", model.SITE_CODES)}, raw) AS site FROM (SELECT *, {_JOINED} AS j FROM (SELECT s_suppkey, {_NAME} AS raw FROM supplier))")
def f1(v: Views) -> DataFrame:
    return v.supplier.select("s_suppkey", F.expr(_NAME).alias("raw")).withColumn("site", scalars.normalise_site(F.col("raw")))


@query("f2_parse_lengths", duck("v_text", "SELECT p_partkey, split_part(split_part(len, ' ', 1), '-', 2)::DOUBLE * 0.01 AS a, split_part(split_part(len, '-', 3), ' ', 1)::DOUBLE * 0.01 AS b FROM v_text", "a b"))
def f2(v: Views) -> DataFrame:
    return v.v_text.withColumn("x", scalars.parse_lengths(F.col("len"))).select("p_partkey", F.get("x", F.lit(0)).alias("a"), F.get("x", F.lit(1)).alias("b"))


@query("f3_parse_area", duck("v_text", "SELECT p_partkey, split_part(dim, ' ', 1)::DOUBLE * split_part(dim, ' ', 4)::DOUBLE AS area FROM v_text", "area"))
def f3(v: Views) -> DataFrame:
    return v.v_text.select("p_partkey", scalars.parse_area(F.col("dim")).alias("area"))


@query("f5_location_key", duck("v_sites", "SELECT site, lpad(CAST(CAST(abs(trunc(round_even(lon, 2) * 1000)) AS INTEGER) AS VARCHAR), 6, '0') || CASE WHEN lon < 0 THEN 'W' ELSE 'E' END || '_' || lpad(CAST(CAST(abs(trunc(round_even(lat, 2) * 1000)) AS INTEGER) AS VARCHAR), 6, '0') || CASE WHEN lat < 0 THEN 'S' ELSE 'N' END || '.nc' AS file FROM v_sites"))
def f5(v: Views) -> DataFrame:
    return v.v_sites.select("site", scalars.location_key(F.col("lon"), F.col("lat")).alias("file"))


@query("f6_make_time", duck("v_daily", """SELECT cell, day, day AS made, strptime(strftime(day, '%d/%m/%Y') || ' 06:30', '%d/%m/%Y %H:%M') AS read, make_timestamp(year(day), month(day), day(day), cell, 0, 0) AS hourly,
  make_timestamp(year(day), month(day), day(day), cell, cell * 5, cell * 3) AS exact, CAST(day AS TIMESTAMP) + INTERVAL 1 HOUR * cell AS counted FROM v_daily"""))
def f6(v: Views) -> DataFrame:
    day, cell = F.col("day"), F.col("cell").cast("int")
    ymd = {"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)}
    return v.v_daily.select(
        "cell", "day", scalars.make_time(year=F.year(day), doy=F.dayofyear(day)).cast("date").alias("made"),
        scalars.make_time(text=F.concat(F.date_format("day", "dd/MM/yyyy"), F.lit(" 06:30")), pattern="dd/MM/yyyy HH:mm").alias("read"), scalars.make_time(**ymd, hour=cell).alias("hourly"),
        scalars.make_time(**ymd, hour=cell, minute=cell * 5, second=cell * 3).alias("exact"), scalars.make_time(year=F.year(day), doy=F.dayofyear(day) - 1, hour=cell, base=0).alias("counted"),
    )


@query("f7_cf_time", duck("v_series", "SELECT site, t, date_diff('second', TIMESTAMP '2000-01-01', t) / 3600.0 AS hours, t + INTERVAL 0 SECOND AS back, date_diff('second', TIMESTAMP '2020-01-01', t) / 86400.0 AS days FROM v_series", "hours days"))
def f7(v: Views) -> DataFrame:
    t = F.col("t")
    coded = v.v_series.select("site", "t", scalars.cf_encode(t, "hours", "2000-01-01").alias("hours"), scalars.cf_encode(t, "days", "2020-01-01").alias("days"))
    return coded.withColumn("back", scalars.cf_decode(F.col("hours"), "hours", "2000-01-01"))


_CUM = {28: [0, 31, 59, 90, 120, 151, 181, 212, 243, 273, 304, 334], 29: [0, 31, 60, 91, 121, 152, 182, 213, 244, 274, 305, 335]}
_CALENDAR_SQL = f"""
WITH n AS (SELECT o_orderkey, date_diff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) AS n, o_orderkey % 24 AS hour FROM orders),
y AS (
  SELECT *, '360_day' AS calendar, 1990 + n // 360 AS year, n % 360 AS doy, NULL AS cum, n + 50400 AS own FROM n
  UNION ALL SELECT *, 'noleap', 1990 + n // 365, n % 365, {_CUM[28]}, n + 51100 FROM n
  UNION ALL SELECT *, 'all_leap', 1990 + n // 366, n % 366, {_CUM[29]}, n + 51240 FROM n
  UNION ALL SELECT o_orderkey, n, hour, 'julian', 1988 + 4 * (t // 1461) + CASE WHEN t % 1461 < 366 THEN 0 ELSE 1 + (t % 1461 - 366) // 365 END,
    CASE WHEN t % 1461 < 366 THEN t % 1461 ELSE (t % 1461 - 366) % 365 END, CASE WHEN t % 1461 < 366 THEN {_CUM[29]} ELSE {_CUM[28]} END, n + 51135 FROM (SELECT *, n + 731 AS t FROM n)
  UNION ALL SELECT *, 'standard', year(DATE '1990-01-01' + CAST(n AS INTEGER)), dayofyear(DATE '1990-01-01' + CAST(n AS INTEGER)) - 1,
    CASE WHEN year(DATE '1990-01-01' + CAST(n AS INTEGER)) % 4 = 0 THEN {_CUM[29]} ELSE {_CUM[28]} END, n + 51134 FROM n
), m AS (
  SELECT *, CASE WHEN cum IS NULL THEN doy // 30 + 1 ELSE len(list_filter(cum, lambda c: c <= doy)) END AS month FROM y
), d AS (
  SELECT *, CASE WHEN cum IS NULL THEN doy % 30 + 1 ELSE doy - cum[month] + 1 END AS day FROM m
)
SELECT o_orderkey, calendar, CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month, CAST(day AS INTEGER) AS day, CAST(hour AS INTEGER) AS hour, CAST(doy + 1 AS INTEGER) AS doy,
       round(own + hour / 24.0 + 1e-9, 6) AS own_days,
       CASE WHEN day <= 28 OR month <> 2 OR (day = 29 AND year % 4 = 0) THEN round(date_diff('day', DATE '1850-01-01', make_date(year, month, least(day, CASE WHEN month = 2 THEN 29 ELSE 31 END))) + hour / 24.0 + 1e-9, 6) END AS civil_days
FROM d
""".replace("make_date(year, month, least(day, CASE WHEN month = 2 THEN 29 ELSE 31 END))", "(make_date(year, month, 1) + CAST(day - 1 AS INTEGER))")


@query("f7_calendars", _CALENDAR_SQL)
def f7_calendars(v: Views) -> DataFrame:
    """Hours since 1990 read in five calendars, written in days since 1850, and as the same date of the civil calendar where that has it."""
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1990-01-01").cast("date"))
    hours = v.orders.select("o_orderkey", (days * 24 + F.col("o_orderkey") % 24).cast("double").alias("hours"))
    since, to = "hours since 1990-01-01", "days since 1850-01-01 00:00:00"
    times = hours.select("hours").distinct()  # many rows have the same time: each is worked out once
    read = [
        times.select(F.col("hours").alias("time"), F.lit(c).alias("calendar"), calendars.decode("hours", since, c).alias("p"))
        .select("*", calendars.encode("p", to, c).alias("own_days"), calendars.encode("p", to, "standard").alias("civil_days"), calendars.day_of_year(F.col("p"), c).alias("doy")) for c in ("360_day", "noleap", "all_leap", "julian", "standard")
    ]
    known = reduce(DataFrame.union, read).select("time", "calendar", "p.year", "p.month", "p.day", "p.hour", "doy", "own_days", "civil_days")
    return hours.join(known, F.col("hours").eqNullSafe(F.col("time"))).drop("hours", "time")


@query("f8_align_time", duck("v_raw", "SELECT event_id, date_trunc('day', ts) + INTERVAL 1 MINUTE * CAST(round_even(date_diff('second', date_trunc('day', ts), ts) / 1800.0, 0) * 30 AS INTEGER) AS half FROM v_raw"))
def f8(v: Views) -> DataFrame:
    return v.v_raw.select("event_id", scalars.align_time(F.date_trunc("second", "ts").cast("timestamp_ntz"), 30).cast("timestamp_ntz").alias("half"))


@query("f8_align_series", duck("v_series", "SELECT site, t, value FROM v_series", "value"))
def f8_series(v: Views) -> DataFrame:
    """Hours that are seven minutes late, moved back to the hour."""
    late = v.v_series.select("site", (F.col("t") + F.expr("INTERVAL 7 MINUTE")).cast("timestamp_ntz").alias("t"), "value")
    return win.align_series(late, "site", "t", "strict_hour", 60)


@query("f9_calendar_parts", duck("v_daily", "SELECT cell, day, year(day) AS year, dayofyear(day) - 1 AS doy0, dayofyear(day) AS doy1, 0 AS hour, day = date_trunc('year', day) AS is_year_start, make_date(CAST(year(day) AS BIGINT) + 1, 1, 1) AS next_year, CAST(trunc(date_diff('second', TIMESTAMP '1998-01-01', CAST(day AS TIMESTAMP)) / (1000 * 60)) AS BIGINT) AS steps FROM v_daily"))
def f9(v: Views) -> DataFrame:
    return v.v_daily.select("cell", "day", *[c.alias(n) for n, c in scalars.calendar_parts(F.col("day")).items()], scalars.steps_between(F.lit("1998-01-01"), F.col("day"), 1000).alias("steps"))


_ESAT = lambda a, b, c, t: f"{a} * exp({b} * {t} / ({c} + {t})) / 1000"
_E = "huss * ps / ((1 - 0.622) * huss + 0.622)"


@query("f10_vpd", duck("v_grid", f"SELECT lon, lat, month, {_ESAT(611.2, 17.62, 243.12, 'tas')} - {_E} AS sonntag, {_ESAT(610.94, 17.625, 243.04, 'tas')} - {_E} AS alduchov, {_ESAT(610.8, 17.27, 237.3, 'tas')} - {_E} AS allen FROM v_grid", "sonntag alduchov allen"))
def f10(v: Views) -> DataFrame:
    return v.v_grid.select("lon", "lat", "month", *[scalars.vpd(F.col("tas"), F.col("huss"), F.col("ps"), c).alias(c) for c in ("sonntag", "alduchov", "allen")])


@query("f11_vpd_from_rh", duck("v_grid", f"SELECT lon, lat, month, {_ESAT(611.2, 17.62, 243.04, 'tas')} * (1 - huss * 1000 / 100) AS vpd FROM v_grid", "vpd"))
def f11(v: Views) -> DataFrame:
    return v.v_grid.select("lon", "lat", "month", scalars.vpd_from_rh(F.col("tas"), F.col("huss") * 1000).alias("vpd"))


@query("f14_derotate", duck("v_grid", """SELECT DISTINCT lon, lat, CASE WHEN l < 0 THEN l + 360 ELSE l END - 180 AS x, degrees(asin(sin(p) * sin(radians(lat)) + cos(p) * cos(radians(lat)) * cos(radians(lon)))) AS y
  FROM (SELECT *, fmod(321.38 - 180 + degrees(atan2(cos(radians(lat)) * sin(radians(lon)), sin(p) * cos(radians(lat)) * cos(radians(lon)) - cos(p) * sin(radians(lat)))) + 180, 360) AS l FROM (SELECT lon, lat, radians(-60.31) AS p FROM v_grid))""", "x y"))
def f14(v: Views) -> DataFrame:
    x, y = scalars.derotate(F.col("lon"), F.col("lat"), 321.38, -60.31)
    return v.v_grid.select("lon", "lat").distinct().select("lon", "lat", x.alias("x"), y.alias("y"))


@query("f15_wrap_lon", duck("v_sites", "SELECT site, CASE WHEN lon * 2 > 180 THEN lon * 2 - 360 ELSE lon * 2 END AS lon FROM v_sites", "lon"))
def f15(v: Views) -> DataFrame:
    return v.v_sites.select("site", scalars.wrap_lon(F.col("lon") * 2).alias("lon"))


@query("f16_basal_area", duck("v_stems", "SELECT plot, start_visit, transect, pi() * pow(diameter_cm / 200, 2) AS area, start_visit + CAST(floor(date_diff('day', start_visit, end_visit) / 2) AS INTEGER) AS mid FROM v_stems", "area"))
def f16(v: Views) -> DataFrame:
    return v.v_stems.select("plot", "start_visit", "transect", scalars.basal_area(F.col("diameter_cm")).alias("area"), scalars.midpoint(F.col("start_visit"), F.col("end_visit")).alias("mid"))


_KIND = "CASE s_suppkey % 4 WHEN 0 THEN 'pr' WHEN 1 THEN 'temp' WHEN 2 THEN 'pr' ELSE 'ws' END"
_KIND_UNITS = "CASE s_suppkey % 4 WHEN 0 THEN 'mm' WHEN 1 THEN 'K' WHEN 2 THEN 'kg m-2 s-1' ELSE 'm/s' END"


@query("f17_standard_name", f"SELECT s_suppkey, CASE WHEN k = 'pr' THEN CASE WHEN u = 'mm' THEN 'precipitation_amount' ELSE 'precipitation_flux' END WHEN k = 'temp' THEN 'air_temperature' ELSE 'wind_speed' END AS std FROM (SELECT s_suppkey, {_KIND} AS k, {_KIND_UNITS} AS u FROM supplier)")
def f17(v: Views) -> DataFrame:
    return v.supplier.select("s_suppkey", scalars.standard_name(F.expr(_KIND), F.expr(_KIND_UNITS)).alias("std"))


@query("f19_parse_height", "SELECT p_partkey, round(CASE p_partkey % 3 WHEN 0 THEN p_size::DOUBLE * 0.01 WHEN 1 THEN p_size::DOUBLE END, 6) AS h FROM part")
def f19(v: Views) -> DataFrame:
    text = F.expr("CASE p_partkey % 3 WHEN 0 THEN concat(p_size, 'cm') WHEN 1 THEN concat(p_size, ' m') ELSE ' ' END")
    return v.part.select("p_partkey", scalars.parse_height(text).alias("h"))


@query("d3_unit_registry", duck("v_daily", "SELECT cell, day, value * 0.3048 AS value FROM v_daily", "value"))
def d3(v: Views) -> DataFrame:
    scalars.register_conversion("ft", "m", 0.3048)
    return filters.convert_units(v.v_daily, "value", "ft", "m")


@query("d4_expressions", duck("v_grid", "SELECT lon, lat, month, 0.611 * exp(17.27 * tas / (tas + 237.3)) AS esat, huss * ps / 0.622 / (0.611 * exp(17.27 * tas / (tas + 237.3))) AS share FROM v_grid", "esat share"))
def d4(v: Views) -> DataFrame:
    made = filters.with_expressions(v.v_grid, {"esat": "0.611D * exp(17.27D * tas / (tas + 237.3D))", "share": "huss * ps / 0.622D / esat"})
    return made.select("lon", "lat", "month", "esat", "share")
