"""Views over the driver's tables on which every operator has data to run.

Each view is one SQL text, valid in Spark and in DuckDB; {table} stands for a table, {view:name} for another view.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VIEWS = {
    "v_raw": "SELECT event_id, event_type AS site, ts, value, CASE event_id % 8 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 10 WHEN 3 THEN 30 WHEN 4 THEN 50 WHEN 5 THEN 410 WHEN 6 THEN 999 END AS qc FROM {events}",
    "v_hours": "SELECT site, date_trunc('hour', ts) AS t, avg(value) AS value FROM {view:v_raw} GROUP BY site, date_trunc('hour', ts)",
    "v_daily": "SELECT l_suppkey % 10 AS cell, CAST(l_shipdate AS DATE) AS day, avg(l_quantity) AS value FROM {lineitem} GROUP BY l_suppkey % 10, CAST(l_shipdate AS DATE)",
    "v_grid": "SELECT 110 + 0.5 * CAST(l_suppkey % 20 AS DOUBLE) AS lon, -40 + 0.5 * CAST(l_partkey % 20 AS DOUBLE) AS lat, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, avg(l_quantity - 10) AS tas, avg(l_discount / 10) AS huss, avg(95 + 100 * l_tax) AS ps FROM {lineitem} GROUP BY l_suppkey % 20, l_partkey % 20, CAST(date_trunc('month', l_shipdate) AS DATE)",
    "v_stems": "SELECT l_orderkey, l_suppkey % 20 AS plot, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS start_visit, CAST(date_trunc('quarter', l_shipdate) AS DATE) + 14 AS end_visit, CAST(l_quantity AS DOUBLE) AS diameter_cm, 0.4 * CAST(l_quantity AS DOUBLE) AS height_m, CAST(l_extendedprice AS DOUBLE) / 1000 AS live_kg, CASE WHEN l_linenumber % 3 = 0 THEN CAST(l_extendedprice AS DOUBLE) / 5000 END AS dead_kg, l_linenumber AS transect FROM {lineitem}",
    "v_sites": "SELECT s_suppkey, s_name AS site, 110 + CAST(s_suppkey * 37 % 450 AS DOUBLE) / 10 AS lon, -44 + CAST(s_suppkey * 53 % 340 AS DOUBLE) / 10 AS lat FROM {supplier}",
    "v_modis": "SELECT user_id AS id, CAST(ts AS DATE) AS date, value / 20 AS lai, CAST(event_id % 256 AS INTEGER) AS qc FROM {events}",
    "v_text": "SELECT p_partkey, concat(CAST(p_size AS VARCHAR(9)), ' m x ', CAST(p_size % 7 + 1 AS VARCHAR(9)), ' m') AS dim, concat('-', CAST(p_size AS VARCHAR(9)), ' to -', CAST(p_size + 50 AS VARCHAR(9)), ' cm') AS len FROM {part}",
    "v_layers": "SELECT p_partkey % 25 AS cell, p_size % 5 AS layer, CASE p_size % 5 WHEN 0 THEN 0.0 WHEN 1 THEN 5.0 WHEN 2 THEN 15.0 WHEN 3 THEN 30.0 ELSE 60.0 END AS d0, CASE p_size % 5 WHEN 0 THEN 5.0 WHEN 1 THEN 15.0 WHEN 2 THEN 30.0 WHEN 3 THEN 60.0 ELSE 100.0 END AS d1, avg(p_retailprice) / 20 AS value FROM {part} GROUP BY p_partkey % 25, p_size % 5",
    "v_files": "SELECT DISTINCT o_orderstatus AS var, concat('tas_AUS-11_v1_1hr_', CAST(year(o_orderdate) * 100 + month(o_orderdate) AS VARCHAR(9)), '-', CAST(year(o_orderdate) * 100 + month(o_orderdate) AS VARCHAR(9)), '.nc') AS name FROM {orders}",
}

#: The regular hourly axis of all sites, which the two engines generate in their own ways.
_SERIES_DUCK = """SELECT g.site, g.t, h.value, CAST(row_number() OVER (PARTITION BY g.site ORDER BY g.t) - 1 AS INTEGER) AS i
FROM (SELECT site, unnest(generate_series((SELECT min(t) FROM {view:v_hours}), (SELECT max(t) FROM {view:v_hours}), INTERVAL 1 HOUR)) AS t FROM (SELECT DISTINCT site FROM {view:v_hours})) g
LEFT JOIN {view:v_hours} h ON g.site = h.site AND g.t = h.t"""
#: The polygon V_BOX as closed rings of edges.
BOX = ((1, 112.0, -38.0, 118.0, -38.0), (1, 118.0, -38.0, 118.0, -32.0), (1, 118.0, -32.0, 112.0, -32.0), (1, 112.0, -32.0, 112.0, -38.0))
_BOX_DUCK = "SELECT * FROM (VALUES " + ", ".join(map(str, BOX)) + ") AS e(poly, x1, y1, x2, y2)"
CELLS = range(10)
_WIDE_DUCK = "SELECT day, " + ", ".join(f"avg(value) FILTER (cell = {c}) AS site{c}" for c in CELLS) + " FROM {view:v_daily} GROUP BY day"

DUCK = VIEWS | {"v_series": _SERIES_DUCK, "v_box": _BOX_DUCK, "v_wide": _WIDE_DUCK}


def with_views(*names: str) -> str:
    """DuckDB: "WITH ..." of the views and of those that they read."""
    out: dict[str, str] = {}

    def add(name: str) -> None:
        for other in re.findall(r"\{view:(\w+)\}", DUCK[name]):
            add(other)
        out.setdefault(name, re.sub(r"\{(?:view:)?(\w+)\}", r"\1", DUCK[name]))

    for name in names:
        add(name)
    return "WITH " + ", ".join(f"{name} AS ({text})" for name, text in out.items())


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Spark: the view as a table."""
    if name == "v_series":
        return series(view(spark, sf_dir, "v_hours"))
    if name == "v_box":
        return spark.createDataFrame(list(BOX), "poly int, x1 double, y1 double, x2 double, y2 double")
    if name == "v_wide":
        return view(spark, sf_dir, "v_daily").groupBy("day").pivot("cell", list(CELLS)).agg(F.avg("value")).select("day", *[F.col(str(c)).alias(f"site{c}") for c in CELLS])
    args = {}

    def part(m: re.Match) -> str:
        label = m[1].removeprefix("view:")
        args[label] = view(spark, sf_dir, label) if m[1].startswith("view:") else spark.read.parquet(f"{sf_dir}/{label}.parquet")
        return "{" + label + "}"

    text = re.sub(r"\{((?:view:)?\w+)\}", part, VIEWS[name])
    return spark.sql(text, **args)


def series(hours: DataFrame) -> DataFrame:
    """(site, t, value, i): hourly values on the full axis from the first to the last hour of any site; missing ones are null."""
    from terraflux.functions.generators import axis_of

    grid = hours.select("site").distinct().join(axis_of(hours, "t", "1 hour"))
    from pyspark.sql import Window

    joined = grid.join(hours, ["site", "t"], "left")
    return joined.withColumn("i", F.row_number().over(Window.partitionBy("site").orderBy("t")) - 1)
