"""Joins: merges on keys, attribute lookups, nearest cells, points in polygons, missing keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraflux import model
from terraflux.sources.scratch import once

#: Rows of a lookup table that may be broadcast; a larger one is joined by a shuffle.
MAX_BROADCAST = 100_000


def small(df: DataFrame, limit: int = MAX_BROADCAST) -> DataFrame:
    """df with a broadcast hint if it has at most limit rows."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def small_once(df: DataFrame, name: str, limit: int = MAX_BROADCAST) -> DataFrame:
    """small() of a table that is dear to work out: it is written first, so that counting it does not do so twice."""
    return small(once(df, name), limit)


def merge_variables(keys: list[str], *tables: DataFrame) -> DataFrame:
    """One wide table of all keys in any of the tables."""
    return reduce(lambda a, b: a.join(b, keys, "full_outer"), tables)


def join_aligned(keys: list[str], key: str, time: str, *tables: DataFrame) -> DataFrame:
    """Inner join of tables that must agree, per series, in size, start and step; otherwise the job stops."""
    checks = [t.groupBy(key).agg(F.struct(F.count("*"), F.min(time), F.max(time)).alias(f"__c{i}")) for i, t in enumerate(tables)]
    check = reduce(lambda a, b: a.join(b, key, "full_outer"), checks)
    same = reduce(Column.__and__, [F.col("__c0").eqNullSafe(F.col(f"__c{i}")) for i in range(1, len(tables))])
    check = check.select(key, F.when(same, True).otherwise(F.raise_error(F.concat(F.lit("inputs differ for "), F.col(key).cast("string"))).cast("boolean")).alias("__ok"))
    return reduce(lambda a, b: a.join(b, keys), tables).join(check, key).filter("__ok").drop("__ok")


def resolve_sites(df: DataFrame, sites: DataFrame, site: str = "site") -> DataFrame:
    """Site attributes; a name that matches no site, or several, stops the job."""
    once = sites.groupBy(site).agg(F.count("*").alias("__n"), *[F.first(c).alias(c) for c in sites.columns if c != site])
    out = df.join(small(once), site, "left")
    found = F.when(F.coalesce("__n", F.lit(0)) == 1, True).otherwise(F.raise_error(F.concat(F.lit("not exactly one site "), F.col(site))).cast("boolean"))
    return out.filter(found).drop("__n")


def attach_attributes(df: DataFrame, attributes: DataFrame, keys: list[str]) -> DataFrame:
    """Attributes where there are any."""
    return df.join(attributes, keys, "left")


#: Bins of an axis, each with about as many of its values; a point meets the values of one bin and one from either side.
AXIS_BINS = 256


def nearest_values(points: DataFrame, key: str, value: str, axis: DataFrame, period: float | None = None) -> DataFrame:
    """(key, nearest, below, above, at_below, at_above, at) of each point on an axis of values.

    nearest is the axis value nearest to the point's, the smaller of two equally near; below and above are those on
    either side (both the same on a value of the axis), and at_below, at_above and at where they and the point stand. With
    a period values a whole period apart are the same, and neighbours are sought across its ends. Nulls for an empty axis or a null point.

    Bins end at quantiles of the axis, so that gaps and far values do not fill one of them; each also gets the last value
    before it and the first one after it.
    """
    outs = ["nearest", "below", "above", "at_below", "at_above", "at"]
    values = axis.select(F.col(axis.columns[0]).cast("double").alias("own")).dropna().distinct()
    x = F.col(value).cast("double")
    if period:  # the axis three times over, and points within the middle one
        middle = F.pmod("own", F.lit(float(period)))
        values = values.withColumn("v", F.explode(F.array(middle - float(period), middle, middle + float(period))))
        x = F.pmod(x, F.lit(float(period)))
    else:
        values = values.withColumn("v", F.col("own"))
    values = once(values, "axis")
    n, edges = values.agg(F.count("*"), F.percentile_approx("v", [i / AXIS_BINS for i in range(1, AXIS_BINS)], 10_000)).first()
    if not n:
        return points.select(key, *[F.lit(None).cast("double").alias(c) for c in outs])
    ends = F.array(*map(F.lit, sorted(set(edges))))
    bin_of = lambda x: F.size(F.filter(ends, lambda e: e <= x))
    own = values.withColumn("bin", bin_of(F.col("v")))
    first, last = (side(F.struct("v", "own")) for side in (F.min, F.max))
    sides = own.groupBy("bin").agg(first.alias("lo"), last.alias("hi"))  # a row per bin
    near = own.select("bin", "v", "own").union(sides.select(F.col("bin") + 1, "hi.*")).union(sides.select(F.col("bin") - 1, "lo.*"))
    probe = points.select(key, x.alias("__x"), F.when(x.isNotNull(), bin_of(x)).alias("bin"))
    found = probe.join(F.broadcast(near) if n <= MAX_BROADCAST else near, "bin", "left").groupBy(key)
    below, above = F.max(F.when(F.col("v") <= F.col("__x"), F.struct("v", "own"))), F.min(F.when(F.col("v") >= F.col("__x"), F.struct("v", "own")))
    best = F.min_by("own", F.struct(F.abs(F.col("v") - F.col("__x")), "own" if not period else "v"))
    found = found.agg(best.alias("nearest"), below.alias("b"), above.alias("a"), F.first("__x").alias("__x"))
    return found.select(key, "nearest", F.col("b.own").alias("below"), F.col("a.own").alias("above"), F.col("b.v").alias("at_below"), F.col("a.v").alias("at_above"), F.col("__x").alias("at"))


def nearest_on_axis(points: DataFrame, key: str, value: str, axis: DataFrame, out: str, period: float | None = None) -> DataFrame:
    """(key, out): the axis value nearest to each point's, see nearest_values()."""
    return nearest_values(points, key, value, axis, period).select(key, F.col("nearest").alias(out))


def nearest_cell(points: DataFrame, key: str, cells: DataFrame, period: float | None = None) -> DataFrame:
    """Points with cell_lon and cell_lat, the nearest value of each axis of the grid; longitudes go round after a period, if given."""
    lon = nearest_on_axis(points, key, "lon", cells.select("lon"), "cell_lon", period)
    lat = nearest_on_axis(points, key, "lat", cells.select("lat"), "cell_lat")
    return points.join(lon, key).join(lat, key)


def coord_join(df: DataFrame, cells: DataFrame, eps: float = 1e-16) -> DataFrame:
    """Rows with the cells whose coordinates differ by less than eps.

    Buckets are as wide as eps, a millionth of a degree at least; a cell stands in its own and in the two beside it, on
    either axis, so that pairs across an edge meet, each in one bucket only.
    """
    width = max(eps, 1e-6)
    bucket = lambda c: F.floor(F.col(c) / width)
    beside = lambda c: F.explode(F.sequence(bucket(c) - 1, bucket(c) + 1))
    a = df.withColumns({"__x": bucket("lon"), "__y": bucket("lat")})
    b = cells.withColumnsRenamed({"lon": "__lon", "lat": "__lat"}).withColumn("__x", beside("__lon")).withColumn("__y", beside("__lat"))
    near = (F.abs(F.col("lon") - F.col("__lon")) < eps) & (F.abs(F.col("lat") - F.col("__lat")) < eps)
    return a.join(b, ["__x", "__y"]).filter(near).drop("__x", "__y", "__lon", "__lat")


def _edge_rows(edges: DataFrame, band: float) -> DataFrame:
    """edges(poly, x1, y1, x2, y2) once for each row of squares that they touch, with the columns from __west to __east that they touch there."""
    rows = edges.withColumn("__b", F.explode(F.sequence(F.floor(F.least("y1", "y2") / band), F.floor(F.greatest("y1", "y2") / band))))
    low, high = F.greatest(F.least("y1", "y2"), F.col("__b") * band), F.least(F.greatest("y1", "y2"), (F.col("__b") + 1) * band)
    west, east = (F.when(F.col("y1") == F.col("y2"), end("x1", "x2")).otherwise(end(_x_at(low), _x_at(high))) for end in (F.least, F.greatest))
    return rows.withColumns({"__west": F.floor((west - ON_EDGE) / band), "__east": F.floor((east + ON_EDGE) / band)})


def _x_at(y: Column) -> Column:
    return F.col("x1") + (y - F.col("y1")) / F.nullif(F.col("y2") - F.col("y1"), F.lit(0.0)) * (F.col("x2") - F.col("x1"))


def polygon_cover(edges: DataFrame, band: float) -> DataFrame:
    """(poly, __b, __c, full): the squares of a grid that a polygon covers in full, and those that its edges run through.

    Between two squares with edges of one row lies inside or outside only; which of both the crossings of the row's
    middle to the east of it tell.
    """
    middle = (F.col("__b") + 0.5) * band
    crosses = (F.least("y1", "y2") <= middle) & (middle < F.greatest("y1", "y2")) & (F.col("__c") == F.least(F.greatest(F.floor(_x_at(middle) / band), "__west"), "__east"))
    touched = _edge_rows(edges, band).withColumn("__c", F.explode(F.sequence("__west", "__east"))).groupBy("poly", "__b", "__c").agg(F.count(F.when(crosses, 1)).alias("n"))
    row = Window.partitionBy("poly", "__b").orderBy("__c")  # the squares with edges of one row
    beyond = F.sum("n").over(row.rowsBetween(1, Window.unboundedFollowing))
    gaps = touched.select("poly", "__b", "__c", F.lead("__c").over(row).alias("next"), beyond.alias("beyond")).filter("next > __c + 1 AND beyond % 2 = 1")
    return touched.select("poly", "__b", "__c", F.lit(False).alias("full")).union(gaps.select("poly", "__b", F.explode(F.sequence(F.col("__c") + 1, F.col("next") - 1)), F.lit(True)))


#: Degrees from an edge at which a point is on it.
ON_EDGE = 1e-12


def points_in_polygons(points: DataFrame, keys: list[str], edges: DataFrame, band: float = 1.0) -> DataFrame:
    """(keys, poly), each once, of points strictly within polygons; points on an edge or corner are not.

    edges(poly, x1, y1, x2, y2) are closed rings in any order; rings within rings are holes. Points in squares (of band
    degrees) that a polygon covers in full need no test. Others are within if a ray to the east crosses an odd number of
    the polygon's edges, of which they meet those of their own row.
    """
    at = points.select(*keys, F.col("lon").alias("__x"), F.col("lat").alias("__y"), F.floor(F.col("lat") / band).alias("__b"), F.floor(F.col("lon") / band).alias("__c"))
    found = at.join(small(polygon_cover(edges, band)), ["__b", "__c"])
    spans = (F.least("y1", "y2") <= F.col("__y")) & (F.col("__y") < F.greatest("y1", "y2"))
    length = F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    aside = F.abs((F.col("x2") - F.col("x1")) * (F.col("__y") - F.col("y1")) - (F.col("y2") - F.col("y1")) * (F.col("__x") - F.col("x1")))
    beside = F.col("__x").between(F.least("x1", "x2") - ON_EDGE, F.greatest("x1", "x2") + ON_EDGE) & F.col("__y").between(F.least("y1", "y2") - ON_EDGE, F.greatest("y1", "y2") + ON_EDGE)
    tested = found.filter("NOT full").join(small(_edge_rows(edges, band).drop("__west", "__east")), ["poly", "__b"]).groupBy(*keys, "__x", "__y", "poly")
    tested = tested.agg(F.count(F.when(spans & (F.col("__x") < _x_at(F.col("__y"))), 1)).alias("n"), F.max(beside & (aside <= ON_EDGE * length)).alias("on"))
    return found.filter("full").select(*keys, "poly").union(tested.filter("n % 2 = 1 AND NOT on").select(*keys, "poly")).distinct()


def align_to_grid(grid: DataFrame, observed: DataFrame, keys: list[str], variable: str, value: str, variables: list[str]) -> DataFrame:
    """A column per variable on the rows of grid, null where nothing was observed."""
    wide = observed.groupBy(*keys).pivot(variable, variables).agg(F.avg(value))
    return grid.join(wide, keys, "left")


def on_axis(df: DataFrame, axis: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys the axis has."""
    return df.join(axis.select(*keys).distinct(), keys, "left_semi")


def off_axis(df: DataFrame, axis: DataFrame, keys: list[str]) -> DataFrame:
    """The rows that on_axis() drops."""
    return df.join(axis.select(*keys).distinct(), keys, "left_anti")


def missing_steps(df: DataFrame, key: str, time: str, step: str) -> DataFrame:
    """The regular steps between a series' first and last time that it has no row for."""
    expected = df.groupBy(key).agg(F.explode(F.sequence(F.min(time), F.max(time), F.expr(f"interval {step}"))).alias(time))
    return expected.join(df.select(key, time), [key, time], "left_anti")


def missing_periods(catalog: DataFrame, variable: str, period: str, start: int, end: int) -> DataFrame:
    """(variable, period as yyyymm) that the catalogue lacks of the years start to end."""
    periods = F.explode(F.expr(f"transform(sequence(0, {(end - start + 1) * 12 - 1}), m -> ({start} + floor(m / 12)) * 100 + m % 12 + 1)"))
    expected = catalog.select(variable).distinct().withColumn(period, periods)
    have = catalog.select(variable, F.col(period).cast("bigint").alias(period))
    return expected.join(have, [variable, period], "left_anti")


def qc_explain(df: DataFrame, flag: str) -> DataFrame:
    """(flag, n, passed, description); unknown flags pass and have no description."""
    rows = [(flag, *said) for flag, said in model.QC_FLAGS.items()]
    table = df.sparkSession.createDataFrame(rows, f"`{flag}` int, passed boolean, description string")  # 69 rows
    counts = df.groupBy(F.col(flag).cast("int").alias(flag)).agg(F.count("*").alias("n"))
    return counts.join(F.broadcast(table), flag, "left").withColumn("passed", F.coalesce("passed", F.lit(True)))


def merge_points(*tables: DataFrame) -> DataFrame:
    """All points' rows, columns by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
