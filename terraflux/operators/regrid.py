"""Regridding: conservative (area-weighted) and bilinear. Cells meet their targets by index, so both are equi-joins.

On regular grids the index is worked out (regrid_conservative, regrid_bilinear). Axes given as tables of bounds meet by
bins (regrid_bounds, regrid_axes), with longitudes that go round; grids whose cells have four corners of their own are
clipped by the target's cells (regrid_corners). There the small tables of weights are made first and the data follow by
equi-joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraflux.operators.joins import nearest_values, small


def _index(x: str | object, x0: float, dx: float) -> object:
    return F.floor((x - (x0 - dx / 2)) / dx)


def target_axis(df: DataFrame, column: str, res: float, x0: float, dx: float) -> DataFrame:
    """The centres on one axis of the target cells that regrid_conservative() fills, from the source's own few coordinates."""
    half = res / 2
    source = df.select(F.col(column).alias("__s")).distinct()
    at = source.withColumn("__i", F.explode(F.sequence(_index(F.col("__s") - half, x0, dx), _index(F.col("__s") + half, x0, dx))))
    centre = x0 + F.col("__i") * dx
    wide = F.least(F.col("__s") + half, centre + dx / 2) - F.greatest(F.col("__s") - half, centre - dx / 2)
    return at.filter(wide > 1e-9).select(centre.alias(column)).distinct()


def regrid_conservative(df: DataFrame, keys: list[str], value: str | list[str], res: float, x0: float, dx: float, y0: float, dy: float) -> DataFrame:
    """The mean of the source cells of size res that overlap each target cell, weighted by the area of the overlap.

    Target cells have centres x0 + i * dx, y0 + j * dy; (keys, lon, lat, value), or several values at once. Missing source
    values have no weight; a target cell without any has no row.
    """
    values = [value] if isinstance(value, str) else value
    half = res / 2
    lo_x, hi_x, lo_y, hi_y = F.col("lon") - half, F.col("lon") + half, F.greatest(F.col("lat") - half, F.lit(-90.0)), F.least(F.col("lat") + half, F.lit(90.0))
    out = df.dropna("all", subset=values).withColumn("__i", F.explode(F.sequence(_index(lo_x, x0, dx), _index(hi_x, x0, dx))))
    out = out.withColumn("__j", F.explode(F.sequence(_index(lo_y, y0, dy), _index(hi_y, y0, dy))))
    cx, cy = x0 + F.col("__i") * dx, y0 + F.col("__j") * dy
    wide = F.least(hi_x, cx + dx / 2) - F.greatest(lo_x, cx - dx / 2)
    high = F.sin(F.radians(F.least(hi_y, cy + dy / 2))) - F.sin(F.radians(F.greatest(lo_y, cy - dy / 2)))
    out = out.withColumn("__w", wide * high).filter("__w > 1e-12")
    means = [(F.sum(F.col("__w") * F.col(v)) / F.sum(F.when(F.col(v).isNotNull(), F.col("__w")))).alias(v) for v in values]
    return out.groupBy(*keys, "__i", "__j").agg(*means).select(*keys, (x0 + F.col("__i") * dx).alias("lon"), (y0 + F.col("__j") * dy).alias("lat"), *values)


def regrid_bilinear(df: DataFrame, keys: list[str], value: str, x0: float, dx: float, y0: float, dy: float, targets: DataFrame) -> DataFrame:
    """Values at targets(lon, lat) between the four source cells around each; a target that lacks one has no row.

    Source cells have centres x0 + i * dx, y0 + j * dy.
    """
    fx, fy = (F.col("lon") - x0) / dx, (F.col("lat") - y0) / dy
    corners = F.array(*[F.struct((F.floor(fx) + i).alias("i"), (F.floor(fy) + j).alias("j"), ((fx - F.floor(fx) if i else 1 - fx + F.floor(fx)) * (fy - F.floor(fy) if j else 1 - fy + F.floor(fy))).alias("w")) for i in (0, 1) for j in (0, 1)])
    near = targets.select("lon", "lat", F.explode(corners).alias("c")).select(F.col("lon").alias("__x"), F.col("lat").alias("__y"), "c.i", "c.j", "c.w").filter("w > 0")
    source = df.select(*keys, value, F.round((F.col("lon") - x0) / dx).cast("long").alias("i"), F.round((F.col("lat") - y0) / dy).cast("long").alias("j")).filter(F.col(value).isNotNull())
    whole = source.join(near, ["i", "j"]).groupBy(*keys, "__x", "__y").agg(F.sum(F.col("w") * F.col(value)).alias(value), F.sum("w").alias("__w"))
    return whole.filter("__w > 1 - 1e-9").select(*keys, F.col("__x").alias("lon"), F.col("__y").alias("lat"), value)


#: Overlaps narrower than this, in degrees, come from rounding.
NARROW = 1e-9


def _intervals(axis: DataFrame, keys: list[str], period: float | None, copies: tuple[int, ...]) -> DataFrame:
    """axis(keys.., low, high) with low below high and, with a period, low within 0..period, and copies some periods away."""
    low, high = F.least("low", "high"), F.greatest("low", "high")
    out = axis.select(*keys, low.cast("double").alias("low"), (high - low).cast("double").alias("wide")).filter("low IS NOT NULL AND wide > 0")
    if period:
        once = F.pmod("low", F.lit(float(period)))
        out = out.withColumn("low", F.explode(F.array(*[once + k * float(period) for k in copies])))
    return out.select(*keys, "low", (F.col("low") + F.col("wide")).alias("high"))


def overlaps(source: DataFrame, keys: list[str], target: DataFrame, period: float | None = None) -> DataFrame:
    """(keys.., target, low, high, target_low, target_high): source(keys.., low, high) cut by target(target, low, high).

    An equi-join on bins as wide as a target is on average; a pair counts in the bin in which its overlap begins. With a
    period both go round, so that a pair may meet twice.
    """
    ours = _intervals(source, keys, period, (0,))
    theirs = _intervals(target, ["target"], period, (-1, 0, 1)).withColumnsRenamed({"low": "target_low", "high": "target_high"})
    n, width = theirs.agg(F.count("*"), F.avg(F.col("target_high") - F.col("target_low"))).first()
    width = width or 1.0
    bins = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / width), F.floor(F.col(b) / width)))
    met = ours.withColumn("bin", bins("low", "high")).join(small(theirs.withColumn("bin", bins("target_low", "target_high"))), "bin")
    cut = {"low": F.greatest("low", "target_low"), "high": F.least("high", "target_high")}
    met = met.filter(F.col("bin") == F.floor(cut["low"] / width)).withColumns(cut)
    return met.filter(F.col("high") - F.col("low") > NARROW).select(*keys, "target", "low", "high", "target_low", "target_high")


def _height(low: str = "low", high: str = "high") -> Column:
    """The share of the sphere's axis between two latitudes: areas are in proportion to it."""
    pole = lambda c: F.sin(F.radians(F.greatest(F.least(F.col(c), F.lit(90.0)), F.lit(-90.0))))
    return pole(high) - pole(low)


def _weighted(met: DataFrame, groups: list[str], values: list[str]) -> DataFrame:
    """The mean of each value by __w over its rows that are neither null nor NaN; a group without any has no row."""
    valid = lambda v: F.when(F.col(v).isNotNull() & ~F.isnan(F.col(v).cast("double")), F.col(v))
    means = [(F.try_divide(F.sum(F.col("__w") * valid(v)), F.sum(F.when(valid(v).isNotNull(), F.col("__w"))))).alias(v) for v in values]
    return met.groupBy(*groups).agg(*means).dropna("all", subset=values)


def regrid_bounds(df: DataFrame, keys: list[str], values: list[str], lons: DataFrame, lats: DataFrame, target_lons: DataFrame, target_lats: DataFrame, period: float | None = 360.0) -> DataFrame:
    """(keys, lon, lat, values), area-weighted means of the source cells that overlap each target cell.

    lons and lats are the source's axes, (value, low, high) with value as in df's lon and lat; the target's have its
    centres. Axes may be irregular and in either order; longitudes go round after a period (source in 0..360, target in
    -180..180; None: they do not), latitudes end at the poles. Missing source values, null or NaN, have no weight.
    """
    target = lambda t: t.withColumnRenamed("value", "target")
    across = overlaps(lons, ["value"], target(target_lons), period).groupBy("value", "target").agg(F.sum(F.col("high") - F.col("low")).alias("wide"))
    up = overlaps(lats, ["value"], target(target_lats)).withColumn("tall", _height()).filter("tall > 0")
    across, up = across.select(F.col("value").alias("lon"), F.col("target").alias("to_lon"), "wide"), up.select(F.col("value").alias("lat"), F.col("target").alias("to_lat"), "tall")
    met = df.dropna("all", subset=values).join(small(across), "lon").join(small(up), "lat").withColumn("__w", F.col("wide") * F.col("tall"))
    return _weighted(met, [*keys, "to_lon", "to_lat"], values).withColumnsRenamed({"to_lon": "lon", "to_lat": "lat"}).select(*keys, "lon", "lat", *values)


def _between(targets: DataFrame, axis: DataFrame, value: str, period: float | None) -> DataFrame:
    """(to, value, w): the values of an axis on either side of each target's, and their linear weights; none outside the axis."""
    wanted = targets.select(F.col(value).alias("to")).dropna().distinct()
    sides = nearest_values(wanted, "to", "to", axis.select(value), period)
    one = F.array(F.struct(F.col("below").alias("value"), F.lit(1.0).alias("w")))
    share = (F.col("at") - F.col("at_below")) / (F.col("at_above") - F.col("at_below"))
    two = F.array(F.struct(F.col("below").alias("value"), (1 - share).alias("w")), F.struct(F.col("above").alias("value"), share.alias("w")))
    found = sides.filter("below IS NOT NULL AND above IS NOT NULL").select("to", F.inline(F.when(F.col("at_below") == F.col("at_above"), one).otherwise(two)))
    return found.select("to", F.col("value").alias(value), F.col("w").alias(f"w_{value}"))


def regrid_axes(df: DataFrame, keys: list[str], value: str, targets: DataFrame, lons: DataFrame | None = None, lats: DataFrame | None = None, period: float | None = 360.0) -> DataFrame:
    """Values at targets(lon, lat) between the source's grid lines on either side, whatever the spacing of its axes.

    lons(lon) and lats(lat) are the source's axes, by default those of df. Longitudes go round after a period (None: they
    do not). A target beyond the outer latitudes, or one of whose neighbours is missing, has no row.
    """
    across = _between(targets, df.select("lon").distinct() if lons is None else lons, "lon", period)
    up = _between(targets, df.select("lat").distinct() if lats is None else lats, "lat", None)
    wanted = targets.select(F.col("lon").alias("to_lon"), F.col("lat").alias("to_lat")).distinct()
    near = wanted.join(across.withColumnRenamed("to", "to_lon"), "to_lon").join(up.withColumnRenamed("to", "to_lat"), "to_lat").withColumn("__w", F.col("w_lon") * F.col("w_lat")).filter("__w > 0")
    valid = df.select(*keys, "lon", "lat", value).filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    whole = valid.join(small(near), ["lon", "lat"]).groupBy(*keys, "to_lon", "to_lat").agg(F.sum(F.col("__w") * F.col(value)).alias(value), F.sum("__w").alias("__w"))
    return whole.filter("__w > 1 - 1e-9").select(*keys, F.col("to_lon").alias("lon"), F.col("to_lat").alias("lat"), value)


def _let(value: Column, body) -> Column:  # noqa: ANN001
    """body(value) with value worked out once."""
    return F.transform(F.array(value), body)[0]


def _under(edge: Column, box: dict[str, Column]) -> Column:
    """The area inside a box and below an edge, negative if the edge runs west. Summed over a polygon's edges this is
    the area that it has in common with the box, and its sign tells which way round it runs."""
    def between(x: Column) -> Column:
        at = lambda v: edge["ya"] + (edge["yb"] - edge["ya"]) * ((v - edge["xa"]) / (edge["xb"] - edge["xa"]))
        return _let(F.struct(F.least(at(x["a"]), at(x["b"])).alias("a"), F.greatest(at(x["a"]), at(x["b"])).alias("b")), lambda y: (x["b"] - x["a"]) * height(y))

    def height(y: Column) -> Column:
        """Mean height, within the box, of what lies below a line from y.a up to y.b."""
        whole, a, b = box["y1"] - box["y0"], F.greatest(y["a"], box["y0"]), F.least(y["b"], box["y1"])
        partly = F.greatest(b - a, F.lit(0.0)) * ((a + b) / 2 - box["y0"]) + F.greatest(y["b"] - F.greatest(y["a"], box["y1"]), F.lit(0.0)) * whole
        level = F.least(F.greatest(y["a"], box["y0"]), box["y1"]) - box["y0"]
        return F.when(y["b"] > y["a"], partly / (y["b"] - y["a"])).otherwise(level)

    ends = F.struct(F.greatest(F.least(edge["xa"], edge["xb"]), box["x0"]).alias("a"), F.least(F.greatest(edge["xa"], edge["xb"]), box["x1"]).alias("b"))
    area = _let(ends, lambda x: F.when(x["b"] > x["a"], between(x)).otherwise(0.0))
    return F.when(edge["xb"] > edge["xa"], area).otherwise(-area)


def corner_weights(corners: DataFrame, cell: list[str], target_lons: DataFrame, target_lats: DataFrame, period: float = 360.0) -> DataFrame:
    """(cell.., to_lon, to_lat, w): the area that each cell has in common with each target cell, in degrees times sine of latitude.

    corners is (cell.., lons, lats), arrays of the corners in order, either way round; see W11. In the plane of longitude
    and sine of latitude, which keeps areas, edges are straight lines. A cell may lie over the date line; one around a
    pole reaches up to it. Candidates are those whose boxes overlap, found by bins.
    """
    turn = lambda d: F.pmod(d + period / 2, F.lit(period)) - period / 2
    n = F.size("lons")
    step = lambda to, i: F.concat(to, F.array(F.element_at(to, -1) + turn(F.get("lons", i) - F.get("lons", i - 1))))
    # each longitude is counted on from the one before it; n + 1 of them, the last one back at the first
    around = F.aggregate(F.sequence(F.lit(1), n - 1), F.array(F.pmod(F.get("lons", F.lit(0)), F.lit(period))), step)
    closed = lambda x: F.concat(x, F.array(F.element_at(x, -1) + turn(F.get("lons", F.lit(0)) - F.element_at("lons", -1))))
    heights = F.transform(F.concat("lats", F.slice("lats", 1, 1)), lambda y: F.sin(F.radians(y)))
    sound = F.size("lons") == F.size("lats")
    out = corners.filter(sound & (n >= 3) & ~F.exists(F.concat("lons", "lats"), lambda v: v.isNull() | F.isnan(v))).select(*cell, "lons", "lats", around.alias("around"), heights.alias("ys"))
    out = out.select(*cell, "lats", closed(F.col("around")).alias("xs"), "ys")
    # a cell around a pole goes round once: its last corner is a period away from the first, and the pole closes it
    pole = F.when(F.aggregate("lats", F.lit(0.0), lambda a, y: a + y) > 0, 1.0).otherwise(-1.0)
    sides = F.transform(F.sequence(F.lit(0), F.size("xs") - 2), lambda i: F.struct(F.get("xs", i).alias("xa"), F.get("ys", i).alias("ya"), F.get("xs", i + 1).alias("xb"), F.get("ys", i + 1).alias("yb")))
    last = F.struct(F.element_at("xs", -1).alias("xa"), pole.alias("ya"), F.get("xs", F.lit(0)).alias("xb"), pole.alias("yb"))
    round_ = F.abs(F.element_at("xs", -1) - F.get("xs", F.lit(0))) > period / 2
    edges = F.when(round_, F.concat(sides, F.array(last))).otherwise(sides)
    north = F.when(round_ & (pole > 0), 90.0).otherwise(F.array_max("lats"))
    south = F.when(round_ & (pole < 0), -90.0).otherwise(F.array_min("lats"))
    west = F.array_min("xs")
    boxes = out.select(*cell, edges.alias("edges"), west.alias("low"), F.array_max("xs").alias("high"), south.alias("south"), north.alias("north"))
    # cells begin within 0..period, as overlaps() has them; what it moves is told by the difference
    rows = overlaps(boxes.select(*cell, "edges", F.col("south").alias("low"), F.col("north").alias("high"), F.col("low").alias("west"), F.col("high").alias("east")), [*cell, "edges", "west", "east"], target_lats.withColumnRenamed("value", "target"))
    rows = rows.select(*cell, "edges", "west", F.col("west").alias("low"), F.col("east").alias("high"), F.col("target").alias("to_lat"), F.col("target_low").alias("y0"), F.col("target_high").alias("y1"))
    met = overlaps(rows, [*cell, "edges", "west", "to_lat", "y0", "y1"], target_lons.withColumnRenamed("value", "target"), period)
    shift = F.pmod("west", F.lit(period)) - F.col("west")
    up = lambda c: F.sin(F.radians(F.greatest(F.least(F.col(c), F.lit(90.0)), F.lit(-90.0))))
    box = met.select(*cell, "edges", F.col("target").alias("to_lon"), "to_lat", F.struct((F.col("target_low") - shift).alias("x0"), (F.col("target_high") - shift).alias("x1"), up("y0").alias("y0"), up("y1").alias("y1")).alias("box"))
    parts = {c: F.col("box")[c] for c in ("x0", "x1", "y0", "y1")}
    area = F.aggregate("edges", F.lit(0.0), lambda a, e: a + _under(e, parts))
    return box.select(*cell, "to_lon", "to_lat", F.abs(area).alias("w")).groupBy(*cell, "to_lon", "to_lat").agg(F.sum("w").alias("w")).filter("w > 1e-13")


def regrid_corners(df: DataFrame, keys: list[str], values: list[str], cell: list[str], corners: DataFrame, target_lons: DataFrame, target_lats: DataFrame, period: float = 360.0) -> DataFrame:
    """(keys, lon, lat, values), area-weighted means over cells with corners of their own, see corner_weights().

    df is (keys.., cell.., values..); the target's axes are (value, low, high). Missing values, null or NaN, have no weight.
    """
    weights = corner_weights(corners, cell, target_lons, target_lats, period).withColumnRenamed("w", "__w")
    met = df.dropna("all", subset=values).join(small(weights), cell)
    return _weighted(met, [*keys, "to_lon", "to_lat"], values).withColumnsRenamed({"to_lon": "lon", "to_lat": "lat"}).select(*keys, "lon", "lat", *values)
