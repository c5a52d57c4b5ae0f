"""Nearest cells on the sphere, for grids without axes of their own (rotated, curvilinear, scattered).

Coordinates become unit vectors, and the cube around the sphere is halved again and again in each direction. For every
cube that holds cells the tight box around them is known. A search goes down from large cubes to small ones: it drops a
cube whose box begins farther away than another one's box ends, so that the rings around a point are as wide as they
must be and no wider. Each step is an equi-join of the candidates with the cubes below them; the last one is with cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraflux.operators.joins import MAX_BROADCAST
from terraflux.sources.scratch import scratch

#: Bits of each coordinate of a cube at most (a cube is then 150 m wide), bits that a step goes down, cells that a cube should hold.
BITS, STEP, OCCUPANCY = 16, 2, 8
#: Distances this close, in radians, are equal (0.6 mm), and what boxes may err by.
PLACES, SLACK = 10, 1e-9


def unit_vector(lon: Column, lat: Column) -> dict[str, Column]:
    """x, y and z of degrees."""
    east, north = F.radians(lon), F.radians(lat)
    return {"x": F.cos(north) * F.cos(east), "y": F.cos(north) * F.sin(east), "z": F.sin(north)}


def angle(chord2: Column) -> Column:
    """Radians between two unit vectors of a squared distance."""
    return 2 * F.asin(F.least(F.sqrt(chord2) / 2, F.lit(1.0)))


def _cube(bits: int) -> Column:
    """The number of the cube of x, y and z."""
    part = lambda c: F.least(F.floor((F.col(c) + 1) * 2.0 ** (bits - 1)).cast("long"), F.lit(2**bits - 1))
    return (part("x") * 2**BITS + part("y")) * 2**BITS + part("z")


def _above(cube: Column, bits: int) -> Column:
    """The cube that holds it, some bits larger."""
    part = lambda places: F.shiftright(F.shiftright(cube, places).bitwiseAND(2**BITS - 1), bits)
    return (part(2 * BITS) * 2**BITS + part(BITS)) * 2**BITS + part(0)


def _places(df: DataFrame) -> DataFrame:
    """Distinct places of df(lon, lat) that are numbers, with their vectors."""
    sound = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < 1e6)
    return df.select(F.col("lon").cast("double").alias("lon"), F.col("lat").cast("double").alias("lat")).filter(sound("lon") & sound("lat")).distinct().withColumns(unit_vector(F.col("lon"), F.col("lat")))


def _bits(cells: DataFrame) -> int:
    """Bits of the smallest cubes, so that they hold some cells each."""
    counts = cells.agg(F.count("*"), *[F.approx_count_distinct(_cube(b)) for b in range(STEP, BITS + 1, STEP)]).first()
    return next((STEP * (i + 1) for i, n in enumerate(counts[1:]) if n * OCCUPANCY >= counts[0]), BITS)


_BOX = [f"{side}{c}" for c in "xyz" for side in ("lo", "hi")]


def _boxes(df: DataFrame, merged: bool) -> DataFrame:
    return df.groupBy("cube").agg(*[(F.min if b[:2] == "lo" else F.max)(b if merged else b[2:]).alias(b) for b in _BOX])


def _near(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= MAX_BROADCAST else df


def nearest_on_sphere(points: DataFrame, cells: DataFrame) -> DataFrame:
    """points(lon, lat, ..) with cell_lon, cell_lat and distance (radians), the nearest of cells(lon, lat, ..) on the sphere.

    Of cells that are equally near the one with the smallest latitude, then longitude, counts. Places are worked out once
    for all points that share them. A point without a place, and any point if there is no cell, gets nulls.
    """
    spark = points.sparkSession
    paths = {name: scratch(spark, f"sphere-{name}") for name in ("cells", "boxes")}
    _places(cells).write.parquet(paths["cells"])
    cells = spark.read.parquet(paths["cells"])
    bits = _bits(cells)
    cells = cells.withColumn("cube", _cube(bits))
    if not cells.limit(1).count():
        return points.withColumns({c: F.lit(None).cast("double") for c in ("cell_lon", "cell_lat", "distance")})
    levels = list(range(STEP, bits + 1, STEP))
    boxes = _boxes(cells, merged=False)
    for b in reversed(levels):
        boxes.write.parquet(f"{paths['boxes']}/{b}")
        boxes = _boxes(spark.read.parquet(f"{paths['boxes']}/{b}").withColumn("cube", _above(F.col("cube"), STEP)), merged=True)
    below = {b: spark.read.parquet(f"{paths['boxes']}/{b}") for b in levels}
    # the largest cubes are 4 ** 3 at most, so that every point can start with all of them
    first = [F.struct(F.lit(r["cube"]).cast("long").alias("cube"), *[F.lit(r[b]).alias(b) for b in _BOX]) for r in below[levels[0]].collect()]
    own = _places(points).withColumnsRenamed({"lon": "plon", "lat": "plat"}).repartition("plon", "plat")
    found = own.withColumn("b", F.explode(F.array(*first))).select(*own.columns, "b.*")
    for b in levels:
        if b > STEP:
            children = below[b].withColumnsRenamed({"cube": "child"}).withColumn("cube", _above(F.col("child"), STEP))
            found = found.join(_near(children), "cube").drop("cube").withColumnRenamed("child", "cube")
        gaps = [F.greatest(F.col(f"lo{c}") - F.col(c), F.col(c) - F.col(f"hi{c}"), F.lit(0.0)) for c in "xyz"]
        ends = [F.greatest(F.abs(F.col(f"lo{c}") - F.col(c)), F.abs(F.col(f"hi{c}") - F.col(c))) for c in "xyz"]
        far = F.min(F.sqrt(sum(e * e for e in ends))).over(Window.partitionBy("plon", "plat"))
        found = found.withColumn("__far", far).filter(F.sqrt(sum(g * g for g in gaps)) <= F.col("__far") + SLACK).select(*own.columns, "cube")
    at = cells.select("cube", F.col("lon").alias("cell_lon"), F.col("lat").alias("cell_lat"), *[F.col(c).alias(f"c{c}") for c in "xyz"])
    apart = F.round(angle(sum((F.col(f"c{c}") - F.col(c)) * (F.col(f"c{c}") - F.col(c)) for c in "xyz")), PLACES)
    best = found.join(_near(at), "cube").groupBy("plon", "plat").agg(F.min(F.struct(apart.alias("distance"), F.col("cell_lat"), F.col("cell_lon"))).alias("best"))
    joined = points.join(best, (F.col("lon").cast("double") == F.col("plon")) & (F.col("lat").cast("double") == F.col("plat")), "left")
    return joined.select(*[points[c] for c in points.columns], "best.cell_lon", "best.cell_lat", "best.distance")
