"""Polygons, bounds, corners, nearest values on a circle and coordinate joins against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraflux.operators import joins, regrid
from terraflux.operators.windows import cell_corners


def ring(poly, *corners):
    return [(poly, *map(float, a), *map(float, b)) for a, b in zip(corners, [*corners[1:], corners[0]])]


def within(x, y, edges):
    """Strictly inside, in exact fractions of the given doubles."""
    from fractions import Fraction as Q

    inside = False
    for _, x1, y1, x2, y2 in edges:
        x1, y1, x2, y2, px, py = map(Q, (x1, y1, x2, y2, x, y))
        if (x2 - x1) * (py - y1) == (y2 - y1) * (px - x1) and min(x1, x2) <= px <= max(x1, x2) and min(y1, y2) <= py <= max(y1, y2):
            return False
        if min(y1, y2) <= py < max(y1, y2) and px < x1 + (py - y1) / (y2 - y1) * (x2 - x1):
            inside = not inside
    return inside


POLYGONS = [
    ring(1, (112, -38), (118, -38), (118, -32), (112, -32)) + ring(1, (114, -36), (114, -34), (116, -34), (116, -36)),  # a hole
    ring(2, (113, -40), (119.5, -35), (113, -30), (114.5, -35)),  # overlaps it, slanting
    ring(3, (110.25, -33), (110.75, -33), (110.5, -32.5)),  # smaller than a square
    ring(4, (100, 10), (140, 10), (140, 30), (100, 30)) + ring(4, (110, 15), (120, 15), (120, 20), (110, 20)) + ring(4, (112, 16), (118, 16), (118, 18), (112, 18)),  # an island in the hole
]


@pytest.mark.parametrize("band", [1.0, 0.7, 13.0])
def test_points_in_polygons(spark, band):
    rng = random.Random(1)
    points = [(x / 2, y / 2) for x in range(218, 244) for y in range(-82, -58)] + [(rng.uniform(99, 141), rng.uniform(-41, 31)) for _ in range(600)]
    points += [(c[i], c[i + 1]) for p in POLYGONS for c in p for i in (1, 3)] + [((c[1] + c[3]) / 2, (c[2] + c[4]) / 2) for p in POLYGONS for c in p]
    points = sorted(set(points))
    edges = [e for p in POLYGONS for e in p]
    rng.shuffle(edges)
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)] + [(9999, None, 1.0)], "id long, lon double, lat double")
    got = joins.points_in_polygons(df, ["id"], spark.createDataFrame(edges, "poly int, x1 double, y1 double, x2 double, y2 double"), band)
    assert got.columns == ["id", "poly"]
    assert sorted(map(tuple, got.collect())) == sorted((i, p[0][0]) for i, (x, y) in enumerate(points) for p in POLYGONS if within(x, y, p))


@pytest.mark.parametrize("eps", [1e-16, 1e-6, 1e-3, 0.4])
def test_coord_join(spark, eps):
    rng = random.Random(2)
    a = [(i, *(round(rng.uniform(-3, 3), 1) + rng.choice([0, 0.9, -0.9, 1.1, 0.4]) * eps for _ in range(2))) for i in range(120)]
    b = [(i, x / 10, y / 10) for i, (x, y) in enumerate((x, y) for x in range(-30, 31) for y in range(-30, 31))]
    got = joins.coord_join(spark.createDataFrame(a, "id long, lon double, lat double"), spark.createDataFrame(b, "cell long, lon double, lat double"), eps)
    assert sorted((r.id, r.cell) for r in got.collect()) == sorted((i, c) for i, x, y in a for c, u, v in b if abs(x - u) < eps and abs(y - v) < eps)


@pytest.mark.parametrize("axis", [[0.0, 350.0], [-179.0, -60.0, 0.0, 100.0, 179.5], [float(x) for x in range(0, 360, 7)], [5.0]])
def test_nearest_on_a_circle(spark, axis):
    xs = [0.0, 359.9, 354.9, -180.0, 180.0, 190.0, 5.1, -5.0, 720.5, 100.0]
    got = joins.nearest_on_axis(spark.createDataFrame(list(enumerate(xs)), "id long, lon double"), "id", "lon", spark.createDataFrame([(x,) for x in axis], "lon double"), "out", 360.0).collect()
    gap = lambda a, b: abs((a - b + 180) % 360 - 180)
    for r in got:
        assert gap(xs[r.id], r.out) == pytest.approx(min(gap(xs[r.id], a) for a in axis), abs=1e-9)


def bounds(spark, rows):
    return spark.createDataFrame([tuple(map(float, r)) for r in rows], "value double, low double, high double")


def area(low, high):
    return math.sin(math.radians(min(high, 90))) - math.sin(math.radians(max(low, -90)))


def test_regrid_over_the_date_line_and_poles(spark):
    """A global source in 0..360, a target in -180..180 with cells of any width, one over the date line, one round a pole."""
    rng = random.Random(4)
    lons = [(x * 30 + 15, x * 30, x * 30 + 30) for x in range(12)]
    lats = [(75, 60, 95), (0, 60, -60), (-75, -95, -60)]  # one axis runs down, and the outer cells reach over the poles
    to_lons, to_lats = [(-175, -190, -160), (-100, -160, -40), (0, -40, 37.5), (100, 37.5, 170)], [(-80, -90, -70), (-20, -70, 30), (60, 30, 90)]
    rows = [(m, float(x[0]), float(y[0]), None if rng.random() < 0.1 else rng.uniform(-5, 5)) for m in (1, 2) for x in lons for y in lats]
    got = regrid.regrid_bounds(spark.createDataFrame(rows, "month int, lon double, lat double, v double"), ["month"], ["v"], bounds(spark, lons), bounds(spark, lats), bounds(spark, to_lons), bounds(spark, to_lats))
    have = {(r.month, r.lon, r.lat): r.v for r in got.collect()}
    want = {}
    for m in (1, 2):
        for tx, ta, tb in to_lons:
            for ty, tc, td in to_lats:
                num = den = 0.0
                for mm, x, y, v in rows:
                    if mm == m and v is not None:
                        a, b = next(r[1:] for r in lons if r[0] == x)
                        c, d = sorted(next(r[1:] for r in lats if r[0] == y))
                        wide = sum(max(0, min(b + k, tb) - max(a + k, ta)) for k in (-360, 0, 360))
                        w = wide * max(0.0, area(max(c, tc), min(d, td)) if min(d, td) > max(c, tc) else 0.0)
                        num, den = num + w * v, den + w
                if den:
                    want[m, float(tx), float(ty)] = num / den
    assert have.keys() == want.keys() and all(have[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_bilinear_on_irregular_axes(spark):
    lons, lats = [0.25, 90.0, 170.0, 200.0, 359.75], [-60.0, -10.0, 5.0, 70.0]
    f = lambda x, y: 3 * y + 2
    rows = [(1, x, y, f(x, y)) for x in lons for y in lats] + [(2, x, y, 1.0 if x != 90 else None) for x in lons for y in lats]
    targets = [(0.0, 0.0), (-0.1, 5.0), (180.0, 70.0), (-170.0, -59.0), (90.0, 3.0), (45.0, 0.0), (10.0, 80.0), (200.0, -60.0), (-160.0, 1.0)]
    got = regrid.regrid_axes(spark.createDataFrame(rows, "m int, lon double, lat double, v double"), ["m"], "v", spark.createDataFrame(targets, "lon double, lat double"))
    have = {(r.m, r.lon, r.lat): r.v for r in got.collect()}
    inside = [t for t in targets if t[1] <= 70]
    assert {k[1:]: v for k, v in have.items() if k[0] == 1} == pytest.approx({t: f(*t) for t in inside})
    assert {k[1:] for k in have if k[0] == 2} == {t for t in inside if t not in ((90.0, 3.0), (45.0, 0.0))}
    east = regrid.regrid_axes(spark.createDataFrame([(1, x, y, float(x < 180)) for x in lons for y in lats], "m int, lon double, lat double, v double"), ["m"], "v", spark.createDataFrame([(0.0, 0.0), (185.0, 0.0)], "lon double, lat double"))
    assert {r.lon: r.v for r in east.collect()} == pytest.approx({0.0: 0.5, 185.0: 0.5})


def clip(poly, box):
    """The area of a polygon within a box, by cutting it at one side after another."""
    x0, x1, y0, y1 = box
    for axis, bound, sign in ((0, x0, 1), (0, x1, -1), (1, y0, 1), (1, y1, -1)):
        out = []
        for p, q in zip(poly, poly[1:] + poly[:1]):
            a, b = sign * (p[axis] - bound), sign * (q[axis] - bound)
            if a >= 0:
                out.append(p)
            if a * b < 0:
                out.append(tuple(p[i] + (q[i] - p[i]) * a / (a - b) for i in (0, 1)))
        poly = out
        if not poly:
            return 0.0
    return abs(sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(poly, poly[1:] + poly[:1]))) / 2


def test_corner_weights_against_clipping(spark):
    rng = random.Random(9)
    cells = []
    for i in range(60):
        x, y = rng.choice([rng.uniform(-180, 180), 179.5, -179.9, 0.1]), rng.uniform(-80, 80)
        turn = [rng.uniform(0, 2 * math.pi)] * 4
        corners = [(x + 4 * math.cos(t + k * math.pi / 2), y + 3 * math.sin(t + k * math.pi / 2)) for k, t in enumerate(turn)]
        cells.append((i, corners if i % 2 else corners[::-1]))
    cells.append((60, [(10.0, 5.0), (14.0, 5.0), (14.0, 8.0), (10.0, 8.0)]))
    lons = [(-180 + 7.5 * k + 3.75, -180 + 7.5 * k, -172.5 + 7.5 * k) for k in range(48)]
    lats = [(-87.5 + 5 * k, -90 + 5 * k, -85 + 5 * k) for k in range(36)]
    wrapped = [(i, [((x + 180) % 360) - 180 for x, _ in c], [y for _, y in c]) for i, c in cells]
    got = regrid.corner_weights(spark.createDataFrame(wrapped, "cell int, lons array<double>, lats array<double>"), ["cell"], bounds(spark, lons), bounds(spark, lats))
    have = {(r.cell, r.to_lon, r.to_lat): r.w for r in got.collect()}
    want = {}
    for i, c in cells:
        flat = [(x, math.sin(math.radians(y))) for x, y in c]
        for tx, a, b in lons:
            for ty, d, e in lats:
                w = sum(clip(flat, (a + k, b + k, math.sin(math.radians(d)), math.sin(math.radians(e)))) for k in (-360, 0, 360))
                if w > 1e-13:
                    want[i, tx, ty] = w
    assert have.keys() == want.keys() and max(abs(have[k] - want[k]) for k in want) < 1e-11


def test_corner_cells_fill_the_sphere(spark):
    """Cells round both poles and all between: every target is covered once, and the mean over the sphere is kept."""
    cells = [("n", [0.0, 120.0, 240.0], [60.0, 60.0, 60.0], 5.0), ("s", [200.0, 80.0, -40.0], [-60.0, -60.0, -60.0], -3.0)]
    cells += [(f"m{k}", [k * 60.0, k * 60.0 + 60, k * 60.0 + 60, k * 60.0], [-60.0, -60.0, 60.0, 60.0], float(k)) for k in range(6)]
    lons, lats = [(x, x - 10, x + 10) for x in range(-170, 190, 20)], [(-70, -90, -50), (0, -50, 50), (70, 50, 90)]
    df = spark.createDataFrame(cells, "cell string, lons array<double>, lats array<double>, v double")
    weights = regrid.corner_weights(df.select("cell", "lons", "lats"), ["cell"], bounds(spark, lons), bounds(spark, lats))
    for r in weights.groupBy("to_lon", "to_lat").agg(F.sum("w").alias("w")).collect():
        low, high = next(t[1:] for t in lats if t[0] == r.to_lat)
        assert r.w == pytest.approx(20 * area(low, high), abs=1e-9)
    got = regrid.regrid_corners(df.select("cell", "v"), [], ["v"], ["cell"], df.select("cell", "lons", "lats"), bounds(spark, lons), bounds(spark, lats)).collect()
    mean = sum(r.v * 20 * area(*next(t[1:] for t in lats if t[0] == r.lat)) for r in got) / 720
    own = sum(v * (360 * area(60, 90) if c in "ns" else 60 * area(-60, 60)) for c, _, _, v in cells) / 720
    assert mean == pytest.approx(own, abs=1e-9)


def test_corners_of_a_rotated_grid(spark):
    """W11's corners of a rotated grid onto a regular one: area times mean is kept where targets are covered whole."""
    from terraflux.functions.scalars import derotate

    grid = spark.range(400).select((F.col("id") % 20).cast("int").alias("c"), F.floor(F.col("id") / 20).cast("int").alias("r"))
    lon, lat = derotate((F.col("c") - 10) * 1.0 + 180, (F.col("r") - 10) * 1.0, 321.38, -60.31)
    corners = cell_corners(grid.select("r", "c", lon.alias("lon"), lat.alias("lat")), "r", "c", "lon", "lat")
    lons, lats = [(100.5 + k, 100 + k, 101 + k) for k in range(90)], [(-59.5 + k, -60 + k, -59 + k) for k in range(60)]
    weights = regrid.corner_weights(corners, ["r", "c"], bounds(spark, lons), bounds(spark, lats))
    have = {(r.r, r.c): r.w for r in weights.groupBy("r", "c").agg(F.sum("w").alias("w")).collect()}
    for r in corners.collect():
        flat = [(x, math.sin(math.radians(y))) for x, y in zip(r.lons, r.lats)]
        assert have[r.r, r.c] == pytest.approx(clip(flat, (-1e3, 1e3, -1, 1)), abs=1e-11)
    assert np.isfinite(list(have.values())).all()
