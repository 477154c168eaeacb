"""Rays, boxes and points against triangles and boxes of very unlike sizes, by plain loops; and how many cells a large one lists."""

import random

import numpy as np
from pyspark.sql import functions as F

from tesserae.operators import rays, spatial


def triangles(r, n):
    out = []
    for fid in range(n):
        x, y, z, s = r.uniform(-20, 20), r.uniform(-20, 20), r.uniform(0, 2), r.choice([0.1, 0.5, 2, 30])
        out.append(("s" if fid % 3 else "t", fid, *(v for _ in range(3) for v in (x + r.uniform(-s, s), y + r.uniform(-s, s), z + r.uniform(-0.5, 0.5)))))
    out += [("s", n, -50.0, -50.0, 0.0, 50.0, -50.0, 0.0, 50.0, 50.0, 0.0), ("s", n + 1, -50.0, -50.0, 0.0, 50.0, 50.0, 0.0, -50.0, 50.0, 0.0)]
    return out


COLUMNS = "scene_id string, fid int, " + ", ".join(f"{a}{k} double" for k in range(3) for a in "xyz")


def plain_hits(ray, tris):
    s, _, *o, dx, dy, dz, size = ray
    o, way, out = np.array(o), np.array([dx, dy, dz]), []
    for t in tris:
        if t[0] != s:
            continue
        p = [np.array(t[2 + 3 * k : 5 + 3 * k]) for k in range(3)]
        e1, e2 = p[1] - p[0], p[2] - p[0]
        h = np.cross(way, e2)
        det = e1 @ h
        if abs(det) > 1e-12:
            q = np.cross(o - p[0], e1)
            u, v, w = (o - p[0]) @ h / det, way @ q / det, e2 @ q / det
            if u >= 0 and v >= 0 and u + v <= 1 and 0 <= w <= size:
                out.append(w)
    return out


def test_rays(spark):
    r = random.Random(1)
    tris = triangles(r, 60)
    lines = []
    for k in range(140):
        way = np.array([r.gauss(0, 1), r.gauss(0, 1), r.gauss(0, 0.3)]) if k % 4 else np.array([(0, 0, -1), (1, 0, 0), (0, -1, 0)][k // 4 % 3], float)
        way /= np.linalg.norm(way)
        lines.append(("s" if k % 2 else "t", k, r.uniform(-20, 20), r.uniform(-20, 20), 3.0 if k % 4 == 0 else r.uniform(0, 2), *map(float, way), r.choice([0.5, 5.0, 60.0])))
    lines += [("s", 900, 0.0, 0.0, 1.0, 0.0, 0.0, -1.0, 2.0), ("s", 901, 0.5, -1.0, 1.0, 0.0, 0.0, -1.0, 2.0)]
    f = spark.createDataFrame(tris, COLUMNS).withColumn("nz", F.lit(1.0))
    got = {(x.scene_id, x.ray): (x.n_hits, round(x.t, 6)) for x in rays.ray_hits(spark.createDataFrame(lines, "scene_id string, ray int, ox double, oy double, oz double, dx double, dy double, dz double, len double"), f).collect()}
    want = {(x[0], x[1]): (len(h), round(min(h), 6)) for x in lines if (h := plain_hits(x, tris))}
    assert got == want and len(want) > 30 and max(n for n, _ in want.values()) > 3


def boxes(r, n, p):
    out = []
    for k in range(n):
        s = r.choice([0.05, 0.4, 3, 40])
        low = [r.uniform(-20, 20), r.uniform(-20, 20), r.uniform(0, 1)]
        out.append(("s" if k % 2 else "t", k, *(v for a in low for v in (a, a + r.uniform(0.01, s)))))
    return out, f"scene_id string, {p} int, " + ", ".join(f"{x}_{m} double" for x in "xyz" for m in ("min", "max"))


def test_boxes(spark):
    r = random.Random(2)
    (a, ca), (b, cb) = boxes(r, 90, "a"), boxes(r, 90, "b")
    got = sorted(map(tuple, rays.touching(spark.createDataFrame(a, ca), spark.createDataFrame(b, cb), 0.5).collect()))
    want = [(x[0], x[1], y[1]) for x in a for y in b if x[0] == y[0] and all(x[2 + 2 * k] < y[3 + 2 * k] and y[2 + 2 * k] < x[3 + 2 * k] for k in range(3))]
    assert got == sorted(want) and len(want) > 150


def test_points_in_boxes(spark):
    r = random.Random(3)
    b, cb = boxes(r, 80, "b")
    pts = [("s" if k % 2 else "t", k, r.uniform(-20, 20), r.uniform(-20, 20)) for k in range(200)]
    got = sorted((x.scene_id, x.pid, x.b) for x in spatial.boxes_holding(spark.createDataFrame(pts, "scene_id string, pid int, x double, y double"), spark.createDataFrame(b, cb), 0.5, ("scene_id",)).collect())
    want = [(s, k, y[1]) for s, k, px, py in pts for y in b if y[0] == s and y[2] <= px <= y[3] and y[4] <= py <= y[5]]
    assert got == sorted(want) and len(want) > 50


def test_a_large_box_lists_few_cells(spark):
    one = spark.range(1).select(F.lit(0.0).alias("low"), F.lit(1e6).alias("high"))
    lev = spatial.level(F.col("high") - F.col("low"), 0.5)
    assert one.select(F.size(spatial.cells_between(F.col("low"), F.col("high"), lev, 0.5))).first()[0] <= 3
