"""Small analytic cases of the operators."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tesserae.functions import geometry as G
from tesserae.operators import masks, spatial
from tesserae.operators.graph import connected_components
from tesserae.plans import catalogue, mesh, scene


def test_triangle_attributes(spark):
    row = spark.createDataFrame([(0.0, 0.0, 0.0, 2.0, 0.0, 0.0, 0.0, 2.0, 0.0), (1.0,) * 9], [f"{a}{k}" for k in range(3) for a in "xyz"])
    flat, point = G.with_triangle_attributes(row).orderBy(F.col("area").desc()).collect()
    assert (flat.area, flat.nz, round(flat.cx, 6)) == (2.0, 1.0, round(2 / 3, 6))
    assert (point.area, point.nx, point.ny, point.nz) == (0.0, 0.0, 0.0, 0.0)


def test_anchor_is_outside_its_sector(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (-1.0, 0.0), (9.0, 0.0)], ["dx", "dy"])
    inside = G.in_sector(F.col("dx"), F.col("dy"), F.lit(0.0), F.lit(1.0), F.lit(0.0), 4.0, 45.0, F.lit(-1.0), F.lit(1.0))
    assert [r[0] for r in df.select(inside).collect()] == [False, True, False, False]


def test_intrinsics(spark):
    fx, fy, cx, cy = spark.range(1).select(*G.intrinsics(F.lit(64.0), F.lit(90.0), F.lit(32.0), F.lit(90.0))).first()
    assert math.isclose(fx, 32) and math.isclose(fy, 16) and (cx, cy) == (32, 16)


def test_runs_round_trip(spark):
    bits = [(m, i, b) for m, s in (("a", "0011101"), ("b", "1"), ("c", "000"), ("d", "1101")) for i, b in enumerate(map(int, s))]
    rle = masks.encode_runs(spark.createDataFrame(bits, ["mask", "idx", "bit"]))
    assert {r.mask: list(r.rle) for r in rle.collect()} == {"a": [2, 3, 1, 1], "b": [0, 1], "c": [3], "d": [0, 2, 1, 1]}
    assert sorted(map(tuple, masks.decode_runs(rle).collect())) == sorted((m, i) for m, i, b in bits if b)


def test_components_against_union_find(spark):
    r = random.Random(3)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1060)] + [(5000, k) for k in range(5001, 5200)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    got = {x.node: x.component for x in connected_components(spark.createDataFrame(edges, ["src", "dst"])).collect()}
    assert got == {x: root(x) for x in parent}


def test_no_edges_no_components(spark):
    assert connected_components(spark.createDataFrame([(1, 1), (None, 2)], "src long, dst long")).count() == 0


def test_nearest_takes_the_lowest_id_among_equals(spark):
    q = spark.createDataFrame([(1, 0.0, 0.0, 0.0), (2, 9.0, 9.0, 9.0)], ["pid", "x", "y", "z"])
    r = spark.createDataFrame([(7, 0.1, 0.0, 0.0), (5, -0.1, 0.0, 0.0)], ["pid", "x", "y", "z"])
    assert [tuple(x)[:2] for x in spatial.nearest_within(q, r, 0.2).collect()] == [(1, 5)]


def test_zero_shot(spark):
    """Ties, one class alone, a vector of zeros and a null one; more classes than allowed, and none."""
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, [0.0, 0.0]), (4, None)], "vec_id int, embedding array<float>")
    p = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("c", [0.0, 1.0])], "label string, proto array<double>")
    got = {r.vec_id: r for r in scene.zero_shot(v, p, 2, 0.4, 0.05).collect()}
    assert [[t.label for t in got[k].top] for k in (1, 2, 3, 4)] == [["a", "b"], ["c", "a"], ["a", "b"], ["a", "b"]]
    e = math.e
    assert math.isclose(got[2].top[0].conf, e / (e + 2)) and math.isclose(got[2].margin, (e - 1) / (e + 2)) and not got[2].unknown
    assert got[1].margin == 0 and got[1].unknown and got[3].unknown and math.isclose(got[4].top[0].conf, 1 / 3)
    alone = scene.zero_shot(v.where("vec_id = 1"), p.where("label = 'c'")).first()
    assert alone.margin == 1 and not alone.unknown and len(alone.top) == 1
    for k in (0, 2):
        with pytest.raises(ValueError):
            scene.zero_shot(v, p.limit(3) if k else p.where("false"), most=k or 9)


def test_prototypes(spark):
    e = spark.createDataFrame([("a", [3.0, 4.0]), ("a", [4.0, 3.0]), ("b", [0.0, 0.0])], "label string, embedding array<float>")
    got = {r.label: r.proto for r in scene.prototypes(e, 2).collect()}
    assert all(math.isclose(x, math.sqrt(0.5), abs_tol=1e-7) for x in got["a"]) and got["b"] == [0.0, 0.0]


def test_faces_are_placed_by_their_instances(spark):
    corner = [f"{a}{k}" for k in range(3) for a in "xyz"]
    f = spark.createDataFrame([("s", 1, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0, 2.0), ("s", 2, *[1.0] * 9), ("t", 1, *[1.0] * 9)], "scene_id string, instance int, " + ", ".join(f"{c} double" for c in corner))
    turn = [0.0, -1.0, 0.0, 10.0, 1.0, 0.0, 0.0, 20.0, 0.0, 0.0, 1.0, 30.0, 0.0, 0.0, 0.0, 1.0]
    got = mesh.placed_faces(f, spark.createDataFrame([("s", 1, turn, 0.1)], "scene_id string, instance int, matrix array<double>, metres double")).collect()
    assert [[round(r[c], 9) for c in corner] for r in got] == [[1.0, 2.0, 3.0, 1.0, 2.1, 3.0, 0.9, 2.0, 3.2]]


def test_surface_points(spark):
    corner = [f"{a}{k}" for k in range(3) for a in "xyz"] + [f"{a}{k}" for k in range(3) for a in "rgb"]
    row = (0.0, 0.0, 0.0, 2.0, 0.0, 0.0, 0.0, 2.0, 0.0, -40.0, 10.0, 300.0, 20.0, 20.5, 400.0, 0.0, 0.0, 500.0)
    f = spark.createDataFrame([row], ", ".join(f"{c} double" for c in corner))
    p = mesh.surface_points(f, F.lit(0.75), F.lit(0.5)).first()  # reflected to (0.25, 0.5)
    assert (p.x, p.y, p.z, p.r, p.g, p.b, p.nx, p.ny, p.nz) == (0.5, 1.0, 0.0, 0, 7, 255, 0.0, 0.0, 1.0)


def test_bounds_stay_within_their_scene(spark):
    b = spark.createDataFrame([("s", 1, 0.0, 1.0, 0.0, 1.0, 0.0, 1.0), ("s", 2, 5.0, 9.0, 0.5, 4.0, -1.0, 0.5), ("t", 1, 0.0, 1.0, 0.0, 1.0, 0.0, 1.0)], "scene_id string, region int, x_min double, x_max double, y_min double, y_max double, z_min double, z_max double")
    got = {(r.scene_id, r.region): tuple(r)[2:] for r in mesh.expanded_bounds(b, 0.75).collect()}
    assert got == {("s", 1): (0.0, 1.75, 0.0, 1.75, -1.0, 1.0), ("s", 2): (4.25, 9.0, 0.0, 4.0, -1.0, 1.0), ("t", 1): (0.0, 1.0, 0.0, 1.0, 0.0, 1.0)}


def test_answers_take_their_rule(spark):
    rules = spark.createDataFrame([("cup", "surface", 0.1)], "canonical_class string, placement string, low double")
    raw = ['so {"decision":"accepted","canonical_class":"cup","confidence":0.9,"reason":"r"} ok', '{"decision":"accepted","canonical_class":"cup","confidence":0.5}', '{"decision":"accepted","canonical_class":"hat","confidence":1}', '{"decision":"rejected","reason":""}', "none", None]
    got = [tuple(r)[1:] for r in catalogue.judged(spark.createDataFrame(list(enumerate(raw)), "uid int, raw string"), rules).orderBy("uid").collect()]
    assert got == [("accepted", "cup", 0.9, "r", "surface", 0.1), ("needs_review", None, 0.5, "Below acceptance threshold", None, None), ("rejected", None, 1.0, "Local LLM classification", None, None), ("rejected", None, 0.0, "Local LLM classification", None, None), ("needs_review", None, 0.0, "Invalid model output", None, None), ("needs_review", None, 0.0, "Invalid model output", None, None)]
