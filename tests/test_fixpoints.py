"""Operators that SQL cannot express, against plain loops on small inputs."""

import math
import os
import random

import numpy as np
import pytest

from tesserae.plans import catalogue, instances, observing


def test_exclusive_owners(spark):
    r = random.Random(3)
    sets = {i: {r.randrange(60) for _ in range(r.randrange(1, 30))} for i in range(80)}
    want = {}
    for s in (0, 1):
        free = set(range(60))
        for i in range(s, 80, 2):
            own = sets[i] & free
            if len(own) >= 5:
                free -= own
                want |= {(s, p): i for p in own}
    members = spark.createDataFrame([(i % 2, i, p) for i, s in sets.items() for p in s], "scene_id int, inst int, pid int")
    ranks = spark.createDataFrame([(i % 2, i, i) for i in [*sets, 99]], "scene_id int, inst int, rank int")
    assert {(x.scene_id, x.pid): x.inst for x in instances.exclusive_owners(members, ranks, 5).collect()} == want


def test_spaced(spark):
    r = random.Random(4)
    pts = [(f"s{i % 2}", i, r.random() * 10 - 5, r.random() * 10 - 5) for i in range(200)] + [("s0", 200, 0.0, 0.0), ("s0", 201, 0.0, 0.0)]
    want = []
    for s, i, x, y in pts:
        if all(t != s or math.hypot(x - a, y - b) >= 1.5 for t, _, a, b in want):
            want.append((s, i, x, y))
    df = spark.createDataFrame(pts, "scene_id string, rank int, x double, y double")
    assert sorted(x.rank for x in observing.spaced(df, 1.5).collect()) == sorted(i for _, i, _, _ in want)
    first = {s: [i for t, i, _, _ in want if t == s][:3] for s in ("s0", "s1")}
    assert sorted((x.scene_id, x.rank) for x in observing.spaced(df, 1.5, 3).collect()) == [(s, i) for s in first for i in first[s]]


def test_spaced_in_turns(spark, monkeypatch):
    """Turns of a few points give what one gives, and list few neighbours of a scene that is soon covered."""
    r = random.Random(8)
    pts = [(s, i, r.random() * 6, r.random() * 6) for s in "ab" for i in range(1500)]
    want = []
    for s, i, x, y in pts:
        if all(t != s or math.hypot(x - a, y - b) >= 1.0 for t, _, a, b in want):
            want.append((s, i, x, y))
    edges, write = [], observing.materialize
    monkeypatch.setattr(observing, "materialize", lambda df, name="t", **k: (lambda t: edges.append(t.count() if name == "spacing" else 0) or t)(write(df, name, **k)))
    df = spark.createDataFrame(pts, "scene_id string, rank int, x double, y double")
    assert sorted((x.scene_id, x.rank) for x in observing.spaced(df, 1.0, first=64).collect()) == [(s, i) for s, i, _, _ in want]
    # all pairs that are too close number some 150,000
    assert 0 < sum(edges) < 10_000


@pytest.mark.parametrize("block", [2, 64])
def test_spaced_chain(spark, block, monkeypatch):
    """A chain in order of rank, each point near the one before: few rounds where it lies in few blocks."""
    rounds = []
    write = observing.materialize
    monkeypatch.setattr(observing, "materialize", lambda df, name="t", **k: rounds.append(name) or write(df, name, **k))
    df = spark.createDataFrame([("s", i, 0.9 * i, 0.0) for i in range(40)], "scene_id string, rank int, x double, y double")
    assert sorted(x.rank for x in observing.spaced(df, 1.0, block=block).collect()) == list(range(0, 40, 2))
    assert rounds.count("spaced") <= (3 if block == 64 else 45)


def test_placement_search(spark):
    """A table with a block on it: what fits, what touches the block, what a wall hides, against plain loops over the ordered trials."""
    from tesserae.operators import placement

    tri = lambda fid, *p: ("s", fid, *(v for q in p for v in q), 1.0)
    corner = [f"{a}{k}" for k in range(3) for a in "xyz"]
    faces = [tri(1, (0.0, 0.0, 0.0), (2.0, 0.0, 0.0), (2.0, 2.0, 0.0)), tri(2, (1.0, 0.9, 0.01), (1.2, 0.9, 0.01), (1.1, 1.1, 0.3)), tri(3, (-0.2, -0.2, 0.0), (-0.2, 0.6, 0.0), (-0.2, 0.2, 3.0))]
    f = spark.createDataFrame(faces, "scene_id string, fid int, " + ", ".join(f"{c} double" for c in corner) + ", nz double")
    objects = [("o", 1, 1, [3], 0.2, 0.2, 900.0, 0.1, 0.2), ("o", 2, 2, [9, 3], 0.3, 0.1, 0.2, 0.2, 0.4), ("o", 3, 3, [3], 0.1, 0.1, 0.1, 0.1, 0.1), ("p", 4, 1, [8], 0.1, 0.1, 0.1, 0.1, 0.1)]
    o = spark.createDataFrame(objects, "observation string, uid int, turn int, classes array<int>, dx double, dy double, dz double, target_min double, target_max double")
    s = spark.createDataFrame([("o", "a", 3, 0.0, 2.0, 0.0, 2.0), ("p", "a", 3, 0.0, 2.0, 0.0, 2.0)], "observation string, patch string, class int, x_lo double, x_hi double, y_lo double, y_hi double")
    spots = [("o", "a", k, x, y, 0.0, min(x, y, 2 - x, 2 - y)) for k, (x, y) in enumerate([(0.1, 0.1), (1.1, 1.0), (0.2, 0.2), (0.5, 0.6), (1.5, 0.5), (1.9, 1.0)])]
    pts = spark.createDataFrame(spots, "observation string, patch string, point int, px double, py double, pz double, clearance double")
    eyes = spark.createDataFrame([("o", "s", -1.0, 0.2, 1.6), ("p", "s", 0.0, 0.0, 1.6)], "observation string, scene_id string, eye_x double, eye_y double, eye_z double")
    every = placement.trials(o, s, pts, 3, positions=5, yaws=4)
    got = placement.searched(every, f, eyes).collect()
    want = []
    for t in sorted(every.collect(), key=lambda t: (t.turn, t.patch_turn, t.patch, t.point_turn, t.yaw_turn)):
        scale = t.target / t.dz
        ex, ey = (scale * (abs(math.cos(t.yaw)) * p + abs(math.sin(t.yaw)) * q) for p, q in ((t.dx, t.dy), (t.dy, t.dx)))
        box = [t.px - ex / 2, t.px + ex / 2, t.py - ey / 2, t.py + ey / 2, 0.005, 0.005 + t.target]
        look = [(box[k] + box[k + 1]) / 2 for k in (0, 2, 4)]
        touches = any(all(box[2 * k] < max(c[2 + k::3][:3]) and min(c[2 + k::3][:3]) < box[2 * k + 1] for k in range(3)) for c in faces)
        eye = np.array([-1.0, 0.2, 1.6])

        def blocked(c, eye=eye, look=look):
            p = [np.array(c[2 + 3 * k : 5 + 3 * k]) for k in range(3)]
            way = np.array(look) - eye
            m = np.array([way, p[0] - p[1], p[0] - p[2]]).T
            if abs(np.linalg.det(m)) < 1e-12:
                return False
            u, v, w = np.linalg.solve(m, p[0] - eye)
            return v >= 0 and w >= 0 and v + w <= 1 and 0 <= u * np.linalg.norm(way) <= np.linalg.norm(way) - 1e-3

        reason = "scale" if scale < 0.001 else "outside" if box[0] < 0 or box[1] > 2 or box[2] < 0 or box[3] > 2 else "clearance" if t.clearance < math.hypot(ex, ey) / 2 + 0.03 else "collision" if touches else "occluded" if any(map(blocked, faces)) else ""
        want.append((t.uid, t.point, t.yaw_turn, reason))
        if not reason:
            break
    assert sorted((x.uid, x.point, x.yaw_turn, x.reason) for x in got) == sorted(want)
    assert {x[3] for x in want} >= {"scale", "outside", "clearance", "occluded", ""} or len({x[3] for x in want}) >= 4


def regions(points, box, most, side, name="r"):
    spans = [box[1] - box[0], box[3] - box[2]]
    if len(points) > most or max(spans) > side:
        for axis in (0, 1) if spans[0] >= spans[1] else (1, 0):
            values = sorted(p[axis] for p in points)
            distinct = sorted(set(values))
            if spans[axis] < 0.5 or len(distinct) < 2:
                continue
            k = next(i for i, v in enumerate(distinct) if sum(u <= v for u in values) >= len(values) // 2)
            k = min(k, len(distinct) - 2)
            cut = 0.5 * (distinct[k] + distinct[k + 1])
            if cut - box[2 * axis] < 0.25 or box[2 * axis + 1] - cut < 0.25:
                continue
            low, high = list(box), list(box)
            low[2 * axis + 1] = high[2 * axis] = cut
            return regions([p for p in points if p[axis] < cut], low, most, side, name + "0") | regions([p for p in points if p[axis] >= cut], high, most, side, name + "1")
    return {name: (len(points), *box)}


@pytest.mark.parametrize("seed", [1, 2])
def test_plan_regions(spark, seed):
    r = random.Random(seed)
    pts = [(round(r.random() * 8, 1), round(r.random() ** 3 * 6, 1)) for _ in range(300)] + [(2.0, 2.0)] * 60
    box = [f(p[a] for p in pts) for a in (0, 1) for f in (min, max)]
    want = regions(pts, box, 40, 3.0)
    got = observing.plan_regions(spark.createDataFrame([("s", *p) for p in pts] + [("t", 0.0, 0.0)], "scene string, x double, y double"), 40, 3.0).collect()
    assert {x.node: (x.n, x.x_min, x.x_max, x.y_min, x.y_max) for x in got if x.scene == "s"} == want
    assert [x.n for x in got if x.scene == "t"] == [1]


@pytest.mark.parametrize("large, rounds", [(1000, 0), (150, 2)])
def test_regions_of_few_points_are_cut_in_a_task(spark, monkeypatch, large, rounds):
    """Rounds, each of which broadcasts its cuts, are for the large regions only; results are the same, for values that are no numbers, too."""
    r, made, write = random.Random(7), [], observing.materialize
    pts = [(round(r.random() * 8, 1), round(r.random() * 6, 1)) for _ in range(500)]
    box = [f(p[a] for p in pts) for a in (0, 1) for f in (min, max)]
    monkeypatch.setattr(observing, "materialize", lambda df, name="t", **o: made.append(name) or write(df, name, **o))
    frame = lambda rows: spark.createDataFrame(rows, "scene string, x double, y double")
    rows = lambda got, s: {x.node: (x.n, x.x_min, x.x_max, x.y_min, x.y_max) for x in got if x.scene == s}
    got = observing.plan_regions(frame([("s", *p) for p in pts]), 40, 3.0, large=large).collect()
    assert rows(got, "s") == regions(pts, box, 40, 3.0)
    assert made.count("cuts") == rounds
    odd = [("n", x, None if k == 3 else y) for k, (x, y) in enumerate(pts[:90])] + [(None, *p) for p in pts[:90]]
    by_size = [sorted(map(str, observing.plan_regions(frame(odd), 40, 3.0, large=k).collect())) for k in (large, 0)]
    assert by_size[0] == by_size[1]


def test_oriented_boxes(spark):
    r = np.random.default_rng(0)
    p = r.standard_normal((500, 3)) * [5, 2, 0.5]
    q, _ = np.linalg.qr(r.standard_normal((3, 3)))
    p = p @ q
    df = spark.createDataFrame([("a", *map(float, x)) for x in p] + [("b", 1.0, 1.0, 1.0)], "k string, x double, y double, z double")
    got = {x.k: (x.e1, x.e2, x.e3) for x in instances.oriented_boxes(df, "k").collect()}
    axes = np.linalg.eigh(np.cov(p.T))[1][:, ::-1]
    assert np.allclose(got["a"], np.ptp(p @ axes, axis=0)) and np.allclose(got["b"], 0)


def test_manifest_last_line_counts(spark):
    lines = [(1, "`000-001\\a.glb`"), (2, "000-002/a.GLB"), (3, "# note"), (4, " 000-003/b.glb "), (5, "000-003/b.gltf"), (6, None)]
    got = {x.uid: (x.shard, x.path, x.n_shards) for x in catalogue.parse_manifest(spark.createDataFrame(lines, "line_no int, line string")).collect()}
    assert got == {"a": ("000-002", "000-002/a.GLB", 2), "b": ("000-003", "000-003/b.glb", 1)}


def test_inventory_strips_its_own_folder_only(spark, tmp_path):
    for name in ("x.y/in/A b.PARQUET", "x.y/x.y/in/c.parquet", "d.parquet", "e.txt"):
        at = tmp_path / "x.y" / name
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_bytes(b"1")
    got = catalogue.inventory(spark, str(tmp_path / "x.y"), ".parquet").collect()
    assert [x.rel_path for x in got] == ["d.parquet", "x.y/in/A b.PARQUET", "x.y/x.y/in/c.parquet"]
    assert got[1].scene_id.startswith("x.y__in__A_b-") and len({x.scene_id for x in got}) == 3


def test_inventory_lists_files(spark, data):
    got = {x.rel_path: x.length for x in catalogue.inventory(spark, data, ".parquet").collect()}
    assert got == {os.path.relpath(os.path.join(r, f), data): os.path.getsize(os.path.join(r, f)) for r, _, fs in os.walk(data) for f in fs if f.endswith(".parquet")}


def test_components_by_parts(spark, monkeypatch):
    """Places, chunks and their order change nothing: ids of both kinds, two scenes of equal ids, null ids, chains over many parts, and the same links as without places."""
    from pyspark.sql import functions as F

    from tesserae.operators import graph

    r = random.Random(3)
    rows = [(s, k, k + 1, k // 7) for s in "st" for k in range(200) if k % 50] + [(s, r.randrange(300), r.randrange(300), r.randrange(9)) for s in "st" for _ in range(60)] + [("s", None, 5, 1), ("t", 4, None, None), ("s", 7, 7, 1), (None, 1000, 1001, 0), (None, 1001, 1002, None)]
    e = spark.createDataFrame(rows, "scene_id string, a long, b long, place long")
    text = e.withColumns({c: F.concat(F.lit("é/"), c) for c in "ab"})
    for table, by, chunk in ((e, (), 1 << 17), (text, ("scene_id",), 5)):
        known = table.where("scene_id IS NOT NULL")
        want = sorted(map(tuple, graph.connected_components(known, "a", "b", by).collect()))
        monkeypatch.setattr(graph, "CHUNK", chunk)
        assert sorted(map(tuple, graph.connected_components(known, "a", "b", by, ("place",)).collect())) == want
    rounds = []
    real = graph._mark
    monkeypatch.setattr(graph, "CHUNK", 1 << 17)
    monkeypatch.setattr(graph, "_mark", lambda e, pair: rounds.append(real(e, pair)) or rounds[-1])
    chain = spark.range(2000).selectExpr("id AS a", "id + 1 AS b", "id div 500 AS place")
    assert [x.component for x in graph.connected_components(chain, "a", "b", (), ("place",)).select("component").distinct().collect()] == [0]
    assert rounds[0][0] <= 6
