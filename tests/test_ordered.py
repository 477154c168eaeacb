"""Running sums, as-of merges and medians over range partitions, against plain loops; scenes whose ids are equal stay apart."""

import bisect
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tesserae.operators.graph import connected_components
from tesserae.operators.ordered import as_of, medians, prefix_sums
from tesserae.plans import mesh, observing


@pytest.fixture()
def small_ranges(spark):
    """Many small ranges, so that groups span several."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")


def test_prefix_sums(spark, small_ranges):
    r = random.Random(1)
    rows = [(r.choice("aaab"), i, r.randrange(9)) for i in range(400)]
    got = prefix_sums(spark.createDataFrame(rows, "g string, i int, w int"), ["g"], ["i"], F.col("w")).collect()
    want = [(g, i, w, sum(x[2] for x in rows if x[0] == g and x[1] < i)) for g, i, w in rows]
    assert sorted(map(tuple, got)) == sorted(want)


def test_as_of(spark, small_ranges):
    r = random.Random(2)
    marks = [(r.choice("ab"), r.randrange(40) * 25, i) for i in range(30)]
    events = [(r.choice("aabc"), r.randrange(1200), i) for i in range(300)]
    got = as_of(spark.createDataFrame(events, "g string, t int, e int"), spark.createDataFrame(marks, "g string, t int, v int"), ["g"], "t", "v").collect()

    def last(g, t):
        best = max(((u, v) for h, u, v in marks if h == g and u <= t), default=(0, None))
        return best[1]

    assert sorted(map(str, map(tuple, got))) == sorted(str((g, t, e, last(g, t))) for g, t, e in events)


@pytest.mark.parametrize("large", [1 << 20, 10, 0])
def test_medians(spark, small_ranges, large):
    r = random.Random(3)
    rows = [(g, r.randrange(50) / 4, None if r.random() < 0.1 else r.random()) for g, n in (("a", 101), ("b", 100), ("c", 1), ("d", 9)) for _ in range(n)] + [("e", 1.0, None)]
    got = {x.g: (x.n, x.x, x.y) for x in medians(spark.createDataFrame(rows, "g string, x double, y double"), ["g"], ["x", "y"], large).collect()}
    for g in "abcde":
        own = [x for x in rows if x[0] == g]
        ys = [y for _, _, y in own if y is not None]
        assert got[g] == (len(own), statistics.median(x for _, x, _ in own), statistics.median(ys) if ys else None)


def test_weighted_draws(spark, small_ranges):
    """One item with nearly all weight, as many draws as items, a scene without weight."""
    r = random.Random(4)
    items = [("s", i, r.randrange(4)) for i in range(300)] + [("s", 300, 10**12), ("s", 301, 7), ("t", 0, 3), ("t", 1, 5), ("u", 0, 0)]
    draws = [(s, k, r.random()) for k, s in enumerate(["s"] * 200 + ["t"] * 50 + ["u"] * 5)] + [("s", 900, 0.0), ("s", 901, 1 - 1e-15)]
    got = observing.weighted_draws(spark.createDataFrame(items, "scene_id string, fid int, w long"), spark.createDataFrame(draws, "scene_id string, draw int, u double")).collect()
    want = []
    for s, k, u in draws:
        own = [(i, w) for t, i, w in items if t == s and w > 0]
        ends = [sum(w for _, w in own[: n + 1]) for n in range(len(own))]
        if own:
            want.append((s, k, own[bisect.bisect_right(ends, int(u * ends[-1]))][0]))
    assert sorted(map(tuple, got)) == sorted(want)


def test_components_keep_scenes_apart(spark):
    e = spark.createDataFrame([("a", 1, 2), ("a", 2, 3), ("b", 3, 4), ("b", 1, 5)], "s string, x int, y int")
    got = {(r.s, r.node): r.component for r in connected_components(e, "x", "y", ("s",)).collect()}
    assert got == {("a", 1): 1, ("a", 2): 1, ("a", 3): 1, ("b", 3): 3, ("b", 4): 3, ("b", 1): 1, ("b", 5): 1}


def test_patches_of_two_scenes_with_equal_ids(spark):
    """Two scenes that number faces and vertices alike: a strip of two faces, and two single ones; clearances from places that no grid gives."""
    tri = lambda s, fid, v, p: (s, fid, *v, *(c for q in p for c in q))
    a, b, c, e = (0.0, 0.0, 0.0), (1.7, 0.0, 0.0), (1.7, 2.3, 0.0), (0.0, 2.3, 0.0)
    rows = [tri("s1", 1, (0, 1, 2), (a, b, c)), tri("s1", 2, (0, 2, 3), (a, c, e)), tri("s2", 1, (0, 1, 2), (a, b, c)), tri("s2", 2, (3, 4, 5), (a, c, e))]
    cols = "scene_id string, fid int, v0 int, v1 int, v2 int, " + ", ".join(f"{x}{k} double" for k in range(3) for x in "xyz")
    f = mesh.G.with_triangle_attributes(spark.createDataFrame(rows, cols)).withColumns({"semantic": F.lit(3), "instance": F.lit(0)})
    p = mesh.patches(f)
    assert {(r.scene_id, r.fid): r.patch for r in p.collect()} == {("s1", 1): 1, ("s1", 2): 1, ("s2", 1): 1, ("s2", 2): 2}
    assert {(r.scene_id, r.patch): r.n_faces for r in mesh.patch_summary(p).collect()} == {("s1", 1): 2, ("s2", 1): 1, ("s2", 2): 1}
    edges = mesh.boundary_edges(p)
    assert {(r.scene_id, r.patch): r["count"] for r in edges.groupBy("scene_id", "patch").count().collect()} == {("s1", 1): 4, ("s2", 1): 3, ("s2", 2): 3}
    got = {(r.scene_id, r.fid): r.clearance for r in mesh.clearances(mesh.candidates(p), edges).collect()}
    assert got[("s1", 1)] == pytest.approx(1.7 / 3) and got[("s1", 2)] == pytest.approx(1.7 / 3) and got[("s2", 1)] < 0.5
