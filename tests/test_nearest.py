"""Nearest points where some places are dense: the same as by plain loops, by cells that are finer than the radius."""

import math
import random

from tesserae.operators import spatial


def test_nearest_among_dense_points(spark, monkeypatch):
    r = random.Random(9)
    spot = lambda k: tuple(r.gauss(0, 0.05) if k % 2 else r.uniform(-2, 2) for _ in "xyz")
    ref = [(s, i, *spot(i)) for s in "ab" for i in range(300)] + [("a", 300, 0.5, 0.5, 0.5), ("a", 301, 0.5, 0.5, 0.5)]
    ask = [(s, i, *spot(i)) for s in "ab" for i in range(80)] + [("a", 80, 0.5, 0.5, 0.6)]
    want = []
    for s, i, *p in ask:
        near = min(((math.dist(p, q), j) for t, j, *q in ref if t == s), default=None)
        if near[0] < 0.7:
            want.append((s, i, near[1], round(near[0], 9)))
    rounds, write = [], spatial.materialize
    monkeypatch.setattr(spatial, "materialize", lambda df, name="t", **k: rounds.append(name) or write(df, name, **k))
    q, p = (spark.createDataFrame(x, "scene_id string, pid int, x double, y double, z double") for x in (ask, ref))
    got = spatial.nearest_within(q, p, 0.7, ("scene_id",), full=8).collect()
    assert sorted((x.scene_id, x.qid, x.pid, round(x.dist, 9)) for x in got) == sorted(want)
    assert rounds.count("nearest") >= 2
