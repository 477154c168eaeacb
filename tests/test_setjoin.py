"""The prefix filter against all pairs, and masks linked at the library's own limit."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from tesserae.operators.setjoin import similar_sets
from tesserae.plans import scene


@pytest.mark.parametrize("least", [0.05, 0.18, 0.5, 1.0])
def test_similar_sets(spark, least):
    r = random.Random(5)
    sets = {}
    for g in "ab":
        for m in range(40):
            base = set(r.sample(range(60), r.randrange(1, 25))) if m < 21 else set(sets[g, m - 21]) - set(r.sample(range(60), m % 3))
            sets[g, m] = base | ({0} if m % 3 else set())
    members = spark.createDataFrame([(g, m, p, m % 4) for (g, m), s in sets.items() for p in s], "scene_id string, mask int, pid int, view int")
    got = sorted((r.scene_id, r.a, r.b, r.na, r.nb, r.common) for r in similar_sets(members, least, ("scene_id",), apart="view").collect())
    want = []
    for g in "ab":
        for a, b in itertools.combinations(range(40), 2):
            x, y = sets[g, a], sets[g, b]
            if a % 4 != b % 4 and len(x & y) / len(x | y) >= least - 1e-12:
                want.append((g, a, b, len(x), len(y), len(x & y)))
    assert got == sorted(want) and len(want) > 3


@pytest.mark.parametrize("least", [0.55, 0.7, 0.3])
def test_linked_masks_are_those_of_all_pairs(spark, least):
    """Overlapping masks about three centres, of two scenes with equal numbers; the same edges and components as by scoring all pairs."""
    r = random.Random(6)
    rows, features = [], []
    for s in ("s1", "s2"):
        places = {p: (r.random(), r.random(), r.random() * 0.3) for p in range(300)}
        for m in range(36):
            low = 100 * (m % 3) + r.randrange(40)
            own = set(range(low, low + r.randrange(20, 60))) | {299}
            rows += [(s, m, m % 5, m % 2, p, 0.5, *places[p]) for p in own if p < 300]
            features.append((s, m, [float(m % 3 == k) + 0.1 for k in range(3)]))
    mp = spark.createDataFrame(rows, "scene_id string, mask int, view int, class int, pid int, weight double, x double, y double, z double")
    f = spark.createDataFrame(features, "scene_id string, mask int, feature array<double>")
    every = scene.edge_scores(scene.pair_overlap(mp), f).where(F.col("score") >= least)
    key = lambda df: sorted((x.scene_id, x.a, x.b, round(x.iou, 9), round(x.score, 9)) for x in df.collect())
    links = scene.linked_masks(mp, f, least)
    assert key(links) == key(every) and len(key(every)) > 5
    comp = {(x.scene_id, x.mask): x.instance for x in scene.mask_components(scene.mask_heads(mp), links, least).collect()}
    parent = {k: k for k in comp}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for s, a, b, *_ in key(every):
        x, y = sorted((root((s, a)), root((s, b))))
        parent[y] = x
    assert comp == {k: root(k)[1] for k in comp} and math.isclose(0.55, scene.linked_masks.__defaults__[0])
