"""Pairs met tile by tile against plain loops, and what of them is shuffled."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tesserae.operators import tiles
from tesserae.operators.graph import connected_components
from tesserae.plans import scene


def _sets(spark, n=90):
    r = random.Random(3)
    rows = [(g, m, r.randrange(3), [r.uniform(0, 3), r.uniform(0, 3)], sorted(r.sample(range(30 if m % 2 else 3000), r.randrange(1, 20)))) for g in "ab" for m in range(n)]
    df = spark.createDataFrame(rows, "scene string, id bigint, apart int, at array<double>, elements array<bigint>").withColumn("n", F.size("elements").cast("bigint"))
    return rows, df


def test_set_pairs_of_several_blocks(spark, monkeypatch):
    """Blocks of eight sets: each pair of neighbouring cells once, with its common elements, whatever blocks they are in."""
    monkeypatch.setattr(tiles, "BLOCK", 8)
    rows, df = _sets(spark)
    cells = [F.floor(F.col("at")[k]).cast("long") for k in (0, 1)]
    got = sorted((x.scene, x.a, x.b, x.na, x.nb, x.common, round(x.dist, 9)) for x in tiles.set_pairs(df, ("scene",), cells).collect())
    want = []
    for (g, i, u, p, x), (h, j, v, q, y) in itertools.combinations(rows, 2):
        if g == h and u != v and all(abs(int(s) - int(t)) <= 1 for s, t in zip(p, q)):
            want.append((g, i, j, len(x), len(y), len(set(x) & set(y)), round(sum((s - t) ** 2 for s, t in zip(p, q)) ** 0.5, 9)))
    assert got == sorted(want) and len(want) > 1000


def test_forest_connects_what_all_pairs_do(spark, monkeypatch):
    monkeypatch.setattr(tiles, "BLOCK", 16)
    _, df = _sets(spark)
    every, some = (tiles.set_pairs(df, ("scene",), least=0.12, forest=f) for f in (False, True))
    comp = lambda e: sorted((x.scene, x.node, x.component) for x in connected_components(e, "a", "b", ("scene",)).collect())
    assert comp(every) == comp(some) and some.count() < every.count()


def test_pairs_are_not_shuffled(spark):
    """Nothing is exchanged once pairs are met: what grows with their number goes straight to the output."""
    mp = spark.createDataFrame([("s", m, m % 2, 0, p, 0.5, 0.1, 0.1, 0.1) for m in range(4) for p in range(m, m + 4)], "scene_id string, mask int, view int, class int, pid int, weight double, x double, y double, z double")
    f = spark.createDataFrame([("s", 0, [1.0, 0.0])], "scene_id string, mask int, feature array<double>")
    for pairs in (scene.pair_overlap(mp), scene.scored_pairs(mp, f), scene.linking_pairs(mp, f, 0.25), scene.similar_sets(mp, 0.3, ("scene_id", "class"), apart="view")):
        plan = pairs._jdf.queryExecution().sparkPlan().toString() + pairs._jdf.queryExecution().optimizedPlan().toString()
        above = plan[: plan.index("MapInArrow")]
        assert not any(word in above for word in ("Exchange", "Join", "Aggregate"))


def _judged(path, least):
    """Pairs of enough overlap and closeness; the numbers of pairs that are asked for go to the file."""

    def keep(v):
        with open(path, "a") as f:
            f.write(f"{len(v['common'])}\n")
        return v["common"] / (v["na"] + v["nb"] - v["common"]) - v["dist"] / 5 >= least

    return keep


@pytest.mark.parametrize("block,least", [(8, 0.1), (8, 0.3), (16, 0.0), (2048, 0.1)])
def test_connections_are_those_of_all_pairs(spark, monkeypatch, tmp_path, block, least):
    """Sets of several blocks a cell, clusters that reach over cells, copies with the same and other views, sets linked to none: each is connected to what all pairs connect it to."""
    monkeypatch.setattr(tiles, "BLOCK", block)
    r = random.Random(block + int(10 * least))
    rows = []
    for g in "ab":
        for m in range(150):
            at = [r.uniform(0, 3), r.uniform(0, 1)]
            low = 40 * int(at[0] // 1.2)
            rows.append((g, m, None if m % 49 == 5 else r.randrange(3), at, sorted(r.sample(range(low, low + 45), r.randrange(1, 30)))))
        # masks of the same points, one of a number below that of its like, and one that only its like is like
        rows += [(g, 200 + k, u if k % 3 else 7, p, list(reversed(e))) for k, (_, _, u, p, e) in enumerate(x for x in rows[:40] if x[0] == g)]
        rows += [(g, -1, *rows[-1][2:]), *((g, 900 + k, 1, [2.9, 0.9], [5000]) for k in range(3))]
    df = spark.createDataFrame(rows, "scene string, id bigint, apart int, at array<double>, elements array<bigint>").withColumn("n", F.size("elements").cast("bigint"))
    cells = [F.floor(F.col("at")[k]).cast("long") for k in (0, 1)]
    keep = _judged(str(tmp_path / "n"), least)
    every = connected_components(tiles.set_pairs(df, ("scene",), cells, keep=keep), "a", "b", ("scene",)).where("node <> component")
    got = tiles.connections(df, ("scene",), cells, keep)
    want = sorted((x.scene, x.component, x.node) for x in every.collect())
    assert sorted(map(tuple, got.collect())) == want and len(want) > 20


def test_connected_sets_are_not_asked_for_again(spark, monkeypatch, tmp_path):
    """A crowded cell whose sets are all connected costs sets times a block, and copies nothing; all pairs are some 180,000."""
    monkeypatch.setattr(tiles, "BLOCK", 32)
    r = random.Random(4)
    rows = [("s", m, m % 7, [0.5, 0.5], sorted(r.sample(range(60), 40))) for m in range(300)]
    rows += [("s", 300 + m, *x[2:]) for m, x in enumerate(rows)]
    df = spark.createDataFrame(rows, "scene string, id bigint, apart int, at array<double>, elements array<bigint>").withColumn("n", F.size("elements").cast("bigint"))
    got = tiles.connections(df, ("scene",), [F.floor(F.col("at")[k]).cast("long") for k in (0, 1)], _judged(str(tmp_path / "n"), 0.3))
    assert sorted(map(tuple, got.collect())) == [("s", 0, m) for m in range(1, 600)]
    assert sum(map(int, (tmp_path / "n").read_text().split())) < 300 * 32


def test_pairs_carry_only_what_is_given(spark):
    _, df = _sets(spark, 20)
    full = {(x.scene, x.a, x.b): x for x in tiles.set_pairs(df, ("scene",)).collect()}
    got = tiles.set_pairs(df, ("scene",), give=("iou", "dist"))
    made = next(line for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "MapInArrow" in line)
    assert not any(f"{c}#" in made for c in ("na", "nb", "common", "like"))
    assert {(x.scene, x.a, x.b): (x.iou, x.dist) for x in got.collect()} == {k: (x.common / (x.na + x.nb - x.common), x.dist) for k, x in full.items()}


def test_overlaps_are_rounded_as_before(spark):
    """All overlaps of sets of 400 elements together."""
    x = spark.range(401 * 401).selectExpr("id div 401 AS p", "id % 401 AS q").where("p <= q AND q > 0").select((F.col("p") / F.col("q")).alias("c"))
    assert x.where(scene._R4("c") != scene.R(F.col("c"))).isEmpty()
