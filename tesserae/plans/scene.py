"""Queries over samples, points, masks, pixels, features and metadata."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesserae.functions import geometry as G
from tesserae.operators import masks, spatial
from tesserae.operators.graph import connected_components
from tesserae.operators.ordered import medians
from tesserae.operators.setjoin import overlap, similar_sets
from tesserae.operators.tiles import connections, set_pairs
from tesserae.plans.materialize import materialize
from tesserae.sources import fixtures as X
from tesserae.sources.fixtures import BITS, MASK_POINTS, PIXELS, POINTS, SAMPLES

#: Rounded off the ties, so that both engines agree.
R = lambda c, n=4: F.round(c + 1e-9, n)
#: The same at four places for the pairs of masks, which are many: round() takes six times as long, as it goes by decimals.
_R4 = lambda c: F.rint((F.col(c) + 1e-9) * 1e4) / 1e4
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def face_semantics(samples: DataFrame, least: float = 0.45) -> DataFrame:
    """(scene_id, fid, label, confidence): each face's most frequent known label, the smallest among equals, if it has the share `least` of all samples, unknown ones (-1) included; the mean confidence of its samples. Else -1 and 0 (AGG16)."""
    s = samples.groupBy("scene_id", "fid", "label").agg(F.count("*").alias("n"), F.sum("conf").alias("s"))
    best = F.max(F.when(F.col("label") >= 0, F.struct("n", (-F.col("label")).alias("neg"), "s"))).alias("b")
    t = s.groupBy("scene_id", "fid").agg(F.sum("n").alias("total"), best)
    won = F.coalesce(F.col("b.n") / F.col("total") >= least, F.lit(False))
    return t.select("scene_id", "fid", F.when(won, -F.col("b.neg")).otherwise(-1).alias("label"), F.when(won, F.col("b.s") / F.col("b.n")).otherwise(0.0).alias("confidence"))


@query(f"""WITH {SAMPLES}, c AS (SELECT scene_id, fid, label, count(*) AS n, sum(conf) AS s FROM samples GROUP BY ALL), t AS (SELECT scene_id, fid, sum(n) AS total FROM c GROUP BY ALL),
w AS (SELECT *, row_number() OVER (PARTITION BY scene_id, fid ORDER BY n DESC, label) AS k FROM c WHERE label >= 0)
SELECT t.scene_id, t.fid, CASE WHEN n / total >= 0.45 THEN label ELSE -1 END AS label, CASE WHEN n / total >= 0.45 THEN round(s / n + 1e-9, 4) ELSE 0e0 END AS confidence FROM t LEFT JOIN w ON w.scene_id = t.scene_id AND w.fid = t.fid AND k = 1""")
def agg16_face_semantics(spark, d):
    return face_semantics(X.samples(spark, d)).withColumn("confidence", F.when(F.col("confidence") > 0, R(F.col("confidence"))).otherwise(0.0))


def face_visibility(faces: DataFrame, samples: DataFrame) -> DataFrame:
    """(scene_id, fid, visibility, core): the most views that see one of a face's samples, 0 without any; a face without a mapping is core (AGG8)."""
    seen = samples.groupBy("scene_id", "fid").agg(F.max("visible").alias("v"))
    return faces.join(seen, ["scene_id", "fid"], "left").select("scene_id", "fid", F.coalesce("v", F.lit(0)).alias("visibility"), F.coalesce("core", F.lit(True)).alias("core"))


@query(f"WITH {SAMPLES}, f AS (SELECT 's' || (o_orderkey // 1024 % 3) AS scene_id, o_orderkey // 1024 // 3 * 1024 + o_orderkey % 1024 AS fid, o_custkey % 4 <> 0 AS core FROM orders) SELECT scene_id, fid, coalesce(max(visible), 0) AS visibility, bool_and(core) AS core FROM f LEFT JOIN samples s USING (scene_id, fid) GROUP BY ALL")
def agg8_face_visibility(spark, d):
    return face_visibility(X.faces(spark, d).selectExpr("scene_id", "fid", "visibility <> 0 AS core"), X.samples(spark, d))


def instance_faces(samples: DataFrame, least: float = 0.55) -> DataFrame:
    """(scene_id, fid, owned, n): faces of whose samples an instance owns the share `least` (AGG15)."""
    return samples.groupBy("scene_id", "fid").agg(F.count_if("selected").alias("owned"), F.count("*").alias("n")).where(F.col("owned") / F.col("n") >= least)


@query(f"WITH {SAMPLES} SELECT scene_id, fid, sum(selected::INT)::BIGINT AS owned, count(*) AS n FROM samples GROUP BY scene_id, fid HAVING sum(selected::INT) / count(*) >= 0.55")
def agg15_instance_face_vote(spark, d):
    return instance_faces(X.samples(spark, d))


def face_instances(claims: DataFrame) -> DataFrame:
    """(scene_id, fid, instance, confidence): the claim (scene_id, fid, instance, conf) of the highest confidence as a 32-bit number, the lowest instance among equals (AGG17)."""
    best = claims.groupBy("scene_id", "fid").agg(F.max(F.struct(F.col("conf").cast("float").alias("c"), (-F.col("instance")).alias("i"))).alias("b"))
    return best.select("scene_id", "fid", (-F.col("b.i")).alias("instance"), F.col("b.c").cast("double").alias("confidence"))


@query(f"WITH {SAMPLES}, r AS (SELECT scene_id, fid, instance, conf::FLOAT AS conf, row_number() OVER (PARTITION BY scene_id, fid ORDER BY conf::FLOAT DESC, instance) AS k FROM samples) SELECT scene_id, fid, instance, round(conf::DOUBLE + 1e-9, 4) AS confidence FROM r WHERE k = 1")
def agg17_face_instance_conflict(spark, d):
    return face_instances(X.samples(spark, d)).withColumn("confidence", R(F.col("confidence")))


@query(f"WITH {POINTS}, q AS (SELECT * FROM points WHERE is_query), r AS (SELECT * FROM points WHERE NOT is_query), j AS (SELECT q.scene_id, q.pid AS qid, r.pid, sqrt((q.x - r.x) * (q.x - r.x) + (q.y - r.y) * (q.y - r.y) + (q.z - r.z) * (q.z - r.z)) AS dist FROM q JOIN r ON q.scene_id = r.scene_id AND abs(q.x - r.x) < 0.2 AND abs(q.y - r.y) < 0.2 AND abs(q.z - r.z) < 0.2), k AS (SELECT *, row_number() OVER (PARTITION BY scene_id, qid ORDER BY dist, pid) AS k FROM j WHERE dist < 0.2) SELECT scene_id, qid, pid, round(dist + 1e-9, 4) AS dist FROM k WHERE k = 1")
def joi8_nearest_point(spark, d):
    p = X.points(spark, d)
    return spatial.nearest_within(p.where("is_query"), p.where("NOT is_query"), 0.2, ("scene_id",)).select("scene_id", "qid", "pid", R(F.col("dist")).alias("dist"))


def point_visibility(pixels: DataFrame, points: DataFrame, radius: float, stride: int = 2) -> DataFrame:
    """(scene_id, pid, n_views): views in which a point is the nearest to some pixel, of every stride-th row and column (AGG7).

    pixels: (scene_id, pid, view, row, col, x, y, z); points: (scene_id, pid, x, y, z). Points that no view sees have no row.
    """
    some = pixels.where((F.col("row") % stride == 0) & (F.col("col") % stride == 0))
    near = spatial.nearest_within(some, points, radius, ("scene_id",)).select("scene_id", "qid", F.col("pid").alias("rid"))
    seen = near.join(some.select("scene_id", F.col("pid").alias("qid"), "view"), ["scene_id", "qid"])
    return seen.groupBy("scene_id", F.col("rid").alias("pid")).agg(F.countDistinct("view").alias("n_views"))


@query(f"WITH {POINTS}, q AS (SELECT *, pid % 7 AS row, pid // 7 % 5 AS col FROM points WHERE is_query), r AS (SELECT * FROM points WHERE NOT is_query), j AS (SELECT q.scene_id, q.view, q.pid AS qid, r.pid, sqrt((q.x - r.x) * (q.x - r.x) + (q.y - r.y) * (q.y - r.y) + (q.z - r.z) * (q.z - r.z)) AS dist FROM q JOIN r ON q.scene_id = r.scene_id AND row % 2 = 0 AND col % 2 = 0 AND abs(q.x - r.x) < 0.2 AND abs(q.y - r.y) < 0.2 AND abs(q.z - r.z) < 0.2), k AS (SELECT *, row_number() OVER (PARTITION BY scene_id, qid ORDER BY dist, pid) AS k FROM j WHERE dist < 0.2) SELECT scene_id, pid, count(DISTINCT view) AS n_views FROM k WHERE k = 1 GROUP BY scene_id, pid")
def agg7_point_visibility(spark, d):
    p = X.points(spark, d)
    pixels = p.where("is_query").withColumns({"row": F.expr("pid % 7"), "col": F.expr("pid div 7 % 5")})
    return point_visibility(pixels, p.where("NOT is_query"), 0.2)


_VOXEL = """v0 AS (SELECT scene_id, min(x) AS mx, min(y) AS my, min(z) AS mz FROM points GROUP BY scene_id), v AS (SELECT p.*, floor((x - mx) / 0.5)::BIGINT AS gx, floor((y - my) / 0.5)::BIGINT AS gy, floor((z - mz) / 0.5)::BIGINT AS gz FROM points p JOIN v0 USING (scene_id)),
vx AS (SELECT scene_id, gx, gy, gz, min(pid) AS first_pid, count(*) AS n, arg_min(x, pid) AS x, arg_min(y, pid) AS y, arg_min(z, pid) AS z, avg(r) / 127.5e0 - 1 AS r, avg(g) / 127.5e0 - 1 AS g, avg(b) / 127.5e0 - 1 AS b FROM v GROUP BY scene_id, gx, gy, gz),
vc AS (SELECT scene_id, avg(x) AS ax, avg(y) AS ay, avg(z) AS az FROM vx GROUP BY scene_id)"""


def voxels(p: DataFrame, size: float = 0.5) -> DataFrame:
    """Points with their voxel (gx, gy, gz), counted from their scene's least corner (AGG4)."""
    low = p.groupBy("scene_id").agg(*(F.min(a).alias(f"m{a}") for a in "xyz"))
    return p.join(low, "scene_id").select(*p.columns, *(F.floor((F.col(a) - F.col(f"m{a}")) / size).cast("long").alias(f"g{a}") for a in "xyz"))


def voxel_points(v: DataFrame) -> DataFrame:
    """One row for each voxel: its first point's place, centred on the scene's mean of them, and mean colours from -1 to 1 (AGG4)."""
    first = F.min(F.struct("pid", "x", "y", "z")).alias("f")
    g = v.groupBy("scene_id", "gx", "gy", "gz").agg(first, F.count("*").alias("n"), *((F.avg(c) / 127.5 - 1).alias(c) for c in "rgb")).select("scene_id", "gx", "gy", "gz", F.col("f.pid").alias("first_pid"), "n", *(F.col(f"f.{a}").alias(a) for a in "xyz"), "r", "g", "b")
    mean = g.groupBy("scene_id").agg(*(F.avg(a).alias(f"a{a}") for a in "xyz"))
    return g.join(mean, "scene_id").select("scene_id", "gx", "gy", "gz", "first_pid", "n", *((F.col(a) - F.col(f"a{a}")).alias(a) for a in "xyz"), "r", "g", "b")


@query(f"WITH {POINTS}, {_VOXEL} SELECT scene_id, gx, gy, gz, first_pid, n, round(x - ax + 1e-9, 4) + 0e0 AS x, round(y - ay + 1e-9, 4) + 0e0 AS y, round(z - az + 1e-9, 4) + 0e0 AS z, round(r + 1e-9, 4) + 0e0 AS r, round(g + 1e-9, 4) + 0e0 AS g, round(b + 1e-9, 4) + 0e0 AS b FROM vx JOIN vc USING (scene_id)")
def agg4_voxels(spark, d):
    v = voxel_points(voxels(X.points(spark, d)))
    return v.select("scene_id", "gx", "gy", "gz", "first_pid", "n", *((R(F.col(c)) + 0.0).alias(c) for c in "xyzrgb"))


@query(f"WITH {POINTS}, {_VOXEL} SELECT scene_id, pid, min(pid) OVER (PARTITION BY scene_id, gx, gy, gz) AS first_pid FROM v")
def agg5_voxel_back_projection(spark, d):
    v = voxels(X.points(spark, d)).select("scene_id", "pid", "gx", "gy", "gz")
    return v.join(voxel_points(voxels(X.points(spark, d))).select("scene_id", "gx", "gy", "gz", "first_pid"), ["scene_id", "gx", "gy", "gz"]).select("scene_id", "pid", "first_pid")


def occupied_targets(p: DataFrame, size: float = 5.0, least: int = 8, large: int = 1 << 20) -> DataFrame:
    """(scene_id, gx, gy, n, x, y, z): medians of XY cells, counted from the scene's least corner, with enough points; a scene without any has its centre, without a cell. Cells with more than `large` points take medians by selection (AGG22)."""
    box = p.groupBy("scene_id").agg(F.count("*").alias("all"), *(g for a in "xyz" for g in (F.min(a).alias(f"{a}_min"), F.max(a).alias(f"{a}_max"))))
    at = p.join(box.select("scene_id", "x_min", "y_min"), "scene_id").withColumns({f"g{a}": F.floor((F.col(a) - F.col(f"{a}_min")) / size).cast("long") for a in "xy"})
    cells = medians(at, ["scene_id", "gx", "gy"], ["x", "y", "z"], large).where(F.col("n") >= least)
    none = F.lit(None).cast("long")
    rest = box.join(cells.select("scene_id").distinct(), "scene_id", "left_anti").select("scene_id", none.alias("gx"), none.alias("gy"), F.col("all").alias("n"), *(((F.col(f"{a}_min") + F.col(f"{a}_max")) / 2).alias(a) for a in "xyz"))
    return cells.unionByName(rest)


@query(f"""WITH {POINTS}, pp AS (SELECT * FROM points UNION ALL SELECT 'sparse', pid, x, y, z, r, g, b, view, is_query FROM points WHERE pid < 3), bx AS (SELECT scene_id, count(*) AS n, min(x) AS mx, max(x) AS nx, min(y) AS my, max(y) AS ny, min(z) AS mz, max(z) AS nz FROM pp GROUP BY scene_id),
c AS (SELECT scene_id, floor((x - mx) / 1)::BIGINT AS gx, floor((y - my) / 1)::BIGINT AS gy, count(*) AS n, median(x) AS x, median(y) AS y, median(z) AS z FROM pp JOIN bx USING (scene_id) GROUP BY ALL HAVING count(*) >= 8), a AS (SELECT * FROM c UNION ALL SELECT scene_id, NULL, NULL, n, (mx + nx) / 2, (my + ny) / 2, (mz + nz) / 2 FROM bx WHERE scene_id NOT IN (SELECT scene_id FROM c))
SELECT scene_id, coalesce(gx, -1) AS gx, coalesce(gy, -1) AS gy, n, round(x + 1e-9, 4) AS x, round(y + 1e-9, 4) AS y, round(z + 1e-9, 4) AS z FROM a""")
def agg22_occupied_cells(spark, d):
    p = X.points(spark, d)
    t = occupied_targets(p.unionByName(p.where("pid < 3").withColumn("scene_id", F.lit("sparse"))), 1.0)
    return t.select("scene_id", F.coalesce("gx", F.lit(-1).cast("long")).alias("gx"), F.coalesce("gy", F.lit(-1).cast("long")).alias("gy"), "n", *(R(F.col(a)).alias(a) for a in "xyz"))


_HEAD = "h AS (SELECT scene_id, mask, min(view) AS view, min(class) AS class, count(*) AS n, avg(x) AS x, avg(y) AS y, avg(z) AS z, max(weight) AS score FROM mask_points GROUP BY scene_id, mask)"


def lifted_points(near: DataFrame, radius: float) -> DataFrame:
    """(scene_id, mask, pid, weight): each mask's points, weighted by their nearest pixel as exp(-(dist/radius)^2) (AGG6); near: (scene_id, mask, pid, dist)."""
    share = F.col("dist") / max(radius, 1e-8)
    return near.groupBy("scene_id", "mask", "pid").agg(F.max(F.exp(-share * share)).alias("weight"))


def mask_heads(mp: DataFrame, *more: Column) -> DataFrame:
    """One row for each lifted mask: view, class, size, centroid, score (AGG6), and `more` aggregates of its points."""
    return mp.groupBy("scene_id", "mask").agg(F.min("view").alias("view"), F.min("class").alias("class"), F.count("*").alias("n"), *(F.avg(a).alias(a) for a in "xyz"), F.max("weight").alias("score"), *more)


@query(f"WITH {MASK_POINTS}, {_HEAD} SELECT scene_id, mask, view, class, n, round(x + 1e-9, 4) AS x, round(y + 1e-9, 4) AS y, round(z + 1e-9, 4) AS z FROM h")
def agg6_mask_centroids(spark, d):
    return mask_heads(X.mask_points(spark, d)).select("scene_id", "mask", "view", "class", "n", *(R(F.col(a)).alias(a) for a in "xyz"))


@query("WITH n AS (SELECT 's' || (l_suppkey % 3) AS scene_id, l_suppkey // 3 * 8 + l_linenumber AS mask, l_partkey % 200 AS pid, l_quantity::DOUBLE / 1000 AS dist FROM lineitem) SELECT scene_id, mask, pid, round(max(exp(-(dist / 0.035e0) * (dist / 0.035e0))) + 1e-9, 4) AS weight FROM n GROUP BY scene_id, mask, pid")
def agg6_point_weights(spark, d):
    near = X.read(spark, d, "lineitem").selectExpr("concat('s', l_suppkey % 3) AS scene_id", "l_suppkey div 3 * 8 + l_linenumber AS mask", "l_partkey % 200 AS pid", "CAST(l_quantity AS DOUBLE) / 1000 AS dist")
    return lifted_points(near, 0.035).select("scene_id", "mask", "pid", R(F.col("weight")).alias("weight"))


_PAIRS = "pr AS (SELECT a.scene_id, a.mask AS a, b.mask AS b, a.n AS na, b.n AS nb, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)) AS dist FROM h a JOIN h b ON a.scene_id = b.scene_id AND a.class = b.class AND a.view <> b.view AND a.mask < b.mask AND abs(floor(a.x / 0.5) - floor(b.x / 0.5)) <= 1 AND abs(floor(a.y / 0.5) - floor(b.y / 0.5)) <= 1 AND abs(floor(a.z / 0.5) - floor(b.z / 0.5)) <= 1)"


def _mask_sets(h: DataFrame, size: float) -> tuple[DataFrame, list]:
    """Masks as sets with their places, and the cells that these lie in."""
    sets = h.withColumnsRenamed({"mask": "id", "view": "apart"}).withColumn("at", F.array("x", "y", "z"))
    return sets, [spatial.cell(k, size) for k in "xyz"]


def mask_pairs(h: DataFrame, size: float = 0.5, give: tuple[str, ...] = ("na", "nb", "dist")) -> DataFrame:
    """Pairs of masks of one scene and class, seen from different views, with centroids in neighbouring cells, and what is given of each (JOI10)."""
    sets, cells = _mask_sets(h.withColumn("elements", F.array().cast("array<bigint>")), size)
    return set_pairs(sets, ("scene_id", "class"), cells, give=give).select("scene_id", "a", "b", *give)


@query(f"WITH {MASK_POINTS}, {_HEAD}, {_PAIRS} SELECT scene_id, a, b, round(dist + 1e-9, 4) AS dist FROM pr")
def joi10_mask_pairs(spark, d):
    return mask_pairs(mask_heads(X.mask_points(spark, d)), give=("dist",)).select("scene_id", "a", "b", _R4("dist").alias("dist"))


_IOU = """io AS (SELECT pr.scene_id, pr.a, pr.b, any_value(na) AS na, any_value(nb) AS nb, any_value(dist) AS dist, count(q.pid) AS common FROM pr JOIN mask_points p ON p.scene_id = pr.scene_id AND p.mask = pr.a LEFT JOIN mask_points q ON q.scene_id = pr.scene_id AND q.mask = pr.b AND q.pid = p.pid GROUP BY pr.scene_id, pr.a, pr.b),
sc AS (SELECT scene_id, a, b, dist, common / (na + nb - common) AS iou FROM io)"""
#: Vectors go to three scenes in turn and are the features of the masks of their number; other masks have none.
_EDGE = """ft AS (SELECT 's' || (vec_id % 3) AS scene_id, vec_id // 3 AS mask, embedding FROM embeddings), es AS (SELECT sc.*, 0.55e0 * iou + 0.2e0 * greatest(0e0, 1 - dist / 0.5) + 0.25e0 * greatest(0e0, coalesce(list_sum(list_transform(list_zip(e.embedding, g.embedding), lambda z: z[1]::DOUBLE * z[2]::DOUBLE)) / sqrt(list_sum(list_transform(e.embedding, lambda z: z::DOUBLE * z::DOUBLE)) * list_sum(list_transform(g.embedding, lambda z: z::DOUBLE * z::DOUBLE))), 0e0)) AS score FROM sc LEFT JOIN ft e ON e.scene_id = sc.scene_id AND e.mask = sc.a LEFT JOIN ft g ON g.scene_id = sc.scene_id AND g.mask = sc.b)"""


def _elements() -> Column:
    """A mask's points."""
    return F.collect_list("pid").alias("elements")


def _point_sets(h: DataFrame, features: DataFrame | None, size: float) -> tuple[DataFrame, list]:
    """_mask_sets() of heads with their points (elements), and the feature of each mask."""
    if features is not None:
        h = h.join(features.select("scene_id", "mask", F.col("feature").cast("array<double>").alias("feature")), ["scene_id", "mask"], "left")
    return _mask_sets(h, size)


def pair_overlap(mp: DataFrame, size: float = 0.5, features: DataFrame | None = None, give: tuple[str, ...] = ("dist", "iou", "like"), **which) -> DataFrame:
    """(scene_id, a, b, dist, iou, like), or those of the last three that are to be given, of the pairs of mask_pairs() (AGG9); pairs that share no point have an overlap of 0.

    like: cosine of the features (scene_id, mask, feature) of both masks, null if one has none. Points travel with their mask and are
    counted tile by tile, so that pairs leave a task whole. which: the pairs that set_pairs() is to keep.
    """
    sets, cells = _point_sets(mask_heads(mp, _elements()), features, size)
    return set_pairs(sets, ("scene_id", "class"), cells, give=give, **which).select("scene_id", "a", "b", *give)


def _score(iou, dist, like, reach: float, floor: Callable):
    """The score of a pair, of columns or of arrays; floor: what is below 0 made 0."""
    return 0.55 * iou + 0.2 * floor(1 - dist / reach) + 0.25 * floor(like)


def _positive(c: Column) -> Column:
    return F.greatest(F.lit(0.0), c)


def edge_scores(pairs: DataFrame, features: DataFrame, reach: float = 0.5) -> DataFrame:
    """pairs with their score of overlap, closeness and likeness (AGG11); features: (scene_id, mask, feature), a mask without one is like no other (GEO3)."""
    f = lambda k: features.select("scene_id", F.col("mask").alias(k), F.col("feature").alias(f"f{k}"))
    j = pairs.join(f("a"), ["scene_id", "a"], "left").join(f("b"), ["scene_id", "b"], "left")
    like = F.coalesce(G.cosine(F.col("fa"), F.col("fb")), F.lit(0.0))
    return j.withColumn("score", _score(F.col("iou"), F.col("dist"), like, reach, _positive)).drop("fa", "fb")


def scored_pairs(mp: DataFrame, features: DataFrame, size: float = 0.5) -> DataFrame:
    """edge_scores() of all pairs of pair_overlap(), without a join of the pairs (AGG11)."""
    like = F.coalesce(F.col("like"), F.lit(0.0))
    return pair_overlap(mp, size, features).withColumn("score", _score(F.col("iou"), F.col("dist"), like, size, _positive)).drop("like")


def _links(least: float, size: float) -> Callable[[dict], np.ndarray]:
    """Which pairs of a tile score `least` or more at six places."""

    def linked(v: dict) -> np.ndarray:
        s = _score(v["common"] / (v["na"] + v["nb"] - v["common"]), v["dist"], np.nan_to_num(v["like"]), size, lambda x: np.maximum(0.0, x))
        # what R() rounds to `least` or more
        return s + 1e-9 >= least - 5e-7

    return linked


def linking_pairs(mp: DataFrame, features: DataFrame, least: float, size: float = 0.5) -> DataFrame:
    """(scene_id, a, b): of the pairs that score `least` or more at six places as many as connect the same masks (ITR3). A task hands on fewer for a tile than it has masks, however many are linked."""
    return pair_overlap(mp, size, features, (), keep=_links(least, size), forest=True).select("scene_id", "a", "b")


def connected_masks(heads: DataFrame, features: DataFrame, least: float, size: float = 0.5) -> DataFrame:
    """(scene_id, a, b): each mask b that linking_pairs() connects to others, and the smallest of these, a; heads: mask_heads() with the points as `elements`. Pairs of masks that are known to be connected are not scored (ITR3)."""
    sets, cells = _point_sets(heads, features, size)
    return connections(sets, ("scene_id", "class"), cells, _links(least, size)).select("scene_id", "a", "b")


def linked_masks(mp: DataFrame, features: DataFrame, least: float = 0.55, size: float = 0.5) -> DataFrame:
    """(scene_id, a, b, dist, iou, score): pairs of mask_pairs() that score `least` or more (JOI10, AGG9, AGG11).

    Closeness and likeness give 0.45 at most, so a pair needs an overlap of (least - 0.45) / 0.55: above 0, only
    pairs that reach it leave a task. At a lower limit pairs without a common point may be
    linked, and all pairs of neighbouring cells are scored.
    """
    need = (least - 0.45) / 0.55
    if need <= 0:
        return scored_pairs(mp, features, size).where(F.col("score") >= least)
    met = similar_sets(mp, need, ("scene_id", "class"), apart="view")
    h = lambda s: mask_heads(mp).select("scene_id", F.col("mask").alias(s), *(F.col(k).alias(f"{k}{s}") for k in "xyz"))
    j = met.join(h("a"), ["scene_id", "a"]).join(h("b"), ["scene_id", "b"])
    near = [F.abs(spatial.cell(f"{k}a", size) - spatial.cell(f"{k}b", size)) <= 1 for k in "xyz"]
    d = F.sqrt(sum((F.col(f"{k}a") - F.col(f"{k}b")) * (F.col(f"{k}a") - F.col(f"{k}b")) for k in "xyz"))
    pairs = j.where(near[0] & near[1] & near[2]).select("scene_id", "a", "b", d.alias("dist"), overlap().alias("iou"))
    return edge_scores(pairs, features, size).where(F.col("score") >= least)


@query(f"WITH {MASK_POINTS}, h AS (SELECT scene_id, class, view, mask, count(*) AS n FROM mask_points GROUP BY ALL), c AS (SELECT scene_id, class, p.mask AS a, q.mask AS b, count(*) AS common FROM mask_points p JOIN mask_points q USING (scene_id, class, pid) WHERE p.mask < q.mask AND p.view <> q.view GROUP BY ALL) SELECT scene_id, class, a, b, common, round(common / (x.n + y.n - common) + 1e-9, 4) AS iou FROM c JOIN h x USING (scene_id, class) JOIN h y USING (scene_id, class) WHERE x.mask = a AND y.mask = b AND common >= 0.3 * (x.n + y.n - common)")
def joi10_similar_masks(spark, d):
    """Pairs of masks whose overlap is 0.3 or more, wherever they are, counted tile by tile (JOI10, AGG9)."""
    return similar_sets(X.mask_points(spark, d), 0.3, ("scene_id", "class"), apart="view").select("scene_id", "class", "a", "b", "common", R(overlap()).alias("iou"))


def _features(spark, d) -> DataFrame:
    return X.read(spark, d, "embeddings").selectExpr("concat('s', vec_id % 3) AS scene_id", "vec_id div 3 AS mask", "embedding AS feature")


@query(f"WITH {MASK_POINTS}, {_HEAD}, {_PAIRS}, {_IOU} SELECT scene_id, a, b, round(iou + 1e-9, 4) AS iou FROM sc")
def agg9_pair_overlap(spark, d):
    return pair_overlap(X.mask_points(spark, d), give=("iou",)).select("scene_id", "a", "b", _R4("iou").alias("iou"))


@query(f"WITH {MASK_POINTS}, {_HEAD}, {_PAIRS}, {_IOU}, {_EDGE} SELECT scene_id, a, b, round(score + 1e-9, 4) AS score FROM es")
def agg11_edge_scores(spark, d):
    return scored_pairs(X.mask_points(spark, d), _features(spark, d)).select("scene_id", "a", "b", _R4("score").alias("score"))


#: At 0.55 no pair of the bound tables is linked, so the queries pass another limit.
_LEAST = 0.25
_COMP = f"{MASK_POINTS}, {_HEAD}, {_PAIRS}, {_IOU}, {_EDGE}, ed AS (SELECT scene_id, a, b FROM es WHERE round(score + 1e-9, 6) >= {_LEAST} UNION SELECT scene_id, b, a FROM es WHERE round(score + 1e-9, 6) >= {_LEAST}), rc AS (SELECT scene_id, mask, mask AS root FROM h UNION SELECT ed.scene_id, ed.b, r.root FROM rc r JOIN ed ON ed.scene_id = r.scene_id AND ed.a = r.mask WHERE r.root < ed.b), cp AS (SELECT scene_id, mask, min(root) AS instance FROM rc GROUP BY scene_id, mask)"


def mask_components(heads: DataFrame, edges: DataFrame, least: float = 0.55) -> DataFrame:
    """heads with the instance that each mask belongs to: its component over edges of its scene that score at least `least` (ITR3)."""
    comp = connected_components(edges.where(F.col("score") >= least), "a", "b", ("scene_id",)).withColumnRenamed("node", "mask")
    return heads.join(comp, ["scene_id", "mask"], "left").withColumn("instance", F.coalesce("component", "mask")).drop("component")


def merged_instances(masks_: DataFrame, mp: DataFrame, min_views: int = 2, min_points: int = 50) -> DataFrame:
    """Each scene's instances: class, views, score weighted by points, number of distinct points and smallest point; few views or points drop it (AGG12, SET2)."""
    key = ["scene_id", "instance"]
    g = masks_.groupBy(*key).agg(F.min("class").alias("class"), F.countDistinct("view").alias("n_views"), (F.sum(F.col("score") * F.col("n")) / F.sum("n")).alias("score"))
    pts = mp.select("scene_id", "mask", "pid").join(masks_.select("scene_id", "mask", "instance"), ["scene_id", "mask"]).select(*key, "pid").distinct().groupBy(*key).agg(F.count("*").alias("n_points"), F.min("pid").alias("first_point"))
    return g.join(pts, key).where((F.col("n_views") >= min_views) & (F.col("n_points") >= min_points))


def _instances(spark, d) -> tuple[DataFrame, DataFrame]:
    """The points of each mask, and the masks with their instance."""
    h = materialize(mask_heads(X.mask_points(spark, d), _elements()), "mask-heads")
    e = connected_masks(h, _features(spark, d), _LEAST).withColumn("score", F.lit(_LEAST))
    return h.select("scene_id", "mask", F.explode("elements").alias("pid")), mask_components(h.drop("elements"), e, _LEAST)


@query(f"WITH RECURSIVE {_COMP} SELECT scene_id, mask, instance FROM cp")
def itr3_mask_components(spark, d):
    return _instances(spark, d)[1].select("scene_id", "mask", "instance")


@query(f"WITH RECURSIVE {_COMP}, j AS (SELECT instance, h.* FROM h JOIN cp USING (scene_id, mask)), pt AS (SELECT scene_id, instance, count(DISTINCT pid) AS n_points, min(pid) AS first_point FROM mask_points JOIN cp USING (scene_id, mask) GROUP BY scene_id, instance) SELECT scene_id, instance, any_value(class) AS class, count(DISTINCT view) AS n_views, round(sum(score * n) / sum(n) + 1e-9, 4) AS score, any_value(n_points) AS n_points, any_value(first_point) AS first_point FROM j JOIN pt USING (scene_id, instance) GROUP BY scene_id, instance HAVING count(DISTINCT view) >= 2 AND any_value(n_points) >= 50")
def agg12_instances(spark, d):
    mp, m = _instances(spark, d)
    return merged_instances(m, mp).withColumn("score", R(F.col("score")))


_POSE = "cams AS (SELECT n_nationkey AS view, radians(n_nationkey * 15e0) AS t, n_nationkey * 0.5e0 AS px, n_nationkey * 0.25e0 AS py, 1.6e0 AS pz FROM nation)"


def _views(spark, d) -> DataFrame:
    """Cameras turned about Z, as row-major 4x4 matrices."""
    turn = "array(cos(t), -sin(t), 0e0, px, sin(t), cos(t), 0e0, py, 0e0, 0e0, 1e0, pz, 0e0, 0e0, 0e0, 1e0)"
    v = X.read(spark, d, "nation").selectExpr("n_nationkey AS view", "radians(n_nationkey * 15e0) AS t", "n_nationkey * 0.5e0 AS px", "n_nationkey * 0.25e0 AS py", "1.6e0 AS pz")
    return v.selectExpr("view", "64e0 AS fx", "64e0 AS fy", "32e0 AS cx", "32e0 AS cy", f"{turn} AS camera_to_world")


def unprojected(pixels: DataFrame, views: DataFrame) -> DataFrame:
    """pixels (view, row, col, dist) with their world places x, y, z; those without a finite positive distance or a camera have none (GEO7).

    views: ([scene_id,] view, fx, fy, cx, cy, camera_to_world); a table of cameras, which Spark broadcasts if it is small.
    """
    key = [c for c in ("scene_id", "view") if c in views.columns]
    seen = pixels.where((F.col("dist") > 0) & (F.col("dist") < float("inf"))).join(views, key)
    x, y, z = G.unproject(*(F.col(c) for c in ("row", "col", "dist", "fx", "fy", "cx", "cy")))
    m = F.col("camera_to_world")
    out = {a: m[4 * i] * x + m[4 * i + 1] * y + m[4 * i + 2] * z + m[4 * i + 3] for i, a in enumerate("xyz")}
    return seen.withColumns(out).select(*pixels.columns, "x", "y", "z")


@query(f"""WITH {PIXELS}, {_POSE}, r AS (SELECT *, (col + 0.5e0 - 32) / 64 AS rx, -(row + 0.5e0 - 32) / 64 AS ry FROM pixels WHERE dist > 0), n AS (SELECT view, row, col, rx / sqrt(rx * rx + ry * ry + 1) * dist AS x, ry / sqrt(rx * rx + ry * ry + 1) * dist AS y, -1e0 / sqrt(rx * rx + ry * ry + 1) * dist AS z FROM r),
w AS (SELECT view, row, col, cos(t) * x - sin(t) * y + px AS x, sin(t) * x + cos(t) * y + py AS y, z + pz AS z FROM n JOIN cams USING (view)) SELECT view, row, col, count(*) AS n, round(min(x) + 1e-9, 4) + 0e0 AS x, round(min(y) + 1e-9, 4) + 0e0 AS y, round(min(z) + 1e-9, 4) + 0e0 AS z FROM w GROUP BY view, row, col""")
def geo7_unproject(spark, d):
    p = unprojected(X.pixels(spark, d).select("view", "row", "col", "dist"), _views(spark, d))
    return p.groupBy("view", "row", "col").agg(F.count("*").alias("n"), *((R(F.min(a)) + 0.0).alias(a) for a in "xyz"))


def lifted_masks(masks_: DataFrame, depth: DataFrame, cameras: DataFrame, points: DataFrame, radius: float) -> DataFrame:
    """(scene_id, mask, pid, weight): the scene's points that each mask holds, from its run lists, the view's depths and camera (JOI9, GEO7, JOI8, AGG6).

    masks_: (scene_id, mask, view, height, rle); depth: (scene_id, view, row, col, dist), a raster a view;
    cameras: see unprojected(); points: (scene_id, pid, x, y, z). A pixel that several masks hold is placed and
    looks for its nearest point once. Views with problems are for masks.view_problems().
    """
    key = ["scene_id", "view", "row", "col"]
    seen = materialize(masks.seen_pixels(masks_, depth), "lifted-pixels")
    at = unprojected(seen.select(*key, "dist").distinct(), cameras).withColumn("pid", F.struct("view", "row", "col"))
    near = spatial.nearest_within(at, points, radius, ("scene_id",)).select("scene_id", "qid.*", "pid", F.col("dist").alias("away"))
    met = seen.join(near, key).select("scene_id", "mask", "pid", F.col("away").alias("dist"))
    return lifted_points(met, radius)


_MASKS = """ml AS (SELECT 's' || (mask % 3) AS scene_id, mask, 1 + mask % 7 AS view, idx % 8 AS row, idx // 8 AS col FROM bits WHERE bit = 1), dp AS (SELECT 's' || (oid % 3) AS scene_id, view, row, col, min(dist) AS dist FROM pixels GROUP BY ALL)"""


@query(f"""WITH {BITS}, {PIXELS}, {POINTS}, {_POSE}, {_MASKS}, s AS (SELECT *, (col + 0.5e0 - 32) / 64 AS rx, -(row + 0.5e0 - 32) / 64 AS ry FROM ml JOIN dp USING (scene_id, view, row, col) WHERE dist > 0), l AS (SELECT *, rx / sqrt(rx * rx + ry * ry + 1) * dist AS lx, ry / sqrt(rx * rx + ry * ry + 1) * dist AS ly, -1e0 / sqrt(rx * rx + ry * ry + 1) * dist AS lz FROM s),
w AS (SELECT scene_id, mask, row, col, cos(t) * lx - sin(t) * ly + px AS wx, sin(t) * lx + cos(t) * ly + py AS wy, lz + pz AS wz FROM l JOIN cams USING (view)), j AS (SELECT w.*, p.pid, sqrt((wx - x) * (wx - x) + (wy - y) * (wy - y) + (wz - z) * (wz - z)) AS away FROM w JOIN points p ON w.scene_id = p.scene_id AND abs(wx - x) < 1 AND abs(wy - y) < 1 AND abs(wz - z) < 1),
k AS (SELECT *, row_number() OVER (PARTITION BY scene_id, mask, row, col ORDER BY away, pid) AS k FROM j WHERE away < 1) SELECT scene_id, mask, pid, round(max(exp(-(away * away))) + 1e-9, 4) AS weight FROM k WHERE k = 1 GROUP BY scene_id, mask, pid""")
def joi9_lifted_masks(spark, d):
    """Masks of 8 rows lifted onto the scenes' points within 1 (JOI9, AGG6)."""
    m = masks.encode_runs(X.mask_bits(spark, d)).selectExpr("concat('s', mask % 3) AS scene_id", "mask", "1 + mask % 7 AS view", "CAST(8 AS BIGINT) AS height", "rle")
    depth = X.pixels(spark, d).groupBy(F.expr("concat('s', oid % 3)").alias("scene_id"), "view", "row", "col").agg(F.min("dist").alias("dist"))
    return lifted_masks(m, depth, _views(spark, d), X.points(spark, d), 1.0).withColumn("weight", R(F.col("weight")))


@query("SELECT p_partkey AS view, round((p_size + 100) * 0.5e0 / tan(radians(60e0) / 2) + 1e-9, 4) AS fx, round((p_size + 50) * 0.5e0 / tan(radians(45e0) / 2) + 1e-9, 4) AS fy, (p_size + 100) / 2e0 AS cx, (p_size + 50) / 2e0 AS cy FROM part")
def geo8_intrinsics(spark, d):
    w, h = F.col("p_size") + 100, F.col("p_size") + 50
    fx, fy, cx, cy = G.intrinsics(w, F.lit(60.0), h, F.lit(45.0))
    return X.read(spark, d, "part").select(F.col("p_partkey").alias("view"), R(fx).alias("fx"), R(fy).alias("fy"), cx.alias("cx"), cy.alias("cy"))


@query(f"WITH {_POSE}, m AS (SELECT view, unnest([cos(t), sin(t), 0e0, -(cos(t) * px + sin(t) * py), -sin(t), cos(t), 0e0, sin(t) * px - cos(t) * py, 0e0, 0e0, 1e0, -pz]) AS v, unnest(range(0, 12)) AS i FROM cams) SELECT view, i::INT AS i, round(v + 1e-9, 4) + 0e0 AS v FROM m")
def geo8_world_to_camera(spark, d):
    """The inverse of each camera's rigid pose, its first twelve entries (GEO8)."""
    inverse = F.slice(G.rigid_inverse(F.col("camera_to_world")), 1, 12)
    return _views(spark, d).select("view", F.posexplode(inverse).alias("i", "v")).select("view", "i", (R(F.col("v")) + 0.0).alias("v"))


_DOT = "list_sum(list_transform(list_zip({a}, {b}), lambda z: z[1]::DOUBLE * z[2]::DOUBLE))"


@query(f"SELECT a.vec_id, round({_DOT.format(a='a.embedding', b='b.embedding')} / (sqrt({_DOT.format(a='a.embedding', b='a.embedding')}) * sqrt({_DOT.format(a='b.embedding', b='b.embedding')})) + 1e-9, 4) AS cosine FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def geo3_cosine(spark, d):
    e = X.read(spark, d, "embeddings").select("vec_id", "embedding")
    n = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    return e.join(n, "vec_id").select("vec_id", R(G.cosine(F.col("embedding"), F.col("next"))).alias("cosine"))


_PROTO = f"en AS (SELECT label, unnest(range(1, 65)) AS i, embedding, sqrt({_DOT.format(a='embedding', b='embedding')}) AS s FROM embeddings), pm AS (SELECT label, i, avg(embedding[i]::DOUBLE / greatest(s, 1e-8)) AS m FROM en GROUP BY label, i), pn AS (SELECT label, sqrt(sum(m * m)) AS s FROM pm GROUP BY label), proto AS (SELECT label, i, m / greatest(s, 1e-8) AS p FROM pm JOIN pn USING (label))"


def prototypes(e: DataFrame, dim: int) -> DataFrame:
    """(label, proto): each class's prompt vectors of `dim` numbers at unit length, averaged and brought to unit length (AGG23); dim averages side by side, so that nothing is exploded."""
    size = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    unit = e.select("label", "embedding", F.greatest(size(F.col("embedding")), F.lit(1e-8)).alias("s"))
    v = unit.groupBy("label").agg(F.array(*(F.avg(F.col("embedding")[i].cast("double") / F.col("s")) for i in range(dim))).alias("v"))
    v = v.withColumn("n", F.greatest(size(F.col("v")), F.lit(1e-8)))
    return v.select("label", F.transform("v", lambda x: x / F.col("n")).alias("proto"))


@query(f"WITH {_PROTO} SELECT label, (i - 1)::INT AS i, round(p + 1e-9, 4) AS p FROM proto")
def agg23_prototypes(spark, d):
    p = prototypes(X.read(spark, d, "embeddings"), 64)
    return p.select("label", F.posexplode("proto").alias("i", "p")).withColumn("p", R(F.col("p")))


def zero_shot(vectors: DataFrame, protos: DataFrame, k: int = 5, least: float = 0.25, margin: float = 0.05, most: int = 1 << 16) -> DataFrame:
    """(vec_id, top array<struct<label, conf>>, margin, unknown): the k likeliest classes of each vector by softmax over unit vectors' products (TOP1).

    unknown: the first class's confidence is under `least`, or leads the second's by less than `margin` (alone, it leads by all
    of it). The prototypes, one row a class of the vocabulary, are broadcast as one matrix and multiplied in blocks;
    a vocabulary of more than `most` classes is an error, as it would not fit beside the rows. A null vector counts as zeros.
    """
    got = protos.orderBy("label").limit(most + 1).toArrow()
    if not 0 < got.num_rows <= most:
        raise ValueError(f"no classes, or over {most}")
    labels, matrix = got["label"].combine_chunks(), np.array(got["proto"].to_pylist(), float)
    shared = vectors.sparkSession.sparkContext.broadcast((labels, matrix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, proto = shared.value
        step = max(1, (1 << 22) // max(1, len(proto)))
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                b = whole.slice(at, step)
                v = np.array([x or [0.0] * proto.shape[1] for x in b.column(1).to_pylist()], float).reshape(b.num_rows, -1)
                e = np.exp(v @ proto.T / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-8))
                conf = e / e.sum(1, keepdims=True)
                # labels are in order, so that of equals the smaller comes first
                best = np.argsort(-conf, axis=1, kind="stable")[:, :k]
                top = np.take_along_axis(conf, best, 1)
                lead = top[:, 0] - (top[:, 1] if top.shape[1] > 1 else 0.0)
                rows = pa.StructArray.from_arrays([names.take(pa.array(best.ravel())), pa.array(top.ravel())], ["label", "conf"])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, best.size + 1, best.shape[1]), pa.int32()), rows)
                yield pa.RecordBatch.from_arrays([b.column(0), lists, pa.array(lead), pa.array((top[:, 0] < least) | (lead < margin))], names=["vec_id", "top", "margin", "unknown"])

    kinds = vectors.schema["vec_id"].dataType.simpleString(), protos.schema["label"].dataType.simpleString()
    return vectors.select("vec_id", "embedding").mapInArrow(run, f"vec_id {kinds[0]}, top array<struct<label:{kinds[1]},conf:double>>, margin double, unknown boolean")


@query(f"WITH {_PROTO}, d AS (SELECT vec_id, pr.label, sum(e.embedding[i]::DOUBLE * p / s) AS dot FROM (SELECT *, greatest(sqrt({_DOT.format(a='embedding', b='embedding')}), 1e-8) AS s FROM embeddings) e, proto pr GROUP BY vec_id, pr.label), s AS (SELECT vec_id, label, exp(dot) / sum(exp(dot)) OVER (PARTITION BY vec_id) AS conf FROM d), k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY conf DESC, label) AS k, max(conf) OVER (PARTITION BY vec_id) AS first, nth_value(conf, 2) OVER (PARTITION BY vec_id ORDER BY conf DESC, label ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS second FROM s) SELECT vec_id, label, round(conf + 1e-9, 4) AS conf, k::INT AS rank, round(first - second + 1e-9, 4) AS margin, round(first + 1e-9, 7) < 0.15 OR round(first - second + 1e-9, 7) < 0.05 AS unknown FROM k WHERE k <= 5")
def top1_zero_shot(spark, d):
    e = X.read(spark, d, "embeddings").select("vec_id", "embedding", "label")
    s = zero_shot(e, prototypes(e, 64), 5, 0.15, 0.05)
    return s.select("vec_id", F.posexplode("top").alias("k", "x"), "margin", "unknown").select("vec_id", "x.label", R(F.col("x.conf")).alias("conf"), (F.col("k") + 1).alias("rank"), R(F.col("margin")).alias("margin"), "unknown")


@query(f"WITH {BITS}, c AS (SELECT *, coalesce((bit <> lag(bit) OVER w)::INT, 0) AS c FROM bits WINDOW w AS (PARTITION BY mask ORDER BY idx)), r AS (SELECT *, sum(c) OVER (PARTITION BY mask ORDER BY idx) AS run FROM c), g AS (SELECT mask, run, count(*) AS n, min(bit) AS bit FROM r GROUP BY mask, run), l AS (SELECT mask, string_agg(n::VARCHAR, ',' ORDER BY run) AS s, first(bit ORDER BY run) AS b FROM g GROUP BY mask) SELECT mask, CASE WHEN b = 1 THEN '0,' || s ELSE s END AS rle FROM l")
def src8_encode_runs(spark, d):
    return masks.encode_runs(X.mask_bits(spark, d)).select("mask", F.array_join(F.transform("rle", lambda x: x.cast("string")), ",").alias("rle"))


@query(f"WITH {BITS} SELECT mask, idx FROM bits WHERE bit = 1")
def src7_decode_runs(spark, d):
    return masks.decode_runs(masks.encode_runs(X.mask_bits(spark, d)))


@query(f"WITH {BITS} SELECT mask, (idx % 8)::BIGINT AS row, idx // 8 AS col FROM bits WHERE bit = 1")
def src7_decode_pixels(spark, d):
    return masks.decode_pixels(masks.encode_runs(X.mask_bits(spark, d)).withColumn("height", F.lit(8).cast("long"))).withColumn("col", F.col("col").cast("long"))


@query(f"WITH {BITS}, n AS (SELECT mask, count(*) AS n, max(bit) = 1 AND arg_min(bit, idx) = 0 AS two FROM bits GROUP BY mask) SELECT mask, CASE WHEN mask % 5 = 1 THEN 'negative run' ELSE 'size mismatch' END AS problem FROM n WHERE mask % 5 = 1 OR mask % 7 = 2")
def src7_run_problems(spark, d):
    """Run lists, some with a negative run and some of an image that is not of their size."""
    rle = masks.encode_runs(X.mask_bits(spark, d)).withColumns({"height": F.lit(1), "width": F.aggregate("rle", F.lit(0).cast("long"), lambda s, x: s + x)})
    odd = F.when(F.expr("mask % 5 = 1"), F.concat("rle", F.array(F.lit(-3).cast("long"), F.lit(3).cast("long")))).otherwise(F.col("rle"))
    return masks.run_problems(rle.select("mask", odd.alias("rle"), "height", F.when(F.expr("mask % 7 = 2"), F.col("width") + 1).otherwise(F.col("width")).alias("width")))


@query(f"WITH {BITS}, i AS (SELECT mask, idx, idx - row_number() OVER (PARTITION BY mask ORDER BY idx) AS g FROM bits WHERE bit = 1) SELECT mask, min(idx) AS start, max(idx) AS \"end\" FROM i GROUP BY mask, g")
def src9_index_runs(spark, d):
    return masks.compact(X.mask_bits(spark, d).where("bit = 1"), "mask", "idx")


@query(f"WITH {MASK_POINTS} SELECT scene_id, mask, string_agg(pid::VARCHAR, ',' ORDER BY pid) AS pids FROM mask_points GROUP BY scene_id, mask")
def src10_ragged_instances(spark, d):
    g = X.mask_points(spark, d).groupBy("scene_id", "mask").agg(F.sort_array(F.collect_list("pid")).alias("p"))
    return g.select("scene_id", "mask", F.array_join(F.transform("p", lambda x: x.cast("string")), ",").alias("pids"))


@query("SELECT user_id AS mask, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_type, event_id)::INT AS rank FROM events")
def top6_mask_order(spark, d):
    k = F.row_number().over(Window.partitionBy("user_id").orderBy("event_type", "event_id"))
    return X.read(spark, d, "events").select(F.col("user_id").alias("mask"), "event_id", k.alias("rank"))
