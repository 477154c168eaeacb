"""Queries over object instances: fused scores, ownership of points, numbering, summaries, oriented boxes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesserae.operators.masks import view_problems
from tesserae.plans.materialize import materialize, release
from tesserae.plans.scene import mask_heads
from tesserae.sources import fixtures as X
from tesserae.sources.fixtures import BITS, MASK_POINTS, PIXELS

R = lambda c, n=4: F.round(c + 1e-9, n)
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def mean_features(mask_points: DataFrame, features: DataFrame, dim: int) -> DataFrame:
    """(scene_id, mask, feature): mean vector of each mask's points; dim averages side by side, so that nothing is exploded (AGG10)."""
    j = mask_points.select("scene_id", "mask", "pid").join(features, ["scene_id", "pid"])
    return j.groupBy("scene_id", "mask").agg(F.array(*(F.avg(F.element_at("feature", i + 1).cast("double")) for i in range(dim))).alias("feature"))


@query(f"WITH {MASK_POINTS}, e AS (SELECT 's' || (vec_id % 3) AS scene_id, vec_id // 3 AS pid, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings) SELECT scene_id, mask, (i - 1)::INT AS i, round(avg(v::DOUBLE) + 1e-9, 4) + 0e0 AS v FROM mask_points JOIN e USING (scene_id, pid) GROUP BY scene_id, mask, i")
def agg10_mask_features(spark, d):
    e = X.read(spark, d, "embeddings").selectExpr("concat('s', vec_id % 3) AS scene_id", "vec_id div 3 AS pid", "embedding AS feature")
    m = mean_features(X.mask_points(spark, d), e, 64)
    return m.select("scene_id", "mask", F.posexplode("feature").alias("i", "v")).select("scene_id", "mask", "i", (R(F.col("v")) + 0.0).alias("v"))


#: Proposals are all masks of one supplier; each point has a class of its own, a confidence, and may be unknown.
_PROPOSALS = f"""{MASK_POINTS}, h AS (SELECT scene_id, mask, min(view) AS view, min(class) AS class, count(*) AS n, max(weight) AS score FROM mask_points GROUP BY scene_id, mask),
base AS (SELECT DISTINCT scene_id, pid, pid % 5 AS top, (pid * 37 % 100) / 100e0 AS conf, pid % 7 = 0 AS unknown FROM mask_points),
ip AS (SELECT DISTINCT scene_id, mask // 8 AS inst, class, pid FROM mask_points),
ih AS (SELECT scene_id, mask // 8 AS inst, min(class) AS class, count(DISTINCT view) AS views, sum(score * n) / sum(n) AS score FROM h GROUP BY 1, 2),
fs AS (SELECT scene_id, ih.inst, ih.class, views, count(*) AS n, min(ip.pid) AS low, round(0.45e0 * coalesce(avg(CASE WHEN top = ih.class THEN conf END), 0) + 0.35e0 * any_value(score) + 0.1e0 * least(1e0, views / 4e0) + 0.1e0 * least(1e0, count(*) / 200e0) + 1e-9, 6) AS fused FROM ih JOIN ip USING (scene_id, inst) JOIN base USING (scene_id, pid) GROUP BY scene_id, ih.inst, ih.class, views)"""


def _base(spark, d) -> DataFrame:
    return X.mask_points(spark, d).select("scene_id", "pid").distinct().selectExpr("scene_id", "pid", "pid % 5 AS top", "(pid * 37 % 100) / 100e0 AS conf", "pid % 7 = 0 AS unknown")


def _members(spark, d) -> DataFrame:
    return X.mask_points(spark, d).selectExpr("scene_id", "mask div 8 AS inst", "class", "pid").distinct()


def fused_scores(heads: DataFrame, members: DataFrame, base: DataFrame, min_views: int = 2, min_points: int = 50) -> DataFrame:
    """(scene_id, inst, class, views, n, low, fused): how far points, masks, views and size speak for an instance (AGG13)."""
    key = ["scene_id", "inst"]
    h = heads.groupBy(*key).agg(F.min("class").alias("class"), F.countDistinct("view").alias("views"), (F.sum(F.col("score") * F.col("n")) / F.sum("n")).alias("score"))
    p = members.join(base, ["scene_id", "pid"]).groupBy(*key).agg(F.count("*").alias("n"), F.min("pid").alias("low"), F.coalesce(F.avg(F.when(F.col("top") == F.col("class"), F.col("conf"))), F.lit(0.0)).alias("agree"))
    share = lambda c, most: F.least(F.lit(1.0), F.col(c) / most)
    fused = 0.45 * F.col("agree") + 0.35 * F.col("score") + 0.1 * share("views", 2.0 * min_views) + 0.1 * share("n", 4.0 * min_points)
    return h.join(p, key).select(*key, "class", "views", "n", "low", fused.alias("fused"))


def _fused(spark, d) -> DataFrame:
    heads = mask_heads(X.mask_points(spark, d)).withColumn("inst", F.expr("mask div 8"))
    # both engines rank by six places
    return fused_scores(heads, _members(spark, d), _base(spark, d)).withColumn("fused", R(F.col("fused"), 6))


@query(f"WITH {_PROPOSALS} SELECT scene_id, inst, class, views, n, low, round(fused, 4) AS fused FROM fs")
def agg13_fused_scores(spark, d):
    return _fused(spark, d).withColumn("fused", F.round("fused", 4))


def point_labels(base: DataFrame, members: DataFrame, proposals: DataFrame) -> DataFrame:
    """(scene_id, pid, label, score): each point's best label: its own (-1 if unknown), unless a proposal's score is strictly higher as a 32-bit number; the earlier among equal proposals (AGG14)."""
    own = base.select("scene_id", "pid", F.when(F.col("unknown"), -1).otherwise(F.col("top")).cast("long").alias("label"), F.col("conf").cast("float").alias("s"), F.lit(-1).cast("long").alias("k"))
    scored = proposals.select("scene_id", "inst", F.col("fused").cast("float").alias("s"))
    given = members.join(scored, ["scene_id", "inst"]).select("scene_id", "pid", F.col("class").alias("label"), "s", F.col("inst").alias("k"))
    best = own.unionByName(given).groupBy("scene_id", "pid").agg(F.max(F.struct("s", (-F.col("k")).alias("neg"), "label")).alias("b"))
    return best.select("scene_id", "pid", "b.label", F.col("b.s").cast("double").alias("score"))


@query(f"""WITH {_PROPOSALS}, c AS (SELECT scene_id, pid, CASE WHEN unknown THEN -1 ELSE top END AS label, conf::FLOAT AS s, -1 AS k FROM base UNION ALL SELECT scene_id, pid, ip.class, fused::FLOAT, ip.inst FROM ip JOIN fs USING (scene_id, inst)),
r AS (SELECT *, row_number() OVER (PARTITION BY scene_id, pid ORDER BY s DESC, k) AS j FROM c) SELECT scene_id, pid, label, round(s::DOUBLE + 1e-9, 4) AS score FROM r WHERE j = 1""")
def agg14_point_labels(spark, d):
    return point_labels(_base(spark, d), _members(spark, d), _fused(spark, d)).withColumn("score", R(F.col("score")))


def exclusive_owners(members: DataFrame, ranks: DataFrame, least: int) -> DataFrame:
    """(scene_id, pid, inst): the proposal that owns each point, when the best rank of a scene claims first and keeps only if enough is left (ITR6).

    members: (scene_id, inst, pid), ranks: (scene_id, inst, rank), rank 1 first and none twice in a scene. In each round an open proposal
    is accepted if the points that no accepted or open better one holds are enough, and refused if
    those that no accepted better one holds are too few. The best open one is always decided, so the
    rounds end. A point's state is two minima, which are partial aggregations.
    """
    key, point = ["scene_id", "inst"], ["scene_id", "pid"]
    state = materialize(ranks.select(*key, "rank", F.lit(None).cast("boolean").alias("kept")), "owners")
    while not state.where("kept IS NULL").isEmpty():
        m = members.join(state, key)
        best = m.groupBy(*point).agg(F.min(F.when(F.col("kept"), F.col("rank"))).alias("taken"), F.min(F.when(F.col("kept").isNull(), F.col("rank"))).alias("open"))
        free = F.col("taken").isNull() | (F.col("taken") > F.col("rank"))
        left = m.where("kept IS NULL").join(best, point).groupBy(*key).agg(F.count_if(free).alias("upper"), F.count_if(free & (F.col("open") == F.col("rank"))).alias("lower"))
        s = state.join(left, key, "left").fillna(0, ["upper", "lower"])
        after = materialize(s.select(*key, "rank", F.coalesce("kept", F.when(F.col("lower") >= least, True).when(F.col("upper") < least, False)).alias("kept")), "owners")
        release(state)
        state = after
    return members.join(state.where("kept"), key).groupBy(*point).agg(F.min(F.struct("rank", "inst")).alias("m")).select(*point, "m.inst")


def _owned(spark, d) -> DataFrame:
    """Points of proposals for things: classes above 0 here, as 0 stands for a floor."""
    rank = F.row_number().over(Window.partitionBy("scene_id").orderBy(F.col("fused").desc(), "class", "low", "inst"))
    f = _fused(spark, d).where("class > 0")
    return exclusive_owners(_members(spark, d).select("scene_id", "inst", "pid"), f.select("scene_id", "inst", rank.alias("rank")), 20)


@query()
def itr6_exclusive_points(spark, d):
    return _owned(spark, d)


def instance_numbers(instances: DataFrame) -> DataFrame:
    """instances (scene_id, inst, class, x, low) with the number of each in its scene, from 0: by class, centroid, smallest point and id (TOP4)."""
    return instances.withColumn("number", F.row_number().over(Window.partitionBy("scene_id").orderBy("class", "x", "low", "inst")) - 1)


@query(f"WITH {_PROPOSALS}, c AS (SELECT scene_id, inst, ip.class, round(avg((pid * 7919) % 10007) + 1e-9, 4) AS x, min(pid) AS low FROM ip GROUP BY scene_id, inst, ip.class) SELECT scene_id, inst, (row_number() OVER (PARTITION BY scene_id ORDER BY class, x, low, inst) - 1)::INT AS number FROM c")
def top4_instance_numbers(spark, d):
    """Instance numbers of each scene (TOP4)."""
    c = _members(spark, d).groupBy("scene_id", "inst", "class").agg(R(F.avg(F.expr("(pid * 7919) % 10007"))).alias("x"), F.min("pid").alias("low"))
    return instance_numbers(c).select("scene_id", "inst", "number")


def instance_summary(points: DataFrame, names: DataFrame) -> DataFrame:
    """One row for each instance of points (scene_id, inst, class, view, pid, x, y, z, visible, core): size, views, centroid, bounds, shares of visible and core points, label (AGG18, JOI12).

    A point that several views saw counts once. names: (class, label), a table of configuration.
    """
    key = ["scene_id", "inst"]
    views = points.groupBy(*key).agg(F.array_sort(F.collect_set(F.col("view").cast("string"))).alias("views"))
    share = lambda c: (F.count_if(c) / F.count("*")).alias(c)
    g = points.drop("view").distinct().groupBy(*key).agg(F.min("class").alias("class"), F.count("*").alias("n"), *(f(a).alias(a + n) for a in "xyz" for f, n in ((F.avg, ""), (F.min, "_min"), (F.max, "_max"))), share("visible"), share("core"))
    return g.join(views, key).join(names, "class", "left")


@query(f"WITH {MASK_POINTS}, p AS (SELECT DISTINCT scene_id, mask // 8 AS inst, class, pid, x, y, z FROM mask_points), v AS (SELECT scene_id, mask // 8 AS inst, string_agg(DISTINCT view::VARCHAR, ',' ORDER BY view::VARCHAR) AS views FROM mask_points GROUP BY 1, 2) SELECT scene_id, inst, any_value(class) AS class, count(*) AS n, any_value(views) AS views, round(avg(x) + 1e-9, 4) AS x, round(min(x) + 1e-9, 4) AS x_min, round(max(x) + 1e-9, 4) AS x_max, round(avg(y) + 1e-9, 4) AS y, round(min(y) + 1e-9, 4) AS y_min, round(max(y) + 1e-9, 4) AS y_max, round(avg(z) + 1e-9, 4) AS z, round(min(z) + 1e-9, 4) AS z_min, round(max(z) + 1e-9, 4) AS z_max, round(sum(CASE WHEN pid % 4 > 0 THEN 1 ELSE 0 END) / count(*) + 1e-9, 4) AS visible, round(sum(CASE WHEN pid % 3 > 0 THEN 1 ELSE 0 END) / count(*) + 1e-9, 4) AS core, ['table', 'desk', 'counter', 'shelf', 'cabinet'][1 + any_value(class)] AS label FROM p JOIN v USING (scene_id, inst) GROUP BY scene_id, inst")
def agg18_instance_summary(spark, d):
    p = X.mask_points(spark, d).selectExpr("scene_id", "mask div 8 AS inst", "class", "view", "pid", "x", "y", "z", "pid % 4 > 0 AS visible", "pid % 3 > 0 AS core")
    names = spark.createDataFrame(list(enumerate(["table", "desk", "counter", "shelf", "cabinet"])), "class bigint, label string")
    s = instance_summary(p, names)
    return s.select("scene_id", "inst", "class", "n", F.array_join("views", ",").alias("views"), *(R(F.col(c)).alias(c) for a in "xyz" for c in (a, f"{a}_min", f"{a}_max")), R(F.col("visible")).alias("visible"), R(F.col("core")).alias("core"), "label")


def oriented_boxes(points: DataFrame, *key: str) -> DataFrame:
    """(*key, n, e1, e2, e3, axes): extents along each group's principal axes, the longest variance first (AGG19).

    Sums and products are partial aggregations; numpy sees one 3x3 matrix a group. An axis's largest
    component is positive.
    """
    pairs = [(a, b) for i, a in enumerate("xyz") for b in "xyz"[i:]]
    cov = points.groupBy(*key).agg(F.count("*").alias("n"), F.array(*(F.covar_pop(a, b) for a, b in pairs)).alias("cov"))

    @F.pandas_udf("array<double>")
    def axes(cov: pd.Series) -> pd.Series:
        out = []
        for xx, xy, xz, yy, yz, zz in cov:
            v = np.linalg.eigh(np.array([[xx, xy, xz], [xy, yy, yz], [xz, yz, zz]]))[1][:, ::-1].T
            out.append((v * np.where(np.take_along_axis(v, np.abs(v).argmax(1)[:, None], 1) < 0, -1, 1)).ravel().tolist())
        return pd.Series(out)

    a = cov.select(*key, "n", axes("cov").alias("axes"))
    along = [sum(F.col(c) * F.col("axes")[3 * k + i] for i, c in enumerate("xyz")) for k in range(3)]
    e = points.join(a, list(key)).groupBy(*key).agg(*((F.max(p) - F.min(p)).alias(f"e{k + 1}") for k, p in enumerate(along)))
    return a.join(e, list(key))


@query()
def agg19_oriented_boxes(spark, d):
    p = X.mask_points(spark, d).selectExpr("scene_id", "mask div 8 AS inst", "pid", "x", "y", "z").distinct()
    return oriented_boxes(p, "scene_id", "inst").select("scene_id", "inst", "n", *(R(F.col(f"e{k}")).alias(f"e{k}") for k in (1, 2, 3)))


@query(f"""WITH {BITS}, s AS (SELECT mask, max(idx) // 8 AS last FROM bits GROUP BY mask), o AS (SELECT mask, last, idx % 8 AS r, idx // 8 AS c FROM bits JOIN s USING (mask) WHERE bit = 1),
g AS (SELECT mask, count(*) AS area, (sum((r = 0)::INT) + sum((r = 7)::INT) + sum((c = 0)::INT) + sum((c = last)::INT)) / (2e0 * (8 + any_value(last) + 1)) AS edge FROM o GROUP BY mask) SELECT mask, area, round(edge + 1e-9, 4) AS edge FROM g WHERE area >= 2 AND edge <= 0.5""")
def fil4_mask_filter(spark, d):
    """Masks with enough pixels and not too many on the image's border (FIL4); a pixel of 8 rows by column."""
    b = X.mask_bits(spark, d)
    last = b.groupBy("mask").agg(F.expr("max(idx) div 8").alias("last"))
    o = b.where("bit = 1").selectExpr("mask", "idx % 8 AS r", "idx div 8 AS c").join(last, "mask")
    on = sum(F.count_if(F.expr(e)) for e in ("r = 0", "r = 7", "c = 0", "c = last"))
    g = o.groupBy("mask").agg(F.count("*").alias("area"), (on / (2.0 * (F.max("last") + 9))).alias("edge"))
    return g.where("area >= 2 AND edge <= 0.5").select("mask", "area", R(F.col("edge")).alias("edge"))


@query(f"""WITH {PIXELS}, cm AS (SELECT DISTINCT 's' || n_nationkey % 3 AS scene_id, n_nationkey % 7 AS view FROM nation), rs AS (SELECT 's' || n_nationkey % 3 AS scene_id, n_nationkey % 9 AS view, count(*) AS n FROM nation GROUP BY ALL), g AS (SELECT 's' || oid % 3 AS scene_id, view, count(*) AS n_masks FROM pixels GROUP BY ALL)
SELECT * FROM (SELECT scene_id, g.view, n_masks, CASE WHEN cm.view IS NULL THEN 'no camera' WHEN coalesce(rs.n, 0) <> 1 THEN coalesce(rs.n, 0) || ' rasters' END AS problem FROM g LEFT JOIN cm USING (scene_id, view) LEFT JOIN rs USING (scene_id, view)) WHERE problem IS NOT NULL""")
def joi9_view_checks(spark, d):
    """Views of each scene that cannot be lifted: without a camera, or with another number of depth rasters than one (JOI9)."""
    n = X.read(spark, d, "nation")
    cameras, rasters = (n.selectExpr("concat('s', n_nationkey % 3) AS scene_id", f"n_nationkey % {k} AS view") for k in (7, 9))
    return view_problems(X.pixels(spark, d).selectExpr("concat('s', oid % 3) AS scene_id", "view"), cameras, rasters)
