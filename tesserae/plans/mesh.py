"""Queries over the mesh: geometry, filters, statistics, support patches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesserae.functions import geometry as G
from tesserae.operators import spatial
from tesserae.operators.graph import connected_components
from tesserae.operators.ordered import medians
from tesserae.plans.materialize import materialize
from tesserae.sources import fixtures as X
from tesserae.sources.fixtures import FACES

#: Rounded off the ties, so that both engines agree.
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


def _faces(spark, d) -> DataFrame:
    return G.with_triangle_attributes(X.faces(spark, d))


def _face_table(spark, d) -> DataFrame:
    """The faces with their attributes as a stored table, as filters over them would have them."""
    return materialize(_faces(spark, d), "faces")


@query(f"WITH {FACES} SELECT scene_id, fid, round(area + 1e-9, 4) AS area, round(nz + 1e-9, 4) AS nz, round(cx + 1e-9, 4) AS cx, round(cy + 1e-9, 4) AS cy, round(cz + 1e-9, 4) AS cz FROM faces")
def geo1_triangle_attributes(spark, d):
    return _faces(spark, d).select("scene_id", "fid", *(R(F.col(c)).alias(c) for c in ("area", "nz", "cx", "cy", "cz")))


def placed_faces(faces: DataFrame, matrices: DataFrame) -> DataFrame:
    """faces with their corners in world metres: each instance's row-major 4x4 matrix times the corner, then the scene's unit (GEO2).

    matrices: (scene_id, instance, matrix array<double>, metres), a row an instance; faces without one are left out.
    """
    j = faces.join(matrices, ["scene_id", "instance"])
    m, unit = F.col("matrix"), F.col("metres")
    out = {f"{a}{k}": v * unit for k in range(3) for a, v in zip("xyz", G.affine(m, *(F.col(f"{b}{k}") for b in "xyz")), strict=True)}
    return j.withColumns(out).drop("matrix", "metres")


@query(f"WITH {FACES}, m AS (SELECT *, radians(instance * 15e0) AS t, instance * 0.5e0 AS sx, 1e0 AS sz, CASE WHEN scene_id = 's1' THEN 0.01e0 ELSE 1e0 END AS unit FROM faces) SELECT scene_id, fid, {', '.join(f'round((x{k} * cos(t) + y{k} * -sin(t) + z{k} * 0e0 + sx) * 1e0 * unit + 1e-9, 4) + 0e0 AS x{k}, round((x{k} * sin(t) + y{k} * cos(t) + z{k} * 0e0 + 2e0) * 1e0 * unit + 1e-9, 4) + 0e0 AS y{k}, round((x{k} * 0e0 + y{k} * 0e0 + z{k} * 1e0 + sz) * 1e0 * unit + 1e-9, 4) + 0e0 AS z{k}' for k in range(3))} FROM m WHERE instance % 5 <> 4")
def geo2_affine(spark, d):
    """Faces placed by the matrices of their instances; some instances have none."""
    f = X.faces(spark, d)
    m = f.select("scene_id", "instance").distinct().where("instance % 5 <> 4").withColumn("t", F.expr("radians(instance * 15e0)"))
    m = m.selectExpr("scene_id", "instance", "array(cos(t), -sin(t), 0e0, instance * 0.5e0, sin(t), cos(t), 0e0, 2e0, 0e0, 0e0, 1e0, 1e0, 0e0, 0e0, 0e0, 1e0) AS matrix", "if(scene_id = 's1', 0.01e0, 1e0) AS metres")
    return placed_faces(f, m).select("scene_id", "fid", *((R(F.col(f"{a}{k}")) + 0.0).alias(f"{a}{k}") for a in "xyz" for k in range(3)))


_BOX = "(SELECT scene_id, instance, min(least(x0, x1, x2)) AS x_min, max(greatest(x0, x1, x2)) AS x_max, min(least(y0, y1, y2)) AS y_min, max(greatest(y0, y1, y2)) AS y_max FROM faces GROUP BY scene_id, instance)"


def _boxes(f: DataFrame, *keys: str) -> DataFrame:
    return f.groupBy(*(keys or ("scene_id", "instance"))).agg(*(F.min(F.least(*(f"{a}{k}" for k in range(3)))).alias(f"{a}_min") for a in "xyz"), *(F.max(F.greatest(*(f"{a}{k}" for k in range(3)))).alias(f"{a}_max") for a in "xyz"))


def expanded_bounds(boxes: DataFrame, margin: float = 0.75) -> DataFrame:
    """boxes (scene_id, .., x_min .. z_max) widened by the margin in XY within their scene's bounds, and as high as the scene (GEO4)."""
    s = boxes.groupBy("scene_id").agg(*(f(f"{a}_{m}").alias(f"_{a}_{m}") for a in "xyz" for m, f in (("min", F.min), ("max", F.max))))
    grown = {f"{a}_{m}": f(F.col(f"{a}_{m}") + by, f"_{a}_{m}") for a in "xy" for m, f, by in (("min", F.greatest, -margin), ("max", F.least, margin))}
    return boxes.join(s, "scene_id").withColumns(grown | {f"z_{m}": F.col(f"_z_{m}") for m in ("min", "max")}).select(*boxes.columns)


@query(f"""WITH {FACES}, b AS (SELECT scene_id, instance, {", ".join(f"min(least({a}0, {a}1, {a}2)) AS {a}_min, max(greatest({a}0, {a}1, {a}2)) AS {a}_max" for a in "xyz")} FROM faces GROUP BY scene_id, instance), s AS (SELECT scene_id, min(x_min) AS sx0, max(x_max) AS sx1, min(y_min) AS sy0, max(y_max) AS sy1, min(z_min) AS sz0, max(z_max) AS sz1 FROM b GROUP BY scene_id)
SELECT scene_id, instance, round(greatest(x_min - 0.75, sx0) + 1e-9, 4) AS x_min, round(least(x_max + 0.75, sx1) + 1e-9, 4) AS x_max, round(greatest(y_min - 0.75, sy0) + 1e-9, 4) AS y_min, round(least(y_max + 0.75, sy1) + 1e-9, 4) AS y_max, round(sz0 + 1e-9, 4) AS z_min, round(sz1 + 1e-9, 4) AS z_max FROM b JOIN s USING (scene_id)""")
def geo4_expanded_bounds(spark, d):
    return expanded_bounds(_boxes(_faces(spark, d))).select("scene_id", "instance", *(R(F.col(f"{a}_{m}")).alias(f"{a}_{m}") for a in "xyz" for m in ("min", "max")))


_ANCHORS = "anchors AS (SELECT 's' || (n_nationkey % 3) AS scene_id, n_nationkey AS anchor, n_nationkey % 5 * 3e0 AS ax, n_nationkey // 5 * 3e0 AS ay FROM nation)"
_SECTOR = "CASE WHEN hypot > 1e-9 THEN (cx - ax) / hypot ELSE 0e0 END >= cos(radians(44)) AND hypot <= 4 AND cz BETWEEN 0 AND 0.09"


@query(f"""WITH {FACES}, {_ANCHORS}, j AS (SELECT anchor, ax, cx, cz, area, sqrt((cx - ax) * (cx - ax) + (cy - ay) * (cy - ay)) AS hypot FROM faces JOIN anchors USING (scene_id) WHERE abs(cx - ax) <= 4 AND abs(cy - ay) <= 4)
SELECT anchor, count(*) AS n_faces, round(sum(area) + 1e-9, 3) AS area FROM j WHERE {_SECTOR} GROUP BY anchor""")
def joi7_observation_sector(spark, d):
    """Faces whose centroid is in an observer's sector: observers list the cells that they reach (GEO5, JOI7)."""
    a = X.read(spark, d, "nation").selectExpr("concat('s', n_nationkey % 3) AS scene_id", "n_nationkey AS anchor", "n_nationkey % 5 * 3e0 AS ax", "n_nationkey div 5 * 3e0 AS ay")
    a = a.withColumns({"x_min": F.col("ax") - 4, "x_max": F.col("ax") + 4, "y_min": F.col("ay") - 4, "y_max": F.col("ay") + 4})
    f = _faces(spark, d).select("scene_id", F.col("cx").alias("x"), F.col("cy").alias("y"), F.col("cz").alias("z"), "area")
    near = spatial.boxes_holding(f, a, 4.0, ("scene_id",))
    inside = near.where(G.in_sector(F.col("x") - F.col("ax"), F.col("y") - F.col("ay"), F.col("z"), F.lit(1.0), F.lit(0.0), 4.0, 44.0, F.lit(0.0), F.lit(0.09)))
    return inside.groupBy("anchor").agg(F.count("*").alias("n_faces"), R(F.sum("area"), 3).alias("area"))


@query("SELECT n_nationkey AS anchor, n_nationkey % 5 * 3e0 AS eye_x, n_nationkey // 5 * 3e0 AS eye_y, 1.6e0 AS eye_z, round(-sin(radians(n_nationkey * 15)) + 1e-9, 4) AS right_x, round(cos(radians(n_nationkey * 15)) + 1e-9, 4) AS right_y FROM nation")
def geo10_eye_and_right(spark, d):
    yaw = F.radians(F.col("n_nationkey") * 15)
    return X.read(spark, d, "nation").select(F.col("n_nationkey").alias("anchor"), F.expr("n_nationkey % 5 * 3e0").alias("eye_x"), F.expr("n_nationkey div 5 * 3e0").alias("eye_y"), F.lit(1.6).alias("eye_z"), R(-F.sin(yaw)).alias("right_x"), R(F.cos(yaw)).alias("right_y"))


def surface_points(faces: DataFrame, u: Column, v: Column) -> DataFrame:
    """faces (x0 .. z2, colours r0 .. b2) with the point of each at (u, v), reflected beyond the diagonal: place x, y, z, colour r, g, b as whole numbers from 0 to 255, and the unit normal nx, ny, nz (GEO6)."""
    w = G.barycentric(u, v)
    mix = lambda a: sum(w[k] * F.col(f"{a}{k}") for k in range(3))
    f = faces if "nx" in faces.columns else G.with_triangle_attributes(faces)
    return f.withColumns({a: mix(a) for a in "xyz"} | {a: F.floor(F.least(F.greatest(mix(a), F.lit(0.0)), F.lit(255.0))).cast("short") for a in "rgb"})


_COLOUR = {"r": "v{k} * 53 % 300 - 20e0", "g": "v{k} * 31 % 256 + 0e0", "b": "v{k} * 17 % 290 - 5e0"}


@query(f"""WITH {FACES}, u AS (SELECT *, {", ".join(f"{e.format(k=k)} AS {a}{k}" for a, e in _COLOUR.items() for k in range(3))}, (fid * 7 % 101) / 101e0 AS u, (fid * 13 % 103) / 103e0 AS v FROM faces), w AS (SELECT *, CASE WHEN u + v > 1 THEN 1 - u ELSE u END AS p, CASE WHEN u + v > 1 THEN 1 - v ELSE v END AS q FROM u)
SELECT scene_id, fid, {", ".join(f"round((1 - p - q) * {a}0 + p * {a}1 + q * {a}2 + 1e-9, 4) AS {a}" for a in "xyz")}, {", ".join(f"floor(least(greatest((1 - p - q) * {a}0 + p * {a}1 + q * {a}2, 0), 255))::SMALLINT AS {a}" for a in "rgb")}, {", ".join(f"round(n{a} + 1e-9, 4) + 0e0 AS n{a}" for a in "xyz")} FROM w""")
def geo6_barycentric(spark, d):
    f = _faces(spark, d).withColumns({f"{a}{k}": F.expr(e.format(k=k)) for a, e in _COLOUR.items() for k in range(3)})
    p = surface_points(f, F.expr("(fid * 7 % 101) / 101e0"), F.expr("(fid * 13 % 103) / 103e0"))
    return p.select("scene_id", "fid", *(R(F.col(a)).alias(a) for a in "xyz"), "r", "g", "b", *((R(F.col(f"n{a}")) + 0.0).alias(f"n{a}") for a in "xyz"))


def budgets(f: DataFrame, keys: tuple[str, ...] = ("scene_id", "instance"), triangles: int = 1_500_000, points: int = 250_000, side: float = 8.0, density: float = 2500.0) -> DataFrame:
    """(*keys, n, area, n_points, over_budget) of groups of faces: too many triangles or estimated points, or too long a side in XY (FIL1, AGG2)."""
    spans = [F.max(F.greatest(*(f"{a}{k}" for k in range(3)))) - F.min(F.least(*(f"{a}{k}" for k in range(3)))) for a in "xy"]
    # a sum depends on its order, so a whole number may come out a little above itself
    n_points = F.ceil(F.sum("area") * density - 1e-6)
    over = (F.count("*") > triangles) | (n_points > points) | (F.greatest(*spans) > side)
    return f.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("area").alias("area"), n_points.alias("n_points"), over.alias("over_budget"))


@query(f"WITH {FACES} SELECT scene_id, instance, count(*) AS n, round(sum(area) + 1e-9, 3) AS area, ceil(sum(area) * 2500 - 1e-6)::BIGINT AS n_points, count(*) > 100 OR ceil(sum(area) * 2500 - 1e-6) > 8000 OR greatest(max(greatest(x0, x1, x2)) - min(least(x0, x1, x2)), max(greatest(y0, y1, y2)) - min(least(y0, y1, y2))) > 8 AS over_budget FROM faces GROUP BY scene_id, instance")
def fil1_over_budget(spark, d):
    return budgets(_faces(spark, d), triangles=100, points=8000).select("scene_id", "instance", "n", R(F.col("area"), 3).alias("area"), "n_points", "over_budget")


@query(f"WITH {FACES} SELECT scene_id, fid, round(area + 1e-9, 4) AS area FROM faces WHERE nz >= cos(radians(15)) AND area > 1e-10")
def fil5_upward_faces(spark, d):
    return upward_faces(_face_table(spark, d)).select("scene_id", "fid", R(F.col("area")).alias("area"))


_SUPPORT = "semantic IN (3, 4, 5, 6) AND observed AND core AND visibility >= 1 AND nz >= cos(radians(12)) AND 2 * area > 1e-12"


def support_faces(f: DataFrame, classes: tuple[int, ...] = (3, 4, 5, 6), views: int = 1, degrees: float = 12) -> DataFrame:
    """Faces that can carry something: seen, of a supporting class, flat (FIL6)."""
    return f.where(F.col("semantic").isin(*classes) & F.col("observed") & F.col("core") & (F.col("visibility") >= views) & (F.col("nz") >= F.cos(F.radians(F.lit(degrees)))) & (2 * F.col("area") > 1e-12))


@query(f"WITH {FACES} SELECT scene_id, fid, semantic, instance FROM faces WHERE {_SUPPORT}")
def fil6_support_faces(spark, d):
    return support_faces(_face_table(spark, d)).select("scene_id", "fid", "semantic", "instance")


def scene_problems(scenes: DataFrame, faces: DataFrame) -> DataFrame:
    """(scene_id, problem) of scenes (scene_id, scale) whose faces cannot be planned with: none, areas that are negative or not finite, or a scale that is not positive (FIL8)."""
    bad = F.isnan("area") | (F.col("area") < 0) | (F.abs("area") == float("inf"))
    s = scenes.join(faces.groupBy("scene_id").agg(F.count_if(bad).alias("bad")), "scene_id", "left")
    problem = F.when(F.col("bad").isNull(), "empty").when(F.col("bad") > 0, "areas").when(~F.coalesce(F.col("scale") > 0, F.lit(False)), "scale")
    return s.select("scene_id", problem.alias("problem")).where("problem IS NOT NULL")


@query(f"WITH {FACES}, sc AS (SELECT 's' || n_nationkey % 5 AS scene_id, min(n_nationkey) % 3 - 1 AS scale FROM nation GROUP BY 1), g AS (SELECT scene_id, sum((NOT isfinite(area) OR area < 0)::INT) AS bad FROM faces GROUP BY scene_id) SELECT * FROM (SELECT scene_id, CASE WHEN bad IS NULL THEN 'empty' WHEN bad > 0 THEN 'areas' WHEN NOT scale > 0 THEN 'scale' END AS problem FROM sc LEFT JOIN g USING (scene_id)) WHERE problem IS NOT NULL")
def fil8_scene_validation(spark, d):
    scenes = X.read(spark, d, "nation").groupBy(F.expr("concat('s', n_nationkey % 5)").alias("scene_id")).agg((F.min("n_nationkey") % 3 - 1).alias("scale"))
    return scene_problems(scenes, _faces(spark, d))


def scene_statistics(faces: DataFrame, source: str = "semantic", instance: str = "instance", **limits) -> DataFrame:
    """(scene_id, n_faces, n_vertices, area, x_min .. z_max, n_sources, n_instances, n_instanced, n_over_budget), a row a scene (AGG1).

    A vertex counts once for each source mesh that has it; an instanced source has several instances. limits are those of budgets(), for instances.
    """
    bounds = [x for a in "xyz" for x in (F.min(F.least(*(f"{a}{k}" for k in range(3)))).alias(f"{a}_min"), F.max(F.greatest(*(f"{a}{k}" for k in range(3)))).alias(f"{a}_max"))]
    whole = faces.groupBy("scene_id").agg(F.count("*").alias("n_faces"), F.sum("area").alias("area"), *bounds)
    corner = faces.select("scene_id", source, F.explode(F.array("v0", "v1", "v2")).alias("v")).distinct().groupBy("scene_id").agg(F.count("*").alias("n_vertices"))
    uses = faces.select("scene_id", source, instance).distinct().groupBy("scene_id", source).agg(F.count("*").alias("k"))
    uses = uses.groupBy("scene_id").agg(F.count("*").alias("n_sources"), F.count_if(F.col("k") > 1).alias("n_instanced"))
    over = budgets(faces, ("scene_id", instance), **limits).groupBy("scene_id").agg(F.count("*").alias("n_instances"), F.count_if("over_budget").alias("n_over_budget"))
    return whole.join(corner, "scene_id").join(uses, "scene_id").join(over, "scene_id")


@query(f"""WITH {FACES}, w AS (SELECT scene_id, count(*) AS n_faces, round(sum(area) + 1e-9, 3) AS area, {", ".join(f"round(min(least({a}0, {a}1, {a}2)) + 1e-9, 4) AS {a}_min, round(max(greatest({a}0, {a}1, {a}2)) + 1e-9, 4) AS {a}_max" for a in "xyz")}, count(DISTINCT semantic) AS n_sources FROM faces GROUP BY scene_id),
v AS (SELECT scene_id, count(*) AS n_vertices FROM (SELECT DISTINCT scene_id, semantic, unnest([v0, v1, v2]) FROM faces) GROUP BY scene_id), u AS (SELECT scene_id, sum((k > 1)::INT)::BIGINT AS n_instanced FROM (SELECT scene_id, semantic, count(DISTINCT instance) AS k FROM faces GROUP BY ALL) GROUP BY scene_id),
i AS (SELECT scene_id, count(*) AS n_instances, sum((n > 100 OR ceil(s * 2500 - 1e-6) > 8000 OR side > 8)::INT)::BIGINT AS n_over_budget FROM (SELECT scene_id, instance, count(*) AS n, sum(area) AS s, greatest(max(greatest(x0, x1, x2)) - min(least(x0, x1, x2)), max(greatest(y0, y1, y2)) - min(least(y0, y1, y2))) AS side FROM faces GROUP BY ALL) GROUP BY scene_id) SELECT * FROM w JOIN v USING (scene_id) JOIN u USING (scene_id) JOIN i USING (scene_id)""")
def agg1_scene_statistics(spark, d):
    s = scene_statistics(_face_table(spark, d), triangles=100, points=8000)
    return s.withColumns({"area": R(F.col("area"), 3)} | {f"{a}_{m}": R(F.col(f"{a}_{m}")) for a in "xyz" for m in ("min", "max")})


@query(f"""WITH {FACES}, b AS {_BOX}, j AS (SELECT scene_id, b.instance AS region, fid, area, cx BETWEEN x_min AND x_max AND cy BETWEEN y_min AND y_max AS core FROM faces f JOIN b USING (scene_id) WHERE cx BETWEEN x_min - 0.75 AND x_max + 0.75 AND cy BETWEEN y_min - 0.75 AND y_max + 0.75)
SELECT scene_id, region, sum(CASE WHEN core THEN 1 ELSE 0 END)::BIGINT AS n_core, sum(CASE WHEN core THEN 0 ELSE 1 END)::BIGINT AS n_context, ceil(sum(CASE WHEN core THEN area ELSE 0 END) * 2500 - 1e-6)::BIGINT AS n_points FROM j GROUP BY scene_id, region""")
def joi6_region_halo(spark, d):
    """Core and context faces of each region by the cells of its widened bounds (JOI6, AGG2)."""
    f = _faces(spark, d)
    b = _boxes(f).selectExpr("scene_id", "instance AS region", "x_min AS kx0", "x_max AS kx1", "y_min AS ky0", "y_max AS ky1", "x_min - 0.75 AS x_min", "x_max + 0.75 AS x_max", "y_min - 0.75 AS y_min", "y_max + 0.75 AS y_max")
    j = spatial.boxes_holding(f.select("scene_id", "fid", "area", F.col("cx").alias("x"), F.col("cy").alias("y")), b, 2.0, ("scene_id",))
    j = j.withColumn("core", F.expr("x BETWEEN kx0 AND kx1 AND y BETWEEN ky0 AND ky1"))
    return j.groupBy("scene_id", "region").agg(F.count_if("core").alias("n_core"), F.count_if(~F.col("core")).alias("n_context"), F.ceil(F.sum(F.when(F.col("core"), F.col("area")).otherwise(0.0)) * 2500 - 1e-6).alias("n_points"))


def patches(f: DataFrame) -> DataFrame:
    """f with the patch of each face: faces of one scene, class and instance that share vertices; a patch is known by its scene_id and its smallest face's id (ITR4).

    Faces meet at their vertices: each is linked with the smallest face of its group at each of its
    vertices, which keeps a vertex of many faces linear. Face and vertex ids need be unique in their scene only.
    """
    group = ["scene_id", "semantic", "instance", "v"]
    corner = f.select("scene_id", "fid", "semantic", "instance", F.explode(F.array("v0", "v1", "v2")).alias("v"))
    first = corner.groupBy(*group).agg(F.min("fid").alias("low"))
    # faces of near numbers are often neighbours
    edges = corner.join(first, group).withColumn("block", F.floor(F.col("low") / 65536))
    comp = connected_components(edges, "fid", "low", ("scene_id",), ("block",)).withColumnRenamed("node", "fid")
    return f.join(comp, ["scene_id", "fid"], "left").withColumn("patch", F.coalesce("component", "fid")).drop("component")


_PATCH = f"""{FACES}, s AS (SELECT * FROM faces WHERE {_SUPPORT}), c AS (SELECT scene_id, fid, semantic, instance, unnest([v0, v1, v2]) AS v FROM s),
e AS (SELECT DISTINCT scene_id, a.fid AS a, b.fid AS b FROM c a JOIN c b USING (scene_id, semantic, instance, v)),
reach AS (SELECT scene_id, fid, fid AS root FROM s UNION SELECT e.scene_id, e.b, r.root FROM reach r JOIN e ON e.a = r.fid AND e.scene_id = r.scene_id WHERE r.root < e.b),
p AS (SELECT scene_id, fid, min(root) AS patch FROM reach GROUP BY scene_id, fid), sp AS (SELECT * FROM s JOIN p USING (scene_id, fid))"""


@query(f"WITH RECURSIVE {_PATCH} SELECT scene_id, fid, patch FROM p")
def itr4_mesh_components(spark, d):
    return patches(support_faces(_face_table(spark, d))).select("scene_id", "fid", "patch")


_SUMMARY = f"q AS (SELECT scene_id, patch, min(semantic) AS semantic, min(instance) AS instance, count(*) AS n_faces, round(sum(area) + 1e-9, 4) AS area, round(sum(area * cx) / sum(area) + 1e-9, 4) AS x, round(sum(area * cy) / sum(area) + 1e-9, 4) AS y, round(sum(area * cz) / sum(area) + 1e-9, 4) AS z, {", ".join(f"round(sum(area * n{a}) / sqrt(sum(area * nx) * sum(area * nx) + sum(area * ny) * sum(area * ny) + sum(area * nz) * sum(area * nz)) + 1e-9, 4) + 0e0 AS n{a}" for a in "xyz")}, {", ".join(f"round(min(least({a}0, {a}1, {a}2)) + 1e-9, 4) AS {a}_min, round(max(greatest({a}0, {a}1, {a}2)) + 1e-9, 4) AS {a}_max" for a in "xyz")} FROM sp GROUP BY scene_id, patch HAVING sum(area) >= 0.04)"


def patch_summary(p: DataFrame, least_area: float = 0.04) -> DataFrame:
    """Each patch's faces, area, weighted centroid, weighted unit normal (nx, ny, nz) and bounds; patches of less area are left out (AGG20)."""
    total = lambda c: F.sum(F.col("area") * F.col(c))
    size = F.sqrt(sum(total(f"n{a}") * total(f"n{a}") for a in "xyz"))
    bounds = [x for a in "xyz" for x in (F.min(F.least(*(f"{a}{k}" for k in range(3)))).alias(f"{a}_min"), F.max(F.greatest(*(f"{a}{k}" for k in range(3)))).alias(f"{a}_max"))]
    s = p.groupBy("scene_id", "patch").agg(F.min("semantic").alias("semantic"), F.min("instance").alias("instance"), F.count("*").alias("n_faces"), F.sum("area").alias("area"), *((total(f"c{a}") / F.sum("area")).alias(a) for a in "xyz"), *((total(f"n{a}") / F.greatest(size, F.lit(1e-12))).alias(f"n{a}") for a in "xyz"), *bounds)
    return s.where(F.col("area") >= least_area)


def _rounded(s: DataFrame) -> DataFrame:
    """Figures to four places, for the comparison with SQL."""
    return s.select(*((R(F.col(c)) + 0.0).alias(c) if t == "double" else F.col(c) for c, t in s.dtypes))


@query(f"WITH RECURSIVE {_PATCH}, {_SUMMARY} SELECT * FROM q")
def agg20_patch_summary(spark, d):
    return _rounded(patch_summary(patches(support_faces(_face_table(spark, d)))))


def boundary_edges(p: DataFrame) -> DataFrame:
    """(scene_id, patch, a, b, ax, ay, bx, by): edges of exactly one face of their patch, with their ends in XY (AGG21)."""

    def edge(i: int, j: int):
        turned = F.col(f"v{i}") > F.col(f"v{j}")
        end = lambda p, q, n: F.when(turned, F.col(f"{p}{j if n == 'a' else i}")).otherwise(F.col(f"{p}{i if n == 'a' else j}")).alias(q)
        return F.struct(*(end(p, q, n) for n in "ab" for p, q in (("v", n), ("x", f"{n}x"), ("y", f"{n}y"))))

    e = p.select("scene_id", "patch", F.explode(F.array(edge(0, 1), edge(1, 2), edge(2, 0))).alias("e")).select("scene_id", "patch", "e.*")
    at = ("ax", "ay", "bx", "by")
    return e.groupBy("scene_id", "patch", "a", "b").agg(F.count("*").alias("n"), *(F.min(c).alias(c) for c in at)).where("n = 1").drop("n")


_EDGES = "ed AS (SELECT scene_id, patch, unnest([{'a': least(v0, v1), 'b': greatest(v0, v1)}, {'a': least(v1, v2), 'b': greatest(v1, v2)}, {'a': least(v2, v0), 'b': greatest(v2, v0)}]) AS e FROM sp), bd AS (SELECT scene_id, patch, e.a AS a, e.b AS b FROM ed GROUP BY ALL HAVING count(*) = 1)"


@query(f"WITH RECURSIVE {_PATCH}, {_EDGES} SELECT * FROM bd")
def agg21_boundary_edges(spark, d):
    return boundary_edges(patches(support_faces(_face_table(spark, d)))).select("scene_id", "patch", "a", "b")


_TOP = "cand AS (SELECT scene_id, patch, fid, cx, cy, row_number() OVER (PARTITION BY scene_id, patch ORDER BY round(area + 1e-9, 6) DESC, fid) AS k FROM sp)"


def candidates(p: DataFrame, most: int = 96) -> DataFrame:
    """(scene_id, patch, fid, cx, cy, cz, k): centroids of each patch's largest faces, the smallest id first among equals (TOP3). Spark keeps only the first `most` of a patch in each task before it shuffles."""
    k = F.row_number().over(Window.partitionBy("scene_id", "patch").orderBy(F.col("area").desc(), "fid"))
    return p.withColumn("k", k).where(F.col("k") <= most).select("scene_id", "patch", "fid", "cx", "cy", "cz", "k")


def _six(f: DataFrame) -> DataFrame:
    """Areas to six places, by which both engines rank."""
    return f.withColumn("area", R(F.col("area"), 6))


@query(f"WITH RECURSIVE {_PATCH}, {_TOP} SELECT scene_id, patch, fid, k::INT AS k FROM cand WHERE k <= 96")
def top3_candidate_points(spark, d):
    return candidates(_six(patches(support_faces(_face_table(spark, d))))).select("scene_id", "patch", "fid", "k")


_CLEAR = """seg AS (SELECT scene_id, patch, (a % 65) * 0.25e0 AS ax, (a // 65) * 0.25e0 AS ay, (b % 65) * 0.25e0 AS bx, (b // 65) * 0.25e0 AS by_ FROM bd),
cs AS (SELECT scene_id, patch, c.fid, cx, cy, ax, ay, bx - ax AS dx, by_ - ay AS dy FROM cand c LEFT JOIN seg USING (scene_id, patch) WHERE k <= 96),
ct AS (SELECT *, greatest(0, least(1, ((cx - ax) * dx + (cy - ay) * dy) / greatest(dx * dx + dy * dy, 1e-12))) AS t FROM cs),
cl AS (SELECT scene_id, patch, fid, round(coalesce(min(sqrt((cx - ax - t * dx) * (cx - ax - t * dx) + (cy - ay - t * dy) * (cy - ay - t * dy))), 0) + 1e-9, 4) AS clearance FROM ct GROUP BY scene_id, patch, fid)"""


def clearances(c: DataFrame, edges: DataFrame) -> DataFrame:
    """(scene_id, patch, fid, clearance): each candidate's distance in XY from its patch's boundary; 0 for a patch without one (GEO9). edges: those of boundary_edges(), with their ends."""
    s = edges.select("scene_id", "patch", "ax", "ay", "bx", "by")
    d = G.segment_distance(*(F.col(k) for k in ("cx", "cy", "ax", "ay", "bx", "by")))
    return c.join(s, ["scene_id", "patch"], "left").groupBy("scene_id", "patch", "fid").agg(F.coalesce(F.min(d), F.lit(0.0)).alias("clearance"))


@query(f"WITH RECURSIVE {_PATCH}, {_EDGES}, {_TOP}, {_CLEAR} SELECT * FROM cl")
def geo9_boundary_clearance(spark, d):
    p = patches(support_faces(_face_table(spark, d)))
    return clearances(candidates(_six(p)), boundary_edges(p)).withColumn("clearance", R(F.col("clearance")))


@query(f"WITH RECURSIVE {_PATCH}, {_SUMMARY}, {_EDGES}, {_TOP}, {_CLEAR}, n AS (SELECT scene_id, patch, 'support_' || lpad((row_number() OVER (PARTITION BY scene_id ORDER BY semantic, instance, patch) - 1)::VARCHAR, 5, '0') AS patch_id FROM q), b AS (SELECT scene_id, patch, max(clearance) AS best FROM cl GROUP BY scene_id, patch) SELECT patch_id, q.*, best FROM q JOIN n USING (scene_id, patch) JOIN b USING (scene_id, patch)")
def support_patches(spark, d):
    """Support patches in full: components, totals, numbering and the clearest candidate (FIL6, ITR4, AGG20, AGG21, GEO9, TOP2, TOP3)."""
    p = materialize(patches(support_faces(_face_table(spark, d))), "patches")
    q = _rounded(patch_summary(p))
    number = F.row_number().over(Window.partitionBy("scene_id").orderBy("semantic", "instance", "patch")) - 1
    q = q.withColumn("patch_id", F.concat(F.lit("support_"), F.lpad(number.cast("string"), 5, "0")))
    best = clearances(candidates(_six(p)), boundary_edges(p)).groupBy("scene_id", "patch").agg(R(F.max("clearance")).alias("best"))
    return q.join(best, ["scene_id", "patch"])


_FLOOR = f"""{FACES}, up AS (SELECT *, floor(cx / 0.5)::BIGINT AS gx, floor(cy / 0.5)::BIGINT AS gy, floor(cz / 0.25)::BIGINT AS gz FROM faces WHERE nz >= cos(radians(15)) AND area > 1e-10),
cells AS (SELECT DISTINCT scene_id, gx, gy, gz, scene_id || '/' || gx || '/' || gy || '/' || gz AS k FROM up),
fe AS (SELECT a.k AS a, b.k AS b FROM cells a JOIN cells b ON a.scene_id = b.scene_id AND abs(a.gx - b.gx) <= 1 AND abs(a.gy - b.gy) <= 1 AND abs(a.gz - b.gz) <= 1),
fr AS (SELECT k, k AS root FROM cells UNION SELECT fe.b, r.root FROM fr r JOIN fe ON fe.a = r.k WHERE r.root < fe.b),
fc AS (SELECT k, min(root) AS floor FROM fr GROUP BY k)"""


def upward_faces(f: DataFrame, degrees: float = 15, least_area: float = 1e-10) -> DataFrame:
    """Faces that look up (FIL5)."""
    return f.where((F.col("nz") >= F.cos(F.radians(F.lit(degrees)))) & (F.col("area") > least_area))


def floor_faces(up: DataFrame, size: float = 0.5, height: float = 0.25) -> DataFrame:
    """up with the floor of each face: a scene's upward faces flooded over neighbouring cells (ITR2).

    A cell is known by its scene and its three numbers; an edge is listed once, from the cell that
    comes first in 13 of the 26 directions. Edges of 64 x 64 columns of cells are connected together first.
    """
    up = up.withColumns({"c_x": spatial.cell("cx", size), "c_y": spatial.cell("cy", size), "c_z": spatial.cell("cz", height)})
    axes = ["scene_id", "c_x", "c_y", "c_z"]
    up = up.withColumn("k", F.concat_ws("/", *axes))
    cells = up.select(*axes, "k").distinct()
    steps = [(x, y, z) for x in (0, 1) for y in (-1, 0, 1) for z in (-1, 0, 1) if (x, y, z) > (0, 0, 0)]
    step = F.explode(F.array(*(F.struct(*(F.lit(v).alias(a) for a, v in zip("xyz", t, strict=True))) for t in steps)))
    near = cells.withColumn("s", step).select("scene_id", F.col("k").alias("a"), *((F.col(f"c_{a}") + F.col(f"s.{a}")).alias(f"c_{a}") for a in "xyz"))
    edges = near.join(cells.withColumnRenamed("k", "b"), axes).withColumns({f"t_{a}": F.floor(F.col(f"c_{a}") / 64) for a in "xy"})
    comp = connected_components(edges, "a", "b", near=("scene_id", "t_x", "t_y"))
    return up.join(comp.withColumnRenamed("node", "k"), "k", "left").withColumn("floor", F.coalesce("component", "k")).drop("component")


def floors(up: DataFrame, size: float = 0.5, height: float = 0.25, least_area: float = 2.0, large: int = 1 << 20) -> DataFrame:
    """(scene_id, floor, n_faces, area, z): totals of the floors of floor_faces(), small ones left out; z is the median height, of floors with more than `large` faces by selection (AGG3)."""
    f = materialize(floor_faces(up, size, height).select("scene_id", "floor", "area", "cz"), "floor-areas")
    area = f.groupBy("scene_id", "floor").agg(F.sum("area").alias("area")).where(F.col("area") >= least_area)
    return area.join(medians(f, ["scene_id", "floor"], ["cz"], large), ["scene_id", "floor"]).select("scene_id", "floor", F.col("n").alias("n_faces"), "area", F.col("cz").alias("z"))


@query(f"WITH RECURSIVE {_FLOOR} SELECT scene_id, floor, count(*) AS n_faces, round(sum(area) + 1e-9, 3) AS area, round(median(cz) + 1e-9, 4) AS z FROM up JOIN fc ON fc.k = scene_id || '/' || gx || '/' || gy || '/' || gz GROUP BY scene_id, floor HAVING sum(area) >= 2")
def itr2_floors(spark, d):
    return floors(upward_faces(_face_table(spark, d))).select("scene_id", "floor", "n_faces", R(F.col("area"), 3).alias("area"), R(F.col("z")).alias("z"))
