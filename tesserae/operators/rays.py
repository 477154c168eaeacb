"""Rays and boxes against a scene's triangles, met on grid cells (JOI14, JOI15)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserae.operators import spatial


def _cross(a: list[Column], b: list[Column]) -> list[Column]:
    return [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]


def _dot(a: list[Column], b: list[Column]) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


#: How far a place may be off by rounding; cells are listed that much wider.
_SLACK = 1e-6


def _walked(rays: DataFrame, size: float) -> DataFrame:
    """rays (with a level) with the cells of that level along their way, as c_x, c_y: column by column, in each the rows that the ray passes there."""
    c, step = F.col, F.lit(size) * F.pow(F.lit(2.0), F.col("level"))
    end = {a: c(f"o{a}") + c(f"d{a}") * c("len") for a in "xy"}
    low = {a: F.least(c(f"o{a}"), end[a]) for a in "xy"}
    high = {a: F.greatest(c(f"o{a}"), end[a]) for a in "xy"}
    r = rays.withColumn("c_x", F.explode(spatial.cells_between(low["x"] - _SLACK, high["x"] + _SLACK, c("level"), size)))
    # where the ray is in Y while it is in this column
    at = lambda x: c("oy") + (x - c("ox")) * c("dy") / c("dx")
    left, right = F.greatest(low["x"], c("c_x") * step) - _SLACK, F.least(high["x"], (c("c_x") + 1) * step) + _SLACK
    steep = F.abs(c("dx")) * c("len") <= _SLACK
    ya, yb = (F.when(steep, b["y"]).otherwise(F.greatest(low["y"], F.least(high["y"], at(x)))) for x, b in ((left, low), (right, high)))
    return r.withColumn("c_y", F.explode(spatial.cells_between(F.least(ya, yb) - _SLACK, F.greatest(ya, yb) + _SLACK, c("level"), size)))


def ray_hits(rays: DataFrame, faces: DataFrame, size: float = 0.5) -> DataFrame:
    """(scene_id, ray, n_hits, t, nz): faces of its scene_id that each ray (ray, ox..oz, unit dx..dz, len) meets, the nearest distance and the upward part of the nearest face's normal; rays without a hit have no row (JOI14).

    A triangle is filed in XY at the level of its own size, so it lists four cells or little more, however
    large; a ray walks the cells of each level that its scene has, as many as it passes. What meets is tested
    by column arithmetic, and a hit counts in the cell that holds it.
    """
    c = F.col
    f = faces.select("scene_id", "nz", *(f"{a}{k}" for k in range(3) for a in "xyz"))
    low = {a: F.least(*(f"{a}{k}" for k in range(3))) for a in "xy"}
    high = {a: F.greatest(*(f"{a}{k}" for k in range(3))) for a in "xy"}
    f = f.withColumn("level", spatial.level(F.greatest(*(high[a] - low[a] for a in "xy")), size))
    r = _walked(rays.join(spatial.levels(f, ("scene_id",)), "scene_id"), size)
    for a in "xy":
        f = f.withColumn(f"c_{a}", F.explode(spatial.cells_between(low[a] - _SLACK, high[a] + _SLACK, c("level"), size)))
    j = r.join(f, ["scene_id", "level", "c_x", "c_y"])
    e1, e2 = ([c(f"{a}{k}") - c(f"{a}0") for a in "xyz"] for k in (1, 2))
    o, dv = [c(f"o{a}") - c(f"{a}0") for a in "xyz"], [c(f"d{a}") for a in "xyz"]
    p = _cross(dv, e2)
    det, q = _dot(e1, p), _cross(o, e1)
    j = j.withColumns({"det": det, "u": _dot(o, p), "v": _dot(dv, q), "w": _dot(e2, q)}).where("abs(det) > 1e-12")
    own = " AND ".join(f"c_{a} = CAST(floor((o{a} + d{a} * w / det) / ({size!r} * pow(2e0, level))) AS BIGINT)" for a in "xy")
    j = j.where(own).selectExpr("scene_id", "ray", "nz", "len", "u / det AS u", "v / det AS v", "w / det AS t").where("u >= 0 AND v >= 0 AND u + v <= 1 AND t >= 0 AND t <= len")
    return j.groupBy("scene_id", "ray").agg(F.count("*").alias("n_hits"), F.min("t").alias("t"), F.min(F.struct("t", "nz")).getField("nz").alias("nz"))


def touching(a: DataFrame, b: DataFrame, size: float) -> DataFrame:
    """(scene_id, a, b): pairs of boxes (x_min..z_max) of one scene_id, of a (key a) and b (key b), that overlap (JOI15).

    A pair meets at the level of the larger box, in the first cell that both cover there. So a box lists
    its cells, four at most, at its own level and at the coarser ones that the other side has, and a floor-sized box
    no more than a small one.
    """

    def sized(df: DataFrame, p: str) -> DataFrame:
        df = df.select("scene_id", p, *(F.col(f"{x}_{m}").alias(f"{p}{x}_{m}") for x in "xyz" for m in ("min", "max")))
        return df.withColumn("level", spatial.level(F.greatest(*(F.col(f"{p}{x}_max") - F.col(f"{p}{x}_min") for x in "xy")), size))

    def spread(df: DataFrame, p: str, of: DataFrame) -> DataFrame:
        df = df.withColumnRenamed("level", f"{p}level").join(of, "scene_id").where(F.col("level") >= F.col(f"{p}level"))
        for x in "xy":
            low, high = F.col(f"{p}{x}_min"), F.col(f"{p}{x}_max")
            df = df.withColumn(f"{p}{x}", spatial.cell_at(low, F.col("level"), size)).withColumn(f"c_{x}", F.explode(spatial.cells_between(low, high, F.col("level"), size)))
        return df

    a, b = sized(a, "a"), sized(b, "b")
    of = spatial.levels(a, ("scene_id",)).union(spatial.levels(b, ("scene_id",))).distinct()
    j = spread(a, "a", of).join(spread(b, "b", of), ["scene_id", "level", "c_x", "c_y"])
    j = j.where("level = greatest(alevel, blevel)").where(" AND ".join(f"c_{x} = greatest(a{x}, b{x})" for x in "xy"))
    return j.where(" AND ".join(f"a{x}_min < b{x}_max AND b{x}_min < a{x}_max" for x in "xyz")).select("scene_id", "a", "b")


def _ring(n: int, r: float) -> list[tuple[float, float]]:
    return [(r * math.cos(2 * math.pi * k / n), r * math.sin(2 * math.pi * k / n)) for k in range(n)]


def anchor_probes(eye: float = 1.6) -> list[tuple]:
    """(kind, ox, oy, oz, dx, dy, dz, len) of the rays about a standing place: one up, three rings to the sides, a ring of feet down."""
    head = [("head", 0.0, 0.0, 0.05, 0.0, 0.0, 1.0, 1.8)]
    body = [("body", 0.0, 0.0, h, x, y, 0.0, 0.35) for h in (0.3, min(0.9, eye), eye) for x, y in _ring(16, 1.0)]
    return head + body + [("ground", x, y, 0.35, 0.0, 0.0, -1.0, 0.7) for x, y in _ring(8, 0.28)]


def anchor_checks(anchors: DataFrame, faces: DataFrame, eye: float = 1.6, step: float = 0.3, flat: float = 0.7) -> DataFrame:
    """(scene_id, anchor, head, body, ground) of places (scene_id, anchor, x, y, z): whether nothing is in the way of the head and the body, and whether all feet meet flat ground (JOI14).

    Ground is met if each ray down first hits a face within `step` of the place's height whose upright part of the normal is `flat` or more.
    """
    probes = F.array(*(F.struct(F.lit(k).alias("k"), *(F.lit(v).alias(n) for n, v in zip(("kind", "px", "py", "pz", "dx", "dy", "dz", "len"), p, strict=True))) for k, p in enumerate(anchor_probes(eye))))
    r = anchors.withColumn("p", F.explode(probes)).select("scene_id", "anchor", "z", "p.*", F.concat_ws("/", "anchor", "p.k").alias("ray"), *((F.col(a) + F.col(f"p.p{a}")).alias(f"o{a}") for a in "xyz"))
    h = r.join(ray_hits(r.select("scene_id", "ray", *(f"{c}{a}" for c in "od" for a in "xyz"), "len"), faces).select("scene_id", "ray", "t", "nz"), ["scene_id", "ray"], "left")
    free = lambda kind: F.bool_and(F.when(F.col("kind") == kind, F.col("t").isNull()))
    firm = F.coalesce((F.abs(F.col("oz") - F.col("t") - F.col("z")) <= step) & (F.col("nz") >= flat), F.lit(False))
    return h.groupBy("scene_id", "anchor").agg(free("head").alias("head"), free("body").alias("body"), F.bool_and(F.when(F.col("kind") == "ground", firm)).alias("ground"))
