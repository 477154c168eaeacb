"""Placing objects on supports: boxes, an ordered search over trials, reasons for failures (GEO12, SMP7, SMP8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesserae.operators.rays import ray_hits, touching

#: In the order in which they are checked.
REASONS = ("scale", "outside", "clearance", "collision", "occluded")


def placed_boxes(objects: DataFrame, clearance: float = 0.005) -> DataFrame:
    """World boxes of objects (uid, dx, dy, dz, yaw, px, py, pz, target): turned upright, then by yaw, scaled to a size, set down on a point (GEO12).

    up (+Z if there is no such column) names the axis of the object's box that is to stand upright;
    dimension ("height" if there is no such column) says whether target is the height or the "longest" side of the turned
    object's box. scale is null for an object without that extent.
    """
    axis = F.substring("up", 2, 1) if "up" in objects.columns else F.lit("Z")
    side = lambda x, y, z: F.when(axis == "X", F.col(x)).when(axis == "Y", F.col(y)).otherwise(F.col(z))
    ex, ey, ez = side("dz", "dx", "dx"), side("dy", "dz", "dy"), side("dx", "dy", "dz")
    c, s = F.abs(F.cos("yaw")), F.abs(F.sin("yaw"))
    o = objects.withColumns({"_x": c * ex + s * ey, "_y": s * ex + c * ey, "_z": ez})
    longest = (F.col("dimension") == "longest") if "dimension" in objects.columns else F.lit(False)
    size = F.when(longest, F.greatest("_x", "_y", "_z")).otherwise(F.col("_z"))
    o = o.withColumn("scale", F.when(size > 1e-8, F.col("target") / size))
    out = {}
    for a in "xy":
        half = F.col("scale") * F.col(f"_{a}") / 2
        out |= {f"{a}_min": F.col(f"p{a}") - half, f"{a}_max": F.col(f"p{a}") + half}
    return o.withColumns(out | {"z_min": F.col("pz") + clearance, "z_max": F.col("pz") + clearance + F.col("scale") * F.col("_z")}).drop("_x", "_y", "_z")


def uniform(seed: int, *keys: str) -> Column:
    """A number in [0, 1) that follows from the keys alone, whatever the partitions."""
    return F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1 << 40)) / (1 << 40)


def trials(objects: DataFrame, supports: DataFrame, points: DataFrame, seed: int, positions: int = 24, yaws: int = 12) -> DataFrame:
    """Every trial of a search, in an order that the seed fixes: each object on each support of its classes, at up to `positions` points, with `yaws` turns.

    objects: (observation, uid, turn, classes, dx, dy, dz, target_min, target_max), turn being their order;
    supports: (observation, patch, class, x_lo, x_hi, y_lo, y_hi); points: (observation, patch, point,
    px, py, pz, clearance). A trial's order is (turn, patch_turn, point_turn, yaw_turn).
    """
    on = objects.withColumn("class", F.explode(F.array_distinct("classes"))).join(supports, ["observation", "class"])
    on = on.drop("classes").withColumn("patch_turn", F.xxhash64(F.lit(seed), "observation", "uid", "patch"))
    at = on.join(points, ["observation", "patch"])
    k = F.row_number().over(Window.partitionBy("observation", "uid", "patch").orderBy(F.xxhash64(F.lit(seed), "observation", "uid", "patch", "point"), "point"))
    at = at.withColumn("point_turn", k).where(F.col("point_turn") <= positions)
    t = at.withColumn("yaw_turn", F.explode(F.sequence(F.lit(0), F.lit(yaws - 1))))
    keys = ("observation", "uid", "patch", "point", "yaw_turn")
    yaw = (uniform(seed, *keys) * 2 - 1) * 3.141592653589793
    target = F.col("target_min") + uniform(seed + 1, *keys) * (F.col("target_max") - F.col("target_min"))
    return t.withColumns({"yaw": yaw, "target": target})


def searched(tried: DataFrame, faces: DataFrame, eyes: DataFrame, margin: float = 0.03, smallest: float = 0.001, largest: float = 100.0) -> DataFrame:
    """tried() up to the first trial of each observation that passes, each with its first reason for failing, '' for the winner (SMP7).

    faces: (scene_id, fid, corners, nz); eyes: (observation, scene_id, eye_x, eye_y, eye_z). The cheap reasons come first;
    only trials that pass them meet the scene's faces: boxes that touch, then what stands between the eye and the box's
    centre. A winner has the place to look at (look_x, look_y, look_z) from the eye (SMP8).
    """
    p = placed_boxes(tried).join(eyes, "observation")
    p = p.withColumns({f"look_{a}": (F.col(f"{a}_min") + F.col(f"{a}_max")) / 2 for a in "xyz"})
    p = p.withColumn("order", F.struct("turn", "patch_turn", "patch", "point_turn", "yaw_turn")).withColumn("key", F.concat_ws("/", "observation", "uid", "patch", "point", "yaw_turn"))
    half = F.hypot(F.col("x_max") - F.col("x_min"), F.col("y_max") - F.col("y_min")) / 2
    cheap = F.when(F.col("scale").isNull() | ~F.col("scale").between(smallest, largest), "scale").when(F.expr("x_min < x_lo OR x_max > x_hi OR y_min < y_lo OR y_max > y_hi"), "outside").when(F.col("clearance") < half + margin, "clearance").otherwise("")
    p = p.withColumn("cheap", cheap)
    left = p.where("cheap = ''").select("scene_id", "key", *(f"{a}_{m}" for a in "xyz" for m in ("min", "max")), *(f"eye_{a}" for a in "xyz"), *(f"look_{a}" for a in "xyz"))
    boxes = faces.select("scene_id", F.col("fid").alias("b"), *(e for x in "xyz" for e in (F.least(*(f"{x}{k}" for k in range(3))).alias(f"{x}_min"), F.greatest(*(f"{x}{k}" for k in range(3))).alias(f"{x}_max"))))
    hit = touching(left.withColumnRenamed("key", "a"), boxes, 0.5).select("scene_id", F.col("a").alias("key")).distinct().withColumn("hit", F.lit(True))
    way = {a: F.col(f"look_{a}") - F.col(f"eye_{a}") for a in "xyz"}
    size = F.sqrt(sum(v * v for v in way.values()))
    rays = left.withColumn("len", size - 1e-3).select("scene_id", F.col("key").alias("ray"), *(F.col(f"eye_{a}").alias(f"o{a}") for a in "xyz"), *((v / size).alias(f"d{a}") for a, v in way.items()), "len")
    dark = ray_hits(rays, faces).select("scene_id", F.col("ray").alias("key")).withColumn("dark", F.lit(True))
    j = p.join(hit, ["scene_id", "key"], "left").join(dark, ["scene_id", "key"], "left")
    j = j.withColumn("reason", F.when(F.col("cheap") != "", F.col("cheap")).when(F.col("hit"), "collision").when(F.col("dark"), "occluded").otherwise(""))
    won = j.groupBy("observation").agg(F.min(F.when(F.col("reason") == "", F.col("order"))).alias("first"))
    return j.join(won, "observation").where(F.col("first").isNull() | (F.col("order") <= F.col("first"))).drop("cheap", "hit", "dark", "first")
