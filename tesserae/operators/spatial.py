"""Grid-bucketed joins: pairs meet on equal cells, never by a bare range condition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserae.plans.materialize import materialize


def cell(col: str, size: float):
    return F.floor(F.col(col) / size).cast("long")


def neighbours(df: DataFrame, axes: list[str], size: float) -> DataFrame:
    """df with one row for each cell around a row's own, as columns c_<axis>."""
    for a in axes:
        df = df.withColumn(f"c_{a}", F.explode(F.array(*(cell(a, size) + k for k in (-1, 0, 1)))))
    return df


def nearest_within(queries: DataFrame, reference: DataFrame, radius: float, by: tuple[str, ...] = (), full: int = 64) -> DataFrame:
    """(*by, qid, pid, dist): each query point's closest reference point within the radius, the lowest id among equals (JOI8).

    Inputs have pid, x, y, z and the columns of by (a scene), within which ids are unique and points meet. A query first looks in the
    27 cells around it of a fine grid, whose fullest cell holds `full` reference points at most (or that is 2^10 times finer than the
    radius). Whatever is closer than a cell's side is certain to be found; queries without such a point look again in cells of twice the side, up to the radius.
    So where points are dense few are met, however many lie within the radius. A minimum by query is a partial aggregation.
    """
    r = reference.select(*by, F.col("pid").alias("rid"), *(F.col(a).alias(f"r{a}") for a in "xyz"))
    left = queries.select(*by, "pid", "x", "y", "z")
    fine = 0
    while fine < 10 and (r.groupBy(*by, *(F.floor(F.col(f"r{a}") / (radius / 2**fine)) for a in "xyz")).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0) > full:
        fine += 1
    found = None
    for k in range(fine, -1, -1):
        side = radius / 2**k
        q = neighbours(left, ["x", "y", "z"], side)
        at = r.select("*", *(F.floor(F.col(f"r{a}") / side).cast("long").alias(f"c_{a}") for a in "xyz"))
        d = F.sqrt(sum((F.col(a) - F.col(f"r{a}")) * (F.col(a) - F.col(f"r{a}")) for a in "xyz"))
        near = q.join(at, [*by, "c_x", "c_y", "c_z"]).withColumn("dist", d).where(F.col("dist") < side)
        best = near.groupBy(*by, F.col("pid").alias("qid")).agg(F.min(F.struct("dist", "rid")).alias("m"))
        best = best.select(*by, "qid", F.col("m.rid").alias("pid"), F.col("m.dist").alias("dist"))
        if k:
            best = materialize(best, "nearest")
            left = materialize(left.join(best.select(*by, F.col("qid").alias("pid")), [*by, "pid"], "left_anti"), "nearest-left")
        found = best if found is None else found.unionByName(best)
    return found


def level(extent: Column, size: float) -> Column:
    """The level of the grid at which a box of this extent covers two cells an axis at most: cells of size * 2^level; 0 for small boxes."""
    return F.when(extent > size, F.ceil(F.log2(extent / size))).otherwise(0).cast("int")


def cell_at(at: Column, lev: Column, size: float) -> Column:
    """The cell of a place on a level."""
    return F.floor(at / (size * F.pow(F.lit(2.0), lev))).cast("long")


def cells_between(low: Column, high: Column, lev: Column, size: float) -> Column:
    return F.sequence(cell_at(low, lev, size), cell_at(high, lev, size))


def levels(boxes: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """(*by, level): the levels that a scene's boxes have; a few rows a scene."""
    return boxes.select(*by, "level").distinct()


def boxes_holding(points: DataFrame, boxes: DataFrame, size: float, by: tuple[str, ...]) -> DataFrame:
    """Points with each box (x_min, x_max, y_min, y_max) of their scene (by) that holds them, both ends included (JOI6).

    A box is filed at the level of its own extent, so it lists four cells at most, whatever its size; a
    point looks in one cell of each level that its scene has.
    """
    b = boxes.withColumn("level", level(F.greatest(F.col("x_max") - F.col("x_min"), F.col("y_max") - F.col("y_min")), size))
    p = points.join(levels(b, by), list(by))
    p = p.withColumns({f"c_{a}": cell_at(F.col(a), F.col("level"), size) for a in "xy"})
    for a in "xy":
        b = b.withColumn(f"c_{a}", F.explode(cells_between(F.col(f"{a}_min"), F.col(f"{a}_max"), F.col("level"), size)))
    inside = (F.col("x") >= F.col("x_min")) & (F.col("x") <= F.col("x_max")) & (F.col("y") >= F.col("y_min")) & (F.col("y") <= F.col("y_max"))
    return p.join(b, [*by, "level", "c_x", "c_y"]).where(inside).drop("level", "c_x", "c_y")
