"""Run-length masks and index runs (SRC7, SRC8, SRC9, FIL4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def encode_runs(bits: DataFrame) -> DataFrame:
    """(mask, rle): lengths of alternating runs of (mask, idx, bit), the first of zeros, even if empty."""
    w = Window.partitionBy("mask").orderBy("idx")
    change = F.coalesce((F.col("bit") != F.lag("bit").over(w)).cast("int"), F.lit(0))
    run = bits.withColumn("_c", change).withColumn("run", F.sum("_c").over(w))
    sized = run.groupBy("mask", "run").agg(F.count("*").alias("n"), F.min("bit").alias("bit"))
    lists = sized.groupBy("mask").agg(F.sort_array(F.collect_list(F.struct("run", "n", "bit"))).alias("r"))
    rle = F.transform("r", lambda x: x["n"])
    return lists.select("mask", F.when(F.col("r")[0]["bit"] == 1, F.concat(F.array(F.lit(0).cast("long")), rle)).otherwise(rle).alias("rle"))


def decode_runs(runs: DataFrame) -> DataFrame:
    """(mask, idx): places of the ones of each run list."""
    runs = runs.select("mask", F.posexplode("rle").alias("pos", "n"))
    end = F.sum("n").over(Window.partitionBy("mask").orderBy("pos"))
    ones = runs.withColumn("end", end).where("pos % 2 = 1 AND n > 0")
    return ones.select("mask", F.explode(F.expr("sequence(end - n, end - 1)")).alias("idx"))


def compact(indices: DataFrame, owner: str, idx: str) -> DataFrame:
    """(owner, start, end) of each owner's runs of consecutive indices, ends included."""
    d = indices.select(owner, idx).distinct()
    island = F.col(idx) - F.row_number().over(Window.partitionBy(owner).orderBy(idx))
    return d.withColumn("_i", island).groupBy(owner, "_i").agg(F.min(idx).alias("start"), F.max(idx).alias("end")).drop("_i")


def run_problems(runs: DataFrame) -> DataFrame:
    """(mask, problem) of run lists (mask, rle, height, width) that cannot be decoded: a negative run, or a sum that is not the image's size (SRC7)."""
    total = F.aggregate("rle", F.lit(0).cast("long"), lambda s, x: s + x)
    problem = F.when(F.exists("rle", lambda x: x < 0), "negative run").when(total != F.col("height") * F.col("width"), "size mismatch")
    return runs.select("mask", problem.alias("problem")).where("problem IS NOT NULL")


def decode_pixels(runs: DataFrame) -> DataFrame:
    """(mask, row, col) of the ones of run lists (mask, rle, height), which go down the columns; lists with problems are for run_problems() (SRC7)."""
    return decode_runs(runs).join(runs.select("mask", "height"), "mask").select("mask", (F.col("idx") % F.col("height")).alias("row"), F.floor(F.col("idx") / F.col("height")).alias("col"))


def column_runs(masks: DataFrame) -> DataFrame:
    """(scene_id, mask, view, col, low, high): the rows of each image column that a mask covers, ends included. masks: (scene_id, mask, view, height, rle); runs go down the columns, so one may span several."""
    r = masks.select("scene_id", "mask", "view", "height", F.posexplode("rle").alias("pos", "n"))
    end = F.sum("n").over(Window.partitionBy("scene_id", "mask").orderBy("pos"))
    ones = r.withColumn("stop", end - 1).where("pos % 2 = 1 AND n > 0").withColumn("start", F.expr("stop - n + 1"))
    c = ones.withColumn("col", F.explode(F.expr("sequence(start div height, stop div height)")))
    return c.selectExpr("scene_id", "mask", "view", "col", "greatest(start - col * height, 0) AS low", "least(stop - col * height, height - 1) AS high")


def seen_pixels(masks: DataFrame, depth: DataFrame) -> DataFrame:
    """(scene_id, mask, view, row, col, dist): pixels of masks whose depth (scene_id, view, row, col, dist) is finite and above 0. Runs and depths meet column by column, so that only pixels with a depth are ever listed (JOI9)."""
    d = depth.where((F.col("dist") > 0) & (F.col("dist") < float("inf"))).select("scene_id", "view", "row", "col", "dist")
    j = column_runs(masks).join(d, ["scene_id", "view", "col"]).where("row BETWEEN low AND high")
    return j.select("scene_id", "mask", "view", "row", "col", "dist")


def view_problems(masks: DataFrame, cameras: DataFrame, rasters: DataFrame, due: int = 1) -> DataFrame:
    """(scene_id, view, n_masks, problem) of views of masks (scene_id, view) that cannot be lifted: no camera, or another number of depth rasters, rows of (scene_id, view), than `due` (JOI9)."""
    key = ["scene_id", "view"]
    g = masks.groupBy(*key).agg(F.count("*").alias("n_masks"))
    g = g.join(cameras.select(*key).distinct().withColumn("_c", F.lit(True)), key, "left").join(rasters.groupBy(*key).agg(F.count("*").alias("_r")), key, "left")
    n = F.coalesce("_r", F.lit(0))
    problem = F.when(F.col("_c").isNull(), "no camera").when(n != due, F.concat(n.cast("string"), F.lit(" rasters")))
    return g.select(*key, "n_masks", problem.alias("problem")).where("problem IS NOT NULL")
