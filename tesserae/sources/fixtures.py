"""Bindings of the engine's input tables to the star-schema tables, and the same bindings as DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A height field's triangles: 64 cells a row, two triangles a cell. Bands of 8 rows go to three scenes in turn; each numbers its faces and instances from 0, and neighbouring scenes have vertices of equal numbers."""
    cell, band, corner = "o_orderkey div 2", "o_orderkey div 1024", "(o_orderkey div 2 div 64) * 65 + o_orderkey div 2 % 64"
    f = read(spark, sf_dir, "orders").selectExpr(
        f"concat('s', {band} % 3) AS scene_id", f"{band} div 3 * 1024 + o_orderkey % 1024 AS fid", f"{corner} AS v0", f"{corner} + if(o_orderkey % 2 = 0, 1, 66) AS v1", f"{corner} + if(o_orderkey % 2 = 0, 66, 65) AS v2",
        f"3 + ((({cell}) div 64 div 8) + (({cell}) % 64 div 8)) % 6 AS semantic", f"({band} div 3) * 8 + ({cell}) % 64 div 8 AS instance",
        "o_orderstatus <> 'P' AS observed", "o_custkey % 4 AS visibility", f"({cell}) % 64 < 56 AS core",
    )
    at = {}
    for k in range(3):
        at |= {f"x{k}": F.expr(f"(v{k} % 65) * 0.25e0"), f"y{k}": F.expr(f"(v{k} div 65) * 0.25e0"), f"z{k}": F.expr(f"((v{k} * 37) % 101) / 1000e0")}
    return f.withColumns(at)


_C = "(o_orderkey // 2)"
_V = f"({_C} // 64) * 65 + {_C} % 64"
FACES = f"""f0 AS (SELECT 's' || (o_orderkey // 1024 % 3) AS scene_id, o_orderkey // 1024 // 3 * 1024 + o_orderkey % 1024 AS fid, {_V} AS v0, {_V} + CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 66 END AS v1, {_V} + CASE WHEN o_orderkey % 2 = 0 THEN 66 ELSE 65 END AS v2,
  3 + (({_C} // 64 // 8) + ({_C} % 64 // 8)) % 6 AS semantic, (o_orderkey // 1024 // 3) * 8 + {_C} % 64 // 8 AS instance, o_orderstatus <> 'P' AS observed, o_custkey % 4 AS visibility, {_C} % 64 < 56 AS core FROM orders),
f1 AS (SELECT *, {", ".join(f"(v{k} % 65) * 0.25e0 AS x{k}, (v{k} // 65) * 0.25e0 AS y{k}, ((v{k} * 37) % 101) / 1000e0 AS z{k}" for k in range(3))} FROM f0),
f2 AS (SELECT *, (y1 - y0) * (z2 - z0) - (z1 - z0) * (y2 - y0) AS kx, (z1 - z0) * (x2 - x0) - (x1 - x0) * (z2 - z0) AS ky, (x1 - x0) * (y2 - y0) - (y1 - y0) * (x2 - x0) AS kz FROM f1),
faces AS (SELECT *, sqrt(kx * kx + ky * ky + kz * kz) / 2 AS area, (x0 + x1 + x2) / 3 AS cx, (y0 + y1 + y2) / 3 AS cy, (z0 + z1 + z2) / 3 AS cz,
  {", ".join(f"CASE WHEN sqrt(kx * kx + ky * ky + kz * kz) > 1e-12 THEN k{a} / sqrt(kx * kx + ky * ky + kz * kz) ELSE 0e0 END AS n{a}" for a in "xyz")} FROM f2)"""


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surface samples of the faces, with a label, a confidence and whether an instance's points hold them."""
    return read(spark, sf_dir, "lineitem").selectExpr("concat('s', l_orderkey div 1024 % 3) AS scene_id", "l_orderkey div 1024 div 3 * 1024 + l_orderkey % 1024 AS fid", "if(l_returnflag = 'R', -1, 3 + l_suppkey % 6) AS label", "CAST(1 - l_discount AS DOUBLE) AS conf", "l_linestatus = 'F' AS selected", "l_linenumber AS visible", "l_suppkey AS instance")


SAMPLES = "samples AS (SELECT 's' || (l_orderkey // 1024 % 3) AS scene_id, l_orderkey // 1024 // 3 * 1024 + l_orderkey % 1024 AS fid, CASE WHEN l_returnflag = 'R' THEN -1 ELSE 3 + l_suppkey % 6 END AS label, CAST(1 - l_discount AS DOUBLE) AS conf, l_linestatus = 'F' AS selected, l_linenumber AS visible, l_suppkey AS instance FROM lineitem)"


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A point cloud with colours and the view that saw each point; each scene numbers its points from 0."""
    return read(spark, sf_dir, "events").selectExpr("concat('s', event_id % 3) AS scene_id", "event_id div 3 AS pid", "((event_id * 7919) % 10007) / 10007e0 * 16 AS x", "((event_id * 104729) % 10009) / 10009e0 * 16 AS y", "value / 1000e0 AS z", "user_id % 256 AS r", "user_id div 256 % 256 AS g", "(user_id * 31) % 256 AS b", "user_id % 8 AS view", "event_type = 'click' AS is_query")


POINTS = "points AS (SELECT 's' || (event_id % 3) AS scene_id, event_id // 3 AS pid, ((event_id * 7919) % 10007) / 10007e0 * 16 AS x, ((event_id * 104729) % 10009) / 10009e0 * 16 AS y, value / 1000e0 AS z, user_id % 256 AS r, user_id // 256 % 256 AS g, (user_id * 31) % 256 AS b, user_id % 8 AS view, event_type = 'click' AS is_query FROM events)"


def mask_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct points of each lifted mask, with the mask's view, class and score and the point's place; scenes number their masks anew and have points of equal numbers."""
    p = read(spark, sf_dir, "lineitem").selectExpr("concat('s', l_suppkey % 3) AS scene_id", "l_suppkey div 3 * 8 + l_linenumber AS mask", "l_linenumber AS view", "l_suppkey % 5 AS class", "l_partkey % 200 AS pid", "CAST(1 - l_discount AS DOUBLE) AS score")
    p = p.groupBy("scene_id", "mask", "view", "class", "pid").agg((F.round(F.sum(F.round(F.col("score") * 100).cast("long")) / F.count("*")) / 100).alias("weight"))
    return p.selectExpr("*", "((pid * 7919) % 10007) / 10007e0 * 16 AS x", "((pid * 104729) % 10009) / 10009e0 * 16 AS y", "(pid % 97) / 100e0 AS z")


MASK_POINTS = """mp0 AS (SELECT 's' || (l_suppkey % 3) AS scene_id, l_suppkey // 3 * 8 + l_linenumber AS mask, l_linenumber AS view, l_suppkey % 5 AS class, l_partkey % 200 AS pid, round(sum(CAST(round(CAST(1 - l_discount AS DOUBLE) * 100) AS BIGINT)) / CAST(count(*) AS DOUBLE)) / 100 AS weight FROM lineitem GROUP BY ALL),
mask_points AS (SELECT *, ((pid * 7919) % 10007) / 10007e0 * 16 AS x, ((pid * 104729) % 10009) / 10009e0 * 16 AS y, (pid % 97) / 100e0 AS z FROM mp0)"""


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object metadata; annotation is JSON of free form."""
    return read(spark, sf_dir, "part").selectExpr("p_partkey AS uid", "p_name AS name", "p_type AS category", "lower(p_brand) AS license", "p_size * 100 AS face_count", "p_partkey % 10 AS shard", "to_json(named_struct('name', p_name, 'license', p_brand, 'tags', split(p_name, ' '), 'archives', named_struct('glb', named_struct('faceCount', p_size * 100)))) AS annotation")


OBJECTS = "objects AS (SELECT p_partkey AS uid, p_name AS name, p_type AS category, lower(p_brand) AS license, p_size * 100 AS face_count, p_partkey % 10 AS shard FROM part)"


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS oid", "l_linenumber AS view", "l_partkey % 64 AS row", "l_suppkey % 64 AS col", "CAST(l_quantity AS DOUBLE) / 10 AS dist")


PIXELS = "pixels AS (SELECT l_orderkey AS oid, l_linenumber AS view, l_partkey % 64 AS row, l_suppkey % 64 AS col, CAST(l_quantity AS DOUBLE) / 10 AS dist FROM lineitem)"


def mask_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bit for each event of a user, in event order: whether it is an error."""
    from pyspark.sql import Window

    return read(spark, sf_dir, "events").select(F.col("user_id").alias("mask"), (F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1).alias("idx"), (F.col("event_type") == "error").cast("int").alias("bit"))


BITS = "bits AS (SELECT user_id AS mask, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS idx, CAST(event_type = 'error' AS INT) AS bit FROM events)"
