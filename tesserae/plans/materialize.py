"""Cutting lineage: intermediate tables written to the folder that the whole cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a local session without one (a test) gets a folder of its own."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        named = sc.getCheckpointDir()
        if not named:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            named = "file://" + tempfile.mkdtemp(prefix="tesserae-")
            sc.setCheckpointDir(named)
    return named.rstrip("/")


def materialize(df: DataFrame, name: str = "t", **options) -> DataFrame:
    """Write df as Parquet in the shared folder, with these writer's options, and read it back: lost executors cost no recomputation before this point."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tesserae_path = path
    return out


def release(df: DataFrame | None) -> None:
    """Delete what materialize() wrote, once nothing that will still run reads it."""
    path = getattr(df, "_tesserae_path", None)
    if path:
        jvm = df.sparkSession.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
