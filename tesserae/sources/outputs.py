"""Outputs that are replaced as a whole, and scans of files as they lie (SRC3, SRC4, SRC11, SRC13)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def commit(spark: SparkSession, at: str, outputs: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Write these tables as Parquet below `at`, and then one manifest row that names them; what is read is what the last manifest names.

    A run that fails before its manifest changes nothing for readers, and a second run replaces all
    outputs at once, whatever their number of files. Returns the tables as read back.
    """
    run = uuid.uuid4().hex
    for name, df in outputs.items():
        df.write.parquet(f"{at}/data/{run}/{name}")
    at_ms = spark.sql("SELECT unix_micros(current_timestamp()) AS t").first()["t"]
    spark.createDataFrame([(at_ms, run, sorted(outputs))], "t long, run string, names array<string>").coalesce(1).write.mode("append").json(f"{at}/manifests")
    return {name: spark.read.schema(df.schema).parquet(f"{at}/data/{run}/{name}") for name, df in outputs.items()}


def committed(spark: SparkSession, at: str, name: str) -> DataFrame:
    """The table of this name that the last manifest of commit() names."""
    last = spark.read.schema("t long, run string, names array<string>").json(f"{at}/manifests").orderBy(F.desc("t"), "run").first()
    if last is None or name not in last["names"]:
        raise ValueError(f"no output {name} at {at}")
    return spark.read.parquet(f"{at}/data/{last['run']}/{name}")


def stored_by(df: DataFrame, at: str, *keys: str) -> DataFrame:
    """df written at a path in a folder for each value of the keys, a file each or as many as it needs, and read back: a join on a key, or a filter, then reads the folders of the values that occur only (JOI2, JOI7)."""
    df.repartition(*keys).write.partitionBy(*keys).parquet(at)
    # folders' names are text; the schema says of what type their values are
    return df.sparkSession.read.schema(df.schema).parquet(at)


#: Numbers of a key that share a folder.
BLOCK = 512


def stored_in_blocks(df: DataFrame, at: str, key: str, within: str, block: int = BLOCK) -> DataFrame:
    """df stored by key and blocks of `block` numbers of the column `within`, sorted by it in a file, and read back with the block as _block (SRC12, JOI7).

    A folder and a file for each number would cost more than their rows; here a reader of one lists one folder, and the
    statistics of its file's row groups tell which of them to read. A key is dealt whole: a block of it is one task's.
    """
    b = df.withColumn("_block", block_of(within, block))
    b.repartition(key, "_block").sortWithinPartitions(key, "_block", within).write.partitionBy(key, "_block").parquet(at)
    return df.sparkSession.read.schema(b.schema).parquet(at).select(*b.columns)


def block_of(within: str, block: int = BLOCK) -> Column:
    return F.floor(F.col(within) / block).cast("long")


def metadata_outputs(records: DataFrame, annotations: DataFrame, categories: DataFrame, sample: int = 20) -> dict[str, DataFrame]:
    """The outputs of a metadata run (SRC11): annotations (uid, path, json) in the order of paths, sample, categories, missing, summary.

    records: (line_no, uid, shard, path), the manifest; annotations: (uid, json); categories: (uid, category), those of
    objects with an annotation. json is the annotation with uid, shard, path and the categories in order.
    missing: (line_no, uid) without an annotation; summary: one row of counts and a warning.
    """
    own = categories.groupBy("uid").agg(F.array_sort(F.collect_set("category")).alias("categories"))
    j = records.join(annotations, "uid", "left").join(own, "uid", "left").withColumn("categories", F.coalesce("categories", F.expr("CAST(array() AS array<string>)")))
    found = j.where("json IS NOT NULL")
    added = F.to_json(F.struct("uid", "shard", F.col("path").alias("glb_relative_path"), "categories"))
    # the object's own text, its last brace replaced by what is added
    text = F.concat(F.regexp_replace(F.rtrim("json"), r"\}$", ""), F.when(F.rtrim("json").rlike(r"^\s*\{\s*\}$"), "").otherwise(","), F.lit('"_added":'), added, F.lit("}"))
    lines = found.select("uid", "path", text.alias("json")).repartitionByRange("path", "uid").sortWithinPartitions("path", "uid")
    missing = j.where("json IS NULL").select("line_no", "uid")
    many = F.size("categories") > 0
    counts = j.agg(F.count("*").alias("requested"), F.countDistinct("shard").alias("shards"), F.count("json").alias("annotated"), F.count_if(F.col("json").isNull()).alias("missing"), F.count_if(many & F.col("json").isNotNull()).alias("categorised"))
    warning = F.when(F.col("missing") > 0, F.concat(F.col("missing").cast("string"), F.lit(" requested objects have no annotation"))).otherwise("")
    return {"annotations": lines, "sample": found.select("uid", "path", text.alias("json")).orderBy("path", "uid").limit(sample), "categories": found.where(many).select("uid", "categories"), "missing": missing, "summary": counts.withColumn("warning", warning)}


def region_manifest(regions: DataFrame, config: str, requested: int) -> dict[str, DataFrame]:
    """header: (scene_id, config, n_regions, n_faces, requested, warning), a row a scene, and the regions (scene_id, region, n_faces, ..) that it counts (SRC13). A warning tells of fewer regions than requested."""
    h = regions.groupBy("scene_id").agg(F.count("*").alias("n_regions"), F.sum("n_faces").alias("n_faces")).withColumns({"config": F.lit(config), "requested": F.lit(requested).cast("long")})
    warning = F.when(F.col("n_regions") < F.col("requested"), F.concat(F.lit("only "), F.col("n_regions").cast("string"), F.lit(" of "), F.col("requested").cast("string"))).otherwise("")
    return {"header": h.select("scene_id", "config", "n_regions", "n_faces", "requested", warning.alias("warning")), "regions": regions}


def written_each(df: DataFrame, at: str, *keys: str) -> None:
    """The text of df's rows (*keys, value), a file in a folder of its own for each value of the keys.

    Files are many and small, so that Spark's coalescing by bytes would leave them to one task, and the driver would move them one by one
    at the end: they are dealt over all cores by number, and each task moves its own.
    """
    n = 8 * df.sparkSession.sparkContext.defaultParallelism
    df.repartition(n, *keys).write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy(*keys).text(at)


def keyed_files(spark: SparkSession, root: str, glob: str = "*.json.gz") -> DataFrame:
    """(path, key, value, problem) of the entries of files below a folder, each a JSON object keyed by uid; compressed ones are read as they are (SRC3).

    A file that is no JSON, or no object, gives one row without a key and its problem. value is JSON text.
    """
    t = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(root, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    v = F.try_parse_json("value")
    kind = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    problem = F.when(v.isNull(), "no JSON").when(~kind, "no object")
    e = t.select("path", problem.alias("problem"), F.explode_outer(F.when(kind, F.from_json("value", "map<string,string>"))).alias("key", "value"))
    return e.select("path", "key", "value", F.coalesce("problem", F.lit("")).alias("problem"))


def manifest_files(spark: SparkSession, root: str, keys: tuple[str, ...], artifacts: tuple[str, ...], glob: str = "observation.json") -> DataFrame:
    """(path, json, problem) of the manifests of this name below a folder, in any depth (SRC4).

    problem: no JSON, the first of `keys` that is lacking, or the first of the `artifacts` keys whose file, named
    from the manifest's own folder, is not there or is empty; files are listed, not read.
    """
    t = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(root, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("json"))
    v = F.try_parse_json("json")
    t = t.withColumns({"_v": v, "_dir": F.regexp_replace("path", "/[^/]*$", "")})
    named = lambda k: F.try_variant_get("_v", f"$.{k}", "string")
    lacks = F.coalesce(*(F.when(F.try_variant_get("_v", f"$.{k}", "variant").isNull() | F.is_variant_null(F.try_variant_get("_v", f"$.{k}", "variant")), F.lit(f"lacks {k}")) for k in keys))
    t = t.select("path", "json", F.when(F.col("_v").isNull(), "no JSON").otherwise(lacks).alias("problem"), *(F.concat("_dir", F.lit("/"), named(k)).alias(f"_{k}") for k in artifacts))
    if not artifacts:
        return t.select("path", "json", F.coalesce("problem", F.lit("")).alias("problem"))
    there = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select(F.col("path").alias("_file"))
    # both listings spell a local folder alike
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    there = there.select(plain("_file").alias("_file")).distinct()
    for k in artifacts:
        t = t.join(there.withColumnsRenamed({"_file": f"_f_{k}"}), plain(f"_{k}") == F.col(f"_f_{k}"), "left")
    absent = F.coalesce(*(F.when(F.col(f"_f_{k}").isNull(), F.lit(f"no file for {k}")) for k in artifacts), F.lit(""))
    return t.select("path", "json", F.coalesce("problem", absent).alias("problem"))


def roll_up(wanted: DataFrame, results: DataFrame, by: list[str], statuses: tuple[str, ...] = ("complete", "failed")) -> DataFrame:
    """(*by, requested, <each status>, other, missing): how many of the wanted units (*by, unit) came to what, by one aggregation (AGG25). results: (*by, unit, status), one row a unit."""
    j = wanted.join(results, [*by, "unit"], "left")
    known = F.col("status").isin(*statuses)
    return j.groupBy(*by).agg(F.count("*").alias("requested"), *(F.count_if(F.col("status") == s).alias(s) for s in statuses), F.count_if(~known).alias("other"), F.count_if(F.col("status").isNull()).alias("missing"))
