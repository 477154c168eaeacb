"""Digests of settings and contents, what has to run again by them, and a cache kept by them (LIN4, LIN5, LIN6, TXT6)."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


@F.pandas_udf(StringType())
def canonical(text: pd.Series) -> pd.Series:
    """JSON text with keys in order, no blanks and ASCII only, numbers as the shortest that read back the same; null for what is no JSON."""

    def one(t: str | None) -> str | None:
        try:
            return None if t is None else json.dumps(json.loads(t), sort_keys=True, separators=(",", ":"), ensure_ascii=True)
        except ValueError:
            return None

    return text.map(one).astype(object)


def stable_digest(text: Column) -> Column:
    """SHA-256 of a JSON value, whatever the order of its keys and its blanks."""
    return F.sha2(canonical(text), 256)


def stage_digests(settings: DataFrame, depends: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """(config, stage, config_digest): a digest of exactly the sections that a stage depends on, and of files outside.

    settings: (config, section, value: JSON of any depth); depends: (stage, section, by_digest): a section
    with by_digest stands in the stage's by its own digest. files: (config, stage, path, size,
    mtime), size null for a missing one; in the order of their paths. A stage without a section has the digest of {}.
    """
    value = F.when(F.col("by_digest"), F.concat(F.lit('"'), F.sha2("_v", 256), F.lit('"'))).otherwise(F.col("_v"))
    each = settings.withColumn("_v", canonical("value")).join(depends, "section").select("config", "stage", F.struct("section", F.concat(F.lit('"'), "section", F.lit('":'), value).alias("e")).alias("s"))
    # a handful of sections a stage
    own = each.groupBy("config", "stage").agg(F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda x: x["e"]), ",").alias("b"))
    every = settings.select("config").distinct().join(depends.select("stage").distinct()).join(own, ["config", "stage"], "left")
    d = every.select("config", "stage", F.sha2(F.concat(F.lit("{"), F.coalesce("b", F.lit("")), F.lit("}")), 256).alias("config_digest"))
    if files is None:
        return d
    e = F.when(F.col("size").isNull(), F.concat(F.lit("missing:"), "path")).otherwise(F.concat("path", F.col("size").cast("string"), F.col("mtime").cast("string")))
    f = files.groupBy("config", "stage").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("path", e.alias("e")))), lambda x: x["e"]), "").alias("f"))
    return d.join(f, ["config", "stage"], "left").select("config", "stage", F.sha2(F.concat("config_digest", F.coalesce("f", F.lit(""))), 256).alias("config_digest"))


def stale_stages(units: DataFrame, digests: DataFrame, stages: DataFrame, runs: DataFrame) -> DataFrame:
    """(unit, stage, reason) of the stages that have to run, in each unit from the first such on (LIN4).

    units: (unit, config); digests: those of stage_digests(); stages: (stage, stage_no, upstream), upstream null for the
    first; runs: (unit, stage, status, config_digest, upstream_digest, artifact_digest), the last of each. A
    stage is done if its run is complete under its digest and its upstream stage's artifact digest as it is
    now. reason: never run, failed, settings, upstream, or after <the first that has to run>.
    """
    w = units.join(digests, "config").join(stages, "stage")
    up = runs.where("status = 'complete'").select("unit", F.col("stage").alias("upstream"), F.col("artifact_digest").alias("_now"))
    last = runs.select("unit", "stage", "status", F.col("config_digest").alias("_c"), F.col("upstream_digest").alias("_u"))
    j = w.join(last, ["unit", "stage"], "left").join(up, ["unit", "upstream"], "left")
    reason = F.when(F.col("status").isNull(), "never run").when(F.col("status") != "complete", "failed").when(~F.col("_c").eqNullSafe(F.col("config_digest")), "settings").when(~F.col("_u").eqNullSafe(F.col("_now")), "upstream")
    j = j.select("unit", "stage", "stage_no", reason.alias("reason"))
    first = j.where("reason IS NOT NULL").groupBy("unit").agg(F.min(F.struct("stage_no", "stage")).alias("f"))
    j = j.join(first, "unit").where("stage_no >= f.stage_no")
    return j.select("unit", "stage", F.coalesce("reason", F.concat(F.lit("after "), "f.stage")).alias("reason"))


def cached(requests: DataFrame, cache: DataFrame, digest: str, order: str = "seq") -> DataFrame:
    """requests (uid, ..) with the cache's last record under this digest, and hit: whether there is one (LIN6). cache: (uid, config_digest, order, ..), appended to."""
    rest = [c for c in cache.columns if c not in ("uid", "config_digest", order)]
    last = cache.where(F.col("config_digest") == digest).groupBy("uid").agg(F.max(F.struct(order, *rest)).alias("_m"))
    j = requests.join(last, "uid", "left")
    return j.select(*requests.columns, F.col("_m").isNotNull().alias("hit"), *(F.col(f"_m.{c}").alias(c) for c in rest))


def region_ids(boxes: DataFrame) -> DataFrame:
    """boxes (scene_id, x_min .. y_max) with region_id, which follows from the scene and the bounds to six places (TXT6)."""
    bound = [F.format_string("%.6f", f"{a}_{m}") for a in "xy" for m in ("min", "max")]
    return boxes.withColumn("region_id", F.concat(F.lit("region_"), F.substring(F.sha2(F.concat_ws(":", "scene_id", *bound), 256), 1, 12)))


def mask_ids(masks: DataFrame) -> DataFrame:
    """masks (view, class, prompt, index) with mask_id, which follows from these four (TXT6)."""
    return masks.withColumn("mask_id", F.substring(F.sha2(F.concat_ws("|", "view", "class", "prompt", "index"), 256), 1, 16))


def observation_ids(observations: DataFrame) -> DataFrame:
    """observations (source_digest, ax, ay, az, fx, fy, fz, radius, angle, config_digest) with observation_id: a digest of the source, the place, radius and angle to five places, and the direction to six (TXT6)."""

    @F.pandas_udf(StringType())
    def name(o: pd.DataFrame) -> pd.Series:
        out = []
        for r in o.itertuples():
            five = lambda *v: [round(float(x), 5) for x in v]
            value = {"source": r.source_digest, "anchor": five(r.ax, r.ay, r.az), "forward": [round(float(x), 6) for x in (r.fx, r.fy, r.fz)], "radius_m": five(r.radius)[0], "horizontal_angle_deg": five(r.angle)[0], "config_digest": r.config_digest}
            out.append("observation_" + hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":")).encode()).hexdigest()[:12])
        return pd.Series(out, dtype=object)

    return observations.withColumn("observation_id", name(F.struct("source_digest", "ax", "ay", "az", "fx", "fy", "fz", "radius", "angle", "config_digest")))
