"""Object metadata: normalisation, rule classification, joins with their violations, lineage. Limits are parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserae.plans.materialize import materialize


def normalised(text: Column) -> Column:
    """Lower case, with anything but a-z and 0-9 as single blanks."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def token_set(text: Column) -> Column:
    """The normalised text as a whole and its single words, each once (TXT2)."""
    norm = normalised(text)
    return F.array_distinct(F.filter(F.concat(F.array(norm), F.split(norm, " ")), lambda x: x != ""))


def _names(v: Column, path: str) -> Column:
    """Trimmed names in a list of strings and of objects with a name; blanks and anything else are left out."""
    items = F.coalesce(F.try_variant_get(v, path, "array<variant>"), F.array().cast("array<variant>"))
    name = lambda x: F.trim(F.when(F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string")).otherwise(F.try_variant_get(x, "$.name", "string")))
    return F.filter(F.transform(items, name), lambda x: x.isNotNull() & (x != ""))


def normalised_metadata(objects: DataFrame, extra_key: str = "_extra") -> DataFrame:
    """(uid, name, description, tags, categories, lvis, license) of free-form annotations (uid, annotation: JSON text) (TXT1).

    Annotations that are no JSON, and what they lack, count as empty.
    """
    o = objects.select("uid", F.try_parse_json("annotation").alias("v"))
    text = lambda k: F.trim(F.coalesce(F.try_variant_get("v", f"$.{k}", "string"), F.lit("")))
    return o.select("uid", text("name").alias("name"), text("description").alias("description"), _names(F.col("v"), "$.tags").alias("tags"), _names(F.col("v"), "$.categories").alias("categories"), _names(F.col("v"), f"$.{extra_key}.lvis_categories").alias("lvis"), F.lower(F.coalesce(F.try_variant_get("v", "$.license", "string"), F.lit(""))).alias("license"))


def admission(metadata: DataFrame, licenses: list[str], blocked: list[str]) -> DataFrame:
    """metadata with the reason, if any, that keeps an object out: its licence, else its alphabetically first blocked category (FIL3)."""
    hit = F.array_min(F.array_intersect(F.transform("categories", F.lower), F.array(*(F.lit(b.lower()) for b in blocked)).cast("array<string>")))
    bad = ~F.col("license").isin([x.lower() for x in licenses])
    missing = F.when(F.col("license") == "", "missing").otherwise(F.col("license"))
    return metadata.withColumn("refused", F.when(bad, F.concat(F.lit("License is not allowed: "), missing)).when(hit.isNotNull(), F.concat(F.lit("Rejected metadata category: "), hit)))


def classify(metadata: DataFrame, rules: DataFrame) -> DataFrame:
    """(uid, decision, class, confidence, reason) of admitted objects by rules (canonical_class, terms: array<string>, pos) (TXT3).

    A term counts if it is one of the words, or the whole, of an object's categories, name or tags; descriptions are
    not read. One class that matches is accepted, with 0.98 if a term is a whole LVIS category and
    0.90 else; several or none need a review. Metadata are parsed once and written; each text is normalised once, as a
    column of its own row, and terms are joined by equality to the words. The rules are a table of configuration.
    """
    metadata = materialize(metadata.select("uid", "refused", "name", "tags", "categories", "lvis"), "classified")
    one = lambda c, lvis: F.transform(c, lambda x: F.struct(x.alias("text"), F.lit(lvis).alias("is_lvis")))
    every = F.concat(one(F.col("lvis"), True), one(F.concat(F.array("name"), "tags", "categories"), False))
    texts = metadata.where("refused IS NULL").select("uid", F.explode(every).alias("t")).select("uid", "t.is_lvis", normalised(F.when(F.col("t.is_lvis"), F.replace("t.text", F.lit("_"), F.lit(" "))).otherwise(F.col("t.text"))).alias("whole"))
    tokens = texts.withColumn("token", F.explode(F.array_distinct(F.concat(F.array("whole"), F.split("whole", " "))))).where("token <> ''")
    terms = rules.select("canonical_class", F.posexplode("terms").alias("k", "term")).withColumn("token", normalised(F.col("term")))
    hits = tokens.join(terms, "token").groupBy("uid", "canonical_class").agg(F.min(F.struct("k", "term")).getField("term").alias("term"), F.max(F.col("is_lvis") & (F.col("whole") == F.col("token"))).alias("is_lvis"))
    by_object = hits.groupBy("uid").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list("canonical_class")), ", ").alias("classes"), F.first("term").alias("term"), F.first("is_lvis").alias("is_lvis"))
    j = metadata.select("uid", "refused").join(by_object, "uid", "left")
    one = F.col("n") == 1
    decision = F.when(F.col("refused").isNotNull(), "rejected").when(one, "accepted").otherwise("needs_review")
    reason = F.when(F.col("refused").isNotNull(), F.col("refused")).when(one, F.concat(F.when(F.col("is_lvis"), "Matched LVIS term: ").otherwise("Matched metadata term: "), "term")).when(F.col("n") > 1, F.concat(F.lit("Conflicting canonical classes: "), "classes")).otherwise("No high-confidence canonical class rule matched")
    confidence = F.when(F.col("refused").isNotNull(), 1.0).when(one, F.when(F.col("is_lvis"), 0.98).otherwise(0.90)).otherwise(0.0)
    return j.select("uid", decision.alias("decision"), F.when(one & F.col("refused").isNull(), F.col("classes")).alias("class"), confidence.alias("confidence"), reason.alias("reason"))


def annotated_objects(files: DataFrame, annotations: DataFrame, excluded: tuple[str, ...] = ("metadata", "cache", "work", ".cache", "weights")) -> DataFrame:
    """(uid, path, problem): local files (uid, path) that have an annotation (uid, given_uid, given_path) (JOI1).

    Files in excluded folders and files without an annotation are passed over. problem names what is
    wrong: a uid of several files, another uid or, but for case, another path in the annotation.
    """
    kept = files.where(~F.arrays_overlap(F.split("path", "/"), F.array(*map(F.lit, excluded))))
    twice = kept.groupBy("uid").agg(F.count("*").alias("files"))
    j = kept.join(annotations, "uid").join(twice, "uid")
    problem = F.when(F.col("files") > 1, "duplicate uid").when(F.col("given_uid").cast("string") != F.col("uid").cast("string"), "uid mismatch").when(F.lower("given_path") != F.lower("path"), "path mismatch").otherwise("")
    return j.select("uid", "path", problem.alias("problem"))


def shard_lookup(wanted: DataFrame, entries: DataFrame, reserved: str = "_extra") -> DataFrame:
    """(shard, uid, status) of wanted (shard, uid) objects among the shards' entries (shard, uid, value: JSON text): found, missing, not an object, or reserved key (JOI2)."""
    v = F.try_parse_json("value")
    kind = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    status = F.when(F.col("uid_").isNull(), "missing").when(~kind, "not an object").when(F.try_variant_get(v, f"$.{reserved}", "variant").isNotNull(), "reserved key").otherwise("found")
    e = entries.select(F.col("shard"), F.col("uid"), F.col("uid").alias("uid_"), "value")
    return wanted.join(e, ["shard", "uid"], "left").select("shard", "uid", status.alias("status"))


def inverted(lists: DataFrame, wanted: DataFrame) -> DataFrame:
    """(uid, categories) of wanted (uid) objects from lists (category, uids): each category once, in order whatever its case, then as it is spelled (JOI3)."""
    each = lists.select("category", F.explode("uids").alias("uid")).join(wanted.select("uid"), "uid", "left_semi").distinct()
    g = each.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct(F.lower("category").alias("low"), "category"))).alias("c"))
    return g.select("uid", F.transform("c", lambda x: x["category"]).alias("categories"))


def latest(runs: DataFrame) -> DataFrame:
    """The last row (by seq) of each unit's stage in an append-only table of runs."""
    rest = [c for c in runs.columns if c not in ("unit", "stage")]
    return runs.groupBy("unit", "stage").agg(F.max(F.struct("seq", *(c for c in rest if c != "seq"))).alias("m")).select("unit", "stage", *(F.col(f"m.{c}").alias(c) for c in rest))


def to_run(wanted: DataFrame, runs: DataFrame) -> DataFrame:
    """Wanted (unit, stage, config_digest, upstream_digest) without a complete last run of both digests; digests that are null are equal (LIN4, LIN6)."""
    done = latest(runs).where("status = 'complete'")
    same = [wanted[k] == done[k] for k in ("unit", "stage")] + [wanted[k].eqNullSafe(done[k]) for k in ("config_digest", "upstream_digest")]
    return wanted.join(done, same, "left_anti")


def invalidated(runs: DataFrame, forced: DataFrame, stages: DataFrame) -> DataFrame:
    """(unit, stage, status): last status of each unit's stages, pending from the first forced stage on (LIN5).

    forced: (unit, stage) of stages to run again or of changed sources; stages: (stage, stage_no). A
    stage that never ran is pending.
    """
    units = runs.select("unit").union(forced.select("unit")).distinct()
    low = forced.join(stages, "stage").groupBy("unit").agg(F.min("stage_no").alias("low"))
    s = units.crossJoin(F.broadcast(stages)).join(latest(runs).select("unit", "stage", "status"), ["unit", "stage"], "left").join(low, "unit", "left")
    status = F.when(F.col("stage_no") >= F.col("low"), "pending").otherwise(F.coalesce("status", F.lit("pending")))
    return s.select("unit", "stage", status.alias("status"))


def artifact_digests(files: DataFrame) -> DataFrame:
    """(unit, stage, artifact_digest): one digest over (name, size, mtime) of each stage's files in the order of their paths (LIN3)."""
    each = F.concat(F.element_at(F.split("path", "/"), -1), F.col("size").cast("string"), F.col("mtime").cast("string"))
    g = files.groupBy("unit", "stage").agg(F.sort_array(F.collect_list(F.struct("path", each.alias("e")))).alias("l"))
    return g.select("unit", "stage", F.sha2(F.array_join(F.transform("l", lambda x: x["e"]), ""), 256).alias("artifact_digest"))


def vocabulary_problems(vocabulary: DataFrame) -> DataFrame:
    """(id, problem) of a vocabulary (id, name, kind): ids and, whatever their case, names that occur twice; kinds that are none (SRC5)."""
    twice = lambda key, what: vocabulary.join(vocabulary.groupBy(key.alias("_k")).agg(F.count("*").alias("_n")).where("_n > 1"), key == F.col("_k"), "left_semi").select("id", F.lit(what).alias("problem"))
    kind = vocabulary.where(~F.coalesce(F.col("kind").isin("thing", "stuff"), F.lit(False))).select("id", F.lit("kind").alias("problem"))
    return twice(F.col("id"), "duplicate id").union(twice(F.lower("name"), "duplicate name")).union(kind)


def setting_problems(settings: DataFrame, weights: tuple[str, ...], thresholds: tuple[str, ...]) -> DataFrame:
    """(config, problem) of settings (config, name, value): thresholds outside 0 to 1, and fusion weights whose sum is not 1 but for 1e-6 (SRC5)."""
    out = settings.where(F.col("name").isin(*thresholds) & ~F.coalesce(F.col("value").between(0, 1), F.lit(False))).select("config", F.concat(F.lit("threshold "), "name").alias("problem"))
    total = settings.where(F.col("name").isin(*weights)).groupBy("config").agg(F.sum("value").alias("s"))
    return out.union(total.where(F.abs(F.col("s") - 1) > 1e-6).select("config", F.lit("weights").alias("problem")))


def rule_problems(rules: DataFrame) -> DataFrame:
    """(rule, problem) of class rules (rule, placement, dimension, low, high, terms, supports), one row for each thing wrong (SRC5)."""
    lacks = lambda c: F.coalesce(F.size(c) <= 0, F.lit(True))
    checks = {"placement": ~F.col("placement").isin("surface", "floor"), "dimension": ~F.col("dimension").isin("height", "longest"), "range": ~((F.col("low") > 0) & (F.col("low") <= F.col("high"))), "terms": lacks("terms"), "supports": lacks("supports")}
    problems = F.array_compact(F.array(*(F.when(F.coalesce(bad, F.lit(True)), F.lit(k)) for k, bad in checks.items())))
    return rules.select("rule", F.explode(problems).alias("problem"))
