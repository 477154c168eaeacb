"""Queries over object metadata, text rules and lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.functions import geometry as G
from tesserae.operators import digests as D
from tesserae.operators import metadata as M
from tesserae.plans.materialize import shared_dir
from tesserae.operators.metadata import token_set
from tesserae.sources import fixtures as X
from tesserae.sources.fixtures import OBJECTS
from tesserae.sources.outputs import roll_up, stored_by

R = lambda c, n=4: F.round(c, n)
QUERIES: dict = {}
SQL: dict[str, str] = {}
#: Rules of the bound tables: classes with their terms, single words and whole names.
RULES = [("ball", ["ball", "small ball", "sphere"]), ("cup", ["cup", "mug", "red cup"]), ("ring", ["ring", "shiny"]), ("widget", ["widget", "gadget"]), ("panel", ["panel", "large panel"])]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query(f"WITH {OBJECTS} SELECT uid, face_count, face_count BETWEEN 500 AND 4000 AS accepted FROM objects")
def fil2_face_count(spark, d):
    """Face count from the free-form annotation; a missing one passes."""
    n = F.try_variant_get(F.parse_json("annotation"), "$.archives.glb.faceCount", "bigint")
    return X.objects(spark, d).select("uid", n.cast("int").alias("face_count"), F.coalesce(n.between(500, 4000), F.lit(True)).alias("accepted"))


_NORM = "trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g'))"


@query(f"WITH {OBJECTS} SELECT DISTINCT uid, unnest(list_distinct(list_filter(list_concat([{_NORM}], string_split({_NORM}, ' ')), lambda x: x <> ''))) AS token FROM objects")
def txt2_tokens(spark, d):
    return X.objects(spark, d).select("uid", F.explode(token_set(F.col("name"))).alias("token"))


_META = """meta AS (SELECT p_partkey AS uid, trim(p_name) AS name, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE 'a ' || p_name END AS description, list_filter([string_split(p_name, ' ')[1], '', lower(p_brand)], lambda x: x <> '') AS tags, [p_type] AS categories, CASE WHEN p_partkey % 4 = 0 THEN [replace(p_name, ' ', '_')] ELSE [] END AS lvis, CASE WHEN p_partkey % 9 = 0 THEN '' ELSE lower(p_brand) END AS license FROM part)"""


def _metadata(spark, d) -> DataFrame:
    """Annotations of free form: tags as texts and as objects, blanks, categories as objects."""
    tags = "array(to_json(split(p_name, ' ')[0]), '\" \"', to_json(named_struct('name', lower(p_brand))), '7')"
    lvis = "if(p_partkey % 4 = 0, concat('[', to_json(replace(p_name, ' ', '_')), ']'), '[]')"
    note = "if(p_partkey % 5 = 0, 'null', to_json(concat(' a ', p_name)))"
    licence = "if(p_partkey % 9 = 0, 'null', to_json(p_brand))"
    text = f"concat('{{\"name\":', to_json(concat(p_name, '  ')), ',\"description\":', {note}, ',\"license\":', {licence}, ',\"tags\":[', concat_ws(',', {tags}), '],\"categories\":[', to_json(named_struct('name', p_type)), '],\"_extra\":{{\"lvis_categories\":', {lvis}, '}}}}')"
    for part in ("split(p_name, ' ')[0]", "replace(p_name, ' ', '_')", "concat(' a ', p_name)", "p_brand", "concat(p_name, '  ')"):
        text = text.replace(f"to_json({part})", f"concat('\"', {part}, '\"')")
    return M.normalised_metadata(X.read(spark, d, "part").selectExpr("p_partkey AS uid", f"{text} AS annotation"))


@query(f"WITH {_META} SELECT uid, name, description, array_to_string(tags, '|') AS tags, array_to_string(categories, '|') AS categories, array_to_string(lvis, '|') AS lvis, license FROM meta")
def txt1_normalised_metadata(spark, d):
    return _metadata(spark, d).select("uid", "name", "description", *(F.array_join(k, "|").alias(k) for k in ("tags", "categories", "lvis")), "license")


_BLOCKED = ["ECONOMY", "promo"]
_REFUSED = "ad AS (SELECT *, CASE WHEN license NOT IN (SELECT 'brand#' || i FROM range(1, 21) t(i)) THEN 'License is not allowed: ' || CASE WHEN license = '' THEN 'missing' ELSE license END WHEN lower(categories[1]) IN ('economy', 'promo') THEN 'Rejected metadata category: ' || lower(categories[1]) END AS refused FROM meta)"


def _admitted(spark, d) -> DataFrame:
    return M.admission(_metadata(spark, d), [f"Brand#{i}" for i in range(1, 21)], _BLOCKED)


@query(f"WITH {_META}, {_REFUSED} SELECT uid, license, coalesce(refused, 'ok') AS verdict FROM ad")
def fil3_license_and_category(spark, d):
    return _admitted(spark, d).select("uid", "license", F.coalesce("refused", F.lit("ok")).alias("verdict"))


_N = "trim(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g'))"
_CLASSIFIED = f"""fl AS (SELECT uid, unnest(list_concat(list_transform(lvis, lambda x: replace(x, '_', ' ')), [name], tags, categories)) AS x FROM ad WHERE refused IS NULL), fn AS (SELECT uid, {_N.format(x="x")} AS x FROM fl), tk AS (SELECT uid, x AS token FROM fn UNION SELECT uid, unnest(string_split(x, ' ')) FROM fn),
ru AS (SELECT * FROM (VALUES {", ".join(f"('{c}', {k}, '{t}')" for c, ts in RULES for k, t in enumerate(ts))}) t(class, k, term)),
ht AS (SELECT tk.uid, class, arg_min(term, k) AS term, bool_or(term IN (SELECT unnest(list_transform(m.lvis, lambda y: {_N.format(x="replace(y, '_', ' ')")})))) AS lv FROM tk JOIN ru ON token = term JOIN meta m ON m.uid = tk.uid GROUP BY tk.uid, class),
ob AS (SELECT uid, count(*) AS n, string_agg(class, ', ' ORDER BY class) AS classes, any_value(term) AS term, any_value(lv) AS lv FROM ht GROUP BY uid)"""


@query(f"WITH {_META}, {_REFUSED}, {_CLASSIFIED} SELECT ad.uid, CASE WHEN refused IS NOT NULL THEN 'rejected' WHEN n = 1 THEN 'accepted' ELSE 'needs_review' END AS decision, CASE WHEN refused IS NULL AND n = 1 THEN classes END AS class, CASE WHEN refused IS NOT NULL THEN 1e0 WHEN n = 1 THEN CASE WHEN lv THEN 0.98e0 ELSE 0.9e0 END ELSE 0e0 END AS confidence, CASE WHEN refused IS NOT NULL THEN refused WHEN n = 1 THEN 'Matched ' || CASE WHEN lv THEN 'LVIS' ELSE 'metadata' END || ' term: ' || term WHEN n > 1 THEN 'Conflicting canonical classes: ' || classes ELSE 'No high-confidence canonical class rule matched' END AS reason FROM ad LEFT JOIN ob ON ob.uid = ad.uid")
def txt3_rule_classification(spark, d):
    rules = spark.createDataFrame(RULES, "canonical_class string, terms array<string>")
    return M.classify(_admitted(spark, d), rules)


@query("SELECT p_partkey AS uid, regexp_replace(regexp_replace(p_name, '[^A-Za-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS dashed, regexp_replace(p_name, '[^A-Za-z0-9]', '_', 'g') AS scored FROM part")
def txt7_safe_names(spark, d):
    return X.objects(spark, d).select("uid", F.regexp_replace(F.regexp_replace("name", "[^A-Za-z0-9]+", "-"), "^-+|-+$", "").alias("dashed"), F.regexp_replace("name", "[^A-Za-z0-9]", "_").alias("scored"))


@query("""WITH f AS (SELECT p_partkey AS uid, CASE WHEN p_partkey % 8 = 0 THEN 'cache/' ELSE 'a/' END || p_partkey || '.glb' AS path FROM part UNION ALL SELECT p_partkey, 'b/' || p_partkey || '.glb' FROM part WHERE p_partkey % 9 = 0), k AS (SELECT * FROM f WHERE path NOT LIKE 'cache/%'), c AS (SELECT uid, count(*) AS n FROM k GROUP BY uid), n AS (SELECT DISTINCT l_partkey AS uid FROM lineitem WHERE l_quantity > 30)
SELECT uid, path, CASE WHEN n > 1 THEN 'duplicate uid' WHEN uid % 10 = 0 THEN 'uid mismatch' WHEN uid % 11 = 0 THEN 'path mismatch' ELSE '' END AS problem FROM k JOIN c USING (uid) JOIN n USING (uid)""")
def joi1_object_annotations(spark, d):
    """Files of objects, some in an excluded folder and some twice, and annotations with other uids and paths among them."""
    f = X.read(spark, d, "part").selectExpr("p_partkey AS uid", "explode(if(p_partkey % 9 = 0, array(if(p_partkey % 8 = 0, 'cache/', 'a/'), 'b/'), array(if(p_partkey % 8 = 0, 'cache/', 'a/')))) AS folder").selectExpr("uid", "concat(folder, uid, '.glb') AS path")
    n = X.read(spark, d, "lineitem").where("l_quantity > 30").select(F.col("l_partkey").alias("uid")).distinct()
    n = n.selectExpr("uid", "if(uid % 10 = 0, uid + 1, uid) AS given_uid", "concat(if(uid % 8 = 0, if(uid % 9 = 0, 'B/', 'cache/'), 'A/'), if(uid % 11 = 0, 'x', ''), uid, '.GLB') AS given_path")
    return M.annotated_objects(f, n)


@query("WITH w AS (SELECT DISTINCT l_partkey AS uid, l_partkey % 10 AS shard FROM lineitem) SELECT shard, uid, CASE WHEN uid % 7 = 0 THEN 'missing' WHEN uid % 13 = 0 THEN 'not an object' WHEN uid % 17 = 0 THEN 'reserved key' ELSE 'found' END AS status FROM w")
def joi2_shard_lookup(spark, d):
    """Requested objects looked up in a table that is stored by shard; files of shards that none is of are not read."""
    w = X.read(spark, d, "lineitem").selectExpr("l_partkey % 10 AS shard", "l_partkey AS uid").distinct()
    value = """CASE WHEN uid % 13 = 0 THEN '[1]' WHEN uid % 17 = 0 THEN '{"_extra":{}}' ELSE annotation END AS value"""
    entries = X.objects(spark, d).where("uid % 7 <> 0").selectExpr("CAST(shard AS BIGINT) AS shard", "uid", value)
    return M.shard_lookup(w, stored_by(entries, f"{shared_dir(spark)}/sinks/shards-{uuid.uuid4().hex}", "shard"))


@query(f"WITH {OBJECTS}, rq AS (SELECT DISTINCT l_partkey AS uid FROM lineitem) SELECT uid FROM rq WHERE uid NOT IN (SELECT uid FROM objects WHERE uid % 7 <> 0)")
def set1_missing_objects(spark, d):
    """Requested objects without an annotation (JOI2, SET1)."""
    rq = X.read(spark, d, "lineitem").select(F.col("l_partkey").alias("uid")).distinct()
    return rq.join(X.objects(spark, d).where("uid % 7 <> 0"), "uid", "left_anti")


@query("WITH c AS (SELECT DISTINCT l_partkey AS uid, CASE WHEN l_linenumber % 2 = 0 THEN lower(l_returnflag) ELSE l_returnflag END || l_linestatus AS category FROM lineitem), rq AS (SELECT p_partkey AS uid FROM part WHERE p_size > 10) SELECT uid, string_agg(category, '|' ORDER BY lower(category), category) AS categories FROM c JOIN rq USING (uid) GROUP BY uid")
def joi3_category_inversion(spark, d):
    """Categories of requested objects, from lists of a thousand uids a row at most."""
    c = X.read(spark, d, "lineitem").selectExpr("l_partkey AS uid", "concat(if(l_linenumber % 2 = 0, lower(l_returnflag), l_returnflag), l_linestatus) AS category").distinct()
    lists = c.groupBy("category", F.expr("uid div 1000")).agg(F.collect_list("uid").alias("uids"))
    return M.inverted(lists, X.read(spark, d, "part").where("p_size > 10").selectExpr("p_partkey AS uid")).select("uid", F.array_join("categories", "|").alias("categories"))


@query(f"WITH {OBJECTS}, c AS (SELECT l_partkey AS uid, string_agg(DISTINCT l_returnflag, '|' ORDER BY l_returnflag) AS categories FROM lineitem GROUP BY l_partkey) SELECT uid, name, coalesce(categories, '') AS categories, 'shard-' || shard AS provenance FROM objects LEFT JOIN c USING (uid)")
def joi4_enrichment(spark, d):
    """Objects with the categories that another table has for them, and where they come from."""
    c = X.read(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("uid")).agg(F.array_sort(F.collect_set("l_returnflag")).alias("c"))
    o = X.objects(spark, d).join(c, "uid", "left").withColumn("c", F.coalesce("c", F.array().cast("array<string>")))
    return o.select("uid", "name", F.array_join("c", "|").alias("categories"), F.concat(F.lit("shard-"), "shard").alias("provenance"))


@query("WITH m AS (SELECT s_suppkey AS uid, CASE WHEN s_suppkey % 3 = 0 THEN 'rejected' ELSE 'accepted' END AS m FROM supplier) SELECT p_partkey AS uid, CASE WHEN m IS NULL THEN 'rules' ELSE 'model' END AS source, coalesce(m, 'needs_review') AS decision FROM part LEFT JOIN m ON m.uid = p_partkey")
def joi13_result_override(spark, d):
    """A model's answers, where there are any, in place of the rules'."""
    m = X.read(spark, d, "supplier").selectExpr("s_suppkey AS uid", "if(s_suppkey % 3 = 0, 'rejected', 'accepted') AS m")
    o = X.objects(spark, d).select("uid").join(m, "uid", "left")
    return o.select("uid", F.when(F.col("m").isNull(), "rules").otherwise("model").alias("source"), F.coalesce("m", F.lit("needs_review")).alias("decision"))


@query(f"WITH {OBJECTS}, b AS (SELECT uid, 1 + uid % 5 + 0e0 AS dx, 1 + uid % 3 + 0e0 AS dy, 1 + uid % 7 + 0e0 AS dz FROM objects) SELECT uid, round(dz / sqrt(greatest(dx * dy, 1e-12)), 4) AS z, round(dx / sqrt(greatest(dy * dz, 1e-12)), 4) AS x, round(dy / sqrt(greatest(dz * dx, 1e-12)), 4) AS y FROM b")
def geo11_orientations(spark, d):
    dim = lambda k: (1 + F.col("uid") % k).cast("double")
    o = X.objects(spark, d).select("uid", G.orientations(dim(5), dim(3), dim(7)).alias("o"))
    return o.select("uid", *(R(F.col("o")[i]["score"]).alias(a) for i, a in ((0, "z"), (2, "x"), (4, "y"))))


@query(f"WITH {OBJECTS} SELECT category, count(*) AS n, sum(CASE WHEN face_count BETWEEN 500 AND 4000 THEN 1 ELSE 0 END)::BIGINT AS accepted, count(DISTINCT license) AS licenses FROM objects GROUP BY category")
def agg25_catalogue_roll_up(spark, d):
    return X.objects(spark, d).groupBy("category").agg(F.count("*").alias("n"), F.count_if(F.col("face_count").between(500, 4000)).alias("accepted"), F.countDistinct("license").alias("licenses"))


@query(f"WITH {OBJECTS} SELECT uid, name FROM objects ORDER BY name, uid LIMIT 50")
def top5_first_in_order(spark, d):
    return X.objects(spark, d).select("uid", "name").orderBy("name", "uid").limit(50)


@query("WITH k AS (SELECT o_custkey AS obs, o_orderkey AS uid, row_number() OVER (PARTITION BY o_custkey ORDER BY sha256('7:' || o_custkey || ':' || o_orderkey), o_orderkey) AS k FROM orders) SELECT obs, uid, k::INT AS k FROM k WHERE k <= 12")
def smp6_seeded_shuffle(spark, d):
    """The first twelve of each observation's objects in an order that a seed fixes, whatever the partitions."""
    from pyspark.sql import Window

    o = X.read(spark, d, "orders").select(F.col("o_custkey").alias("obs"), F.col("o_orderkey").alias("uid"))
    k = F.row_number().over(Window.partitionBy("obs").orderBy(F.sha2(F.concat_ws(":", F.lit("7"), "obs", "uid"), 256), "uid"))
    return o.withColumn("k", k).where("k <= 12")


#: A table of runs: one row for each line of an order, of the order's customer and one of three stages; the last of a stage counts.
_RUNS = """runs AS (SELECT o_custkey AS unit, ['lift', 'merge', 'export'][1 + l_linenumber % 3] AS stage, o_orderkey * 8 + l_linenumber AS seq, CASE WHEN l_returnflag = 'R' THEN 'failed' ELSE 'complete' END AS status, 'c' || l_suppkey % 2 AS config_digest, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE 'u' || l_partkey % 2 END AS upstream_digest FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
last AS (SELECT unit, stage, max({'q': seq, 's': status, 'c': config_digest, 'u': coalesce(upstream_digest, '')}) AS m FROM runs GROUP BY unit, stage), st(stage, stage_no) AS (VALUES ('lift', 0), ('merge', 1), ('export', 2))"""
_STAGES = [("lift", 0), ("merge", 1), ("export", 2)]


def _runs(spark, d) -> DataFrame:
    j = X.read(spark, d, "lineitem").join(X.read(spark, d, "orders"), F.expr("o_orderkey = l_orderkey"))
    return j.selectExpr("o_custkey AS unit", "array('lift', 'merge', 'export')[l_linenumber % 3] AS stage", "o_orderkey * 8 + l_linenumber AS seq", "if(l_returnflag = 'R', 'failed', 'complete') AS status", "concat('c', l_suppkey % 2) AS config_digest", "if(l_linenumber % 3 = 0, NULL, concat('u', l_partkey % 2)) AS upstream_digest")


@query("SELECT o_custkey AS unit, o_orderstatus AS stage, sha256(string_agg('f' || o_orderkey || '.npz' || o_custkey * 7 || (o_orderkey % 1000), '' ORDER BY 'd' || o_orderkey % 3 || '/f' || o_orderkey || '.npz')) AS artifact_digest FROM orders GROUP BY o_custkey, o_orderstatus")
def lin3_artifact_digest(spark, d):
    f = X.read(spark, d, "orders").selectExpr("o_custkey AS unit", "o_orderstatus AS stage", "concat('d', o_orderkey % 3, '/f', o_orderkey, '.npz') AS path", "o_custkey * 7 AS size", "o_orderkey % 1000 AS mtime")
    return M.artifact_digests(f)


@query(f"WITH {_RUNS}, w AS (SELECT c_custkey AS unit, stage, 'c' || c_custkey % 2 AS config_digest, CASE WHEN stage = 'lift' THEN '' ELSE 'u1' END AS u FROM customer, st) SELECT unit, stage FROM w WHERE NOT EXISTS (SELECT 1 FROM last l WHERE l.unit = w.unit AND l.stage = w.stage AND l.m.s = 'complete' AND l.m.c = w.config_digest AND l.m.u = w.u)")
def lin4_units_to_run(spark, d):
    """Stages of all units that have no complete last run under both digests; the digest of a stage covers its own settings (LIN4, LIN6)."""
    w = X.read(spark, d, "customer").selectExpr("c_custkey AS unit", "explode(array('lift', 'merge', 'export')) AS stage").selectExpr("unit", "stage", "concat('c', unit % 2) AS config_digest", "if(stage = 'lift', NULL, 'u1') AS upstream_digest")
    return M.to_run(w, _runs(spark, d)).select("unit", "stage")


@query(f"WITH {_RUNS}, fo AS (SELECT c_custkey AS unit, min(stage_no) AS low FROM customer JOIN st ON stage = ['lift', 'merge', 'export'][1 + c_nationkey % 3] WHERE c_acctbal > 5000 GROUP BY c_custkey), un AS (SELECT unit FROM runs UNION SELECT unit FROM fo) SELECT un.unit, st.stage, CASE WHEN stage_no >= low THEN 'pending' ELSE coalesce(l.m.s, 'pending') END AS status FROM un CROSS JOIN st LEFT JOIN fo ON fo.unit = un.unit LEFT JOIN last l ON l.unit = un.unit AND l.stage = st.stage")
def lin5_invalidation(spark, d):
    """A forced stage and all after it are pending again, whatever their last run."""
    forced = X.read(spark, d, "customer").where("c_acctbal > 5000").selectExpr("c_custkey AS unit", "array('lift', 'merge', 'export')[c_nationkey % 3] AS stage")
    return M.invalidated(_runs(spark, d), forced, spark.createDataFrame(_STAGES, "stage string, stage_no int"))


#: Settings of 25 configurations, as their sections' JSON; blanks and the order of keys do not count.
_SECTIONS = {
    "geometry": ("""concat('{"unit": "m",  "density": ', n_nationkey * 0.5e0, '}')""", """'{"density":' || (n_nationkey * 0.5e0)::DOUBLE::VARCHAR || ',"unit":"m"}'"""),
    "render": ("""concat('{"views": ', n_nationkey % 4, ', "size": [64, {"b": 2, "a": 1}]}')""", """'{"size":[64,{"a":1,"b":2}],"views":' || n_nationkey % 4 || '}'"""),
    "fusion": ("""concat('{"least": 0.5}', '')""", """'{"least":0.5}'"""),
    "vocabulary": ("""concat('[{"name": "table", "id": ', n_nationkey % 2, '}]')""", """'[{"id":' || n_nationkey % 2 || ',"name":"table"}]'"""),
}
_DEPENDS = [("geometry", "geometry", False), ("views", "geometry", False), ("views", "render", False), ("fusion", "fusion", False), ("fusion", "vocabulary", True)]
_GRAPH = [("geometry", 0, None), ("views", 1, "geometry"), ("fusion", 2, "views")]
_DIGESTS = f"""se AS (SELECT n_nationkey AS config, {", ".join(f"{e[1]} AS {n}" for n, e in _SECTIONS.items())} FROM nation), dg AS (SELECT config, 'geometry' AS stage, 0 AS stage_no, sha256('{{"geometry":' || geometry || '}}') AS config_digest FROM se UNION ALL SELECT config, 'views', 1, sha256('{{"geometry":' || geometry || ',"render":' || render || '}}') FROM se UNION ALL SELECT config, 'fusion', 2, sha256('{{"fusion":' || fusion || ',"vocabulary":"' || sha256(vocabulary) || '"}}') FROM se)"""


def _digests(spark, d) -> DataFrame:
    n = X.read(spark, d, "nation")
    s = None
    for name, (e, _) in _SECTIONS.items():
        part = n.selectExpr("n_nationkey AS config", f"'{name}' AS section", f"{e} AS value")
        s = part if s is None else s.union(part)
    return D.stage_digests(s, spark.createDataFrame(_DEPENDS, "stage string, section string, by_digest boolean"))


@query(f"WITH {_DIGESTS} SELECT config, stage, config_digest FROM dg")
def lin4_stage_digests(spark, d):
    """A digest for each stage of each configuration, of the sections that it depends on (LIN4)."""
    return _digests(spark, d)


_STALE = f"""{_DIGESTS}, un AS (SELECT c_custkey AS unit, c_nationkey AS config FROM customer), wa AS (SELECT * FROM un JOIN dg USING (config)),
ru AS (SELECT unit, stage, stage_no, CASE WHEN (unit + stage_no) % 19 = 0 THEN 'failed' ELSE 'complete' END AS status, CASE WHEN (unit + stage_no) % 17 = 3 THEN 'old' ELSE config_digest END AS c, CASE WHEN stage_no > 0 THEN 'a' || unit || (stage_no - 1) || CASE WHEN unit % 13 = 5 THEN 'x' ELSE '' END END AS u, 'a' || unit || stage_no AS artifact_digest FROM wa WHERE (unit * 3 + stage_no) % 11 <> 0),
rs AS (SELECT wa.unit, wa.stage, wa.stage_no, CASE WHEN r.status IS NULL THEN 'never run' WHEN r.status <> 'complete' THEN 'failed' WHEN r.c <> wa.config_digest THEN 'settings' WHEN r.u IS DISTINCT FROM p.artifact_digest THEN 'upstream' END AS reason FROM wa LEFT JOIN ru r ON r.unit = wa.unit AND r.stage = wa.stage LEFT JOIN ru p ON p.unit = wa.unit AND p.stage_no = wa.stage_no - 1 AND p.status = 'complete'),
lo AS (SELECT unit, min(stage_no) AS low, arg_min(stage, stage_no) AS first FROM rs WHERE reason IS NOT NULL GROUP BY unit)"""


@query(f"WITH {_STALE} SELECT unit, stage, coalesce(reason, 'after ' || first) AS reason FROM rs JOIN lo USING (unit) WHERE stage_no >= low")
def lin4_stale_stages(spark, d):
    """Stages of each customer's unit that have to run, with the reason: settings, upstream artifacts, failures, or an earlier stage that runs (LIN4, LIN5)."""
    g = _digests(spark, d)
    stages = spark.createDataFrame(_GRAPH, "stage string, stage_no int, upstream string")
    units = X.read(spark, d, "customer").selectExpr("c_custkey AS unit", "c_nationkey AS config")
    runs = units.join(g, "config").join(stages, "stage").where("(unit * 3 + stage_no) % 11 <> 0").selectExpr("unit", "stage", "if((unit + stage_no) % 19 = 0, 'failed', 'complete') AS status", "if((unit + stage_no) % 17 = 3, 'old', config_digest) AS config_digest", "if(stage_no > 0, concat('a', unit, stage_no - 1, if(unit % 13 = 5, 'x', '')), NULL) AS upstream_digest", "concat('a', unit, stage_no) AS artifact_digest")
    return D.stale_stages(units, g, stages, runs)


@query("WITH c AS (SELECT l_partkey AS uid, arg_max(l_returnflag, l_orderkey * 8 + l_linenumber) AS decision FROM lineitem WHERE l_suppkey % 3 = 1 GROUP BY 1) SELECT p_partkey AS uid, c.uid IS NOT NULL AS hit, coalesce(decision, '') AS decision FROM part LEFT JOIN c ON c.uid = p_partkey")
def lin6_classification_cache(spark, d):
    """Objects whose classification under this digest is at hand, by the cache's last record (LIN6)."""
    cache = X.read(spark, d, "lineitem").selectExpr("l_partkey AS uid", "concat('c', l_suppkey % 3) AS config_digest", "l_orderkey * 8 + l_linenumber AS seq", "l_returnflag AS decision")
    return D.cached(X.read(spark, d, "part").selectExpr("p_partkey AS uid"), cache, "c1").withColumn("decision", F.coalesce("decision", F.lit("")))


@query(f"WITH {_RUNS} SELECT stage, count(*) AS requested, sum((coalesce(l.m.s, '') = 'complete')::INT)::BIGINT AS complete, sum((coalesce(l.m.s, '') = 'failed')::INT)::BIGINT AS failed, 0::BIGINT AS other, sum((l.m.s IS NULL)::INT)::BIGINT AS missing FROM (SELECT c_custkey AS unit, stage FROM customer, st) w LEFT JOIN last l USING (unit, stage) GROUP BY stage")
def agg25_batch_roll_up(spark, d):
    """Of all units and stages, how many were asked for, done, failed or never run (AGG25)."""
    wanted = X.read(spark, d, "customer").selectExpr("c_custkey AS unit", "explode(array('lift', 'merge', 'export')) AS stage")
    return roll_up(wanted, M.latest(_runs(spark, d)).select("unit", "stage", "status"), ["stage"])


@query(f"WITH {OBJECTS}, b AS (SELECT uid, CASE WHEN uid % 9 = 0 THEN NULL WHEN face_count > 4000 THEN 'rejected' WHEN uid % 5 = 2 THEN 'needs_review' ELSE 'accepted' END AS status, category FROM objects) SELECT category, count(*) AS requested, sum((coalesce(status, '') = 'accepted')::INT)::BIGINT AS accepted, sum((coalesce(status, '') = 'rejected')::INT)::BIGINT AS rejected, sum((coalesce(status, '') = 'needs_review')::INT)::BIGINT AS other, sum((status IS NULL)::INT)::BIGINT AS missing FROM b GROUP BY category")
def agg25_classified_roll_up(spark, d):
    """Each category's objects by what their classification came to (AGG25)."""
    o = X.objects(spark, d).selectExpr("category", "uid AS unit", "face_count")
    r = o.where("unit % 9 <> 0").selectExpr("category", "unit", "CASE WHEN face_count > 4000 THEN 'rejected' WHEN unit % 5 = 2 THEN 'needs_review' ELSE 'accepted' END AS status")
    return roll_up(o.select("category", "unit"), r, ["category"], ("accepted", "rejected"))
