"""Files as they lie, outputs replaced as a whole, and digests, against plain Python."""

import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tesserae.operators import digests as D
from tesserae.operators.masks import column_runs, seen_pixels
from tesserae.operators.metadata import inverted, shard_lookup
from tesserae.plans.observing import near_sources
from tesserae.sources import outputs as O


def test_keyed_files(spark, tmp_path):
    """Compressed and nested, over several lines; broken, no object, empty."""
    files = {"a.json.gz": '{"x": {"n": 1,\n "t": [1, 2]}, "y": null}', "in/b.json.gz": "{broken", "in/c.json.gz": "[1]", "d.json.gz": "{}", "e.json": '{"z": 1}'}
    for name, text in files.items():
        at = tmp_path / name
        at.parent.mkdir(exist_ok=True)
        at.write_bytes(gzip.compress(text.encode()) if name.endswith("gz") else text.encode())
    got = sorted((r.path.rsplit("/", 1)[1], str(r.key), json.loads(r.value) if r.value and r.value.startswith("{") else r.value, r.problem) for r in O.keyed_files(spark, str(tmp_path)).collect())
    assert got == [("a.json.gz", "x", {"n": 1, "t": [1, 2]}, ""), ("a.json.gz", "y", None, ""), ("b.json.gz", "None", None, "no JSON"), ("c.json.gz", "None", None, "no object"), ("d.json.gz", "None", None, "")]


def test_manifest_files(spark, tmp_path):
    """Manifests in any depth: those without a key, with a null one, with a missing or an empty artifact."""
    cases = {"s1/o1": {"id": 1, "geometry": "g.bin", "more": "x/p.txt"}, "s1/o2": {"id": None, "geometry": "g.bin", "more": "x/p.txt"}, "s2/deep/o3": {"id": 3, "geometry": "gone.bin", "more": "x/p.txt"}, "o4": {"id": 4, "geometry": "g.bin"}, "o5": "{broken", "o6": {"id": 6, "geometry": "empty.bin", "more": "x/p.txt"}}
    for name, value in cases.items():
        at = tmp_path / name
        (at / "x").mkdir(parents=True)
        (at / "observation.json").write_text(value if isinstance(value, str) else json.dumps(value, indent=1))
        (at / "g.bin").write_bytes(b"g")
        (at / "empty.bin").write_bytes(b"")
        (at / "x" / "p.txt").write_text("p")
    got = {r.path.split(str(tmp_path))[1]: r.problem for r in O.manifest_files(spark, str(tmp_path), ("id", "more"), ("geometry", "more")).collect()}
    assert got == {"/s1/o1/observation.json": "", "/s1/o2/observation.json": "lacks id", "/s2/deep/o3/observation.json": "no file for geometry", "/o4/observation.json": "lacks more", "/o5/observation.json": "no JSON", "/o6/observation.json": "no file for geometry"}


def test_commit_replaces_whole_outputs(spark, tmp_path):
    at = f"file://{tmp_path}/out"
    with pytest.raises(Exception):
        O.committed(spark, at, "a")
    O.commit(spark, at, {"a": spark.range(5), "b": spark.range(2)})
    O.commit(spark, at, {"a": spark.range(3)})
    spark.range(99).write.parquet(f"{at}/data/unfinished/a")  # a run that fails before its manifest
    assert O.committed(spark, at, "a").count() == 3
    with pytest.raises(ValueError):
        O.committed(spark, at, "b")


def test_metadata_outputs(spark):
    records = spark.createDataFrame([(1, "u1", "s", "s/1"), (2, "u2", "s", "s/0"), (3, "u3", "t", "t/1"), (4, "u4", "t", "a/1")], "line_no int, uid string, shard string, path string")
    annotations = spark.createDataFrame([("u1", '{"k": {"z": 1}} '), ("u2", "{}"), ("u4", '{"a":"}"}'), ("u9", "{}")], "uid string, json string")
    categories = spark.createDataFrame([("u1", "b"), ("u1", "a"), ("u1", "a"), ("u3", "c")], "uid string, category string")
    out = O.metadata_outputs(records, annotations, categories, 2)
    rows = [json.loads(r.json) for r in out["annotations"].orderBy("path", "uid").collect()]
    assert rows == [{"a": "}", "_added": {"uid": "u4", "shard": "t", "glb_relative_path": "a/1", "categories": []}}, {"_added": {"uid": "u2", "shard": "s", "glb_relative_path": "s/0", "categories": []}}, {"k": {"z": 1}, "_added": {"uid": "u1", "shard": "s", "glb_relative_path": "s/1", "categories": ["a", "b"]}}]
    assert [r.uid for r in out["sample"].collect()] == ["u4", "u2"] and [r.uid for r in out["missing"].collect()] == ["u3"]
    assert [(r.uid, r.categories) for r in out["categories"].collect()] == [("u1", ["a", "b"])]
    assert tuple(out["summary"].first()) == (4, 2, 3, 1, 1, "1 requested objects have no annotation")


def digest(value):
    return hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def test_digests(spark):
    values = [{"b": [1, 2.50, {"y": None, "x": "é "}], "a": 1e-7}, [], "text", {"n": 10**20, "m": -0.0}, None]
    df = spark.createDataFrame([(json.dumps(v, indent=2, ensure_ascii=False),) for v in values] + [("{broken",), (None,)], "j string")
    assert [r[0] for r in df.select(D.stable_digest(F.col("j"))).collect()] == [*map(digest, values), None, None]
    settings = {"geometry": {"b": 1, "a": [0.5]}, "render": {"w": 64}, "words": [{"id": 1}]}
    s = spark.createDataFrame([("c", k, json.dumps(v, indent=1)) for k, v in settings.items()], "config string, section string, value string")
    d = spark.createDataFrame([("one", "geometry", False), ("two", "render", False), ("two", "geometry", False), ("two", "words", True)], "stage string, section string, by_digest boolean")
    got = {r.stage: r.config_digest for r in D.stage_digests(s, d).collect()}
    want = {"one": digest({"geometry": settings["geometry"]}), "two": digest({"geometry": settings["geometry"], "render": settings["render"], "words": digest(settings["words"])})}
    assert got == want
    files = spark.createDataFrame([("c", "two", "/m/b", 7, 99), ("c", "two", "/m/a", None, None)], "config string, stage string, path string, size long, mtime long")
    more = {r.stage: r.config_digest for r in D.stage_digests(s, d, files).collect()}
    assert more == {"one": hashlib.sha256(want["one"].encode()).hexdigest(), "two": hashlib.sha256((want["two"] + "missing:/m/a" + "/m/b799").encode()).hexdigest()}


def test_observation_ids(spark):
    rows = [("src", 1.0000049, -2.5, 0.0, 0.70710678, -0.70710678, 0.0, 4.0, 88.00001, "c"), ("src", 1e-7, 3.0, 1e16, 1.0, 0.0, 0.0, 4.0, 88.0, "")]
    got = [r.observation_id for r in D.observation_ids(spark.createDataFrame(rows, "source_digest string, ax double, ay double, az double, fx double, fy double, fz double, radius double, angle double, config_digest string")).collect()]
    want = ["observation_" + digest({"source": s, "anchor": [round(v, 5) for v in p[:3]], "forward": [round(v, 6) for v in p[3:6]], "radius_m": round(p[6], 5), "horizontal_angle_deg": round(p[7], 5), "config_digest": c})[:12] for s, *p, c in rows]
    assert got == want


def test_mask_runs_meet_depths(spark):
    """A run over three columns, rows at both ends of a column, depths that are missing, zero or infinite."""
    masks = spark.createDataFrame([("s", 1, "v", 4, [2, 7, 3]), ("s", 2, "v", 4, [0, 1, 11]), ("t", 1, "v", 4, [12])], "scene_id string, mask int, view string, height int, rle array<int>")
    assert sorted(map(tuple, column_runs(masks).collect())) == [("s", 1, "v", 0, 2, 3), ("s", 1, "v", 1, 0, 3), ("s", 1, "v", 2, 0, 0), ("s", 2, "v", 0, 0, 0)]
    depth = spark.createDataFrame([("s", "v", r, c, d) for r, c, d in ((0, 0, 1.0), (3, 0, 2.0), (1, 1, 0.0), (2, 1, float("inf")), (3, 1, 3.0), (0, 2, 4.0), (1, 2, 5.0))] + [("t", "v", 0, 0, 1.0)], "scene_id string, view string, row int, col int, dist double")
    assert sorted(map(tuple, seen_pixels(masks, depth).collect())) == [("s", 1, "v", 0, 2, 4.0), ("s", 1, "v", 3, 0, 2.0), ("s", 1, "v", 3, 1, 3.0), ("s", 2, "v", 0, 0, 1.0)]


def test_stored_tables_are_pruned(spark, tmp_path):
    """Shards that no wanted object names, and sources that no observer reaches, are not read."""
    entries = spark.createDataFrame([(k % 8, k, "{}") for k in range(64)], "shard long, uid long, value string")
    at = f"file://{tmp_path}/shards"
    stored = O.stored_by(entries, at, "shard")
    wanted = spark.createDataFrame([(k % 8, k) for k in range(64)], "shard long, uid long").where("shard < 2")
    found = shard_lookup(wanted, stored)
    assert found.count() == 16 and "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    faces = spark.createDataFrame([("s", i, 3.0 * i, 0.0, 0.0) for i in range(20)] + [("t", 0, 0.0, 0.0, 0.0)], "scene_id string, instance int, x double, y double, z double")
    boxes = faces.selectExpr("scene_id", "instance", "x AS x_min", "x + 1 AS x_max", "y AS y_min", "y + 1 AS y_max", "z AS z_min", "z AS z_max")
    anchors = spark.createDataFrame([("s", 1, 10.0, 0.0, -0.5, 0.5), ("s", 2, 40.0, 30.0, -0.5, 0.5)], "scene_id string, anchor int, ax double, ay double, z_min double, z_max double")
    near = near_sources(O.stored_by(faces, f"file://{tmp_path}/sources", "scene_id", "instance"), boxes, anchors, 4.0)
    assert sorted((r.scene_id, r.instance) for r in near.collect()) == [("s", i) for i in (2, 3, 4)]


def test_categories_in_order_whatever_their_case(spark):
    lists = spark.createDataFrame([("b", [1, 2]), ("A", [1]), ("a", [1, 1]), ("C", [2, 9])], "category string, uids array<int>")
    got = {r.uid: r.categories for r in inverted(lists, spark.createDataFrame([(1,), (2,), (3,)], "uid int")).collect()}
    assert got == {1: ["A", "a", "b"], 2: ["b", "C"]}


def test_every_shard_is_looked_up(spark, data):
    """joi2_shard_lookup asks for all objects that are referenced, in its SQL as in its code."""
    from tesserae.plans import metadata

    got = {(x.shard, x.uid) for x in metadata.joi2_shard_lookup(spark, data).collect()}
    want = {(x.l_partkey % 10, x.l_partkey) for x in spark.read.parquet(f"{data}/lineitem.parquet").select("l_partkey").distinct().collect()}
    assert got == want and " < 4" not in metadata.SQL["joi2_shard_lookup"]


def test_sinks_take_few_folders(spark, tmp_path):
    """Folders grow with blocks of instances, not with instances; one that is asked for is found in its block, and blocks that no observer reaches are not read."""
    faces = spark.createDataFrame([("s", i, 3.0 * i, 0.0, 0.0) for i in range(-3, 1100)] + [("t", 0, 0.0, 0.0, 0.0), ("t", None, 0.0, 0.0, 0.0)], "scene_id string, instance long, x double, y double, z double")
    stored = O.stored_in_blocks(faces, f"file://{tmp_path}/blocks", "scene_id", "instance")
    assert len([p for p in (tmp_path / "blocks").rglob("_block=*")]) == 6
    assert stored.drop("_block").exceptAll(faces).count() == 0 and stored.count() == 1105
    boxes = faces.selectExpr("scene_id", "instance", "x AS x_min", "x + 1 AS x_max", "y AS y_min", "y + 1 AS y_max", "z AS z_min", "z AS z_max")
    anchors = spark.createDataFrame([("s", 1, 10.0, 0.0, -0.5, 0.5)], "scene_id string, anchor int, ax double, ay double, z_min double, z_max double")
    near = near_sources(stored, boxes, anchors, 4.0)
    assert sorted((r.scene_id, r.instance) for r in near.collect()) == [("s", i) for i in (2, 3, 4)]


def test_many_small_files_are_written_by_all_cores(spark, tmp_path):
    """A file in a folder of its own for each key; Spark does not leave them to one task, and scans see each once."""
    rows = spark.createDataFrame([(f"s{k % 2}", k, json.dumps({"id": k})) for k in range(40)], "scene_id string, instance long, value string")
    O.written_each(rows, f"file://{tmp_path}/each", "scene_id", "instance")
    files = [*(tmp_path / "each").rglob("part-*.txt")]
    assert len(files) == 40 and len({p.parent for p in files}) == 40 and len({p.name.split("-")[1] for p in files}) > 4
    got = O.manifest_files(spark, f"file://{tmp_path}/each", ("id",), (), "*.txt")
    assert got.where("problem = ''").count() == 40 and "binaryFile" not in got._jdf.queryExecution().toString()
