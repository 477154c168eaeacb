"""The pipeline's stages on odd rows: nulls in any column, empty and very long texts, ties, repeated rows, no rows, clashing columns."""

import random

import corpus_pipeline as C
import pytest
from pyspark.sql import functions as F

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def prose(seed, n=80):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(3000)}" for _ in range(n))


LONG = " ".join(f"long{k % 7000}" for k in range(60_000))
ROWS = [(1, prose(1), "en", "a"), (1, prose(1), "en", "a"), (2, prose(1).upper(), None, "b"), (3, None, "en", None), (4, "", None, None), (None, prose(2), "de", "a"), (None, None, None, None), (5, LONG, "en", "a"), (6, "mail me: a.b@c.de", "en", "b"), (6, prose(3), "en", "b"), (7, " \n\t ", "en", "a")]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in ROWS], "doc_id long, text string, lang string, source string, n_chars long")
    return C.materialize(df.select("*", *(F.lit("x").alias(c) for c in ("key", "_row", "score", "component", "by", "_t", "_h", "kept"))), "odd")


@pytest.mark.parametrize("name", [n for n, _ in C.STAGES])
def test_stage_on_odd_rows(spark, data, odd, name):
    stage = dict(C.STAGES)[name]
    out = stage(spark, odd, data)
    if name != "packing":
        assert out.columns == odd.columns
    rows = out.collect()
    texts = [(str(r.doc_id), r.text) for r in rows] if name != "packing" else []
    if name == "quality":
        assert set(texts) <= {(str(i), t) for i, t, _, _ in ROWS}
    elif name == "exact_dedup":
        assert sorted((i, (t or "")[:20].lower()) for i, t in texts) == sorted([("2", prose(1)[:20]), ("4", ""), ("None", prose(2)[:20]), ("5", LONG[:20]), ("6", "mail me: a.b@c.de"), ("6", prose(3)[:20]), ("7", " \n\t ")])
    elif name == "near_dedup":
        assert sorted((i, (t or "").strip()[:20].lower()) for i, t in texts) == sorted([("1", prose(1)[:20]), ("3", ""), ("None", prose(2)[:20]), ("5", LONG[:20]), ("6", "mail me: a.b@c.de"), ("6", prose(3)[:20])])
    elif name == "pii":
        assert sorted(str(t) for _, t in texts) == sorted(str(t).replace("a.b@c.de", "[EMAIL]") for _, t, _, _ in ROWS)
        assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in rows)
    else:
        assert sum(r.start == 0 for r in rows) == len(ROWS)


@pytest.mark.parametrize("name", [n for n, _ in C.STAGES])
def test_stage_keeps_ids_of_any_type(spark, data, odd, name):
    named = odd.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    out = dict(C.STAGES)[name](spark, named, data)
    assert out.schema["doc_id"].dataType == named.schema["doc_id"].dataType and out.count() > 0


@pytest.mark.parametrize("name", [n for n, _ in C.STAGES])
def test_stage_without_rows(spark, data, odd, name):
    assert dict(C.STAGES)[name](spark, C.materialize(odd.where("false"), "none"), data).count() == 0
