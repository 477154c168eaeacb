"""Hard negatives: against SQL and a plain search, ties and odd rows included."""

import math
import random

import numpy as np
from conftest import duck, same_rows
from pyspark.sql import functions as F

from tesserae.llm import negatives as N


def plain(rows, every=50, positives=5, negatives=3):
    """rows: (id, label, vector) that take part."""
    v = {i: [math.floor(256 * x) for x in x_] for i, _, x_ in rows}
    label, out = {i: y for i, y, _ in rows}, []
    for a in sorted(v):
        if a % every == 0:
            score = {i: sum(p * q for p, q in zip(v[a], v[i], strict=False)) for i in v if i != a}
            order = sorted(score, key=lambda i: (-score[i], i))
            for p in [i for i in order if label[i] == label[a]][:positives]:
                found = [i for i in order if label[i] != label[a] and 50 * score[p] <= 100 * score[i] <= 95 * score[p]][:negatives]
                out += [(a, p, k + 1, i, score[p], score[i]) for k, i in enumerate(found)]
    return sorted(out)


def mined(spark, rows, **k):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumns({"anchor": F.lit("x"), "key": F.lit(1), "rows": F.lit(None).cast("string")})
    return sorted(map(tuple, N.hard_negatives(df, "vec_id", F.col("label"), "embedding", **k).collect()))


def test_same_as_sql(spark, data):
    same_rows(N.op13_hard_negatives(spark, data).toPandas(), duck(data).sql(N.OP13_SQL).df())


def test_same_as_a_plain_search_with_ties_and_small_blocks(spark, monkeypatch):
    r = random.Random(4)
    some = [[r.choice([-0.5, 0.25, 0.5, 1.0]) for _ in range(4)] for _ in range(12)]
    rows = [(i, r.randrange(3), r.choice(some)) for i in range(-60, 240)]
    monkeypatch.setattr(N, "ROWS", 40)
    monkeypatch.setattr(N, "ANCHORS", 3)
    monkeypatch.setattr(N, "ROUND", 2)
    got = mined(spark, rows, every=20)
    assert got == plain(rows, 20) and len({x[0] for x in got}) > 8
    one = [(i, 1 if i < 200 else 2, [0.5, 0.5]) for i in range(260)]
    assert mined(spark, one) == plain(one) == []
    hot = [(i, i % 2, [0.9 if i % 2 else 1.0, 0.3]) for i in range(400)]
    assert mined(spark, hot) == plain(hot) != []


def test_odd_rows(spark):
    rows = [(0, 1, [1.0, 1.0]), (1, 1, [1.0, 0.5]), (2, 0, [0.5, 0.5]), (3, 0, [0.7, 0.4])]
    want = plain(rows)
    assert want
    odd = [(0, None, [1.0, 1.0]), (5, 1, None), (6, 0, [None, 0.5]), (7, 0, [float("nan"), 0.5]), (8, 1, [float("inf"), 0.5]), (None, 0, [0.5, 0.5])]
    assert mined(spark, rows + odd + rows) == want
    assert mined(spark, [*rows, (3, 0, [0.7, 0.6])]) == want  # of rows that share an id the least counts
    assert mined(spark, [*rows, (4, 0, []), (9, 0, [0.6])]) == plain([*rows, (4, 0, []), (9, 0, [0.6])])
    assert mined(spark, rows[1:]) == [] and mined(spark, []) == []
    big = [(i, y, [x * 2.0**40 for x in v]) for i, y, v in rows]
    assert isinstance(mined(spark, big), list)


def test_keys_sort_as_their_parts(spark):
    r = random.Random(2)
    parts = [(r.randrange(-5, 5), r.randrange(-9, 9), r.random() < 0.5, r.randrange(-(1 << 62), 1 << 62)) for _ in range(300)]
    keys = sorted(N.pack_key(*p) for p in parts)
    assert [N.unpack_key(k) for k in keys] == sorted(parts, key=lambda p: (p[0], -p[1], p[2], p[3]))
    a, s, _, o = (np.array(x, np.int64) for x in zip(*parts, strict=True))
    assert [bytes(k.as_py()) for k in N._packed(a, s, True, o)] == [N.pack_key(int(x), int(y), True, int(z)) for x, y, z in zip(a, s, o, strict=True)]
    df = spark.createDataFrame([p[:2] + p[3:] for p in parts], "a long, s long, o long").select("*", N.packed_column(F.col("a"), F.col("s"), F.col("o")).alias("k"))
    assert all(bytes(x.k) == N.pack_key(x.a, x.s, False, x.o) for x in df.collect())
