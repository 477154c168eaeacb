"""Language-model scores: against plain counting, and words that weak hashes confuse."""

import math
import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tesserae.llm import lm


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


def plain_scores(rows):
    """Counts, deleted events one by one, their weights, and each row's columns."""
    texts = [["<s>", *(t or "").encode().lower().split(), "</s>"] for _, t in rows]
    train = [t for (i, _), t in zip(rows, texts, strict=True) if not held(i)]
    one, two = Counter(w for t in train for w in t), Counter(p for t in train for p in zip(t, t[1:], strict=False))
    n, v = sum(len(t) - 1 for t in train), len(one) - ("<s>" in one)
    events = [(one[a] - 1, (two[a, b] - 1) / max(1, one[a] - 1), (one[b] - 1) / max(1, n - 1)) for t in train for a, b in zip(t, t[1:], strict=False)]
    c, p2, p1 = (np.array(x, float) for x in zip(*events, strict=True)) if events else [np.zeros(0)] * 3
    w = lm.learn_weights(lm.bucket(c), p2, p1, 1 / (v + 1), np.ones(len(c)))
    out = []
    for (i, _), t in zip(rows, texts, strict=True):
        own = [w[min(int(lm.bucket(np.array(float(one[a])))), len(w) - 1)] @ [two[a, b] / max(1, one[a]), one[b] / max(1, n), 1 / (v + 1)] for a, b in zip(t, t[1:], strict=False)]
        base = sum(math.log10((one[b] + 0.5) / (n + 0.5 * (v + 1))) for b in t[1:])
        out.append((str(i), held(i), len(t) - 1, sum(one[b] > 0 for b in t[1:]), n, round(base, 6), sum(map(math.log10, own))))
    return sorted(out)


def same(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("block", F.lit("x"))
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), r.score) for r in lm.score_texts(df, lm.crc_mod(F.col("doc_id"), 5) == 1, **options).collect())
    want = plain_scores(rows)
    assert [g[:6] for g in got] == [w[:6] for w in want]
    assert np.allclose([g[6] for g in got], [w[6] for w in want], rtol=3e-3, atol=0.02)


def test_scores_match_plain_counting(spark):
    r = random.Random(4)
    words = [f"w{int(r.paretovariate(0.6)) % 900}" for _ in range(400)]
    rows = [(k, " ".join(r.choice(words) for _ in range(r.randrange(60)))) for k in range(300)]
    rows += [(5, None), (5, ""), (6, "A a B"), (6, "A a B"), (None, "a b"), (None, None), (7, "x " * 5000)]
    same(spark, rows)
    same(spark, rows, block_bytes=700)


def test_words_of_one_polynomial_hash_differ(spark):
    morse = lambda n: bytes(ord("a") + (k.bit_count() & 1) for k in range(n)).decode()
    first, second = morse(1024), morse(1024).translate(str.maketrans("ab", "ba"))
    known, unknown = next(i for i in range(99) if not held(i)), next(i for i in range(99) if held(i))
    rows = [(known, first), (unknown, second)]
    same(spark, rows)
    got = {r.doc_id: r.n_known for r in lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string"), lm.crc_mod(F.col("doc_id"), 5) == 1).collect()}
    assert got == {known: 2, unknown: 1}


def test_planes_hold_any_count():
    for a in ([], [0, 0], [1, 255], [256, 3], [5_000_000_000, 0], [1 << 63, (1 << 64) - 1]):
        a = np.array(a, np.uint64)
        assert lm.unplanes(lm.planes(a), len(a)).tolist() == a.tolist()


def test_totals_above_32_bits():
    import pyarrow as pa

    key = np.array([7], np.uint64)
    t = pa.table({"group": [0, 0], "block": [1, 2], "n": [1, 1], "keys": pa.array([lm.planes(key)] * 2, pa.binary()), "counts": pa.array([lm.planes(np.array([c], np.uint64)) for c in (4_900_000_000, 100_000_000)], pa.binary())})
    out = lm._answer(t)
    assert [lm.unplanes(x, 1).tolist() for x in out["totals"].to_pylist()] == [[5_000_000_000]] * 2
    assert out["firsts"].to_pylist() == [1, 0]


def test_no_training_rows_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens) for r in lm.score_texts(df, F.lit(True)).collect()) == [(1, 3, 0, 0), (2, 1, 0, 0)]
    assert lm.score_texts(df.where("false"), F.lit(False)).count() == 0
