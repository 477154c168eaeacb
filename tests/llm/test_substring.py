"""Substring dedup: against SQL and a plain scan, with a sketch too small for the input, and odd rows."""

import random

import numpy as np
from conftest import duck, same_rows
from pyspark.sql import functions as F

from tesserae.llm import substring as S


def plain(rows, size=20):
    """(id, n_words, n_removed, kept) of each row; null ids come last; rows of one id are one document."""
    order = lambda i: (i is None, i or 0)
    first, out = {}, []
    for i, t in rows:
        w = (t or "").encode().split()
        for s in range(len(w) - size + 1):
            k = tuple(w[s : s + size])
            first[k] = min(first.get(k, (order(i), s)), (order(i), s))
    for i, t in rows:
        w, gone = (t or "").encode().split(), set()
        for s in range(len(w) - size + 1):
            if first[tuple(w[s : s + size])] < (order(i), s):
                gone |= set(range(s, s + size))
        left = [x for k, x in enumerate(w) if k not in gone]
        out.append((str(i), len(w), len(gone), b" ".join(left).decode()))
    return sorted(out)


def cut(spark, rows, size=20, **k):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumns({"id": F.lit("x"), "dk": F.lit("y"), "_h": F.lit(1)})
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in S.without_repeats(df, size, **k).collect())


def passages():
    r = random.Random(7)
    text = lambda n, m=4000: " ".join(f"w{r.randrange(m)}" for _ in range(n))
    shared = [text(n) for n in (20, 25, 60, 19)]
    rows = [(k, "  ".join([text(r.randrange(40)), r.choice(shared), text(r.randrange(30)), r.choice(["", r.choice(shared)])])) for k in range(80)]
    rows += [(100 + k, text(60, 2)) for k in range(6)] + [(200, "a b " * 300), (201, "x\ty\n" * 30), (202, rows[3][1]), (203, rows[3][1])]
    return rows


def test_same_as_sql(spark, data):
    same_rows(S.op12_substring_dedup(spark, data).toPandas(), duck(data).sql(S.OP12_SQL).df())


def test_same_as_a_plain_scan(spark, monkeypatch):
    rows = passages()
    want = plain(rows)
    assert cut(spark, rows) == want and sum(x[2] for x in want) > 1000
    assert cut(spark, rows, 3) == plain(rows, 3)
    monkeypatch.setattr(S, "COMBINED", 50)
    monkeypatch.setattr(S, "HELD", 100)
    assert cut(spark, rows) == want


def test_a_full_sketch_loses_no_window(spark):
    rows = passages()
    assert cut(spark, rows, shape=S.Shape(2, 9, 6)) == plain(rows)


def test_odd_rows(spark):
    t, u = " ".join(f"a{k}" for k in range(30)), " ".join(f"b{k}" for k in range(25))
    rows = [(5, t), (None, t), (None, t), (5, t), (5, u + " " + t), (3, None), (4, ""), (6, " \t\n "), (7, t.upper()), (8, " ".join(f"c{k % 9000}" for k in range(60_000))), (9, u), (-1, u + " " + u)]
    assert cut(spark, rows) == plain(rows)
    assert cut(spark, []) == []
    named = spark.createDataFrame([(str(i), x) for i, x in rows], "name string, text string")
    assert S.without_repeats(named, id_col="name").count() == len(rows)


def test_window_hashes_tell_windows_apart():
    r = random.Random(1)
    w = [bytes([97 + r.randrange(3)]) for _ in range(5000)]
    for size in (1, 2, 3, 7, 20):
        h = S.window_hashes(w, size)
        seen = {}
        for s in range(len(w) - size + 1):
            assert seen.setdefault(tuple(w[s : s + size]), tuple(h[s])) == tuple(h[s])
        assert len(set(seen.values())) == len(seen)


def test_packed_cells_come_back():
    c = np.unique(np.random.default_rng(0).integers(0, 1 << 24, 5000).astype(np.uint32))
    assert (S._unpack(S._pack(c)) == c).all() and len(S._unpack(S._pack(c[:0]))) == 0


def test_a_sketch_takes_little_memory():
    """What a task adds to a full sketch's windows while it packs them stays small beside an executor."""
    import tracemalloc

    h = np.random.default_rng(1).integers(0, 1 << 63, (S.HELD, 2), np.uint64)
    held = [S.cells(x, S.Shape()) for x in np.array_split(h, 64)]
    tracemalloc.start()
    for _ in S.partition_sketch(held, S.Shape()):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32 << 20


def test_repeated_windows_take_little_memory():
    """What a task adds while it combines the windows of many copies stays small beside an executor, and copies in a batch make one window a hash."""
    import tracemalloc
    from types import SimpleNamespace

    import pyarrow as pa
    import zstandard

    shape = S.Shape(2, 9, 6)
    bits = SimpleNamespace(value={k: zstandard.compress(b"\xff" * 8) for k in range(16)})
    text = lambda k: " ".join(f"{k}x{j}" for j in range(6000))
    batch = lambda n: pa.RecordBatch.from_pydict({"id": [*range(64 * n, 64 * n + 64)], "dk": [*range(64)], "text": [text(k % 60) for k in range(64)]})
    tracemalloc.start()
    rows = [b.select(["id", "start", "n"]).to_pylist() for b in S._contenders(bits, 20, shape, S.COMBINED)(map(batch, range(1)))]
    first = {(r["id"], r["start"]) for b in rows for r in b if not r["n"]}
    late = {(r["id"], s) for b in rows for r in b for s in range(r["start"], r["start"] + r["n"])}
    assert first == {(k, s) for k in range(60) for s in range(5981)} | {(k, s) for k, s in first if k >= 60} and first | late == {(k, s) for k in range(64) for s in range(5981)}
    del rows, first, late
    tracemalloc.reset_peak()
    before = tracemalloc.get_traced_memory()[0]
    n = sum(b.num_rows for b in S._contenders(bits, 20, shape, S.COMBINED)(map(batch, range(6))))
    peak = tracemalloc.get_traced_memory()[1] - before
    tracemalloc.stop()
    assert n >= 60 * 5981 and peak < 64 << 20
