"""The SimHash index of the pipeline's near copies."""

import random

import corpus_pipeline as C
import numpy as np
import pytest
from test_near_copies import brute_force, changed, frame, words

from tesserae.llm import minhash, similar


def keys_by_row(spark, sets):
    """The keys of each text, made by the operator from its fingerprint."""
    df = similar.signatures(spark.createDataFrame(list(enumerate(sets)), "k long, text string"), "k")
    bits, segments = similar.layout(1000)
    out = [set() for _ in sets]
    for at in range(0, segments, similar.ROUND):
        for r in similar.variant_keys(df, bits, at, min(at + similar.ROUND, segments)).collect():
            out[r.key].add((r.at, r.bits))
    assert all(len(o) == 3 * segments for o in out)
    return out


def test_fingerprint_is_a_simhash():
    """Each bit is the majority of the shingles' bits, and bits differ in proportion to the angle between the sets."""
    h = np.random.default_rng(1).integers(0, 1 << 63, 900, np.uint64)
    of = lambda x: np.unpackbits(np.frombuffer(similar.fingerprint(x), np.uint8), bitorder="little")
    each = np.array([of(h[k : k + 1]) for k in range(700)], np.int64)
    assert (of(h[:700]) == (2 * each.sum(0) > 700)).all()
    # 800 of 900: cosine 0.94, similarity 0.89; 0.108 of the bits
    assert abs((of(h) != of(h[:800])).mean() - np.arccos((800 / 900) ** 0.5) / np.pi) < 0.03


def test_the_pipeline_finds_near_copies_by_simhash(spark, monkeypatch):
    """The stage gets its rows through the SimHash index: none of them by minima."""
    monkeypatch.setattr(minhash, "near_copies", None)
    monkeypatch.setattr(minhash, "signatures", None)
    rows = [(1, changed(words(1))), (2, changed(words(1), 60)), (3, changed(words(2)))]
    assert sorted(r.doc_id for r in C.dissimilar_documents(spark, frame(spark, rows), "").collect()) == [1, 3]


def test_pairs_of_similarity_just_over_the_limit_share_a_key(spark):
    r, rows = random.Random(4), []
    for k in range(60):
        n = r.choice([9, 13, 40, 200, 700])
        own = [f"v{k}x{j}" for j in range(n + 4)]
        rows += [" ".join(own), " ".join(own[: n + 4 - n // 5])]  # 0.8 or just over
    keys = keys_by_row(spark, rows)
    assert all(keys[k] & keys[k + 1] for k in range(0, len(rows), 2))
    assert sum(bool(keys[k] & keys[j]) for k in range(0, 40, 2) for j in range(k)) < 60


def test_four_shingles_of_five_are_linked(spark):
    rows = [" ".join(f"u{k}x{j}" for j in range(n)) for k in range(150) for n in (9, 8)]
    df = spark.createDataFrame(list(enumerate(rows)), "_row long, text string")
    got = {x.key: x.component for x in similar.near_copies(df, "_row").collect()}
    assert got == {k: k // 2 * 2 for k in range(300)}


@pytest.mark.parametrize("seed", [3, 4])
def test_chains_groups_and_pairs_beside_the_pivot_match_brute_force(spark, seed, monkeypatch):
    r, rows = random.Random(seed), []
    for k in range(8):
        own = words(k, 80)
        for _ in range(8):
            own = list(own)
            own[r.randrange(80)] = f"x{r.randrange(9999)}"
            rows.append(" ".join(own))
    own = words(77 + seed, 90)
    rows += [" ".join(w if r.random() > share else f"z{r.randrange(40)}" for w in own) for share in [0.005] * 15 + [0.03] * 20 + [0.06] * 20]
    twin = list(own)
    for k in range(0, 90, 9):
        twin[k] = f"t{k}"
    rows += [" ".join(twin), " ".join([*twin[:50], "last", *twin[51:]]), None, " \n", "One two", "one  TWO", "two one"]
    df = spark.createDataFrame(list(enumerate(rows)), "_row long, text string")
    met = []
    monkeypatch.setattr(similar, "overlaps", lambda p, *a: met.append(p) or minhash.overlaps(p, *a))
    got = {x.key: x.component for x in similar.near_copies(df, "_row").collect()}
    assert [got.get(k, k) for k in range(len(rows))] == brute_force([t or "" for t in rows])
    assert len(met) == 2  # the pairs that share no pivot, too
    assert similar.near_copies(df.where("false"), "_row").count() == 0


def test_rows_meet_by_chance_as_often_at_any_size():
    """A sixteenth of a row to a key at most, and no less than a fortieth, so that pairs and triples by chance grow as the rows do."""
    for rows in (10_000, 40_000, 200_000, 1_000_000, 12_000_000):
        bits, _ = similar.layout(rows)
        assert 1 / 40 <= rows / 2 ** (2 * bits / 3) <= 1 / 16


def test_a_group_of_copies_meets_each_pair_once(spark, monkeypatch):
    """In a group in which over half of the rows are too far from all others, pairs are held once over all rounds, and few of those that hubs leave apart."""
    r, own, rows = random.Random(8), words(5, 150), []
    for k in range(60):
        rows.append(" ".join(w if r.random() > k / 60 * 0.06 else f"z{r.randrange(400)}" for w in own))
    df = spark.createDataFrame(list(enumerate(rows)), "_row long, text string")
    held, write = [], similar.materialize
    monkeypatch.setattr(similar, "KEYS", 0)

    def materialize(table, name, **options):
        out = write(table, name, **options)
        if {"a", "b"} <= {*out.columns} or "x_key" in out.columns or "band" in out.columns or {"key", "pivot", "n"} <= {*out.columns}:
            held.append((name, out.count()))
        return out

    monkeypatch.setattr(similar, "materialize", materialize)
    got = {x.key: x.component for x in similar.near_copies(df, "_row").collect()}
    assert [got.get(k, k) for k in range(len(rows))] == brute_force(rows)
    assert sum(n for _, n in held) < 12 * len(rows)
