"""The pipeline's copies: similarity of 0.8 on five-word shingles, and rows without an id of their own."""

import random

import corpus_pipeline as C
from pyspark.sql import functions as F

from tesserae.llm import minhash

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed, n=120):
    r = random.Random(seed)
    return [f"w{r.randrange(5000)}" for _ in range(n)]


def changed(own, *at):
    return " ".join("other" if k in at else w for k, w in enumerate(own))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in rows], COLUMNS)


def brute_force(texts, least=0.8):
    """The smallest index reachable from each text over pairs of that similarity."""
    sets = []
    for t in texts:
        w = t.encode().lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))})
    root = list(range(len(texts)))
    for _ in texts:
        for i in range(len(texts)):
            for j in range(i):
                if len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]):
                    root[i] = root[j] = min(root[i], root[j])
    return root


def test_near_copies_of_similarity_over_the_limit_go(spark):
    rows = [(k * 10, changed(words(k))) for k in range(20)]
    rows += [(k * 10 + 1, changed(words(k), 60)) for k in range(20)]  # 111 of 121 shingles: 0.92
    rows += [(k * 10 + 2, changed(words(k), 20, 80)) for k in range(20)]  # 106 of 126: 0.84
    rows += [(k * 10 + 3, changed(words(k), 10, 50, 90, 110)) for k in range(20)]  # under 0.8 from all
    want = {rows[r][0] for r in brute_force([t for _, t in rows])}
    assert want == {k * 10 + j for k in range(20) for j in (0, 3)}
    assert {r.doc_id for r in C.dissimilar_documents(spark, frame(spark, rows), "").collect()} == want


def test_chains_and_mixed_buckets_match_brute_force(spark):
    r, rows = random.Random(3), []
    for k in range(12):
        own = words(k, 80)
        for _ in range(8):
            own = list(own)
            own[r.randrange(80)] = f"x{r.randrange(9999)}"
            rows.append(" ".join(own))
    df = spark.createDataFrame(list(enumerate(rows)), "_row long, text string")
    got = {x.key: x.component for x in minhash.near_copies(df, "_row").collect()}
    assert [got.get(k, k) for k in range(len(rows))] == brute_force(rows)


def test_a_large_group_around_one_text_matches_brute_force(spark):
    """Copies with few and many changes of one text: only some are similar to the middle one, and some to each other alone."""
    r, own = random.Random(5), words(77, 90)
    rows = [" ".join(w if r.random() > share else f"z{r.randrange(40)}" for w in own) for share in [0.005] * 30 + [0.03] * 40 + [0.06] * 40]
    twin = list(own)
    for k in range(0, 90, 9):
        twin[k] = f"t{k}"
    rows += [" ".join(twin), " ".join([*twin[:50], "last", *twin[51:]])]
    df = spark.createDataFrame(list(enumerate(rows)), "_row long, text string")
    got = {x.key: x.component for x in minhash.near_copies(df, "_row").collect()}
    want = brute_force(rows)
    assert [got.get(k, k) for k in range(len(rows))] == want
    assert want[-1] == want[-2] == len(rows) - 2


def test_bounds_hold():
    from itertools import combinations

    r = random.Random(2)
    sets = [{r.randrange(30) for _ in range(r.randrange(5, 25))} for _ in range(14)]
    for c, x, z in combinations(range(14), 3):
        alone = lambda k: sum(all(h not in s for j, s in enumerate(sets) if j != k) for h in sets[k])
        both = [len(sets[c] & sets[k]) for k in (x, z)]
        beside = [len(sets[k]) - alone(k) - len(sets[c] & sets[k]) for k in (x, z)]
        assert len(sets[x] & sets[z]) <= min(both) + min(beside)


def test_first_key_is_a_shared_key(spark):
    r = random.Random(6)
    rows = []
    for _ in range(300):
        a = [[r.randrange(1024) for _ in range(6)] for _ in range(8)]
        b = [[v if r.random() < 0.7 else r.randrange(1024) for v in s] for s in a]
        pack = lambda f: [sum(v << 10 * k for k, v in enumerate(s)) for s in f]
        rows.append((pack(a), pack(b)))
    df = spark.createDataFrame(rows, "a array<long>, b array<long>")
    got = df.select(minhash.variant_keys(F.col("a")).alias("ka"), minhash.variant_keys(F.col("b")).alias("kb"), minhash.first_key(F.col("a"), F.col("b")).alias("first")).collect()
    for x in got:
        shared = sorted(p.at for p, q in zip(x.ka, x.kb, strict=True) if p == q)
        assert x.first == (shared[0] if shared else None)


def test_odd_texts(spark):
    assert minhash.shingles("A  b\nc") == {b"a b c"} and minhash.shingles(" \t") == {b""}
    assert minhash.shingles("a b c d e f") == {b"a b c d e", b"b c d e f"}
    df = spark.createDataFrame([(1, None), (2, " \n"), (3, "One two"), (4, "one  TWO"), (5, "two one")], "_row long, text string")
    assert sorted(tuple(r) for r in minhash.near_copies(df, "_row").collect()) == [(1, 1), (2, 1), (3, 3), (4, 3)]
    assert minhash.near_copies(df.where("false"), "_row").count() == 0


def test_near_copies_without_own_ids(spark):
    a, b, c = words(1), words(2), words(3)
    rows = [(None, changed(a)), (5, changed(a, 60)), (None, "clean text of its own without any copy"), (None, changed(b)), (None, changed(b, 60)), (7, changed(c)), (7, changed(c, 60)), (7, "other words under the same id as both")]
    out = sorted((str(r.doc_id), r.text) for r in C.dissimilar_documents(spark, frame(spark, rows), "").collect())
    assert [i for i, _ in out] == ["5", "7", "7", "None", "None"]
    assert {rows[1], rows[2], rows[7]} <= {(None if i == "None" else int(i), t) for i, t in out}


def test_exact_copies_without_own_ids(spark):
    rows = [(None, "Copy"), (5, "copy"), (None, "clean"), (7, "twice"), (7, "Twice"), (7, "another text"), (8, "same row"), (8, "same row"), (None, "no id"), (None, "No id"), (None, None), (9, ""), (9, "Another TEXT")]
    got = sorted((str(r.doc_id), (r.text or "").lower()) for r in C.distinct_documents(spark, frame(spark, rows), "").collect())
    assert got == sorted([("5", "copy"), ("None", "clean"), ("7", "twice"), ("9", "another text"), ("8", "same row"), ("None", "no id"), ("9", "")])


def test_one_row_of_each_group_leaves_both_stages(spark):
    a, b, c = changed(words(1)), changed(words(2)), changed(words(3))
    rows = [(None, a), (None, a), (1, changed(words(1), 60)), (None, b), (None, changed(words(2), 60)), (3, c), (3, c), (3, "not a copy"), (None, "nor is this")]
    out = C.dissimilar_documents(spark, C.materialize(C.distinct_documents(spark, frame(spark, rows), ""), "test"), "")
    got = sorted((str(r.doc_id), "b" if r.text in (b, rows[4][1]) else r.text) for r in out.collect())
    assert got == sorted([("1", rows[2][1]), ("None", "b"), ("3", c), ("3", "not a copy"), ("None", "nor is this")])
