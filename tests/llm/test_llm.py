"""The training-data operators: odd rows, and agreement with libraries and brute force."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from conftest import duck, same_rows
from pyspark.sql import functions as F

from tesserae.llm import bpe, exact, lm, packing, pii, quality, queries, rules, simhash, tokens, toxicity

LONG = "lorem ipsum dolor sit amet " * 4000
ROWS = [(1, "Hello World, hello world.", "a"), (2, None, "a"), (3, "", None), (4, LONG, "b"), (5, "hello world, HELLO world.", "b"), (1, "Hello World, hello world.", "a"), (None, "no id here", "a"), (7, "日本語 İ <|endoftext|> x\n\n  y", "c"), (8, " \t\n ", "c")]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, and columns named as the operators' own."""
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    return df.select("*", *(F.lit("x").alias(c) for c in ("fp", "keep_id", "score", "block", "held_out", "label", "_t", "_h")))


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


def words_of(text):
    return (text or "").encode().lower().split()


def docs_of(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


def test_token_counts(spark, data, odd, none):
    path = P.path("byte_bpe_50k.json")
    tok = tokens.load(path)
    for df in (odd, docs_of(spark, data)):
        want = sorted((str(r.doc_id), len((r.text or "").encode()), len(tok.encode(r.text or "", add_special_tokens=False))) for r in df.select("doc_id", "text").collect())
        assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in tokens.count_tokens(df, path, cache_entries=60_000).collect()) == want
    assert tokens.count_tokens(none, path).count() == 0


def test_frequent_lengths_are_counted(spark, data, none):
    path = P.path("byte_bpe_50k.json")
    tok = tokens.load(path)
    docs = docs_of(spark, data)
    counts = Counter(p for r in docs.collect() if tokens.is_plain(r.text or "") for p in tokens.BYTE_LEVEL(r.text or ""))
    got = tokens.frequent_lengths(docs, path, top=300, every=1)
    assert set(got) == set(sorted(counts, key=lambda p: (-counts[p], p))[:300])
    assert got == {p: len(tok.encode(p, add_special_tokens=False)) for p in got}
    assert tokens.frequent_lengths(none, path) == {}


def test_packing(spark, data, odd, none):
    path = P.path("word_bpe_49k.json")
    tok = tokens.load(path)
    for df in (odd, docs_of(spark, data)):
        whole = Counter()
        for r in df.select("doc_id", "text").collect():
            whole[(r.doc_id, np.array([*tok.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4").tobytes())] += 1
        rows = packing.pack(df, path, block_tokens=30_000).collect()
        seqs, parts = defaultdict(list), defaultdict(lambda: defaultdict(list))
        for r in rows:
            assert r.length * 4 == len(r.ids)
            seqs[r.sequence_id].append((r.offset, r.length))
            parts[r.doc_id][r.start].append(bytes(r.ids))
        for pieces in seqs.values():
            at = 0
            for o, n in sorted(pieces):
                assert o == at
                at += n
            assert at == 4096 or at & (at - 1) == 0
        for (i, ids), n in whole.items():
            if n == 1:
                assert b"".join(parts[i][s][0] for s in sorted(parts[i])) == ids
        assert sum(r.length for r in rows) == sum(len(k[1]) // 4 * n for k, n in whole.items())
    assert packing.pack(none, path).count() == 0


def test_assignment_is_even():
    r = np.random.default_rng(0)
    sizes = r.integers(1, 900, 400)
    cost, room = Counter(), Counter()
    for _, _, n, s, _ in packing.assign(sizes, 4096):
        cost[s] += n + n * n / 1024
        room[s] += n
    full = [cost[s] for s in cost if room[s] == 4096]
    assert max(full) < 1.5 * min(full)


def test_exact_dedup(spark, data, odd, none):
    con = duck(data)
    same_rows(exact.op3_exact_dedup(spark, data).toPandas(), con.sql(exact.OP3_SQL).df())
    got = sorted((str(r.doc_id), r.keep_id, r.group_size, r.kept) for r in exact.exact_groups(odd, keep="smallest").collect())
    assert got == sorted([("1", 1, 3, True), ("1", 1, 3, True), ("5", 1, 3, False), ("2", 2, 2, True), ("3", 2, 2, False), ("4", 4, 1, True), ("None", None, 1, True), ("7", 7, 1, True), ("8", 8, 1, True)])
    assert exact.exact_groups(none).count() == 0


def test_exact_dedup_survives_collisions(spark, data):
    weak = lambda t: F.substring(F.md5(t.cast("binary")), 1, 1)
    docs = docs_of(spark, data)
    same_rows(exact.exact_groups(docs, hash_text=weak).toPandas(), exact.exact_groups(docs).toPandas())


def test_bitmap_passes_all_marked_rows_and_few_others(spark):
    rows = spark.range(20_000).select("id", F.md5(F.col("id").cast("string")).alias("_h"))
    maps = exact.marked(rows.where("id < 500"), 1 << 20)
    got = {r.id for r in exact.among(rows, maps, 1 << 20).collect()}
    assert set(range(500)) <= got and len(got) < 600
    assert exact.among(rows, exact.marked(rows.where("false"), 1 << 20), 1 << 20).count() == 0


def test_bpe(spark, data, odd, none):
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for df in (odd, docs_of(spark, data)):
        want = []
        for r in df.select("doc_id", "text").collect():
            ids = lib.encode_ordinary(r.text or "")
            want.append((str(r.doc_id), len(ids), sha(",".join(map(str, ids)).encode()), sha((r.text or "").encode())))
        assert sorted((str(r.doc_id), *r[1:]) for r in bpe.round_trip(df, path).collect()) == sorted(want)
    back = bpe.decode(bpe.encode(odd, path), path).collect()
    assert sorted(bytes(r.data).decode() for r in back) == sorted(t or "" for _, t, _ in ROWS)
    assert bpe.round_trip(none, path).count() == 0


def test_prefix_table_appends_and_edits():
    b = bpe.PrefixBPE(bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken")))
    r = random.Random(5)
    for _ in range(60):
        data = bytes(r.choice(b"the anding") for _ in range(r.randrange(1, 60)))
        last = b.table(data)
        assert b.read(data, last) == b.merge(data)
        more = bytes(r.choice(b"ation er") for _ in range(9))
        assert b.append(data, list(last), more) == (data + more, b.table(data + more))
        i = r.randrange(len(data))
        j = r.randrange(i, len(data) + 1)
        out, table = b.replace(data, last, i, j, b"xing")
        assert table == b.table(out) and out == data[:i] + b"xing" + data[j:]


def slow_fingerprint(text, width=4):
    import xxhash

    w = words_of(text)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + width]), 42) for i in range(max(1, len(w) - width + 1))]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def components(fps, distance):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def similar_components(texts, least=0.8):
    """Components over pairs of that similarity of five-word shingles."""
    sets = []
    for t in texts:
        w = words_of(t)
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(sets))]


def test_simhash(spark, data, odd, none):
    for df in (odd, docs_of(spark, data)):
        rows = df.select("doc_id", "text").collect()
        fps = [slow_fingerprint(r.text) for r in rows]
        low = {}
        for r, c in zip(rows, components(fps, 4), strict=True):
            low[c] = min(low.get(c, 1 << 60), 1 << 60 if r.doc_id is None else r.doc_id)
        want = sorted((str(r.doc_id), f, str(low[c]) if low[c] < 1 << 60 else "None") for r, f, c in zip(rows, fps, components(fps, 4), strict=True))
        assert sorted((str(r.doc_id), r.fp % (1 << 64), str(r.component_id)) for r in simhash.near_duplicates(df).collect()) == want
    assert simhash.near_duplicates(none).count() == 0


def test_every_link_is_found_once(spark):
    r = random.Random(9)
    base = [r.getrandbits(64) for _ in range(8)]
    fps = list({b ^ sum(1 << k for k in r.sample(range(64), r.randrange(0, 6))) for b in base for _ in range(40)} | {0, (1 << 64) - 1, 1 << 63})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = sorted(tuple(sorted(x)) for x in simhash.linked_pairs(spark.createDataFrame([(f, f) for f in signed], "id long, fp long")).collect())
    want = sorted(tuple(sorted((signed[i], signed[j]))) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4)
    assert got == want


def test_keys_are_not_broadcast(spark):
    """Spark sizes the 64 keys of a fingerprint by its one row, so that tables of up to 10 MB were sent to the driver whole, as 640."""
    pairs = simhash.linked_pairs(spark.range(300).select("id", F.xxhash64("id").alias("fp")))
    assert pairs.count() == 0
    assert "Broadcast" not in pairs._jdf.queryExecution().sparkPlan().toString() + pairs._jdf.queryExecution().executedPlan().toString()


def test_lm_base_and_gain(spark, data, odd, none):
    for df in (odd, docs_of(spark, data)):
        rows = df.select("doc_id", "text").collect()
        held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
        c = Counter(w for r in rows if not held(r.doc_id) for w in [*words_of(r.text), None])
        n, v = sum(c.values()), len(c)
        want = sorted((str(r.doc_id), len(words_of(r.text)) + 1, sum(c[w] > 0 for w in [*words_of(r.text), None]), round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in [*words_of(r.text), None]), 4)) for r in rows)
        out = lm.score_texts(df, lm.crc_mod(F.col("doc_id"), 5) == 1).collect()
        assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 4)) for r in out) == want
        assert {r.train_tokens for r in out} == {n}
    test = [r for r in out if r.held_out]
    assert sum(r.score for r in test) > sum(r.base_score for r in test)
    assert lm.score_texts(none, F.lit(False)).count() == 0


def test_quality(spark, data, odd, none):
    m = quality.fit(docs_of(spark, data), spark.read.parquet(f"{data}/labels.parquet"), "quality", F.lit(True))
    scores = [r.score for r in quality.quality_scores(odd, m).collect()]
    assert len(scores) == len(ROWS) and all(0 <= s <= 1 for s in scores)
    assert quality.quality_scores(none, m).count() == 0
    empty = quality.fit(docs_of(spark, data), spark.read.parquet(f"{data}/labels.parquet"), "quality", F.lit(False))
    assert {r.score for r in quality.quality_scores(odd, empty).collect()} == {0.5}


def test_quality_held_out(spark):
    d = "/root/testdata/sf0.01"
    got = quality.op7_quality(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert (got.predicted == got.quality).mean() > 0.95


def test_rules(spark, data, odd, none):
    same_rows(rules.op8_quality_rules(spark, data).toPandas(), duck(data).sql(rules.OP8_SQL).df())
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_repeat_words, r.kept) for r in rules.quality_rules(odd).collect())
    assert got == sorted([("1", 4, 22, 0, False), ("1", 4, 22, 0, False), ("2", 0, 0, 0, False), ("3", 0, 0, 0, False), ("4", 20000, 88000, 20000, False), ("5", 4, 22, 0, False), ("7", 5, 19, 0, False), ("8", 0, 0, 0, False), ("None", 3, 8, 0, False)])
    assert rules.quality_rules(none).count() == 0


def test_recurring_lines_deplete_a_document(spark):
    own = " ".join(f"w{k}" for k in range(60))
    rows = [(k, f"{own} {k}\nSame line here", "h") for k in range(5)] + [(9, "Same  LINE here\n" * 30 + own, "h"), (10, "same line here\n" * 30, "other"), (11, f"{own}\n" + "same line here\n" * 6, "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    of = lambda **o: {r.doc_id: (r.n_line_words, r.kept) for r in rules.quality_rules(df, **o).collect()}
    assert of()[0] == (3, True) and of()[9] == (90, False) and of()[10][0] == 0
    # seven of the host's seven documents have the line
    assert of()[11] == (18, False) and of(least_left=0.7)[11] == (18, True)
    assert of(least_documents=7)[11] == (0, True) and of(host_percent=100)[11] == (0, True) and of(host_percent=99)[11] == (18, False)


def test_rules_take_ids_of_any_type(spark, odd):
    want = sorted((str(r.doc_id), r.n_words, r.kept) for r in rules.quality_rules(odd).collect())
    assert sorted((str(r.doc_id), r.n_words, r.kept) for r in rules.quality_rules(odd.withColumn("doc_id", F.col("doc_id").cast("string"))).collect()) == want


def test_verdicts_differ_by_recurring_lines(spark):
    got = rules.op8_quality_rules(spark, "/root/testdata/sf0.01").where("kept = base_failed AND n_line_words > 0").collect()
    assert got and all(r.n_words - r.n_line_words < 0.8 * r.n_words for r in got)
    same_rows(rules.op8_quality_rules(spark, "/root/testdata/sf0.01").toPandas(), duck("/root/testdata/sf0.01").sql(rules.OP8_SQL).df())


def test_toxicity(spark, odd, none):
    d = "/root/testdata/sf0.01"
    net = toxicity.fit(docs_of(spark, d), spark.read.parquet(f"{d}/labels.parquet"), "toxic", toxicity.crc_mod(F.col("doc_id"), 5) != 0)
    scores = [r.score for r in toxicity.toxicity_scores(odd, net).collect()]
    assert len(scores) == len(ROWS) and all(0 <= s <= 1 for s in scores)
    assert toxicity.toxicity_scores(none, net).count() == 0
    assert {r.score for r in toxicity.toxicity_scores(odd, None).collect()} == {0.0}


def test_windows_cover_all_words():
    for n in (1, 5, 24, 25, 36, 37, 100):
        covered = {i for s in toxicity.window_starts(n) for i in range(s, min(n, s + toxicity.WINDOW))}
        assert covered == set(range(n))


def test_pii_base_spans():
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    r = random.Random(2)
    for _ in range(4000):
        t = "".join(r.choice("ab1.@- 2") for _ in range(r.randrange(24)))
        assert pii.emails(t) == [m.span() for m in email.finditer(t)]
        assert [(a, z) for k, a, z in pii.base_spans(t) if k == "ip"] == [m.span() for m in ip.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    t = "x é +1 (988) 555-2485 z 4041894974608795, 4041894974608796 a.b@c.de"
    assert pii.spell(pii.base_spans(t)) == f"email:{t.index('a.b')}:{len(t)},card:24:40,phone:4:21"


def test_pii(spark, data, odd, none):
    out = pii.personal_data(odd).collect()
    assert len(out) == len(ROWS) and all(r.spans == "" and r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in out)
    assert pii.personal_data(none).count() == 0
    key = lambda k: base64.b32encode(hashlib.sha1(bytes([k])).digest()[:10]).decode() if k else "ABCDEFGHIJKLMNOP"
    rows = [(k, f'word {c} token = "{hashlib.sha1(str(k).encode()).hexdigest()}" and AKIA{key(k)} end 1234567890123456') for k, c in enumerate("abcdefgh")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(r.spans.count("secret:") == 2 and "card" not in r.spans for r in pii.personal_data(df).collect())
    clean = pii.redact(df, pii.learn(pii.scan(df))).collect()
    assert all("AKIA" not in r.text and "1234567890123456" in r.text for r in clean)


def test_pipeline_against_brute_force(spark, data):
    import corpus_pipeline as C

    docs = docs_of(spark, data)
    kept = {}
    for name, stage in C.STAGES[:-1]:
        docs = C.materialize(stage(spark, docs, data), "test")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    scores = {r.doc_id: r.score for r in quality.quality_scores(docs_of(spark, data), quality.fit(docs_of(spark, data), spark.read.parquet(f"{data}/labels.parquet"), "quality", quality.crc_mod(F.col("doc_id"), 4) != 2)).collect()}
    assert set(kept["quality"]) == {i for i, s in scores.items() if s >= 0.7}
    largest = {}
    for i, t in kept["quality"].items():
        t = t.encode().lower()
        largest[t] = max(i, largest.get(t, i))
    assert set(kept["exact_dedup"]) == set(largest.values())
    ids = sorted(kept["exact_dedup"])
    roots = similar_components([kept["exact_dedup"][i] for i in ids])
    first = {}
    for i, c in zip(ids, roots, strict=True):
        first.setdefault(c, i)
    assert set(kept["near_dedup"]) == set(first.values())
    assert set(kept["pii"]) == set(kept["near_dedup"])
    assert all(not pii.base_spans(t) for t in kept["pii"].values())
    packed = C.run(spark, data).toPandas()
    assert set(packed.doc_id) == set(kept["pii"])


def test_queries_are_registered():
    assert [q.split("_")[0] for q in queries.QUERIES] == [f"op{n}" for n in range(1, 11)]


def test_repeated_rows_do_not_make_a_line_recur(spark):
    """Four rows of one id and text, and four without an id, are one document each; four ids with one line are four."""
    lines = lambda k: "\n".join(" ".join(f"w{k}x{i}y{j}" for j in range(12)) for i in range(6))
    rows = [(1, lines(1), "a")] * 4 + [(None, lines(2), "a")] * 4 + [(10 + k, lines(9), "b") for k in range(4)]
    got = rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert all(r.kept and r.n_line_words == 0 for r in got if r.host == "a") and not any(r.kept for r in got if r.host == "b") and len(got) == 12


def test_op1_counts_all_rows(spark, monkeypatch):
    """What the broadcast table holds is counted on every row, not on some: a pre-token of the last rows is in it."""
    seen = []
    real = tokens.frequent_lengths
    monkeypatch.setattr(tokens, "frequent_lengths", lambda *a, **k: seen.append(real(*a, **k)) or seen[-1])
    df = spark.createDataFrame([(i, "aaa" if i < 64 else "zzz") for i in range(128)], "doc_id long, text string").coalesce(1)
    assert tokens.count_tokens(df, P.path("byte_bpe_50k.json")).count() == 128
    assert set(seen[0]) == {"aaa", "zzz"}
