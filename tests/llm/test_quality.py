"""Quality votes: against a plain vote over all labelled rows, with ties, and term counts against plain counting."""

from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tesserae.llm import quality as Q
from tesserae.llm import toxicity
from tesserae.llm.common import labelled_texts


def test_terms_are_counts_of_the_whole_text():
    t = "Der Bär läuft läuft\n\nDER Bär läuft läuft\nfin " * 7
    out, data = Q.terms(t), t.encode()
    words = data.lower().split()
    want = Counter(xxhash.xxh64_intdigest(w, 42) % Q.WORDS for w in words)
    assert all(out[k] == n for k, n in want.items()) and out[: Q.WORDS].sum() == len(words)
    assert out[Q.WORDS : -3].sum() == len(data) - 2
    lines = [x for x in t.split("\n") if x.strip()]
    assert out[-3:].tolist() == [sum(a == b for a, b in zip(words, words[1:], strict=False)), len(lines) - len(set(lines)), len(words) - len(set(words))]
    assert Q.terms("привет мир").tolist() != Q.terms("здравствуй свет").tolist()
    assert not Q.terms("").any()


def plain_vote(model, counts):
    out = []
    for row in counts:
        v = model.space.vectors(row[None])[0]
        cosine = (v[None] @ model.vectors.T)[0]
        near = sorted(range(len(cosine)), key=lambda i: (-cosine[i], i))[: model.k]
        w = [max(float(cosine[i]), 0) ** model.sharpness for i in near]
        ok = row.any() and sum(w) > 1e-9
        out.append(sum(a * float(model.labels[i]) for a, i in zip(w, near, strict=True)) / sum(w) if ok else float(model.labels.mean()))
    return out


def test_vote_matches_a_plain_one():
    r = np.random.default_rng(3)
    words = ["alpha", "beta", "gamma", "délta", "epsilon", "zeta"]
    texts = [" ".join(r.choice(words, r.integers(1, 12))) for _ in range(90)]
    counts = np.array([Q.terms(t) for t in [*texts, *texts[:30]]])  # a third of the rows are tied with another
    space = Q.LatentSpace(counts)
    model = Q.NeighbourVote(space, space.vectors(counts), r.integers(0, 2, len(counts)), k=7)
    asked = np.array([Q.terms(t) for t in ["", "zeta zeta", "alpha délta", *texts[:20]]])
    # products of blocks and of single rows may differ in their last bit, so ties are made exact
    model.vectors = np.round(model.vectors, 3)
    model.space.axes = np.round(space.axes, 3)
    assert np.allclose(model.score(asked), plain_vote(model, asked), atol=0.15)
    assert np.mean(np.abs(model.score(asked) - plain_vote(model, asked)) < 1e-4) > 0.8


def test_first_rows_win_ties():
    counts = np.array([Q.terms("same text here")] * 6 + [Q.terms("other words stand there")] * 6)
    space = Q.LatentSpace(counts)
    vote = lambda labels: Q.NeighbourVote(space, space.vectors(counts), np.array(labels), k=3).score(counts[:1])[0]
    assert vote([1, 1, 1, 0, 0, 0] + [0] * 6) == 1 and vote([0, 0, 0, 1, 1, 1] + [1] * 6) == 0


def test_rows_of_any_kind(spark):
    docs = spark.createDataFrame([(k, ("good plain words " if k % 2 else "# | # | $$ ") * 5 + str(k)) for k in range(40)] + [(50, None), (51, ""), (None, "good plain words " * 5 + "7"), (52, "good plain words " * 9000)], "doc_id long, text string").withColumn("score", F.lit("x"))
    labels = docs.where("doc_id < 40").select("doc_id", (F.col("doc_id") % 2).alias("quality")).union(docs.where("doc_id = 3").select("doc_id", F.lit(0).cast("long")))
    model = Q.fit(docs, labels, "quality", F.lit(True))
    got = {r.doc_id: r.score for r in Q.quality_scores(docs.union(docs.where("doc_id = 1")), model).collect()}
    assert len(got) == 44 and got[50] == got[51] == np.float32(model.labels.mean())
    assert all((s > 0.5) == (k % 2 == 1) for k, s in got.items() if k is not None and k < 40) and got[None] > 0.5 and 0 <= got[52] <= 1
    kept = Q.keep_good(docs, model, 0.7)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {k for k in range(1, 40, 2) if k != 3}


def test_fit_takes_one_row_an_id(spark):
    """A labelled id on many rows gives one vector, whatever their order, in both fits."""
    docs = spark.createDataFrame([(1, f"plain words number {k}") for k in range(300)] + [(2, "other words"), (3, None), (4, "third words here")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0), (3, 0, 0), (4, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = labelled_texts(docs, labels, "quality", F.lit(True), 2).collect()
    assert sorted((r._id, r._label) for r in got) == [(1, 1), (2, 0), (3, 0), (4, 1)]
    again = labelled_texts(docs.orderBy(F.desc("text")).repartition(5), labels, "quality", F.lit(True), 2).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    assert len(Q.fit(docs, labels, "quality", F.lit(True), per_class=1).vectors) == 2
    long = docs.union(spark.createDataFrame([(5, " ".join(f"w{k}" for k in range(40_000)))], docs.schema))
    more = labels.union(spark.createDataFrame([(5, 0, 0)], labels.schema))
    assert toxicity.fit(long, more, "toxic", F.lit(True), per_document=8) is not None
