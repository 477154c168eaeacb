"""The toxicity network: against plain loops, numeric gradients and held-out labels."""

import numpy as np
from pyspark.sql import functions as F

from tesserae.llm import toxicity as T


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


def small(seed=1):
    net = T.Network({w: i + 1 for i, w in enumerate((b"aa", b"bb", b"cc"))}, dim=3, hidden=2, seed=seed)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    net.p["bias"] += 0.1
    return net


def word_vector(net, w):
    data = b"\x02" + w + b"\x03\x03"
    codes = [((data[i] * 961 + data[i + 1] * 31 + data[i + 2]) * 40503 >> 4) % T._TRIGRAMS for i in range(len(data) - 2)]
    return np.concatenate([net.p["word"][net.vocabulary.get(w, 0)], np.mean([net.p["char"][c] for c in codes], 0)])


def slow_logit(net, words):
    h, states = net.h, []
    for way in (0, 1):
        s, out = np.zeros(h), []
        for w in words if way == 0 else words[::-1]:
            g = word_vector(net, w) @ net.p["w"][way] + net.p["bias"][way, 0]
            u = s @ net.p["u"][way]
            z, r = sigmoid(g[:h] + u[:h]), sigmoid(g[h : 2 * h] + u[h : 2 * h])
            s = z * s + (1 - z) * np.tanh(g[2 * h :] + r * u[2 * h :])
            out.append(s)
        states.append(out if way == 0 else out[::-1])
    both = np.array([np.concatenate(x) for x in zip(*states, strict=True)])
    a = np.exp(both @ net.p["attend"])
    return (a / a.sum()) @ both @ net.p["out"] + net.p["off"][0]


WINDOWS = [[b"aa", b"zz", b"bb"], [b"cc"], [b"bb", b"bb", b"aa", b"q"]]


def inputs():
    words, at, size = T._index(WINDOWS)
    return words, at, size


def test_forward_pass_matches_plain_loops():
    net, (words, at, size) = small(), inputs()
    got = net.forward(net.gates(net.inputs(words)[0])[at], size)
    assert np.allclose(got, [slow_logit(net, w) for w in WINDOWS])


def test_gradients_match_differences():
    net, (words, at, size) = small(2), inputs()
    label = np.array([1.0, 0.0, 1.0])

    def loss():
        z = np.array([slow_logit(net, w) for w in WINDOWS])
        return np.mean(np.log1p(np.exp(-z)) + (1 - label) * z)

    r = np.random.default_rng(0)
    for k, g in net.gradients(words, at, size, label).items():
        places = np.argwhere(g) if k in ("word", "char") else np.argwhere(np.ones_like(g))
        for i in map(tuple, r.permutation(places)[:12]):
            keep, eps = net.p[k][i], 1e-5
            net.p[k][i] = keep + eps
            up = loss()
            net.p[k][i] = keep - eps
            down = loss()
            net.p[k][i] = keep
            assert abs((up - down) / (2 * eps) - g[i]) < 1e-6, k


def test_held_out_documents(spark):
    d = "/root/testdata/sf0.1"
    got = T.op9_toxicity(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").toPandas()
    hit = ((got.predicted == 1) & (got.toxic == 1)).sum()
    recall, precision = hit / (got.toxic == 1).sum(), hit / max(1, (got.predicted == 1).sum())
    # always 0: recall 0; always 1: precision of the toxic share; some labels are wrong: 6 of 97 toxic texts have no toxic word
    assert recall > 0.85 and precision > 0.75 > 3 * got.toxic.mean()


def test_ties_and_texts_without_words(spark):
    docs = spark.createDataFrame([(k, f"you vile idiot {k}" if k % 2 else f"a kind word {k}") for k in range(60)] + [(60, None), (61, ". !"), (None, "a kind word")], "doc_id long, text string")
    labels = docs.where("doc_id is not null").select("doc_id", (F.col("doc_id") % 2).alias("toxic")).union(docs.where("doc_id = 3").select("doc_id", F.lit(0).cast("long")))
    net = T.fit(docs, labels, "toxic", F.lit(True))
    got = {r.doc_id: r.score for r in T.toxicity_scores(docs.union(docs.where("doc_id = 5")), net).collect()}
    # document 3 has both labels
    wrong = {k: s for k, s in got.items() if k is not None and k < 60 and k != 3 and (s >= 0.5) != (k % 2 == 1)}
    assert not wrong
    assert got[60] == got[61] < 0.1 and got[None] < 0.5
    assert T.fit(docs, labels.where("toxic = 1"), "toxic", F.lit(True)) is None
    assert T.fit(docs, labels, "toxic", F.lit(False)) is None
