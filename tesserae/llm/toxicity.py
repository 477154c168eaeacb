"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained and run in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm.common import crc_mod, grouped, labelled_texts, table, texts

WINDOW, STRIDE = 24, 12
_TRIGRAMS = 2048
#: Small letters for capital ones, a blank for control characters and punctuation.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b > 127 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_PLAIN).split()


def window_starts(n: int) -> range:
    """Starts of the overlapping windows that cover n words: every STRIDE-th, the last reaching the end."""
    return range(0, max(1, n - WINDOW + STRIDE), STRIDE)


def trigram_sums(words: list[bytes], vectors: np.ndarray) -> np.ndarray:
    """Mean of the vectors of each word's character trigrams, the word's edges included."""
    data = np.frombuffer(b"".join(b"\x02" + w + b"\x03\x03" for w in words), np.uint8).astype(np.int64)
    code = np.zeros(len(data), np.int64)
    code[:-2] = (data[:-2] * 961 + data[1:-1] * 31 + data[2:]) * 40503 >> 4
    size = np.fromiter(map(len, words), np.int64, len(words)) + 3
    start = np.cumsum(size) - size
    # the last two places of a word reach over its end
    live = np.ones(len(data), bool)
    live[start + size - 1] = live[start + size - 2] = False
    owner = np.repeat(np.arange(len(words)), size)[live]
    code = code[live] % _TRIGRAMS
    first = np.searchsorted(owner, np.arange(len(words)))
    return np.add.reduceat(vectors[code], first, axis=0) / (size - 2)[:, None].astype(np.float32), code, owner


def summed(n: int, at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """(n, columns): sums of the rows by their places `at`."""
    order = np.argsort(at, kind="stable")
    first = np.flatnonzero(np.diff(at[order], prepend=-1))
    out = np.zeros((n, rows.shape[1]), rows.dtype)
    out[at[order][first]] = np.add.reduceat(rows[order], first, axis=0)
    return out


class Network:
    """Word and character-trigram vectors, a gated recurrent layer each way, attention over its states, one logit."""

    def __init__(self, vocabulary: dict[bytes, int], dim: int = 12, hidden: int = 8, seed: int = 0):
        r = np.random.default_rng(seed)
        self.vocabulary, self.h, self.dim = vocabulary, hidden, dim
        n = lambda *s, k: (r.standard_normal(s) * k).astype(np.float32)
        # words outside the vocabulary share row 0
        self.p = {"word": n(len(vocabulary) + 1, dim, k=0.1), "char": n(_TRIGRAMS, dim, k=0.3), "w": n(2, 2 * dim, 3 * hidden, k=0.3), "bias": np.zeros((2, 1, 3 * hidden), np.float32), "u": n(2, hidden, 3 * hidden, k=0.3), "attend": n(2 * hidden, k=0.3), "out": n(2 * hidden, k=0.5), "off": np.zeros(1, np.float32)}
        self.p["bias"][:, :, :hidden] = 1.0
        self.moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        self.steps, self.scale, self.shift = 0, 1.0, 0.0

    def inputs(self, words: list[bytes]):
        ids = np.fromiter((self.vocabulary.get(w, 0) for w in words), np.int64, len(words))
        chars, code, owner = trigram_sums(words, self.p["char"])
        return np.concatenate([self.p["word"][ids], chars], 1), ids, code, owner

    def gates(self, x: np.ndarray) -> np.ndarray:
        """What a word adds to the gates of both directions: (words, 2, 3 hidden)."""
        return (np.einsum("nd,kdh->nkh", x, self.p["w"], optimize=True) + self.p["bias"][:, 0]).astype(self.p["w"].dtype)

    def forward(self, g: np.ndarray, size: np.ndarray, keep: bool = False):
        """Logits of windows; g: (windows, WINDOW, 2, 3 hidden), size: words in each."""
        b, t, h, u = len(g), g.shape[1], self.h, self.p["u"]
        live = (np.arange(t) < size[:, None]).astype(g.dtype)
        state, states, kept = np.zeros((2, b, h), g.dtype), np.empty((2, t, b, h), g.dtype), []
        for i in range(t):
            j = t - 1 - i
            gi = np.stack([g[:, i, 0], g[:, j, 1]])
            m = np.stack([live[:, i], live[:, j]])[:, :, None]
            hu = state @ u
            zr = 0.5 + 0.5 * np.tanh(0.5 * (gi[:, :, : 2 * h] + hu[:, :, : 2 * h]))
            z, r = zr[:, :, :h], zr[:, :, h:]
            new = np.tanh(gi[:, :, 2 * h :] + r * hu[:, :, 2 * h :])
            if keep:
                kept.append((state, m, z, r, new, hu[:, :, 2 * h :]))
            state = state + m * (1 - z) * (new - state)
            states[0, i], states[1, j] = state[0], state[1]
        both = np.concatenate([states[0], states[1]], 2)  # (time, windows, 2 hidden)
        a = both @ self.p["attend"] - 30 * (1 - live.T)
        a = np.exp(a - a.max(0))
        a /= a.sum(0)
        pooled = np.einsum("tb,tbh->bh", a, both, optimize=True)
        logit = pooled @ self.p["out"] + self.p["off"]
        return (logit, (both, a, pooled, kept)) if keep else logit

    def gradients(self, words: list[bytes], at: np.ndarray, size: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        """Of the windows' mean logistic loss, by parameter; at: (windows, WINDOW) places in words."""
        x, ids, code, owner = self.inputs(words)
        gate = self.gates(x)
        logit, (both, a, pooled, kept) = self.forward(gate[at], size, keep=True)
        b, t, h, p = len(at), at.shape[1], self.h, self.p
        d = (1 / (1 + np.exp(-logit)) - label) / b
        grad = {"out": pooled.T @ d, "off": d.sum(keepdims=True)}
        dp = d[:, None] * p["out"]
        da = np.einsum("bh,tbh->tb", dp, both, optimize=True)
        ds = a * (da - (a * da).sum(0))
        grad["attend"] = np.einsum("tb,tbh->h", ds, both, optimize=True)
        dboth = a[:, :, None] * dp + ds[:, :, None] * p["attend"]
        dg, du, dstate = np.zeros((b, t, 2, 3 * h), gate.dtype), np.zeros_like(p["u"]), np.zeros((2, b, h), gate.dtype)
        for i in range(t - 1, -1, -1):
            j = t - 1 - i
            state, m, z, r, new, hn = kept[i]
            dstate = dstate + np.stack([dboth[i, :, :h], dboth[j, :, h:]])
            dnew = dstate * m * (1 - z) * (1 - new * new)
            dz = dstate * m * (state - new) * z * (1 - z)
            dr = dnew * hn * r * (1 - r)
            dhu = np.concatenate([dz, dr, dnew * r], 2)
            du += np.swapaxes(state, 1, 2) @ dhu
            dgi = np.concatenate([dz, dr, dnew], 2)
            dg[:, i, 0], dg[:, j, 1] = dgi[0], dgi[1]
            dstate = dstate * (1 - m * (1 - z)) + dhu @ np.swapaxes(p["u"], 1, 2)
        grad["u"] = du
        flat = summed(len(words), at.reshape(-1), dg.reshape(b * t, -1)).reshape(len(words), 2, 3 * h)
        grad["w"], grad["bias"] = np.einsum("nd,nkh->kdh", x, flat, optimize=True), flat.sum(0)[:, None]
        dx = np.einsum("nkh,kdh->nd", flat, p["w"], optimize=True)
        grad["word"] = summed(len(p["word"]), ids, dx[:, : self.dim])
        grad["char"] = summed(len(p["char"]), code, (dx[:, self.dim :] / np.bincount(owner, minlength=len(words)).astype(gate.dtype)[:, None])[owner])
        return grad

    def learn(self, words: list[bytes], at: np.ndarray, size: np.ndarray, label: np.ndarray, rate: float = 0.01) -> None:
        """One step of Adam."""
        p = self.p
        self.steps += 1
        for k, g in self.gradients(words, at, size, label).items():
            m1, m2 = self.moments[k]
            m1 += 0.1 * (g - m1)
            m2 += 0.01 * (g * g - m2)
            p[k] -= (rate * m1 / (1 - 0.9**self.steps) / (np.sqrt(m2 / (1 - 0.99**self.steps)) + 1e-8)).astype(np.float32)


def _index(windows: list[list[bytes]]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, each window's places among them (0 where it has ended), and its size."""
    known: dict[bytes, int] = {}
    at = np.zeros((len(windows), WINDOW), np.int64)
    for row, w in zip(at, windows, strict=True):
        row[: len(w)] = [known.setdefault(x, len(known)) for x in w]
    return list(known), at, np.array([len(w) for w in windows], np.int64)


def train(windows: list[list[list[bytes]]], labels: np.ndarray, steps: int = 160, batch: int = 256, least_documents: int = 5, drop: float = 0.25, seed: int = 0) -> Network | None:
    """A network from documents' windows and labels; None unless both labels occur.

    Only some windows of a toxic document are toxic. Each round teaches from the toxic documents'
    windows that score highest so far, repeated to a third of the others' number, and from the highest
    and some other windows of clean ones; they are ranked by their words' log-odds at first, and anew
    after 20 batches or more. Rounds go on until `steps` batches are taught, whatever the number of
    documents. A share `drop` of the words is taught by their letters alone. A logistic fit on
    the documents' highest logits then turns these into probabilities, with even weight for both labels.
    """
    docs = windows
    if not len(labels) or labels.min() == labels.max():
        return None
    r = np.random.default_rng(seed)
    in_docs: tuple[dict, dict] = ({}, {})
    for d, y in zip(docs, labels, strict=True):
        for w in {x for win in d for x in win}:
            in_docs[y][w] = in_docs[y].get(w, 0) + 1
    n0, n1 = (labels == 0).sum(), (labels == 1).sum()
    odds = {w: np.log((in_docs[1].get(w, 0) + 0.5) / (n1 + 1)) - np.log((in_docs[0].get(w, 0) + 0.5) / (n0 + 1)) for w in in_docs[0].keys() | in_docs[1].keys()}
    frequent = sorted(w for w in odds if in_docs[0].get(w, 0) + in_docs[1].get(w, 0) >= least_documents)
    net = Network({w: i + 1 for i, w in enumerate(frequent)})
    flat = [w for d in docs for w in d]
    words, at, size = _index(flat)
    first = np.cumsum([0, *map(len, docs)])
    known = np.array([odds[w] if w in net.vocabulary else 0.0 for w in words])
    rank = np.where(np.arange(WINDOW) < size[:, None], known[at], -9.0).max(1)
    ranked = 0
    while net.steps < steps:
        if net.steps >= ranked + 20:
            rank, ranked = _logits(net, words, at, size), net.steps
        chosen: tuple[list, list] = ([], [])
        for k, y in enumerate(labels):
            own = np.arange(first[k], first[k + 1])
            top = own[np.argsort(-rank[own], kind="stable")[:2]]
            chosen[y].append(top if y else np.concatenate([top, r.choice(own, min(3, len(own)), replace=False)]))
        clean, toxic = map(np.concatenate, chosen)
        toxic = np.tile(toxic, max(1, round(len(clean) / (3 * len(toxic)))))
        both, target = np.concatenate([clean, toxic]), np.repeat(np.float32([0, 1]), [len(clean), len(toxic)])
        order = r.permutation(len(both))
        for a in range(0, len(order), batch):
            part = order[a : a + batch]
            used, where = np.unique(at[both[part]], return_inverse=True)
            # now and then a word has its letters only, as unknown words do
            own = [words[i] for i in used]
            hidden, vocabulary = {w for w, x in zip(own, r.random(len(own)), strict=True) if x < drop}, net.vocabulary
            net.vocabulary = {w: k for w in own if w not in hidden and (k := vocabulary.get(w))}
            net.learn(own, where.reshape(len(part), WINDOW), size[both[part]], target[part], 0.02 if net.steps < 0.6 * steps else 0.005)
            net.vocabulary = vocabulary
    rank = _logits(net, words, at, size)
    best = np.maximum.reduceat(rank, first[:-1])
    weight = np.where(labels == 1, 0.5 / n1, 0.5 / n0)
    x = np.stack([best, np.ones(len(best))], 1)
    c = np.array([1.0, 0.0])
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        hess = (x * (weight * (q * (1 - q) + 1e-4))[:, None]).T @ x + 1e-3 * np.eye(2)
        c -= np.clip(np.linalg.solve(hess, x.T @ (weight * (q - labels)) + 1e-3 * (c - [1, 0])), -2, 2)
    net.scale, net.shift = float(max(c[0], 0.05)), float(c[1])
    return net


def _logits(net: Network, words: list[bytes], at: np.ndarray, size: np.ndarray, block: int = 2048) -> np.ndarray:
    gate = net.gates(net.inputs(words)[0]) if words else np.zeros((1, 2, 3 * net.h), np.float32)
    return np.concatenate([net.forward(gate[at[i : i + block]], size[i : i + block]) for i in range(0, len(at), block)])


class Scorer:
    """A network with the gate inputs of the words met so far."""

    def __init__(self, net: Network, cache_words: int = 150_000):
        self.net, self.most = net, cache_words
        self.reset()

    def reset(self) -> None:
        self.known: dict[bytes, int] = {}
        self.gate = np.zeros((1024, 2, 3 * self.net.h), np.float32)

    def _admit(self, missing: list[bytes]) -> None:
        if len(self.known) + len(missing) > self.most:
            self.reset()
        n = len(self.known)
        if n + len(missing) > len(self.gate):
            self.gate = np.concatenate([self.gate, np.zeros((n + len(missing), *self.gate.shape[1:]), np.float32)])
        for a in range(0, len(missing), 20_000):
            part = missing[a : a + 20_000]
            self.gate[n + a : n + a + len(part)] = self.net.gates(self.net.inputs(part)[0])
        self.known.update(zip(missing, range(n, n + len(missing)), strict=True))

    def score(self, whole: list[str]) -> np.ndarray:
        """Each text's probability: its windows' highest logit, calibrated; the chance level without words."""
        docs = [words_of(t) for t in whole]
        distinct = set().union(*docs)
        missing = [w for w in distinct if w not in self.known]
        if len(self.known) + len(missing) > self.most:
            self.reset()
            missing = list(distinct)
        if missing:
            self._admit(missing)
        look, best = self.known.__getitem__, np.full(len(docs), -np.inf)
        at, size, owner = [], [], []
        for k, d in enumerate(docs):
            if d:
                ids = np.zeros(len(d) + WINDOW, np.int32)
                ids[: len(d)] = list(map(look, d))
                starts = np.arange(0, window_starts(len(d))[-1] + 1, STRIDE)
                at.append(np.lib.stride_tricks.sliding_window_view(ids, WINDOW)[starts])
                size.append(np.minimum(WINDOW, len(d) - starts))
                owner.append(np.full(len(starts), k))
        if at:
            at, size, owner = map(np.concatenate, (at, size, owner))
            for i in range(0, len(at), 2048):
                np.maximum.at(best, owner[i : i + 2048], self.net.forward(self.gate[at[i : i + 2048]], size[i : i + 2048]))
        z = np.where(np.isfinite(best), self.net.scale * best + self.net.shift, -4.0)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, label_col: str, usable, id_col: str = "doc_id", text_col: str = "text", per_class: int = 800, per_document: int = 1024) -> Network | None:
    """A network fitted on at most per_class labelled documents of each class, one row each (labelled_texts()).

    A document gives all its windows, or if it has over per_document those of the lowest hashes, drawn
    in the tasks from its whole text; so what the driver holds is bounded by per_class and per_document. None unless
    both labels occur. Texts without words teach nothing. Other columns are not read.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in grouped(batches):
            out = []
            for t in texts(b):
                w = words_of(t)
                own = [b" ".join(w[s : s + WINDOW]) for s in window_starts(len(w))] if w else []
                out.append(own if len(own) <= per_document else sorted(own, key=xxhash.xxh64_intdigest)[:per_document])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.list_(pa.binary()))], names=["id", "label", "windows"])

    own = labelled_texts(docs, labels, label_col, usable, per_class, id_col, text_col)
    got = own.mapInArrow(cut, f"id {docs.schema[id_col].dataType.simpleString()}, label int, windows array<binary>").toPandas().sort_values(["id", "label"], kind="stable")
    got = got[got["windows"].map(len) > 0]
    return train([[bytes(w).split() for w in ws] for ws in got["windows"]], got["label"].to_numpy())


def toxicity_scores(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of each whole text, over all its overlapping windows.

    The broadcast network is bounded by its vocabulary, of the labelled rows it was fitted on. Null
    texts and texts without words get a low fixed score; without a network all score 0. Repeated rows
    score alike; null ids stay null; other columns are not read. No rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value) if shared.value else None
        for b in grouped(batches, 1_000_000):
            s = scorer.score(texts(b)) if scorer else np.zeros(b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.asarray(s, float), pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, score double")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = crc_mod(F.col("doc_id"), 5) == 0
    net = fit(docs, table(spark, sf_dir, "labels"), "toxic", ~held)
    return toxicity_scores(docs, net).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
