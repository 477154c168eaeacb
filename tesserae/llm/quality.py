"""Quality scores by nearest-neighbour voting among labelled latent-semantic vectors."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm.common import crc_mod, grouped, labelled_texts, slices, table, texts

#: Terms of a text: hashed words, hashed runs of three UTF-8 bytes, and three of repetition.
WORDS, TRIPLES = 4096, 4096
TERMS = WORDS + TRIPLES + 3


def terms(text: str) -> np.ndarray:
    """Counts of a whole text's terms: A-Z lower-cased words; byte triples; words equal to the one before, lines and words that repeat earlier ones. Words are told apart by XXH64."""
    data, out = text.encode(), np.zeros(TERMS, np.float32)
    if not data:
        return out
    words, lines = data.lower().split(), [x for x in data.split(b"\n") if x.strip()]
    h = np.fromiter(map(xxhash.xxh64_intdigest, words, itertools.repeat(42)), np.uint64, len(words))
    out[:WORDS] = np.bincount((h % WORDS).astype(np.int64), minlength=WORDS)
    d = np.frombuffer(data, np.uint8).astype(np.uint16)
    # bits 4 to 15 of the product are one of TRIPLES terms
    out[WORDS : WORDS + TRIPLES] = np.bincount((d[:-2] * 961 + d[1:-1] * 31 + d[2:]) * 40503 >> 4, minlength=TRIPLES)
    s = np.sort(h)
    out[-3:] = (h[1:] == h[:-1]).sum(), len(lines) - len(set(lines)), (s[1:] == s[:-1]).sum()
    return out


class LatentSpace:
    """Truncated singular value decomposition of weighted term counts, fitted on few rows."""

    def __init__(self, counts: np.ndarray, dims: int = 48):
        df = (counts > 0).sum(0)
        self.idf = (np.log((1 + len(counts)) / (1 + df)) + 0.2).astype(np.float32)
        x = self.weigh(counts)
        r = np.random.default_rng(0)
        dims = min(dims, *x.shape)
        q = np.linalg.qr(x @ r.standard_normal((x.shape[1], min(dims + 16, *x.shape)), dtype=np.float32))[0]
        for _ in range(3):
            q = np.linalg.qr(x @ np.linalg.qr(x.T @ q)[0])[0]
        _, s, vt = np.linalg.svd(q.T @ x, full_matrices=False)
        # directions are evened out by part, so that rare traits count beside the language's
        self.axes = (vt[:dims].T / np.maximum(s[:dims], 1e-6) ** 0.5).astype(np.float32)

    def weigh(self, counts: np.ndarray) -> np.ndarray:
        """Shares of terms, square-rooted and weighted by rarity, at unit length."""
        x = np.sqrt(counts / np.maximum(counts[:, :WORDS].sum(1, keepdims=True), 1)) * self.idf
        return (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)).astype(np.float32)

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        v = self.weigh(counts) @ self.axes
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)


class NeighbourVote:
    """Labelled vectors; a vote of the k most similar ones, by similarity; of vectors as similar as the k-th the first rows count."""

    def __init__(self, space: LatentSpace, vectors: np.ndarray, labels: np.ndarray, k: int = 15, sharpness: float = 8.0):
        self.space, self.vectors, self.labels, self.k, self.sharpness = space, vectors, labels.astype(np.float32), k, sharpness

    def score(self, counts: np.ndarray, block: int = 256) -> np.ndarray:
        out = np.full(len(counts), 0.5)
        v = self.space.vectors(counts)
        for a in range(0, len(v), block):
            cosine = v[a : a + block] @ self.vectors.T
            k = min(self.k, cosine.shape[1])
            last = np.partition(cosine, cosine.shape[1] - k, axis=1)[:, cosine.shape[1] - k, None]
            near = cosine >= last
            for row in np.flatnonzero(near.sum(1) > k):
                tied = np.flatnonzero(cosine[row] == last[row])
                near[row, tied[k - near[row].sum() :]] = False
            at = np.nonzero(near)[1].reshape(-1, k)
            w = np.maximum(np.take_along_axis(cosine, at, 1), 0) ** self.sharpness
            total = w.sum(1)
            out[a : a + block] = np.where(total > 1e-9, np.clip((w * self.labels[at]).sum(1) / np.maximum(total, 1e-9), 0, 1), self.labels.mean())
        return np.where(counts.any(1), out, self.labels.mean())


def fit(docs: DataFrame, labels: DataFrame, label_col: str, usable, id_col: str = "doc_id", text_col: str = "text", per_class: int = 1200) -> NeighbourVote | None:
    """The vote fitted on at most per_class labelled documents of each class, one row each (labelled_texts()).

    Of each only its terms' counts go to the driver, so what it holds is bounded by per_class and TERMS.
    Labelled rows are in order of their ids, which decides among equals. None if no labelled row can be
    used.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in grouped(batches):
            found = [terms(t) for t in texts(b)]
            at = [np.nonzero(x)[0] for x in found]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([i.astype("<u2").tobytes() for i in at], pa.binary()), pa.array([x[i].astype("<f4").tobytes() for x, i in zip(found, at, strict=True)], pa.binary())], names=["id", "label", "at", "n"])

    own = labelled_texts(docs, labels, label_col, usable, per_class, id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    got = own.mapInArrow(count, f"id {kind}, label int, at binary, n binary").toPandas().sort_values(["id", "label"], kind="stable")
    if not len(got):
        return None
    counts = np.zeros((len(got), TERMS), np.float32)
    for row, at, n in zip(counts, got["at"], got["n"], strict=True):
        row[np.frombuffer(at, "<u2")] = np.frombuffer(n, "<f4")
    space = LatentSpace(counts)
    return NeighbourVote(space, space.vectors(counts), got["label"].to_numpy())


def quality_scores(docs: DataFrame, model: NeighbourVote | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of each whole text: the broadcast labelled vectors' vote, by exact cosines in blocks of rows.

    The broadcast is bounded by per_class vectors a class. Null and empty texts have no vector and
    score the share of label 1 among the labelled vectors; without any labelled row all score 0.5.
    Repeated rows score alike; null ids stay null; other columns are not read. No rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(grouped(batches), 64):
            vote = shared.value
            s = vote.score(np.array([terms(t) for t in texts(b)])) if vote and b.num_rows else np.full(b.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s.astype(float), pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, score double")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = crc_mod(F.col("doc_id"), 4) == 2
    model = fit(docs, table(spark, sf_dir, "labels"), "quality", ~held)
    return quality_scores(docs, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: NeighbourVote | None, threshold: float = 0.7) -> DataFrame:
    """The rows of docs, all columns, whose text scores at least the threshold; without a model all stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(grouped(batches), 64):
            vote = shared.value
            yield b.filter(pa.array(vote.score(np.array([terms(t) for t in texts(b)])) >= threshold)) if vote and b.num_rows else b

    return docs.mapInArrow(run, docs.schema)
