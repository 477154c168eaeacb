"""Language-model scores by deleted interpolation of n-gram estimates."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm.common import crc_mod, grouped, table, worker_global
from tesserae.plans.materialize import materialize

_START, _END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_GRAIN = 4  # steps of a factor of two, for the cells that the statistics of the mixture weights are kept by
_GAP = b"\xff"  # between a block's texts; no UTF-8 text has this byte


def _mix(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit of a 64-bit value over the others."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Hasher:
    """XXH64 of words, with those met last kept by."""

    def __init__(self, most: int = 200_000):
        self.known, self.most = {}, most

    def __call__(self, words: list[bytes]) -> np.ndarray:
        missing = set(words).difference(self.known)
        if len(self.known) + len(missing) > self.most:
            self.known, missing = {}, set(words)
        of = xxhash.xxh64_intdigest
        self.known.update((w, of(w, 42)) for w in missing)
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of A-Z lower-cased texts, each as start, words, end; and the number of hashes of each text."""
    split = [t.split() for t in texts]
    n = np.fromiter(map(len, split), np.int64, len(split))
    h = worker_global("hasher", Hasher)([w for own in split for w in own])
    at = np.cumsum(n)
    ends = np.repeat(at, 2)
    marks = np.tile(np.array([_END, _START]), len(n))
    out = np.insert(h, np.concatenate(([0], ends[:-1])), np.concatenate(([_START], marks[:-1])))
    return out, n + 2


def pairs(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """56-bit hashes of each token with the one before it, none across texts."""
    inside = np.ones(len(h), bool)
    inside[np.cumsum(n)[:-1]] = False
    inside[0] = False
    p = _mix(np.concatenate((h[:1], h[:-1])) * np.uint64(0x2545F4914F6CDD1D) + h)
    return p[inside] >> np.uint64(8)


def planes(a: np.ndarray) -> bytes:
    """Unsigned 64-bit values as their byte planes, those above the largest value left out; the first byte is the number of planes."""
    k = (int(a.max(initial=0)).bit_length() + 7) // 8
    return bytes([k]) + np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :k].T).tobytes()


def unplanes(b: bytes, n: int | None = None) -> np.ndarray:
    """The values of planes(); n: how many, needed where all may be 0."""
    k, data = b[0], np.frombuffer(b, np.uint8, offset=1)
    n = len(data) // k if n is None else n
    out = np.zeros((n, 8), np.uint8)
    if k:
        out[:, :k] = data.reshape(k, n).T
    return out.reshape(-1).view("<u8")


def _bounds(bits: int, r: int) -> np.ndarray:
    return np.array([(i << bits) // r for i in range(1, r)], np.uint64)


def _requests(block: int, h: np.ndarray, train: np.ndarray, bits: int, kind: int, r: int) -> Iterator[tuple]:
    """A block's distinct hashes, dealt by range over r groups, with how often each occurs in training texts."""
    keys, where = np.unique(h, return_inverse=True)
    counts = np.bincount(where, weights=train, minlength=len(keys)).astype(np.uint64)
    cuts = [0, *np.searchsorted(keys, _bounds(bits, r)).tolist(), len(keys)]
    for g, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False)):
        if z > a:
            yield kind * r + g, block, z - a, planes(np.diff(keys[a:z], prepend=np.uint64(0))), planes(counts[a:z])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


REQUEST = pa.schema([("group", pa.int32()), ("block", pa.int64()), ("n", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])


def _blocks(block_bytes: int) -> Callable:
    """Neighbouring rows' texts, lower-cased and compressed together: blocks of block_bytes, or of one longer text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        squeeze, ids, held, own, size = zstandard.ZstdCompressor(level=6).compress, [], [], [], 0

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([ids], pa.list_(kind)), pa.array([held], pa.list_(pa.bool_())), pa.array([squeeze(_GAP.join(own))], pa.binary())], names=["block", "doc_ids", "held_out", "texts"])

        for b in grouped(batches):
            kind = b.schema.field(0).type
            for i, h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                t = (t or "").encode().lower()
                if own and size + len(t) > block_bytes:
                    yield made()
                    ids, held, own, size, number = [], [], [], 0, number + 1
                ids.append(i)
                held.append(bool(h))
                own.append(t)
                size += len(t) + 1
        if own:
            yield made()

    return run


def _texts(blob: bytes) -> list[bytes]:
    return zstandard.decompress(blob).split(_GAP)


def _ask(r: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                h, n = tokens(_texts(b.column(2)[i].as_py()))
                block, train = b.column(0)[i].as_py(), 1 - np.array(b.column(1)[i].as_py(), np.int64)
                yield _batch(list(_requests(block, h, np.repeat(train, n), 64, 0, r)), REQUEST)
                yield _batch(list(_requests(block, pairs(h, n), np.repeat(train, n - 1), 56, 1, r)), REQUEST)

    return run


def _answer(t: pa.Table) -> pa.Table:
    """Total training counts of a range of hashes, sent back to each block in its own order.

    firsts is the number of hashes that a block is the first to have in a training text, start marks
    aside: their sum is the number of distinct ones.
    """
    sizes = np.asarray(t["n"])
    keys = np.concatenate([np.cumsum(unplanes(x, n), dtype=np.uint64) for x, n in zip(t["keys"].to_pylist(), sizes, strict=True)])
    counts = np.concatenate([unplanes(x, n) for x, n in zip(t["counts"].to_pylist(), sizes, strict=True)])
    _, where = np.unique(keys, return_inverse=True)
    total = np.bincount(where, weights=counts).astype(np.uint64)[where]
    mine = np.flatnonzero((counts > 0) & (keys != _START))
    owner = np.repeat(np.arange(len(sizes)), sizes)[mine[np.unique(where[mine], return_index=True)[1]]]
    cuts = np.cumsum(sizes)[:-1]
    return pa.table({"group": t["group"], "block": t["block"], "n": t["n"], "totals": pa.array([planes(x) for x in np.split(total, cuts)], pa.binary()), "firsts": pa.array(np.bincount(owner, minlength=len(sizes)), pa.int64())})


STREAMS = "doc_id {id}, held_out boolean, n_tokens long, firsts long, ones binary, twos binary"


def _join(blocks: pa.Table, answers: pa.Table, r: int) -> pa.Table:
    """Each text's tokens with their training counts: of the token (from the start mark on) and of it with the one before."""
    group = np.asarray(answers["group"])
    order = np.argsort(group, kind="stable")
    total = lambda kept: np.concatenate([np.zeros(0, np.uint64), *(unplanes(answers["totals"][i].as_py(), answers["n"][i].as_py()) for i in order[kept].tolist())])
    h, n = tokens(_texts(blocks["texts"][0].as_py()))
    one = total(group[order] < r)[np.unique(h, return_inverse=True)[1]]
    two = total(group[order] >= r)[np.unique(pairs(h, n), return_inverse=True)[1]]
    at = np.concatenate(([0], np.cumsum(n))).tolist()
    ones = [planes(one[a:z]) for a, z in zip(at, at[1:], strict=False)]
    twos = [planes(two[a - i : z - i - 1]) for i, (a, z) in enumerate(zip(at, at[1:], strict=False))]
    firsts = [int(np.asarray(answers["firsts"])[group < r].sum())] + [0] * (len(n) - 1)
    row = blocks.slice(0, 1)
    return pa.table({"doc_id": row["doc_ids"].combine_chunks().flatten(), "held_out": row["held_out"].combine_chunks().flatten(), "n_tokens": pa.array(n - 1, pa.int64()), "firsts": pa.array(firsts, pa.int64()), "ones": pa.array(ones, pa.binary()), "twos": pa.array(twos, pa.binary())})


_CELL = "bucket int, two int, one int, n double, p2 double, c1 double"


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training tokens by cells of context bucket and both estimates without the token itself, with each cell's sums of them; N and V are under bucket -1."""
    for b in batches:
        codes, p2s, c1s, n, v = [], [], [], 0, sum(b.column(2).to_pylist())
        for held, size, ones, twos in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True):
            if held:
                continue
            one, two = unplanes(ones, size + 1).astype(np.float64), unplanes(twos, size).astype(np.float64)
            n += size
            p2, c1 = (two - 1) / np.maximum(one[:-1] - 1, 1), one[1:] - 1
            codes.append((bucket(one[:-1] - 1) << 32) + (_step(p2) << 16) + _step(c1))
            p2s.append(p2)
            c1s.append(c1)
        rows = [(-1, 0, 0, float(n), float(v), 0.0)]
        if codes:
            k, of = np.unique(np.concatenate(codes), return_inverse=True)
            sums = (np.bincount(of, weights=w) for w in (None, np.concatenate(p2s), np.concatenate(c1s)))
            rows += zip((k >> 32).tolist(), (k >> 16 & 65535).tolist(), (k & 65535).tolist(), *(x.astype(float).tolist() for x in sums), strict=True)
        yield _batch(rows, pa.schema([(x.split()[0], pa.int32() if x.endswith("int") else pa.float64()) for x in _CELL.split(", ")]))


def bucket(context: np.ndarray) -> np.ndarray:
    """Contexts' frequencies by powers of two; 0: never seen."""
    return np.where(context > 0, np.log2(np.maximum(context, 1)).astype(np.int64) + 1, 0)


def _step(x: np.ndarray) -> np.ndarray:
    """A positive value on a logarithmic scale of 1 to 65535; 0 for 0."""
    return np.where(x > 0, np.rint(_GRAIN * np.log2(np.maximum(x, 1e-30))).astype(np.int64) + 8192, 0)


def learn_weights(buckets: np.ndarray, p2: np.ndarray, p1: np.ndarray, p0: float, n: np.ndarray, rounds: int = 60) -> np.ndarray:
    """weights[bucket] = (bigram, unigram, uniform), by expectation-maximisation on counts of held-out events.

    Buckets without events take the weights of all others together, without a bigram share.
    """
    w = np.full((int(buckets.max(initial=0)) + 1, 3), 1 / 3)
    p = np.stack([p2, p1, np.full(len(p1), p0)], 1)
    seen = np.bincount(buckets, weights=n, minlength=len(w))
    for _ in range(rounds):
        share = w[buckets] * p
        share *= (n / share.sum(1))[:, None]
        new = np.stack([np.bincount(buckets, weights=share[:, k], minlength=len(w)) for k in range(3)], 1)
        w = np.where(seen[:, None] > 0, new / np.maximum(seen, 1e-300)[:, None], 1 / 3)
    rest = (w * seen[:, None]).sum(0)
    rest = np.array([0, rest[1] + 1e-9, rest[2] + 1e-9])
    w[seen == 0] = rest / rest.sum()
    return w


def score_texts(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 4 << 20) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row.

    The model is a bigram estimate, a unigram estimate and a uniform one over the V known tokens and
    one unknown, mixed by weights that depend on how often the token before occurs (by powers of two).
    Counts are over all rows that are not held out. Each training token's own occurrence is deleted
    from its counts to make it a held-out event; expectation-maximisation on all these events, in
    cells of like estimates that carry their means, gives the weights. log10 probabilities of a text's
    tokens, its end among them, are summed.

    Texts are written in blocks of about block_bytes, which bounds what a task holds. A block asks for
    the counts of its distinct tokens and bigrams: requests are packed by hash range, summed by range,
    and answered in the same order, and each block joins its answers with its texts. Ranges are as many
    as the input's size needs for a range's keys to fit a task. A frequent word costs one entry a
    block, so no task is hot; no table of words is broadcast. Tokens are told apart by XXH64, bigrams by
    56-bit hashes; counts are 64 bits wide and V is counted key by key.

    Null and empty texts are the end token alone. Null ids stay null; repeated rows count as often as
    they occur. Without training rows every token is unknown. Other columns are not read. No rows give none.
    """
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    own = docs.select(F.col(id_col).alias("doc_id"), held_out.alias("held_out"), F.col(text_col).alias("text"))
    r = max(8, 2 * own.rdd.getNumPartitions())
    blocks = materialize(own.mapInArrow(_blocks(block_bytes), f"block long, doc_ids array<{kind}>, held_out array<boolean>, texts binary"), "lm-blocks", compression="none")
    asked = blocks.select("block", "held_out", "texts").mapInArrow(_ask(r), "group int, block long, n long, keys binary, counts binary")
    answers = asked.groupBy("group").applyInArrow(_answer, "group int, block long, n long, totals binary, firsts long")
    streams = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(lambda d, a: _join(d, a, r), STREAMS.format(id=kind))
    streams = materialize(streams, "lm-streams", compression="zstd")

    stats = streams.select("held_out", "n_tokens", "firsts", "ones", "twos").mapInArrow(_statistics, _CELL).groupBy("bucket", "two", "one").agg(*(F.sum(c).alias(c) for c in ("n", "p2", "c1"))).toPandas()
    events = stats[stats.bucket >= 0].sort_values(["bucket", "two", "one"])
    total, distinct = (float(stats[c][stats.bucket == -1].sum()) for c in ("n", "p2"))
    n = events.n.to_numpy()
    w = learn_weights(events.bucket.to_numpy(), events.p2.to_numpy() / n, events.c1.to_numpy() / n / max(1, total - 1), 1 / (distinct + 1), n)
    model = spark.sparkContext.broadcast((w, total, distinct))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, total, distinct = model.value
        for b in batches:
            known, base, out = [], [], []
            for size, ones, twos in zip(b.column(2).to_pylist(), b.column(4).to_pylist(), b.column(5).to_pylist(), strict=True):
                one, two = unplanes(ones, size + 1).astype(np.float64), unplanes(twos, size).astype(np.float64)
                mine = w[np.minimum(bucket(one[:-1]), len(w) - 1)]
                p = mine[:, 0] * two / np.maximum(one[:-1], 1) + mine[:, 1] * one[1:] / max(1, total) + mine[:, 2] / (distinct + 1)
                known.append(int((one[1:] > 0).sum()))
                base.append(float(np.log10((one[1:] + 0.5) / (total + 0.5 * (distinct + 1))).sum()))
                out.append(float(np.log10(np.maximum(p, 1e-300)).sum()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(known, pa.int64()), pa.array([int(total)] * b.num_rows, pa.int64()), pa.array(base, pa.float64()), pa.array(out, pa.float64())], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return streams.mapInArrow(score, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 5) == 1)
