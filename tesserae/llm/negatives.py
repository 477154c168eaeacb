"""Hard negatives: pairs of anchors and rows, mined by a secondary-sort shuffle over packed keys."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm.common import table
from tesserae.plans.materialize import materialize, release

#: Rows in a block, anchors in a block, and blocks of anchors that one round collects and broadcasts: with vectors of 64 numbers 34 MB, however large the table.
ROWS, ANCHORS, ROUND = 4096, 512, 128
#: An anchor's places in lists of entries, one for each of its positives' windows.
PLACES = 1 << 10
_SIGN = 1 << 63


def pack_key(anchor: int, score: int, negative: bool, other: int) -> bytes:
    """Bytes in the order of (anchor, descending score, positives first, id), for signed 64-bit numbers."""
    return struct.pack(">QQ?Q", anchor + _SIGN, _SIGN - 1 - score, negative, other + _SIGN)


def unpack_key(key: bytes) -> tuple[int, int, bool, int]:
    anchor, score, negative, other = struct.unpack(">QQ?Q", key)
    return anchor - _SIGN, _SIGN - 1 - score, negative, other - _SIGN


def _packed(owner: np.ndarray, score: np.ndarray, negative: bool, other: np.ndarray) -> pa.Array:
    """pack_key() of whole arrays."""
    out = np.zeros(len(owner), [("a", ">u8"), ("s", ">u8"), ("n", "u1"), ("o", ">u8")])
    flip = np.uint64(_SIGN)
    out["a"], out["s"], out["n"], out["o"] = owner.astype(np.int64).view(np.uint64) ^ flip, ~(score.astype(np.int64).view(np.uint64) ^ flip), negative, other.astype(np.int64).view(np.uint64) ^ flip
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(out.itemsize), len(out), [None, pa.py_buffer(out.tobytes())]).cast(pa.binary())


def whole_vectors(rows: DataFrame, id_col: str, label: Column, vector_col: str, scale: float = 256) -> DataFrame:
    """(id, label, v): rows that take part, each component as floor(scale * x). A null label, vector or id, and a null or non-finite component leave a row out."""
    x, ok = F.col(vector_col), lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))
    kept = rows.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.transform(x, lambda e: e.cast("double")).alias("x"))
    kept = kept.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()).where(F.forall("x", ok))
    # beyond 64 bits a component is the nearest number that they hold
    whole = F.transform("x", lambda e: F.floor(F.greatest(F.least(e * scale, F.lit(9.2e18)), F.lit(-9.2e18))).cast("long"))
    return kept.select("id", "label", whole.alias("v"))


def blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """(block, rows): rows dealt by the hash of their ids into blocks of about `size`, numbered from 0; rows of one id are in one block."""
    n = -(-rows.count() // size)
    number = F.pmod(F.xxhash64("id"), F.lit(max(n, 1)))
    return materialize(rows.groupBy(number.alias("block")).agg(F.collect_list(F.struct("id", "label", "v")).alias("rows")), name)


def _arrays(rows: pa.StructScalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, labels and vectors of a block, by id; short vectors end in zeros. Of rows that share an id, the one of the least (label, vector)."""
    own = rows.values
    ids, labels, v = own.field("id").to_numpy(), own.field("label").to_numpy(), own.field("v")
    size = np.diff(v.offsets.to_numpy())
    flat, width = v.flatten().to_numpy(), int(size.max(initial=0))
    m = np.zeros((len(ids), width), np.int64)
    m[np.arange(width) < size[:, None]] = flat
    order = np.argsort(ids, kind="stable")
    if len(ids) and (ids[order][1:] == ids[order][:-1]).any():
        order = np.lexsort((*m.T[::-1], labels, ids))
        order = order[np.append(True, ids[order][1:] != ids[order][:-1])]
    return ids[order], labels[order], m[order]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of a and b: by doubles where these are exact, else by 64-bit integers, which wrap."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(width, 1)
    if most < 2.0**52:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    return a @ b.T


def first_of_each(owner: np.ndarray, score: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each owner's first `most` entries by descending score, then id; entries given twice count once."""
    order = np.lexsort((ids, -score, owner))
    owner, score, ids = owner[order], score[order], ids[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (score[1:] != score[:-1]) | (ids[1:] != ids[:-1])
    owner, score, ids = owner[new], score[new], ids[new]
    start = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])[: len(owner)])
    place = np.arange(len(owner)) - np.repeat(start, np.diff(np.append(start, len(owner))))
    return owner[place < most], score[place < most], ids[place < most]


def _best(scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a block's scores (rows, anchors): (anchor, score, id) of each anchor's first `most` allowed rows."""
    lowest = np.iinfo(np.int64).min
    s = np.where(allowed, scores, lowest)
    k = max(len(s) - most, 0)
    last = np.partition(s, k, axis=0)[k]
    row, anchor = np.nonzero(allowed & (s >= last))
    return first_of_each(anchor, s[row, anchor], ids[row], most)


def _pairs(row_blocks: DataFrame, anchors: dict[int, tuple], negative: bool, found, most: int) -> DataFrame:
    """(anchor, packed key) of what found(rows, anchors, windows) gives for all blocks of rows and one round's blocks of anchors.

    The round's anchors are broadcast. Each task keeps each anchor's best so far, so a task hands on a
    few rows an anchor, whatever number of blocks it has met.
    """
    shared = row_blocks.sparkSession.sparkContext.broadcast(anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, tuple] = {}
        for b in batches:
            for rows in b.column("rows"):
                own = _arrays(rows)
                for number, (a, windows) in shared.value.items():
                    parts = [kept[number]] if number in kept else []
                    parts.append(found(own, a, windows))
                    kept[number] = first_of_each(*(np.concatenate(x) for x in zip(*parts, strict=True)), most)
        for number, (owner, score, ids) in kept.items():
            anchor = shared.value[number][0][0][owner // PLACES]
            yield pa.RecordBatch.from_arrays([pa.array(anchor, pa.int64()), _packed(anchor, score, negative, ids)], names=["anchor", "key"])

    return row_blocks.select("rows").mapInArrow(run, "anchor long, key binary")


def sorted_by_anchor(keys: DataFrame) -> DataFrame:
    """(anchor, key) dealt by anchor and sorted by packed key within each partition: an anchor's pairs lie together, in order."""
    return keys.repartition("anchor").sortWithinPartitions("key")


def _first_positives(most: int):
    """Keeps the first `most` keys of each anchor, of a stream that is sorted by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, n, last = None, 0, None
        for b in batches:
            out = []
            for key in b.column("key").to_pylist():
                a, score, _, other = unpack_key(key)
                if a != anchor:
                    anchor, n, last = a, 0, None
                if n < most and key != last:
                    n, last = n + 1, key
                    out.append((a, score, other))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (list(zip(*out, strict=True)) or [[], [], []])], names=["anchor", "score", "id"])

    return run


def _streamed(low: int, high: int, most: int):
    """Negatives of each positive, from keys in order: a positive opens a window, which closes when `most` negatives are found or scores fall below it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, last, open_ = None, None, []
        for b in batches:
            out = []
            for key in b.column("key").to_pylist():
                if key == last:
                    continue
                last = key
                a, score, negative, other = unpack_key(key)
                if a != anchor:
                    anchor, open_ = a, []
                if not negative:
                    open_.append([other, score, 0])
                    continue
                live = []
                for w in open_:
                    if 100 * score >= low * w[1]:
                        if 100 * score <= high * w[1]:
                            w[2] += 1
                            out.append((a, w[0], w[2], other, w[1], score))
                        if w[2] < most:
                            live.append(w)
                open_ = live
            cols = list(zip(*out, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if k == 2 else pa.int64()) for k, c in enumerate(cols)], names=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    return run


def hard_negatives(rows: DataFrame, id_col: str, label: Column, vector_col: str, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: float = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the anchors, the rows whose id is divisible by `every`.

    An anchor's positives are its first rows of the same label by descending score, then id; its hard
    negatives for each are the first rows of another label with low..high per cent of that score. Scores
    are inner products of whole vectors. Anchors, in bounded rounds of broadcast blocks, meet all rows
    block by block. First each task keeps every anchor's best rows of its own label; their packed keys
    (anchor, descending score, id) are dealt by anchor and sorted within partitions (the DataFrame form of
    repartitionAndSortWithinPartitions), and a streaming iterator takes the first ones. With their scores known, each task keeps
    for each positive the first rows that its window holds; positives and negatives are sorted together in the same
    way, and an iterator opens the positives' windows and emits the negatives as they come, without
    holding an anchor's rows. Nothing is cut off: what a task drops has enough better rows in that task.

    A null id, label, vector or component and a component that is not finite leave a row out; of rows that
    share an id one counts, that of the least (label, vector). Vectors of unequal length meet
    in their common components. Scores beyond 64 bits wrap. Other columns are not read. No rows give no rows.
    """
    whole = materialize(whole_vectors(rows, id_col, label, vector_col, scale), "mine-rows")
    row_blocks = blocks(whole, ROWS, "mine-row-blocks")
    anchors = blocks(whole.where(F.col("id") % every == 0), ANCHORS, "mine-anchor-blocks").withColumnRenamed("rows", "anchors")
    n = -(-whole.where(F.col("id") % every == 0).count() // ANCHORS)
    release(whole)

    def same(r, a, _):
        owner, score, ids = _best(products(r[2], a[2]), (r[1][:, None] == a[1]) & (r[0][:, None] != a[0]), r[0], positives)
        return owner * PLACES, score, ids

    def within(r, a, windows):
        s, other = products(r[2], a[2]), r[1][:, None] != a[1]
        out = []
        for k in range(positives):
            own = np.array([x[k] if k < len(x) else -1 for x in windows], np.int64)
            # below 0 the window's lower end is above its upper one
            least, most = -(-own * low // 100), own * high // 100
            ok = other & (own >= 0) & (s >= least) & (s <= most)
            if ok.any():
                owner, score, ids = _best(s, ok, r[0], negatives)
                out.append((owner * PLACES + k, score, ids))
        return tuple(map(np.concatenate, zip(*out, strict=True))) if out else (np.zeros(0, np.int64),) * 3

    done = None
    for first in range(0, max(n, 1), ROUND):
        got = anchors.where((F.col("block") >= first) & (F.col("block") < first + ROUND)).toArrow()
        part = {number: (_arrays(a), []) for number, a in zip(got["block"].to_pylist(), got["anchors"], strict=True)}
        found = _pairs(row_blocks, part, False, same, positives)
        best = materialize(sorted_by_anchor(found).mapInArrow(_first_positives(positives), "anchor long, score long, id long"), "mine-positives")
        of: dict[int, list[int]] = {}
        for anchor, score in zip(*(best.select("anchor", "score").toArrow()[c].to_pylist() for c in ("anchor", "score")), strict=True):
            of.setdefault(anchor, []).append(score)
        part = {number: (a, [sorted(of.get(int(x), []), reverse=True) for x in a[0]]) for number, (a, _) in part.items()}
        keys = best.select("anchor", packed_column(F.col("anchor"), F.col("score"), F.col("id")).alias("key")).union(_pairs(row_blocks, part, True, within, negatives))
        out = sorted_by_anchor(keys).mapInArrow(_streamed(low, high, negatives), "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
        done = out if done is None else done.union(out)
    return done


def packed_column(anchor: Column, score: Column, other: Column) -> Column:
    """pack_key() of positives as a column."""
    flip = lambda c: F.unhex(F.lpad(F.hex(c.bitwiseXOR(F.lit(-_SIGN).cast("long"))), 16, "0"))
    return F.concat(flip(anchor), F.unhex(F.lpad(F.hex(F.bitwise_not(score.bitwiseXOR(F.lit(-_SIGN).cast("long")))), 16, "0")), F.unhex(F.lit("00")), flip(other))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), "vec_id", label, "embedding")


OP13_SQL = """
WITH e AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS anchor, b.id AS other, a.label = b.label AS same, list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::BIGINT AS score FROM e a JOIN e b ON a.id % 50 = 0 AND a.id <> b.id),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) AS k FROM s WHERE same) WHERE k <= 5),
n AS (SELECT p.anchor AS anchor_id, p.other AS positive_id, row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY s.score DESC, s.other)::INT AS rank, s.other AS negative_id, p.score AS positive_score, s.score AS negative_score
  FROM p JOIN s ON p.anchor = s.anchor AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT * FROM n WHERE rank <= 3
"""
