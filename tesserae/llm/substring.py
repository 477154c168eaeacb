"""Substring dedup: a count-min prefilter over windows of words, then exact groups of those it calls repeated."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm.common import grouped, table, texts
from tesserae.llm.exact import among, marked
from tesserae.plans.materialize import materialize

#: Windows whose cells a task holds before it hands on a partition sketch, and those it combines before the shuffle.
HELD, COMBINED = 1 << 20, 1 << 18
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class Shape(NamedTuple):
    """A sketch: `depth` rows of 2^width cells, cut into slices of 2^slice cells; merged, a bit a cell, so 128 MB, whatever the input."""

    depth: int = 2
    width: int = 29
    slice: int = 24


def words_of(text: str) -> list[bytes]:
    """Runs of characters other than ASCII white space."""
    return text.encode().split()


def window_hashes(words: list[bytes], size: int) -> np.ndarray:
    """(windows, 2): 128 bits of each `size` consecutive words, as two polynomials in the halves of the words' XXH3."""
    h = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), "<u8").reshape(-1, 2).astype(np.uint64)
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros((0, 2), np.uint64)
    out, done = np.zeros((n, 2), np.uint64), 0
    step, width, factor = h, 1, [pow(m, 1, 1 << 64) for m in _ODD]
    # runs of 1, 2, 4, .. words; those in `size` are put together
    while True:
        if size & width:
            scale = np.array([pow(m, done, 1 << 64) for m in _ODD], np.uint64)
            out += step[done : done + n] * scale
            done += width
        if 2 * width > size:
            break
        step = step[:-width] + step[width:] * np.array(factor, np.uint64)
        factor, width = [f * f % (1 << 64) for f in factor], 2 * width
    out ^= out >> np.uint64(29)
    out *= np.uint64(_ODD[1])
    return out ^ (out >> np.uint64(32))


def cells(hashes: np.ndarray, shape: Shape) -> list[np.ndarray]:
    """Each sketch row's cell of each window."""
    return [(hashes[:, k] >> np.uint64(64 - shape.width)).astype(np.uint32) for k in range(shape.depth)]


def _pack(sorted_cells: np.ndarray) -> bytes:
    """Sorted numbers as differences, byte by byte of their places, compressed."""
    d = np.diff(sorted_cells, prepend=np.uint32(0)).astype("<u4")
    return zstandard.compress(d.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    d = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1).T.copy().view("<u4").reshape(-1)
    return np.cumsum(d, dtype=np.uint32)


def partition_sketch(held: list[list[np.ndarray]], shape: Shape) -> Iterator[tuple[int, bytes, bytes]]:
    """(slice, cells met once, cells met more than once) of the windows' cells."""
    per = 1 << (shape.width - shape.slice)
    ends = (np.arange(1, per, dtype=np.uint32) << np.uint32(shape.slice)).astype(np.uint32)
    for k in range(shape.depth):
        c = np.concatenate([h[k] for h in held])
        c.sort()
        first = np.append(True, c[1:] != c[:-1])
        more = np.zeros(len(c), bool)
        more[:-1] = ~first[1:]
        own, again = c[first & ~more], c[first & more]
        parts = [np.split(x & np.uint32((1 << shape.slice) - 1), np.searchsorted(x, ends)) for x in (own, again)]
        for s, (a, b) in enumerate(zip(*parts, strict=True)):
            if len(a) or len(b):
                yield k * per + s, _pack(a), _pack(b)


def repeated_cells(docs: DataFrame, size: int, text_col: str = "text", shape: Shape = Shape()) -> dict[int, bytes]:
    """Bits of the cells that two windows or more fall into, compressed, by slice: partition sketches, merged slice by slice.

    A task sends its sketch as compressed lists of cells, about a byte a window and row. A slice's lists are added up as
    they come, in one array of the slice's size, however many tasks there are. The merged bits,
    depth * 2^width / 8 bytes at most, go to the driver to be broadcast.
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> pa.RecordBatch:
            rows = list(partition_sketch(held, shape)) if held else []
            cols = list(zip(*rows, strict=True)) or [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])], names=["slice", "once", "more"])

        for b in grouped(batches):
            for t in texts(b):
                h = window_hashes(words_of(t), size)
                if len(h):
                    held.append(cells(h, shape))
                    n += len(h)
            if n >= HELD:
                yield flush()
                held, n = [], 0
        yield flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, seen, twice = None, None, None
        squeeze = lambda: pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([zstandard.compress(np.packbits(twice, bitorder="little").tobytes(), 1)], pa.binary())], names=["slice", "bits"])
        for b in batches:
            for s, once, more in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if s != at:
                    if at is not None:
                        yield squeeze()
                    at, seen, twice = s, np.zeros(1 << shape.slice, bool), np.zeros(1 << shape.slice, bool)
                once, more = _unpack(once), _unpack(more)
                twice[once[seen[once]]] = True
                twice[more] = True
                seen[once] = seen[more] = True
        if at is not None:
            yield squeeze()

    pieces = docs.select(F.col(text_col).alias("text")).mapInArrow(sketch, "slice int, once binary, more binary")
    merged = pieces.repartition("slice").sortWithinPartitions("slice").mapInArrow(merge, "slice int, bits binary")
    return {r["slice"]: bytes(r["bits"]) for r in merged.toLocalIterator()}


def laid_out(slices: dict[int, bytes], shape: Shape) -> np.ndarray:
    """All cells' bits in one array."""
    out = np.zeros(shape.depth << (shape.width - 3), np.uint8)
    for s, bits in slices.items():
        out[s << (shape.slice - 3) : (s + 1) << (shape.slice - 3)] = np.frombuffer(zstandard.decompress(bits), np.uint8)
    return out


def estimated_repeated(hashes: np.ndarray, bits: np.ndarray, shape: Shape) -> np.ndarray:
    """Windows whose cells are all met more than once: every repeated one, and some others."""
    out = np.ones(len(hashes), bool)
    for k, c in enumerate(cells(hashes, shape)):
        at = (c >> np.uint32(3)) + np.uint32(k << (shape.width - 3))
        out &= (bits[at] >> (c & np.uint32(7)).astype(np.uint8) & 1).astype(bool)
    return out


def _runs(doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first start, number) of runs of consecutive starts; given in order of document and start."""
    new = np.append(True, (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1))[: len(doc)]
    at = np.flatnonzero(new)
    return doc[at], start[at], np.diff(np.append(at, len(doc)))


_ROW = "h1 long, h2 int, id {kind}, dk long, start int, n int"


def _contenders(bits, size: int, shape: Shape, combined: int):
    """Windows estimated repeated, (h1, h2, id, dk, start, 0), without those that an earlier one in the same batch of documents makes second; the latter as runs (.., start, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, keys, held, total, kind = [], [], [], 0, None
        repeated = laid_out(bits.value, shape)

        def flush() -> Iterator[pa.RecordBatch]:
            doc = np.repeat(np.arange(len(ids), dtype=np.int32), [len(s) for s, _, _ in held])
            start, h1, h2 = (np.concatenate([x[k] for x in held]) for k in range(3))
            held.clear()
            # ids in their order, null last; rows of one id are one document
            rank = {v: k for k, v in enumerate(sorted({i for i in ids if i is not None}))}
            place = np.array([rank.get(i, len(rank)) for i in ids], np.int32)[doc]
            order = np.lexsort((doc, start, place, h2, h1)).astype(np.int32)
            same = np.append(False, (h1[order][1:] == h1[order][:-1]) & (h2[order][1:] == h2[order][:-1]))
            best = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order), dtype=np.int32)))]
            second = (place[order] != place[best]) | (start[order] != start[best])
            stay, go = order[~second], np.sort(order[second])
            del order, same, best, second, place
            d, s, n = _runs(doc[go], start[go])
            own, names = np.array(keys, np.int64), pa.array(ids, kind)
            one = lambda where, a, b, s, n: pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int32()), names.take(pa.array(where)), pa.array(own[where], pa.int64()), pa.array(s, pa.int32()), pa.array(n, pa.int32())], names=["h1", "h2", "id", "dk", "start", "n"])
            for i in range(0, len(stay), 50_000):
                p = stay[i : i + 50_000]
                yield one(doc[p], h1[p], h2[p], start[p], np.zeros(len(p), np.int32))
            for i in range(0, len(d), 50_000):
                p = slice(i, i + 50_000)
                yield one(d[p], own[d[p]], np.zeros(len(d[p]), np.int32), s[p], n[p])

        for b in grouped(batches):
            kind = b.column(0).type
            for i, k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts(b), strict=True):
                h = window_hashes(words_of(t), size)
                at = np.flatnonzero(estimated_repeated(h, repeated, shape))
                if len(at):
                    held.append((at.astype(np.int32), h[at, 0].view(np.int64), (h[at, 1] >> np.uint64(32)).astype(np.uint32).view(np.int32)))
                    ids.append(i)
                    keys.append(k)
                    total += len(at)
                # within a batch, too: a large group of copies is all repeated windows
                if total >= combined:
                    yield from flush()
                    ids, keys, held, total = [], [], [], 0
        if held:
            yield from flush()

    return run


def _seconds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, dk, start, n): runs as they are, and the windows that are not the first of their hash, from rows in order of hash, id and start."""
    last = None
    for b in batches:
        h1, h2, start, n = (b.column(c).to_numpy() for c in ("h1", "h2", "start", "n"))
        ids = b.column("id")
        out = n > 0
        at = np.flatnonzero(~out)
        if len(at):
            # the first row of each hash, the one carried over from the batch before included
            new = np.append(True, (h1[at][1:] != h1[at][:-1]) | (h2[at][1:] != h2[at][:-1]))
            carried = last is not None and last[:2] == (h1[at[0]], h2[at[0]])
            group = np.cumsum(new) - 1
            head = at[np.flatnonzero(new)]
            mine = ids.take(pa.array(at))
            theirs = ids.take(pa.array(head)).take(pa.array(group))
            if carried:
                k = int((group == 0).sum())
                theirs = pa.concat_arrays([pa.array([last[2]] * k, ids.type), theirs.slice(k)])
            begin = start[head][group]
            if carried:
                begin = np.where(group == 0, last[3], begin)
            # null ids are equal to each other
            equal = pc.or_(pc.fill_null(pc.equal(mine, theirs), False), pc.and_(pc.is_null(mine), pc.is_null(theirs)))
            out[at] = ~(equal.to_numpy(zero_copy_only=False) & (start[at] == begin))
            if not (carried and group[-1] == 0):
                last = (h1[head[-1]], h2[head[-1]], ids[int(head[-1])].as_py(), start[head[-1]])
        keep = pa.array(np.flatnonzero(out))
        yield pa.RecordBatch.from_arrays([ids.take(keep), b.column("dk").take(keep), b.column("start").take(keep), pa.array(np.maximum(n[out], 1), pa.int32())], names=["id", "dk", "start", "n"])


def second_windows(docs: DataFrame, size: int = 20, id_col: str = "doc_id", text_col: str = "text", shape: Shape = Shape()) -> DataFrame:
    """(id, dk, start, n): runs of n windows of `size` words whose words also stand earlier: at a smaller id, or earlier in the same document. dk tells apart rows that share an id.

    First every task sketches its windows, and the merged sketch, compressed, is broadcast. Then windows that it estimates
    repeated, which are all repeated ones and few others, are combined within a task, so that a common
    passage sends a row a batch of documents, dealt by hash and sorted within partitions; a stream over
    these names all but the first of each hash. A sketch of fixed size lets more through the more windows there are:
    at 5*10^8 about one single window in three, at 10^10 all, and the exact pass, linear in them, is then a plain shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(repeated_cells(docs, size, text_col, shape))
    kind = docs.schema[id_col].dataType.simpleString()
    own = docs.select(F.col(id_col).alias("id"), _key(id_col, text_col).alias("dk"), F.col(text_col).alias("text"))
    rows = own.mapInArrow(_contenders(shared, size, shape, COMBINED), _ROW.format(kind=kind))
    rows = rows.repartition("h1").sortWithinPartitions("h1", "h2", F.col("id").asc_nulls_last(), "start")
    return materialize(rows.mapInArrow(_seconds, f"id {kind}, dk long, start int, n int"), "substring-seconds")


def _key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col))


def _left(words: list[bytes], starts: list[int], counts: list[int], size: int) -> list[bytes]:
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, np.array(starts, np.int64), 1)
    np.add.at(cover, np.minimum(np.array(starts, np.int64) + np.array(counts, np.int64) + size - 1, len(words)), -1)
    return [w for w, c in zip(words, np.cumsum(cover[:-1]), strict=True) if not c]


def without_repeats(docs: DataFrame, size: int = 20, id_col: str = "doc_id", text_col: str = "text", filter_bits: int = 1 << 26, with_text: bool = True, shape: Shape = Shape()) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, kept]) of each row: words in windows of `size` words that stand earlier are removed; kept is the rest, joined by one space.

    A word is a run of characters other than ASCII white space. Windows are judged on the input, not on what is left. Only texts of
    documents that lose words, told by a bitmap of filter_bits, and few others are shuffled to meet their
    runs. Windows are told apart by 96 bits.

    Null texts count as empty; texts of under `size` words lose none. Rows that share an id are one document:
    of two that hold a window the one with the earlier start keeps it, at equal starts both do; repeated rows come out alike.
    Null ids are one document after all others; ids are of any type with an order. Other columns are not read. No rows give no rows.
    """
    runs = second_windows(docs, size, id_col, text_col, shape)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text

    def out(ids, whole, left) -> pa.RecordBatch:
        rest = [b" ".join(w) for w in left]
        cols = [ids, pa.array(list(map(len, whole)), pa.int64()), pa.array([len(a) - len(b) for a, b in zip(whole, left, strict=True)], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in rest], pa.string())]
        return pa.RecordBatch.from_arrays([*cols, *[pa.array([x.decode() for x in rest], pa.string())] * with_text], names=["doc_id", "n_words", "n_removed", "kept_sha256", *["kept"] * with_text])

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in grouped(batches):
            whole = [words_of(t) for t in texts(b)]
            yield out(b.column(0), whole, whole)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in grouped(batches):
            whole = [words_of(t) for t in texts(b)]
            spans = [x or [] for x in b.column(2).to_pylist()]
            yield out(b.column(0), whole, [_left(w, [s["start"] for s in x], [s["n"] for s in x], size) for w, x in zip(whole, spans, strict=True)])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), _key(id_col, text_col).alias("_h"))
    maps = materialize(marked(runs.select(F.col("dk").alias("_h")), filter_bits), "substring-marks")
    bit = F.bitmap_bucket_number(F.pmod(F.xxhash64("_h"), F.lit(filter_bits)))
    # written, so that the join is between plain exchanges, which Spark can split by a row repeated many times
    lost = materialize(runs.groupBy(F.col("id").alias("of"), "dk").agg(F.collect_set(F.struct("start", "n")).alias("runs")), "substring-lost")
    touched = among(rows, maps, filter_bits).join(lost.hint("merge"), (F.col("_h") == F.col("dk")) & F.col("id").eqNullSafe(F.col("of")), "left")
    rest = rows.join(F.broadcast(maps), bit == F.col("bucket"), "left").where(~_set("_h", filter_bits))
    return touched.select("id", "text", "runs").mapInArrow(cut, schema).union(rest.select("id", "text").mapInArrow(untouched, schema))


def _set(h: str, bits: int) -> Column:
    """Whether the hash has its bit set in the row's bitmap; none has in a missing one."""
    at = F.bitmap_bit_position(F.pmod(F.xxhash64(h), F.lit(bits))).cast("int")
    byte = F.conv(F.hex(F.substring("bitmap", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), at % 8)) != 0, F.lit(False))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"), with_text=False)


OP12_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 19), ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d)),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM late),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, len(w)::BIGINT - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
"""
