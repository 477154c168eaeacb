"""Near copies by word similarity: the deletion-variant index of SimHash over a fingerprint of minima instead of bits.

64 bits cannot tell texts of similarity 0.8 (about 10 differing bits) from others, so here a
fingerprint is 48 minima of hashed shingles, of 10 bits each: six to a segment, a segment to a long.
As there, segments with one place deleted are the keys of an equality join; what meets is verified.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import grouped, slices, texts
from tesserae.operators.graph import connected_components
from tesserae.plans.materialize import materialize, release

#: A segment of two texts of similarity 0.8 differs in one place at most with probability 0.655, so one of eight does with 0.9998.
SEGMENTS, PLACES, BITS = 8, 6, 10
_R = np.random.default_rng(42)
_MULTIPLY = _R.integers(0, 1 << 63, SEGMENTS * PLACES, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _R.integers(0, 1 << 63, SEGMENTS * PLACES, np.uint64) * np.uint64(2)
_PLACE = ((1 << BITS) - 1) << (BITS * np.arange(PLACES))
_TOPS = sum(1 << (BITS * (k + 1) - 1) for k in range(PLACES))
_LOWS = ((1 << BITS * PLACES) - 1) ^ _TOPS


def shingles(text: str, width: int = 5) -> set[bytes]:
    """The A-Z lower-cased text's runs of `width` words; fewer words are one run, none the empty run."""
    words = text.encode().lower().split()
    joined, at, start = b" ".join(words), 0, []
    for w in words:
        start.append(at)
        at += len(w) + 1
    if len(words) <= width:
        return {joined}
    return {joined[a : b - 1] for a, b in zip(start, [*start[width:], len(joined) + 1], strict=False)}


def similarity(both: int, a: int, b: int) -> float:
    return both / (a + b - both)


def _hashes(own: set[bytes]) -> np.ndarray:
    of = xxhash.xxh64_intdigest
    return np.fromiter((of(s, 42) for s in own), np.uint64, len(own))


def fingerprint(own: set[bytes], chunk: int = 4096) -> list[int]:
    """The segments of a set of shingles."""
    h, low = _hashes(own), np.full(SEGMENTS * PLACES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(h), chunk):
        low = np.minimum(low, (h[at : at + chunk, None] * _MULTIPLY + _ADD).min(0))
    code = (low >> np.uint64(20)).astype(np.int64) & (1 << BITS) - 1
    return (code.reshape(SEGMENTS, PLACES) << (BITS * np.arange(PLACES))).sum(1).tolist()


def signatures(docs: DataFrame, key_col: str, text_col: str = "text", width: int = 5) -> DataFrame:
    """(key, n, segments): the number of distinct shingles and the fingerprint of each row's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in grouped(batches):
            own = [shingles(t, width) for t in texts(b)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(s) for s in own], pa.int64()), pa.array([fingerprint(s) for s in own], pa.list_(pa.int64()))], names=["key", "n", "segments"])

    return docs.select(F.col(key_col).alias("key"), F.col(text_col).alias("text")).mapInArrow(run, "key long, n long, segments array<long>")


def variant_keys(segments: Column) -> Column:
    """array<struct<at, bits>>: each segment with each of its places deleted."""
    return F.array(*(F.struct(F.lit(PLACES * s + w).cast("byte").alias("at"), segments[s].bitwiseAND(F.lit(((1 << BITS * PLACES) - 1) ^ int(_PLACE[w]))).alias("bits")) for s in range(SEGMENTS) for w in range(PLACES)))


def first_key(a: Column, b: Column) -> Column:
    """The first key (at) that two fingerprints share."""
    out = None
    for s in reversed(range(SEGMENTS)):
        x = a[s].bitwiseXOR(b[s])
        # the top bit of each place that differs
        tops = (x.bitwiseAND(F.lit(_LOWS)) + F.lit(_LOWS)).bitwiseOR(x).bitwiseAND(F.lit(_TOPS))
        place = F.when(tops == 0, 0).otherwise(F.floor(F.bit_count(tops - 1) / BITS))
        here = F.bit_count(tops) <= 1
        out = F.when(here, PLACES * s + place) if out is None else F.when(here, PLACES * s + place).otherwise(out)
    return out


def overlaps(pairs: DataFrame, docs: DataFrame, key_col: str, text_col: str = "text", width: int = 5) -> tuple[DataFrame, DataFrame]:
    """(a, b, both): the number of shingles that the texts of each of pairs (a, b) have in common; and the table that it reads, to be released."""
    wanted = pairs.select(F.col("a").alias("key")).union(pairs.select(F.col("b").alias("key"))).distinct()

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = zstandard.ZstdCompressor(level=3).compress
        for b in grouped(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([small(t.encode()) for t in texts(b)], pa.binary())], names=["key", "blob"])

    own = docs.select(F.col(key_col).alias("key"), F.col(text_col).alias("text")).join(wanted.hint("merge"), "key", "left_semi")
    own = materialize(own.mapInArrow(squeeze, "key long, blob binary"), "minhash-texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, set] = {}

        def known(key: int, blob: bytes) -> set:
            if key not in kept:
                if sum(map(len, kept.values())) > 60_000:
                    kept.clear()
                kept[key] = shingles(zstandard.decompress(blob).decode(), width)
            return kept[key]

        for b in slices(batches):
            rows = zip(*(b.column(i).to_pylist() for i in range(4)), strict=True)
            both = [len(known(x, tx) & known(y, ty)) for x, y, tx, ty in rows]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(both, pa.int64())], names=["a", "b", "both"])

    met = pairs.join(own.select(F.col("key").alias("a"), F.col("blob").alias("ta")).hint("merge"), "a")
    met = met.join(own.select(F.col("key").alias("b"), F.col("blob").alias("tb")).hint("merge"), "b")
    return met.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long, both long"), own


def shared_counts(open_keys: DataFrame, docs: DataFrame, key_col: str, text_col: str = "text", width: int = 5) -> DataFrame:
    """(key, alone): how many shingles of each open text no other open text has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in grouped(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([_hashes(shingles(t, width)).view(np.int64) for t in texts(b)], pa.list_(pa.int64()))], names=["key", "h"])

    own = docs.select(F.col(key_col).alias("key"), F.col(text_col).alias("text")).join(open_keys.hint("merge"), "key", "left_semi")
    each = own.mapInArrow(run, "key long, h array<long>").select("key", F.explode("h").alias("h"))
    single = each.groupBy("h").agg(F.count("*").alias("k"), F.min("key").alias("key")).where("k = 1")
    return single.groupBy("key").agg(F.count("*").alias("alone"))


def near_copies(docs: DataFrame, key_col: str, text_col: str = "text", width: int = 5, least: float = 0.8) -> DataFrame:
    """(key, component) of each row linked to another; links join rows whose shingles have a similarity of `least` or more.

    Keys are longs, one a row and none null. Rows that share a key of their fingerprints are candidates;
    every link is verified on the whole texts. First each bucket's rows are held against one of it, its
    pivot: the row with the most company in all its buckets, which stands in the middle of a group of
    copies, so that a large group makes one pair a row. Then come the pairs of a bucket that this has left in
    different components, each under the first key that the two share, unless they cannot be similar
    enough: two texts have no more shingles in common than both have with their pivot, and beside
    those than both have with any open text. These bounds are exact, so the components are those of all
    candidate pairs. Null texts count as empty; texts without words are copies of each other. Other
    columns are not read.
    """
    signed = materialize(signatures(docs, key_col, text_col, width), "minhash-signed")
    rows = signed.select("key", F.explode(variant_keys(F.col("segments"))).alias("k")).select("key", "k.at", "k.bits")
    by = ["at", "bits"]
    # tables are written where the join that follows has to be split by a hot bucket
    buckets = materialize(rows.groupBy(*by).agg(F.count("*").alias("size")).where("size > 1"), "minhash-buckets")
    members = materialize(rows.join(buckets.hint("merge"), by), "minhash-members")
    company = members.groupBy("key").agg(F.sum("size").alias("company"))
    placed = materialize(members.join(company.hint("merge"), "key").select("key", *by, "company"), "minhash-placed")
    _drop(buckets, members)
    pivots = materialize(placed.groupBy(*by).agg(F.max(F.struct("company", "key")).alias("m")).select(*by, F.col("m.key").alias("pivot")), "minhash-pivots")
    others = materialize(placed.join(pivots.hint("merge"), by).where("key <> pivot").select("key", *by, "pivot"), "minhash-others")
    _drop(placed, pivots)
    star, read = overlaps(others.select(F.col("pivot").alias("a"), F.col("key").alias("b")).distinct(), docs, key_col, text_col, width)
    sizes = lambda k: signed.select(F.col("key").alias(k), F.col("n").alias(f"n{k}")).hint("merge")
    star = materialize(star.join(sizes("a"), "a").join(sizes("b"), "b"), "minhash-star")
    release(read)
    similar = F.col("both") / (F.col("na") + F.col("nb") - F.col("both")) >= least
    links = star.where(similar).select("a", "b")
    comps = materialize(connected_components(links, "a", "b"), "minhash-comps")

    # buckets whose rows, the pivot aside, are still in several components
    c = comps.withColumnsRenamed({"node": "key", "component": "c"})
    placed = materialize(others.join(c.hint("merge"), "key", "left").withColumn("c", F.coalesce("c", "key")), "minhash-parts")
    release(others)
    mixed = materialize(placed.groupBy(*by).agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select(*by), "minhash-mixed")
    if mixed.isEmpty():
        _drop(signed, star, placed, mixed)
        return comps.withColumnRenamed("node", "key")
    met = star.select(F.col("a").alias("pivot"), F.col("b").alias("key"), F.col("nb").alias("n"), "both")
    open_ = materialize(placed.join(mixed.hint("merge"), by).join(met.hint("merge"), ["pivot", "key"]), "minhash-open")
    _drop(placed, mixed)
    keys = materialize(open_.select("key").union(open_.select(F.col("pivot").alias("key"))).distinct(), "minhash-open-keys")
    alone = shared_counts(keys, docs, key_col, text_col, width)
    known = signed.join(keys.hint("merge"), "key", "left_semi").join(alone.hint("merge"), "key", "left").select("key", "segments", F.coalesce("alone", F.lit(0)).alias("alone"))
    every = open_
    open_ = open_.join(known.hint("merge"), "key").withColumn("beside", F.col("n") - F.col("alone") - F.col("both"))
    # no text with this row's shared shingles only could be similar enough
    open_ = materialize(open_.where(F.col("n") - F.col("alone") >= least * F.col("n") - 1e-6), "minhash-open-rows")
    _drop(signed, every, keys)
    # texts of sizes further apart than `least` allows are not met: theirs are bands that do not touch
    band = F.floor(F.log(F.greatest("n", F.lit(1)).cast("double")) / -math.log(least) - 1e-9)
    open_ = open_.withColumn("band", band)
    a, b = (open_.select(*by, "band", *(F.col(x).alias(f"{x}_{s}") for x in ("key", "n", "c", "both", "beside", "segments"))) for s in "ab")
    most = F.least("both_a", "both_b") + F.least("beside_a", "beside_b")
    can = most / (F.col("n_a") + F.col("n_b") - most) >= least
    a = a.withColumn("band", F.explode(F.array(*(F.col("band") + k for k in (-1, 0, 1)))))
    same = [F.col(f"x.{k}") == F.col(f"y.{k}") for k in (*by, "band")]
    on = same[0] & same[1] & same[2] & (F.col("key_a") < F.col("key_b")) & (F.col("c_a") != F.col("c_b")) & can & (first_key(F.col("segments_a"), F.col("segments_b")) == F.col("x.at"))
    more = a.alias("x").join(b.alias("y").hint("merge"), on).select(F.col("key_a").alias("a"), F.col("key_b").alias("b"), "n_a", "n_b")
    more = materialize(more, "minhash-more")
    release(open_)
    if more.isEmpty():
        _drop(star, more)
        return comps.withColumnRenamed("node", "key")
    found, read = overlaps(more.select("a", "b"), docs, key_col, text_col, width)
    found = found.join(more.hint("merge"), ["a", "b"])
    found = materialize(found.where(F.col("both") / (F.col("n_a") + F.col("n_b") - F.col("both")) >= least).select("a", "b"), "minhash-found")
    _drop(read, more, comps)
    out = connected_components(links.union(found), "a", "b").withColumnRenamed("node", "key")
    _drop(star, found)
    return out


def _drop(*tables: DataFrame) -> None:
    for t in tables:
        release(t)
