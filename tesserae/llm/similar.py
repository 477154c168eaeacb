"""Near copies by word similarity with SimHash: deletion-variant signatures of a long fingerprint, an equality join and verification.

64 bits cannot tell texts of similarity 0.8 (15 % of the bits differ, about 10 of 64) from others, so the fingerprint has
2,560 bits. Segments of it are of three places each; a segment with one place deleted is a key of an equality join, as
op5's are with one bit deleted. What meets is verified, by bits first and then on the whole texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import grouped, slices, texts
from tesserae.llm.minhash import _drop, _hashes, overlaps, shared_counts, shingles
from tesserae.operators.graph import connected_components
from tesserae.plans.materialize import materialize, release

WORDS, PLACES = 40, 3
#: Segments whose keys are made, grouped and joined at once; more, if they have no more than so many keys.
ROUND, KEYS = 16, 2_000_000
_STEP = np.arange(1, WORDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
#: The words of a fingerprint that pairs are verified by first.
_SKETCH = [f"s{k}" for k in range(16)]
#: Of the sketch's 1,024 bits 155 differ at similarity 0.8 (standard deviation 11), up to 192 (12) of sets of few shingles, 512 of unlike texts.
_FEW, _FAR_FEW, _FAR = 100, 270, 215


def _spread(h: np.ndarray) -> np.ndarray:
    """WORDS words of hashed bits for each hash."""
    z = h[:, None] + _STEP
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def fingerprint(h: np.ndarray) -> bytes:
    """The SimHash of a set of hashed shingles: a bit is 1 if set in over half of them."""
    ones = np.zeros(64 * WORDS, np.int64)
    for at in range(0, len(h), 255):
        bits = np.unpackbits(_spread(h[at : at + 255]).astype("<u8").view(np.uint8), axis=1, bitorder="little")
        ones += np.add.reduce(bits, 0, dtype=np.uint8)
    return np.packbits(2 * ones > len(h), bitorder="little").tobytes()


def _few(h: np.ndarray) -> list[int]:
    """Keys of their own for sets of four and of five, as four of five leave the least of a fingerprint: the set, or it with one shingle deleted."""
    if len(h) == 4:
        return [int(h.sum().view(np.int64))]
    return (h.sum() - h).view(np.int64).tolist() if len(h) == 5 else []


def signatures(docs: DataFrame, key_col: str, text_col: str = "text", width: int = 5) -> DataFrame:
    """(key, n, fp, s0..s15, few): the number of distinct shingles, the fingerprint of each row's whole text and its first 1,024 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in grouped(batches):
            own = [_hashes(shingles(t, width)) for t in texts(b)]
            fp = [fingerprint(h) for h in own]
            sketch = np.array([np.frombuffer(f[: 8 * len(_SKETCH)], "<i8") for f in fp], np.int64).reshape(-1, len(_SKETCH))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(h) for h in own], pa.int64()), pa.array(fp, pa.binary()), *(pa.array(x) for x in sketch.T.copy()), pa.array([_few(h) for h in own], pa.list_(pa.int64()))], names=["key", "n", "fp", *_SKETCH, "few"])

    return docs.select(F.col(key_col).alias("key"), F.col(text_col).alias("text")).mapInArrow(run, f"key long, n long, fp binary, {', '.join(f'{x} long' for x in _SKETCH)}, few array<long>")


def _widths(bits: int) -> list[int]:
    """The bits of each place of a segment."""
    return [(bits + k) // PLACES for k in range(PLACES)]


def layout(rows: int, least: float = 0.8, miss: float = 1e-4) -> tuple[int, int]:
    """(bits of a segment, segments) for so many rows.

    Keys of two places, two thirds of a segment's bits, tell rows apart: a sixteenth of a row to a key at any number of rows, so that
    what meets by chance, in twos and in threes, grows as the keys do. There are as many segments as leave a pair of similarity `least`
    without a common key with probability `miss`.
    """
    bits = min(54, max(24, math.ceil(1.5 * (math.log2(max(rows, 1)) + 4))))
    x, y, z = ((1 - math.acos(2 * least / (1 + least)) / math.pi) ** w for w in _widths(bits))
    return bits, math.ceil(math.log(miss) / math.log1p(-(x * y + x * z + y * z - 2 * x * y * z)))


def variant_keys(signed: DataFrame, bits: int, first: int, last: int) -> DataFrame:
    """(key, at, bits) of each row: the segments from `first` to before `last` with each of their places deleted."""
    deal, size, widths = np.random.default_rng(42), bits, _widths(bits)
    # places are disjoint until the fingerprint is used up, then dealt anew
    order = np.concatenate([deal.permutation(64 * WORDS) for _ in range(-(-last * size // (64 * WORDS)))])[first * size : last * size]
    at = np.arange(PLACES * first, PLACES * last, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fp = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).reshape(b.num_rows, -1)
            own = np.unpackbits(fp, axis=1, bitorder="little")[:, order].reshape(b.num_rows, last - first, size).astype(np.int64)
            place = [x @ (1 << np.arange(x.shape[2], dtype=np.int64)) for x in np.split(own, np.cumsum(widths)[:-1], axis=2)]
            left = np.stack([place[i] << widths[j] | place[j] for i, j in ((1, 2), (0, 2), (0, 1))], axis=2)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(b.column(0).to_numpy(), len(at))), pa.array(np.tile(at, b.num_rows)), pa.array(left.reshape(-1))], names=["key", "at", "bits"])

    return signed.select("key", "fp").mapInArrow(run, "key long, at long, bits long")


def _near(n_a: Column, n_b: Column, a: list[Column], b: list[Column], least: float) -> Column:
    """Whether sizes and sketches allow the similarity."""
    far = sum((F.bit_count(x.bitwiseXOR(y)) for x, y in zip(a[1:], b[1:], strict=True)), F.bit_count(a[0].bitwiseXOR(b[0])))
    return (F.least(n_a, n_b) >= least * F.greatest(n_a, n_b) - 1e-6) & (far <= F.when(F.least(n_a, n_b) < _FEW, _FAR_FEW).otherwise(_FAR))


def _cols(prefix: str) -> list[Column]:
    return [F.col(f"{prefix}{s}") for s in _SKETCH]


def _members(rows: DataFrame) -> DataFrame:
    """(at, bits, key, size): the rows of buckets of two and more."""
    by = ["at", "bits"]
    # tables are written where the join that follows has to be split by a hot bucket
    buckets = materialize(rows.groupBy(*by).agg(F.count("*").alias("size")).where("size > 1"), "similar-buckets")
    members = materialize(rows.join(buckets.hint("merge"), by).select(*by, "key", "size"), "similar-members")
    release(buckets)
    return members


def _hubs(star: DataFrame) -> DataFrame:
    """(key, n, hub, nhub): for each row of the star one in the middle of its group, the pivot of the most rows among those of the row's own such pivot."""
    ends = star.union(star.select("a", F.col("a").alias("b"), "na", F.col("na").alias("nb")).distinct())
    degree = materialize(star.groupBy("a").agg(F.count("*").alias("degree")), "similar-degree")
    homes = ends.join(degree.hint("merge"), "a").groupBy(F.col("b").alias("key"), F.col("nb").alias("n")).agg(F.max(F.struct("degree", "a", "na")).alias("m"))
    homes = materialize(homes.select("key", "n", F.col("m.a").alias("home"), F.col("m.na").alias("nhome")), "similar-homes")
    above = homes.select(F.col("key").alias("home"), F.col("home").alias("hub"), F.col("nhome").alias("nhub")).hint("merge")
    out = materialize(homes.join(above, "home").select("key", "n", "hub", "nhub"), "similar-hubs")
    _drop(degree, homes)
    return out


def _bounds(keys: DataFrame, hubs: DataFrame, verified: DataFrame, docs: DataFrame, key_col: str, text_col: str, width: int) -> DataFrame:
    """(key, hub, both, common) of those keys that have a hub: the shingles that both have, and those that any of these rows or of their hubs has too."""
    own = materialize(hubs.join(keys.hint("merge"), "key", "left_semi"), "similar-bounded")
    own_and_hubs = own.select("key").union(own.select(F.col("hub").alias("key"))).distinct()
    alone = shared_counts(own_and_hubs, docs, key_col, text_col, width).hint("merge")
    both = verified.select(F.col("a").alias("hub"), F.col("b").alias("key"), "both").hint("merge")
    out = own.join(both, ["hub", "key"], "left").join(alone, "key", "left")
    out = materialize(out.select("key", "hub", F.coalesce("both", "n").alias("both"), (F.col("n") - F.coalesce("alone", F.lit(0))).alias("common")), "similar-bounds")
    release(own)
    return out


def near_copies(docs: DataFrame, key_col: str, text_col: str = "text", width: int = 5, least: float = 0.8) -> DataFrame:
    """(key, component) of each row linked to another; links join rows whose shingles have a similarity of `least` or more.

    Keys are longs, one a row and none null. Rows that share a key of their fingerprints and whose first 1,024 bits
    and sizes allow the similarity are candidates; every link is verified on the whole texts. Keys are made some segments at a
    time (ROUND), so that few lie on disk. In each bucket rows are held against one of it, its pivot: the row with the
    most company in all buckets, which stands in the middle of a group of copies, so that a large group makes few pairs a row.
    A pair is met once, whatever the buckets that it shares. Then come the pairs of a bucket that this has left in different
    components, unless they cannot be similar enough: two texts have no more shingles in common than both have with a
    third, their hub, and beside those than both have with any open text. These bounds are exact, so the components are those of
    all candidate pairs. Null texts count as empty; texts without words are copies of each other. Other columns are not read.
    """
    signed = materialize(signatures(docs, key_col, text_col, width), "similar-signed")
    rows = signed.count()
    (bits, segments), step = layout(rows, least), max(ROUND, KEYS // (PLACES * max(rows, 1)))
    few = signed.select("key", F.lit(-1).cast("long").alias("at"), F.explode("few").alias("bits"))
    parts = []
    for at in range(0, segments, step):
        keys = variant_keys(signed, bits, at, min(at + step, segments))
        parts.append(_members(keys if at else keys.union(few)))
    members, by = parts[0], ["at", "bits"]
    for p in parts[1:]:
        members = members.union(p)
    company = members.groupBy("key").agg(F.sum("size").alias("company"))
    placed = materialize(members.join(company.hint("merge"), "key"), "similar-placed")
    _drop(*parts)
    pivots = materialize(placed.groupBy(*by).agg(F.max(F.struct("company", "key")).alias("m")).select(*by, F.col("m.key").alias("pivot")), "similar-pivots")
    others = materialize(placed.join(pivots.hint("merge"), by).where("key <> pivot").select(*by, "key", "pivot"), "similar-others")
    _drop(placed, pivots)
    own = lambda k: signed.select(F.col("key").alias(k), F.col("n").alias(f"n{k}"), *(F.col(s).alias(f"{k}{s}") for s in _SKETCH)).hint("merge")
    met = others.select(F.col("pivot").alias("a"), F.col("key").alias("b")).distinct().join(own("a"), "a").join(own("b"), "b")
    star = materialize(met.where(_near(F.col("na"), F.col("nb"), _cols("a"), _cols("b"), least)).select("a", "b", "na", "nb"), "similar-near")
    hubs = _hubs(star)
    pairs = materialize(star.union(hubs.where("key <> hub").select(F.col("hub").alias("a"), F.col("key").alias("b"), F.col("nhub").alias("na"), F.col("n").alias("nb"))).distinct(), "similar-held")
    release(star)
    verified, read = overlaps(pairs.select("a", "b"), docs, key_col, text_col, width)
    verified = materialize(verified.join(pairs.hint("merge"), ["a", "b"]), "similar-star")
    _drop(read, pairs)
    similar = F.col("both") / (F.col("na") + F.col("nb") - F.col("both")) >= least
    links = verified.where(similar).select("a", "b")
    # links of a row are dealt together, so that rows of one group are connected in each task and the loop is over few links
    comps = materialize(connected_components(links, "a", "b", near=("b",)), "similar-comps")

    # buckets whose rows, the pivot aside, are still in several components: of a pair one at least is not in the largest
    c = comps.withColumnsRenamed({"node": "key", "component": "c"})
    placed = materialize(others.join(c.hint("merge"), "key", "left").select(*by, "key", F.coalesce("c", "key").alias("c")), "similar-parts")
    release(others)
    counted = placed.groupBy(*by, "c").agg(F.count("*").alias("k"))
    mixed = materialize(counted.groupBy(*by).agg(F.max(F.struct("k", "c")).alias("m"), F.count("*").alias("cs")).where("cs > 1").select(*by, F.col("m.c").alias("largest")), "similar-mixed")
    open_ = materialize(placed.join(mixed.hint("merge"), by).select(*by, "key", "c", "largest"), "similar-open")
    _drop(placed, mixed)
    bounds = _bounds(open_.select("key").distinct(), hubs, verified, docs, key_col, text_col, width)
    known = signed.select("key", "n", *_SKETCH).join(bounds.hint("merge"), "key", "left")
    met = materialize(open_.join(known.hint("merge"), "key"), "similar-met")
    _drop(signed, open_, bounds, hubs)
    held = ("key", "c", "n", "hub", "both", "common", *_SKETCH)
    x = met.where("c <> largest").select(*by, "largest", *(F.col(k).alias(f"x_{k}") for k in held)).alias("x")
    y = met.select(*by, *(F.col(k).alias(f"y_{k}") for k in held)).alias("y")
    # what both have with their hub is known if it is the same one
    most = F.least("x_common", "y_common")
    beside = F.least("x_both", "y_both") + F.least(F.col("x_common") - F.col("x_both"), F.col("y_common") - F.col("y_both"))
    most = F.when(F.col("x_hub") == F.col("y_hub"), F.least(most, beside)).otherwise(most)
    can = F.col("x_common").isNull() | F.col("y_common").isNull() | (most / (F.col("x_n") + F.col("y_n") - most) >= least)
    # of two rows outside the largest component that of the smaller key asks
    asks = (F.col("y_c") == F.col("largest")) | (F.col("x_key") < F.col("y_key"))
    on = (F.col("x.at") == F.col("y.at")) & (F.col("x.bits") == F.col("y.bits")) & (F.col("x_c") != F.col("y_c")) & asks & can & _near(F.col("x_n"), F.col("y_n"), _cols("x_"), _cols("y_"), least)
    more = x.join(y.hint("merge"), on).select(F.col("x_key").alias("a"), F.col("y_key").alias("b"), F.col("x_n").alias("na"), F.col("y_n").alias("nb"))
    more = materialize(more.distinct(), "similar-more")
    release(met)
    if more.isEmpty():
        _drop(verified, more)
        return comps.withColumnRenamed("node", "key")
    found, read = overlaps(more.select("a", "b"), docs, key_col, text_col, width)
    found = materialize(found.join(more.hint("merge"), ["a", "b"]).where(similar).select("a", "b"), "similar-found")
    _drop(read, more, comps)
    out = connected_components(links.union(found), "a", "b", near=("b",)).withColumnRenamed("node", "key")
    _drop(verified, found)
    return out
