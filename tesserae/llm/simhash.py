"""Near-duplicates by SimHash: deletion-variant signatures, an equality join and verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm.common import grouped, table, texts
from tesserae.operators.graph import connected_components
from tesserae.plans.materialize import materialize


def text_fingerprint(text: str, width: int = 4, chunk: int = 1 << 16) -> int:
    """64-bit SimHash of the text's word shingles, repeats included; 0 without words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = (end - size)[: max(1, len(words) - width + 1)].tolist()
    stop = end[min(width, len(words)) - 1 :].tolist()
    of, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(start), chunk):
        h = np.array([of(joined[a:b], 42) for a, b in zip(start[at : at + chunk], stop[at : at + chunk], strict=True)], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(start), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """(doc_id, fp long) of each row's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in grouped(batches):
            fp = np.array([text_fingerprint(t, width) for t in texts(b)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], names=["doc_id", "fp"])

    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return own.mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, fp long")


def _segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, bits) of the fewest segments of which one differs by one bit at most."""
    n = distance // 2 + 1
    edges = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _mask(first: int, bits: int) -> int:
    m = ((1 << bits) - 1) << first
    return m - (1 << 64) if m >> 63 else m


def variant_keys(fp: Column, distance: int) -> Column:
    """array<struct<segment, wild, bits>>: each segment of the fingerprint with each of its bits deleted."""
    return F.array(*(F.struct(F.lit(s).cast("byte").alias("segment"), F.lit(w).cast("byte").alias("wild"), fp.bitwiseAND(_mask(first, bits) & ~(1 << w) if w < 63 else _mask(first, bits - 1)).alias("bits")) for s, (first, bits) in enumerate(_segments(distance)) for w in range(first, first + bits)))


def _first_match(diff: Column, distance: int) -> Column:
    """The one key under which a pair counts: its first segment with one differing bit at most, and that bit (its first, if none differs), as 64*segment + bit."""
    out = None
    for s, (first, bits) in reversed(list(enumerate(_segments(distance)))):
        part = diff.bitwiseAND(_mask(first, bits))
        # the number of trailing zeros of a single bit
        bit = F.when(part == 0, F.lit(first)).otherwise(F.bit_count(part - 1))
        here = F.bit_count(part) <= 1
        out = F.when(here, 64 * s + bit) if out is None else F.when(here, 64 * s + bit).otherwise(out)
    return out


def linked_pairs(fps: DataFrame, distance: int = 4) -> DataFrame:
    """(a, b): ids of fingerprints (id, fp; distinct fp) with 1 to `distance` differing bits, each pair once.

    Each fingerprint is indexed under its segments with one bit deleted. Two fingerprints within the
    distance agree on such a key; the join takes equal keys, checks the whole distance in the join's
    condition and counts a pair under the first key they share, so no distinct is needed. A key has 20
    or 21 bits beside its place: N fingerprints have N * N / 2^15 candidates by chance, each a
    comparison within the join.
    """
    # dealt by number, as Spark would size tasks by the bytes before each row becomes 64
    fps = fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    keys = fps.select("id", "fp", F.explode(variant_keys(F.col("fp"), distance)).alias("k")).select("id", "fp", F.col("k.bits").alias("bits"), (F.col("k.segment") * F.lit(64) + F.col("k.wild")).alias("at"))
    a = keys.select("bits", "at", F.col("id").alias("a"), F.col("fp").alias("fa"))
    b = keys.select(F.col("bits").alias("bits_"), F.col("at").alias("at_"), F.col("id").alias("b"), F.col("fp").alias("fb"))
    diff = F.col("fa").bitwiseXOR(F.col("fb"))
    on = (F.col("bits") == F.col("bits_")) & (F.col("at") == F.col("at_")) & (F.col("fa") < F.col("fb")) & (F.bit_count(diff) <= distance) & (_first_match(diff, distance) == F.col("at"))
    # merged, as Spark sizes the keys by the rows they are made from and would broadcast 64 times as many
    return a.join(b.hint("merge"), on).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, distance: int = 4) -> DataFrame:
    """(doc_id, fp, component_id, n_links): each row's fingerprint, the smallest id reachable over links and the number of other fingerprints linked to its own.

    Texts are A-Z lower-cased; shingles are `width` words (fewer words: all of them; none: fingerprint
    zero). Rows with one fingerprint are one node, whatever their number, so copies make no pairs.
    Null texts count as empty. A null id takes part and is the component's id only if no other id is
    in it. Repeated rows each get a row. Other columns are not read. No rows give no rows.
    """
    fps = materialize(fingerprints(docs, id_col, text_col, width), "simhash-fp")
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    pairs = materialize(linked_pairs(nodes.select(F.col("fp").alias("id"), "fp"), distance), "simhash-pairs")
    both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = both.groupBy(F.col("a").alias("fp")).agg(F.count("*").alias("n_links"))
    comps = connected_components(pairs, "a", "b").withColumnsRenamed({"node": "fp", "component": "c"})
    rooted = nodes.join(comps, "fp", "left").join(links, "fp", "left").withColumn("c", F.coalesce("c", "fp"))
    # written, so that the join below can be split by a hot component
    ids = materialize(rooted.groupBy("c").agg(F.min("first_id").alias("component_id")), "simhash-ids")
    classes = rooted.join(ids, "c").select("fp", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return fps.join(classes, "fp").select("doc_id", "fp", "component_id", "n_links")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_links")
