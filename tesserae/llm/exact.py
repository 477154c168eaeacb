"""Exact deduplication by a 128-bit content hash, with bytes compared inside groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm.common import fold_ascii, table
from tesserae.plans.materialize import materialize


def content_hash(text: Column) -> Column:
    """128 bits of the text."""
    return F.unhex(F.md5(text.cast("binary")))


def _bit(h: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(h), F.lit(bits))


def marked(hashes: DataFrame, bits: int) -> DataFrame:
    """(bucket, bitmap): one bit for each hash (_h), in maps of 32,768 bits; bits / 8 bytes at most, whatever the number of hashes."""
    at = hashes.select(_bit(F.col("_h"), bits).alias("at"))
    return at.groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bitmap"))


def among(rows: DataFrame, maps: DataFrame, bits: int) -> DataFrame:
    """The rows whose hash (_h) has its bit set, and few others: a broadcast of bounded size."""
    place = F.bitmap_bit_position(_bit(F.col("_h"), bits)).cast("int")
    byte = F.conv(F.hex(F.expr("substring(bitmap, _p div 8 + 1, 1)")), 16, 10).cast("int")
    met = rows.withColumn("_p", place).join(F.broadcast(maps), F.bitmap_bucket_number(_bit(F.col("_h"), bits)) == F.col("bucket"))
    return met.where(byte.bitwiseAND(F.expr("shiftleft(1, _p % 8)")) != 0).select(*rows.columns)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", normalise: Callable[[Column], Column] = fold_ascii, hash_text: Callable[[Column], Column] = content_hash, digest: Callable[[Column], Column] | None = None, filter_bits: int = 1 << 26) -> DataFrame:
    """(doc_id, keep_id, group_size, kept[, digest]) for each row; rows whose normalised texts are equal are a group.

    The row with the smallest id stays (keep="largest": the largest). Texts are hashed once; hashes and
    ids are written, and sizes and ids come from a partial aggregation by hash, without any text. Then
    the texts of groups of two and more are compared, byte for byte, with the text of the row that
    stays: a broadcast bitmap of filter_bits marks the hashes of such groups, so that other texts are not
    shuffled, but for a share of them that is that of the bits set. A hot group's rows are dealt over tasks by
    Spark's handling of skewed joins, as its one text is the other side. Should texts differ under one
    hash, the groups of that hash are made anew by hash and text.

    Null texts count as empty. Ids that are null rank below all others and are kept only in a group
    without another id. Of repeated rows (equal id and text) each is a row of the group, and each with
    the id that stays is marked kept. Other columns are not read. No rows give no rows.
    """
    best = F.max if keep == "largest" else F.min
    text = normalise(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("_t")).select("doc_id", hash_text(F.col("_t")).alias("_h"), "_t")
    extra = [digest(F.col("_t")).alias("digest")] if digest else []
    hashed = materialize(rows.select("doc_id", "_h", *extra), "exact-hashed")
    # written, so that the joins below are between plain exchanges, which Spark can split by a hot hash;
    # groups grow with the corpus, so none of them is broadcast
    shared = materialize(hashed.groupBy("_h").agg(best("doc_id").alias("keep_id"), F.count("*").alias("group_size")).where("group_size > 1"), "exact-shared")
    likely = among(rows, marked(shared, filter_bits), filter_bits)
    members = materialize(likely.join(shared.select("_h", "keep_id").hint("merge"), "_h"), "exact-members")
    stays = materialize(members.where("doc_id <=> keep_id").groupBy("_h").agg(F.min("_t").alias("_kept_t")), "exact-stays")
    differ = members.join(stays.hint("merge"), "_h").where("_t <> _kept_t").select("_h")
    out = ["doc_id", "keep_id", "group_size", F.expr("doc_id <=> keep_id").alias("kept"), *(["digest"] if digest else [])]
    found = hashed.join(shared.hint("merge"), "_h", "left")
    alone = F.col("group_size").isNull()
    plain = found.withColumns({"keep_id": F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")), "group_size": F.coalesce("group_size", F.lit(1).cast("long"))})
    if differ.isEmpty():
        return plain.select(*out)
    bad = materialize(differ.distinct(), "exact-differ")
    again = rows.join(bad, "_h").select("doc_id", "_h", "_t", *extra)
    by_text = again.groupBy("_h", "_t").agg(best("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    return plain.join(bad, "_h", "left_anti").select(*out).union(again.join(by_text, ["_h", "_t"]).select(*out))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_groups(table(spark, sf_dir, "documents"), keep="largest", digest=lambda t: F.sha2(t.cast("binary"), 256))
    return out.withColumnRenamed("digest", "text_sha256")


OP3_SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g USING (t)
"""
