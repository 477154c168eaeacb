"""A corpus pipeline: low quality out, copies out, near-copies out, personal data replaced, the rest packed.

Every stage reads all that the one before it kept. run() writes each stage's rows and reads them again.
All stages but the last return the columns they are given, more than those of documents included, and rows in any
order; a table without rows gives none. Null texts count as empty, and texts are read whole, whatever their length.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm import exact, packing, pii, quality, similar
from tesserae.llm.common import crc_mod
from tesserae.plans.materialize import materialize
from tesserae.plans.session import workers_import


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the neighbour vote scores at 0.7 or more.

    Texts without words score the share of good labels, so they stay if that is 0.7 or more; repeated
    rows stay or go together, whatever their ids. Without usable labels all stay.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels, "quality", crc_mod(F.col("doc_id"), 4) != 2)
    return quality.keep_good(docs, model, 0.7)


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a key of their own, in a column of a name that no other has; written, as a second reading might deal out other keys."""
    name, taken = "_row", {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return materialize(docs.withColumn(name, F.monotonically_increasing_id()), "rows"), name


def _without(rows: DataFrame, key: str, dropped: DataFrame) -> DataFrame:
    """The rows whose key is not among the dropped ones."""
    return rows.join(dropped.select(key).hint("merge"), key, "left_anti").drop(key)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows equal but for the case of A-Z, the one with the largest id, of equal ids one; without an id only if none has one. Other columns do not count; null and empty texts are equal."""
    rows, key = _keyed(docs)
    groups = exact.exact_groups(rows.select(F.struct("doc_id", key).alias("by"), "text"), id_col="by", keep="largest")
    return _without(rows, key, groups.where("not kept").select(f"doc_id.{key}"))


def dissimilar_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 5-word similarities of 0.8 or more, the row with the smallest id, of equal ids one; without an id only if none has one. Texts of under five words are one run; those without words are copies of each other."""
    rows, row = _keyed(docs)
    groups = similar.near_copies(rows, row).join(rows.select(F.col(row).alias("key"), "doc_id").hint("merge"), "key")
    groups = materialize(groups.select("component", F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key").alias("by")), "near-groups")
    # written, so that the join can be split by a hot component
    stays = materialize(groups.groupBy("component").agg(F.min("by").alias("stay")), "near-stays")
    dropped = groups.join(stays.hint("merge"), "component").where("by.key <> stay.key").select(F.col("by.key").alias(row))
    return _without(rows, row, dropped)


def redacted_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced; n_chars is the new text's, null for a null text, which stays null. No row goes; repeated rows are changed alike."""
    out = pii.redact(docs, pii.learn(pii.scan(docs)))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens; null and empty texts are one piece, the end id. Repeated rows and null ids are packed once a row."""
    out = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality", good_documents),
    ("exact_dedup", distinct_documents),
    ("near_dedup", dissimilar_documents),
    ("pii", redacted_documents),
    ("packing", packed_sequences),
]

#: SQL can express neither the vote nor the fingerprints' components; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    workers_import(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
