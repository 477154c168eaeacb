"""What the operators of this subpackage share."""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space: everything else is part of a word.
WS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_ascii(text: Column) -> Column:
    """A-Z lower-cased and nothing else; texts of one byte a character take the quicker lower()."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def labelled_texts(docs: DataFrame, labels: DataFrame, label_col: str, usable: Column, per_class: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _label, text): at most per_class labelled documents of each class, those of the lowest hashes of their ids, one row each.

    Of rows that share an id the text of the lowest hash counts, chosen by a partial aggregation, so
    that neither the join nor the driver's share grows with an id's rows. A document with both labels takes both; null
    ids match no label.
    """
    rows = labels.where(usable & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")).distinct()
    part = [rows.where(F.col("_label") == v).orderBy(F.xxhash64("_id"), "_id").limit(per_class) for v in (0, 1)]
    chosen = part[0].union(part[1]).withColumn("_id", F.col("_id").try_cast(docs.schema[id_col].dataType))
    own = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(chosen), "_id")
    return own.groupBy("_id", "_label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches of at most `rows` rows, so that Python never holds many texts at once."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """Whole texts of a batch; null counts as empty."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def grouped(batches: Iterator[pa.RecordBatch], chars: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of at most `chars` bytes of text each (one row at least)."""
    for b in slices(batches):
        col = b.column(b.schema.get_field_index("text"))
        if col.nbytes <= chars:
            yield b
        else:
            for i in range(b.num_rows):
                yield b.slice(i, 1)


def _ranges(chars: list[str]) -> str:
    """A regular expression class body of these characters."""
    out, codes = [], sorted(map(ord, chars))
    while codes:
        n = next((i for i in range(1, len(codes)) if codes[i] != codes[0] + i), len(codes))
        out.append(f"\\u{codes[0]:04x}-\\u{codes[n - 1]:04x}")
        codes = codes[n:]
    return "".join(out)


#: Characters whose classes every Unicode version and regular expression library agrees on: below
#: U+0250 (without U+0130, whose lower case is two characters) and common punctuation.
_PLAIN = [chr(c) for c in (*range(0x130), *range(0x131, 0x250), *range(0x2010, 0x2028), *range(0x2030, 0x205F), 0x20AC, 0x2122)]
_L = _ranges([c for c in _PLAIN if unicodedata.category(c)[0] == "L"])
_N = _ranges([c for c in _PLAIN if unicodedata.category(c)[0] == "N"])
_S = r"\t-\r \u0085 "
_NOT_PLAIN = re.compile(f"[^{_ranges(_PLAIN)}]")
#: The two pre-token patterns of the public tokenizers, over plain characters.
BYTE_LEVEL = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+").findall
WORD_LEVEL = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+").findall


def is_plain(text: str) -> bool:
    return text.isascii() or not _NOT_PLAIN.search(text)


def worker_global(name: str, make):
    """One object for each Python worker process, made when first asked for."""
    store = sys.modules[__name__].__dict__.setdefault("_worker", {})
    if name not in store:
        store[name] = make()
    return store[name]
