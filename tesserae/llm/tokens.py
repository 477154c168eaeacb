"""Token counts: a broadcast table of frequent pre-token lengths in front of worker caches."""

from __future__ import annotations

import json
import os
from collections import Counter
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm.common import BYTE_LEVEL, grouped, is_plain, slices, table, texts, worker_global


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _special(path: str) -> list[str]:
    with open(path) as f:
        return [t["content"] for t in json.load(f)["added_tokens"]]


def _summary(seen: Counter, kept: int) -> bytes:
    """The `kept` commonest entries, in order of count, then piece."""
    best = sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:kept]
    return zstandard.compress(json.dumps([[p for p, _ in best], [n for _, n in best]]).encode(), 1)


def frequent_lengths(docs: DataFrame, path: str, text_col: str = "text", top: int = 50_000, every: int = 1, kept: int = 50_000) -> dict[str, int]:
    """Token counts of the `top` commonest pre-tokens of docs, of equal counts the first in order.

    Each task counts the pre-tokens of all its rows (of every `every`-th slice of 64, if that is asked for) and hands on one summary, its `kept` commonest, as what is common only decides
    which lengths are at hand. Summaries are folded by 64 tasks, then
    by one: no pre-token is dealt by a shuffle, and a task holds some bounded summaries at a time.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for i, b in enumerate(slices(batches, 64)):
            if i % every == 0:
                for t in texts(b):
                    if is_plain(t):
                        seen.update(BYTE_LEVEL(t))
                if len(seen) > 8 * kept:
                    seen = Counter(dict(seen.most_common(4 * kept)))
        yield pa.RecordBatch.from_arrays([pa.array([_summary(seen, kept)], pa.binary())], names=["summary"])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for x in b.column(0).to_pylist():
                for piece, n in zip(*json.loads(zstandard.decompress(x)), strict=True):
                    seen[piece] += n
                if len(seen) > 8 * kept:
                    seen = Counter(dict(seen.most_common(4 * kept)))
        yield pa.RecordBatch.from_arrays([pa.array([_summary(seen, kept)], pa.binary())], names=["summary"])

    folded = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "summary binary").repartition(64).mapInArrow(fold, "summary binary")
    (one,) = folded.repartition(1).mapInArrow(fold, "summary binary").collect()
    special = _special(path)
    pieces = [p for p in json.loads(zstandard.decompress(one["summary"]))[0][:top] if not any(s in p for s in special)]
    return dict(zip(pieces, map(len, load(path).encode_batch(pieces, add_special_tokens=False)), strict=True))


class Lengths(dict):
    """The table of frequent pre-tokens; others are looked up in the worker's cache, `cold`."""

    def __init__(self, frequent: dict[str, int]):
        super().__init__(frequent)
        self.cold: dict[str, int] = {}

    def __missing__(self, piece: str) -> int:
        return self.cold[piece]


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", cache_entries: int = 300_000) -> DataFrame:
    """(id, n_bytes, n_tokens) of each row's whole text, as the library for `path` counts them.

    A text splits into pre-tokens whose encodings are independent, so its count is a sum of lengths.
    A length comes from the broadcast table of the input's frequent pre-tokens, else from the worker's
    cache; what neither has is encoded together for each batch and cached. No pre-token is shuffled to
    be looked up. A worker's cache starts afresh at cache_entries. Special tokens' strings inside texts
    are one token each, as the library's default has it. Texts with characters on whose class libraries
    may disagree go to the library whole. Null and empty texts have 0 bytes and tokens; repeated rows
    and null ids are counted row by row; other columns are not read. No rows give no rows.
    """
    shared, special = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, text_col)), _special(path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, frequent = worker_global(f"tok {path}", lambda: load(path)), shared.value
        known = Lengths(frequent)
        for b in grouped(batches):
            whole, pieces = texts(b), []
            for t in whole:
                if not is_plain(t) or any(s in t for s in special[1:]):
                    pieces.append(None)
                    continue
                parts = t.split(special[0]) if special else [t]
                own = BYTE_LEVEL(parts[0])
                for part in parts[1:]:
                    own += BYTE_LEVEL(part)
                pieces.append((own, len(parts) - 1))
            rare = set().union(*(p[0] for p in pieces if p)).difference(frequent)
            missing = list(rare.difference(known.cold))
            if len(known.cold) + len(missing) > cache_entries:
                known.cold.clear()
                missing = list(rare)
            known.cold.update(zip(missing, map(len, tok.encode_batch(missing, add_special_tokens=False)), strict=True))
            look = known.__getitem__
            n = [len(tok.encode(t, add_special_tokens=False)) if p is None else p[1] + sum(map(look, p[0])) for t, p in zip(whole, pieces, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(t.encode()) for t in whole], pa.int64()), pa.array(n, pa.int64())], names=[id_col, "n_bytes", "n_tokens"])

    own = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    return own.mapInArrow(count, f"{id_col} {docs.schema[id_col].dataType.simpleString()}, n_bytes long, n_tokens long")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.withColumn("over_limit", F.col("n_tokens") > 1024)
