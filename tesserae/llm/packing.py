"""Cost-balanced packing of documents into sequences of a fixed number of tokens."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm.common import WORD_LEVEL, grouped, is_plain, table, texts, worker_global
from tesserae.llm.tokens import load

#: Columns of a piece after its document's id, which keeps its type.
PIECES = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class WordEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes, by a cache of pre-tokens' ids."""

    def __init__(self, path: str, cache_entries: int = 300_000):
        self.tok, self.known, self.most = load(path), {}, cache_entries
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for entry, i in vocab.items() if entry.endswith("</w>")]] = True

    def _add(self, words: list[str]) -> None:
        """Ids of new pre-tokens: encoded as one text, words apart, and cut after each token that ends a word."""
        ids = np.array(self.tok.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        cuts = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
        if len(cuts) == len(words):
            data = ids.tobytes()
            self.known.update((w, data[a:b]) for w, a, b in zip(words, [0, *cuts], cuts, strict=False))
        else:
            self.known.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(words, self.tok.encode_batch_fast(words, add_special_tokens=False), strict=True))

    def encode(self, whole: list[str]) -> list[bytes]:
        """As the library gives them, without special tokens; texts with unusual characters or special strings go there whole."""
        low = [t.lower() for t in whole]
        pieces = [WORD_LEVEL(x) if is_plain(t) and is_plain(x) and "<|" not in t else None for t, x in zip(whole, low, strict=True)]
        distinct = set().union(*(p for p in pieces if p is not None))
        missing = list(distinct.difference(self.known))
        if len(self.known) + len(missing) > self.most:
            self.known = {}
            missing = list(distinct)
        if missing:
            self._add(missing)
        look = self.known.__getitem__
        return [np.array(self.tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes() if p is None else b"".join(map(look, p)) for t, p in zip(whole, pieces, strict=True)]


def capacities(total: int, most: int) -> np.ndarray:
    """Sequence sizes that hold `total` tokens without padding: full ones, then the powers of two in the rest."""
    rest = total % most
    return np.array([most] * (total // most) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1], np.int64)


def assign(lengths: np.ndarray, most: int, linear: float = 1.0, quadratic: float = 1.0 / 1024) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents packed with even attention cost.

    A piece of n tokens costs linear*n + quadratic*n*n. Documents longer than a sequence fill whole
    sequences first; what is left of each is a piece. Pieces go, longest first, to the sequence of
    the lowest cost so far that has room; those that no longer fit anywhere are cut over the room left.
    """
    out, room = [], capacities(int(lengths.sum()), most)
    start, at = np.zeros(len(lengths), np.int64), 0
    for d in np.nonzero(lengths >= most)[0]:
        for _ in range(int(lengths[d]) // most):
            out.append((int(d), int(start[d]), most, at, 0))
            start[d] += most
            at += 1
    size, left = room.copy(), room.copy()
    left[:at] = 0
    cost, over = np.zeros(len(room)), []
    rest = lengths - start
    for d in np.argsort(-rest, kind="stable"):
        n = int(rest[d])
        if not n:
            break
        fits = left >= n
        if not fits.any():
            over.append((int(d), n))
            continue
        s = int(np.where(fits, cost, np.inf).argmin())
        out.append((int(d), int(start[d]), n, s, int(size[s] - left[s])))
        left[s] -= n
        cost[s] += linear * n + quadratic * n * n
    open_ = [int(s) for s in np.argsort(cost, kind="stable") if left[s]]
    for d, n in over:
        while n:
            s = open_[0]
            k = int(min(n, left[s]))
            out.append((d, int(start[d]), k, s, int(size[s] - left[s])))
            left[s] -= k
            start[d] += k
            n -= k
            if not left[s]:
                open_.pop(0)
    return out


def pack(docs: DataFrame, path: str, most: int = 4096, end_id: int = 2, block_tokens: int = 1 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece: doc_id, start, length, ids (little-endian uint32), doc_tokens, sequence_id, offset.

    Each task tokenizes its rows and packs them in blocks of about block_tokens tokens, so a task
    holds one block and nothing is shuffled. A sequence id is the partition's number and a count in
    it. A document keeps its ids' order; each id lies in one piece. Null and empty texts are the end
    id alone; repeated rows are packed once each; ids are of any type, null ones
    stay null; other columns are not read. No rows give no pieces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc = worker_global(f"words {path}", lambda: WordEncoder(path))
        end, base = np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId() << 33
        ids: list = []
        held: list[bytes] = []
        total, kind = 0, pa.int64()

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal base, ids, held, total
            lengths = np.array([len(x) // 4 for x in held], np.int64)
            pieces = sorted(assign(lengths, most), key=lambda p: p[3:])
            for i in range(0, len(pieces), 4096):
                part = pieces[i : i + 4096]
                d, s, n, q, o = map(list, zip(*part, strict=True))
                arrays = [pa.array([ids[k] for k in d], kind), pa.array(s, pa.int64()), pa.array(n, pa.int64()), pa.array([held[k][4 * a : 4 * (a + b)] for k, a, b in zip(d, s, n, strict=True)], pa.binary()), pa.array(lengths[d], pa.int64()), pa.array([base + x for x in q], pa.int64()), pa.array(o, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
            base += max((p[3] for p in pieces), default=-1) + 1
            ids, held, total = [], [], 0

        for b in grouped(batches):
            kind = b.column(0).type
            for i, x in zip(b.column(0).to_pylist(), enc.encode(texts(b)), strict=True):
                ids.append(i)
                held.append(x + end)
                total += len(x) // 4 + 1
                if total >= block_tokens:
                    yield from flush()
        if held:
            yield from flush()

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, {PIECES}")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
