"""Byte-level BPE by prefix dynamic programming, and its inverse."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import ahocorasick
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm.common import BYTE_LEVEL, grouped, is_plain, table, texts, worker_global


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class PrefixBPE:
    """Encodings by the table of each byte prefix's last token.

    For every prefix of a byte string exactly one token can end its encoding: the one that is
    compatible with the last token of the prefix before it, two tokens being compatible when merging
    their joined bytes gives just the two. So one forward pass fills the table, whatever follows
    cannot change an entry, and an encoding is read backwards from any prefix.
    """

    def __init__(self, ranks: dict[bytes, int], pair_entries: int = 500_000):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the ranks lack a byte")
        self.ranks, self.bytes_of = ranks, {r: t for t, r in ranks.items()}
        self.longest, self.pairs, self.most = max(map(len, ranks)), {}, pair_entries
        self.tokens = ahocorasick.Automaton()  # finds every token that ends at a byte, the longest first
        for t, r in ranks.items():
            self.tokens.add_word(t.decode("latin-1"), (r, len(t)))
        self.tokens.make_automaton()

    def merge(self, data: bytes) -> list[int]:
        """Plain merging, lowest rank first: the definition, used on the bytes of single tokens and pairs."""
        parts, get, never = [data[i : i + 1] for i in range(len(data))], self.ranks.get, 1 << 40
        joint = [get(data[i : i + 2], never) for i in range(len(data) - 1)]
        while joint and (low := min(joint)) < never:
            i = joint.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del joint[i]
            if i:
                joint[i - 1] = get(parts[i - 1] + parts[i], never)
            if i < len(joint):
                joint[i] = get(parts[i] + parts[i + 1], never)
        return [self.ranks[p] for p in parts]

    def fits(self, left: int, right: int) -> bool:
        """Whether right can follow left; with left = -1, whether it can be the first token."""
        key = left << 20 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= self.most:
                self.pairs.clear()
            both = [right] if left < 0 else [left, right]
            known = self.pairs[key] = self.merge(b"".join(map(self.bytes_of.__getitem__, both))) == both
        return known

    def extend(self, data: bytes, last: list[int]) -> list[int]:
        """Fill the table for the prefixes of data that `last` (last[i]: token ending the first i bytes; last[0]: -1) has not."""
        filled, get = len(last), self.pairs.get
        base = max(0, filled - self.longest)
        for end, (token, size) in self.tokens.iter(data[base:].decode("latin-1")):
            end += base + 1
            if end < filled:
                continue
            before = last[end - size]
            known = get(before << 20 | token)
            if self.fits(before, token) if known is None else known:
                last.append(token)
                filled += 1
        return last

    def table(self, data: bytes) -> list[int]:
        return self.extend(data, [-1])

    def append(self, data: bytes, last: list[int], more: bytes) -> tuple[bytes, list[int]]:
        """Exact encoding table of data + more: earlier entries stay as they are."""
        return data + more, self.extend(data + more, last)

    def replace(self, data: bytes, last: list[int], start: int, end: int, new: bytes) -> tuple[bytes, list[int]]:
        """Table after data[start:end] became `new`: entries before the edit stay, and the tail is taken over
        once as many entries in a row as the longest token has bytes are those of the old table."""
        out, shift = data[:start] + new + data[end:], len(new) - (end - start)
        fresh, same = last[: start + 1], 0
        for i in range(start + 1, len(out) + 1):
            # the tokens that can end here begin within the last entries
            low = max(0, len(fresh) - self.longest)
            fresh += self.extend(out[low:i], fresh[low:])[len(fresh) - low :]
            old = i - shift
            same = same + 1 if old > end and fresh[i] == last[old] else 0
            if same >= self.longest:
                return out, fresh + last[old + 1 :]
        return out, fresh

    def read(self, data: bytes, last: list[int]) -> list[int]:
        at, ids = len(data), []
        while at:
            ids.append(last[at])
            at -= len(self.bytes_of[last[at]])
        return ids[::-1]

    def encode_piece(self, data: bytes) -> list[int]:
        """A pre-token's ids; one that is itself in the vocabulary is that id, as the library has it."""
        whole = self.ranks.get(data)
        return [whole] if whole is not None else self.read(data, self.table(data))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def split_pieces(text: str) -> list[str]:
    if is_plain(text):
        return BYTE_LEVEL(text)
    import regex

    return worker_global("pattern", lambda: regex.compile(public_tokenizers.PATTERN)).findall(text)


class _Encoder:
    """Pre-tokens' ids as decimal text, kept in a bounded cache."""

    def __init__(self, path: str, cache_entries: int = 800_000):
        self.bpe, self.known, self.most = PrefixBPE(load_ranks(path)), {}, cache_entries
        self.spelled = {str(r): t for r, t in self.bpe.bytes_of.items()}

    def encode(self, text: str) -> str:
        pieces = split_pieces(text)
        missing = set(pieces).difference(self.known)
        if len(self.known) + len(missing) > self.most:
            self.known = {}
            missing = set(pieces)
        for p in missing:
            self.known[p] = ",".join(map(str, self.bpe.encode_piece(p.encode())))
        return ",".join(map(self.known.__getitem__, pieces))

    def decode(self, ids: str) -> bytes:
        return b"".join(map(self.spelled.__getitem__, ids.split(","))) if ids else b""


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>): each whole text by the ranks of `path`; null and empty texts have no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = worker_global(f"bpe {path}", lambda: _Encoder(path))
        for b in grouped(batches):
            rows = [[int(x) for x in s.split(",")] if (s := enc.encode(t)) else [] for t in texts(b)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, data binary) from (doc_id, ids); the exact inverse of encode(), null ids giving no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker_global(f"bpe {path}", lambda: _Encoder(path)).bpe
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([bpe.decode(x or []) for x in b.column(1).to_pylist()], pa.binary())], names=["doc_id", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, data binary")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) in one pass over the texts: what encode() and then decode() give, as digests.

    Null and empty texts have 0 tokens and the digest of nothing. Texts are read whole, whatever their length; rows are
    independent of each other, so repeated ones come out alike. Null ids stay null, ids are of any type, other columns are
    not read. No rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = worker_global(f"bpe {path}", lambda: _Encoder(path))
        for b in grouped(batches):
            n, a, z = [], [], []
            for t in texts(b):
                ids = enc.encode(t)
                n.append(ids.count(",") + 1 if ids else 0)
                a.append(hashlib.sha256(ids.encode()).hexdigest())
                z.append(hashlib.sha256(enc.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(a), pa.array(z)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return own.mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
