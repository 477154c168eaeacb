"""Alignment of two tokenizers' tokens over the same bytes, by interval coalescing."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm.common import grouped, is_plain, table, texts, worker_global
from tesserae.llm.tokens import load
from tesserae.plans.materialize import materialize

#: Runs of white space across which a tokenizer's tokens may depend on each other; other texts fall into units that are encoded apart.
_JOINED = re.compile("  | \n| \\Z|[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]").search
_UNITS = re.compile(r"\n+(?=\n[^ \n])|\n+| ?[^ \n]+").findall


def _byte_values() -> dict[str, int]:
    """The byte for which each character stands in byte-level vocabularies: printable ones for themselves, the others in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}


class Tokenizers:
    """Both tokenizers; tokens as ids and bytes. A: byte-level, of space + text; B: pieces, of the text, before which it puts a space."""

    def __init__(self, a: str, b: str):
        import sentencepiece
        import tiktoken

        self.a, value = load(a), _byte_values()
        self.a.encode_special_tokens = True
        self.a_bytes = {i: bytes(map(value.__getitem__, t)) for t, i in self.a.get_vocab(False).items()}
        self.b = sentencepiece.SentencePieceProcessor(model_file=b)
        spell = lambda i: bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("\u2581", " ").encode()
        self.b_bytes = [spell(i) for i in range(self.b.get_piece_size())]
        with open(a) as f:
            merges = json.load(f)["model"]["merges"]
        vocab = self.a.get_vocab(False)
        joined = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
        # ranks are merges only if later ones have larger ids
        self.quick = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in self.a_bytes.items()}, special_tokens={}) if joined == sorted(joined) else None
        #: Sizes of the tokens of both sides by id.
        self.sizes = [np.zeros(max(self.a_bytes) + 1, np.int64), np.array(list(map(len, self.b_bytes)), np.int64)]
        for i, x in self.a_bytes.items():
            self.sizes[0][i] = len(x)
        #: Each id as text with a sign after it: of A a comma or a bar, of B a comma, a semicolon or a unit's end.
        self.spelled = [f"{i}{sign}" for k, signs in enumerate((",|", ",;\n")) for sign in signs for i in range(len(self.sizes[k]))]
        # a unit's end ends a piece, as no piece goes from a character to a space or holds a line break
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.apart = self.quick is not None and not any("\n" in p or "\u2581" in p.lstrip("\u2581") for p in pieces)

    def signed(self, side: int, ids: np.ndarray, sign: np.ndarray) -> np.ndarray:
        """Places in `spelled`."""
        return side * 2 * len(self.sizes[0]) + sign * len(self.sizes[side]) + ids

    def split(self, text: str) -> list[str]:
        """Units of space + text: words with the space before them, and line breaks; the whole where units could depend on each other."""
        whole = " " + text
        return [whole] if not self.apart or _JOINED(whole) else _UNITS(whole)

    def encode(self, units: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """Of both sides the ids of all units' tokens, one after the other, and how many each unit has; and which units' bytes a side's tokens do not give, which have none.

        Words with a space in front are encoded as one text, since tokens end where they do, and are told
        apart by their sizes; A's by the quicker library for the same merges, which differs at most on characters
        of unlike classes. Others are given to the tokenizers one by one, to B after a line break, which is then
        taken off.
        """
        size = np.fromiter((len(u.encode()) for u in units), np.int64, len(units))
        alone = np.fromiter((u[0] != " " or len(u) < 2 or "\u2581" in u or not is_plain(u) for u in units), bool, len(units)) if self.apart else np.ones(len(units), bool)
        parts: list[tuple[np.ndarray, list[np.ndarray], list[np.ndarray], np.ndarray]] = []
        words = np.flatnonzero(~alone)
        for k in range(0, len(words), 2000):
            own = words[k : k + 2000]
            text = "".join(units[i] for i in own)
            ids = [np.array(self.quick.encode_ordinary(text), np.int64), np.array(self.b.encode(text[1:]), np.int64)]
            upto, counts = np.cumsum(size[own]), []
            for ids_, spelled, sizes in zip(ids, (self.a_bytes, self.b_bytes), self.sizes, strict=True):
                end = np.cumsum(sizes[ids_])
                at = np.searchsorted(end, upto)
                if b"".join(map(spelled.__getitem__, ids_.tolist())) != text.encode() or (end[np.minimum(at, len(end) - 1)] != upto).any():
                    break
                counts.append(np.diff(at + 1, prepend=0))
            if len(counts) == 2:
                parts.append((own, ids, counts, np.zeros(len(own), bool)))
            else:
                alone[own] = True
        single = np.flatnonzero(alone)
        if len(single):
            own = [units[i] for i in single]
            a = [e.ids for e in self.a.encode_batch(own, add_special_tokens=False)]
            b = self.b.encode([u[1:] if u[0] == " " else "\n" + u for u in own], num_threads=1)
            b = [ids if u[0] == " " else ids[2:] for u, ids in zip(own, b, strict=True)]
            bad = np.array([b"".join(map(self.a_bytes.__getitem__, x)) != u.encode() or b"".join(map(self.b_bytes.__getitem__, y)) != u.encode() for u, x, y in zip(own, a, b, strict=True)], bool)
            sides = [[[] if w else ids for ids, w in zip(side, bad, strict=True)] for side in (a, b)]
            parts.append((single, [np.array([i for x in side for i in x], np.int64) for side in sides], [np.array(list(map(len, side)), np.int64) for side in sides], bad))
        where = np.concatenate([p[0] for p in parts])
        back = np.argsort(where, kind="stable")
        out = []
        for k in range(2):
            ids, n = np.concatenate([p[1][k] for p in parts]), np.concatenate([p[2][k] for p in parts])
            first = np.cumsum(n) - n
            m = n[back]
            out.append((ids[np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(first[back], m)], m))
        return [x[0] for x in out], [x[1] for x in out], np.concatenate([p[3] for p in parts])[back]


def align(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of two sequences of token lengths over the same bytes: the group of each A and each B token, and all pairs (places in A and in B) that overlap.

    Tokens of both sides are sorted by start; a group breaks where a start reaches the furthest end so
    far, which is where both sides have a token's end. Within a group the overlaps of a token are a range of the other side's.
    """
    end = [np.cumsum(a_sizes), np.cumsum(b_sizes)]
    start = [end[0] - a_sizes, end[1] - b_sizes]
    begin, reach, side = np.concatenate(start), np.concatenate(end), np.repeat([0, 1], [len(a_sizes), len(b_sizes)])
    order = np.lexsort((side, begin))
    far = np.maximum.accumulate(reach[order])
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(np.append(True, begin[order][1:] >= far[:-1])[: len(order)]) - 1
    first, last = np.searchsorted(end[1], start[0], "right"), np.searchsorted(start[1], end[0], "left")
    n = last - first
    left = np.repeat(np.arange(len(a_sizes)), n)
    return group[: len(a_sizes)], group[len(a_sizes) :], left, np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)


class Units:
    """What is known of units met so far: tokens, groups and linked pairs; starts afresh at `most` of them."""

    def __init__(self, tok: Tokenizers, most: int = 300_000):
        self.tok, self.most = tok, most
        self.reset()

    def reset(self) -> None:
        self.at: dict[str, int] = {}
        #: Of each unit: A tokens, B tokens, groups, links, 1 if the sides' bytes differ from the unit's.
        self.n = np.zeros((1024, 5), np.int64)
        self.spelled: list[str] = []
        self.first = np.zeros(1025, np.int64)
        self.pairs = np.zeros(4096, np.uint32)

    def _add(self, units: list[str]) -> None:
        ids, count, bad = self.tok.encode(units)
        ga, gb, left, right = align(*(self.tok.sizes[k][ids[k]] for k in range(2)))
        owner = np.repeat(np.arange(len(units)), count[0])
        link = (ids[0][left] << 15 | ids[1][right]).astype(np.uint32)
        n = np.zeros((len(units), 5), np.int64)
        n[:, 0], n[:, 1], n[:, 4] = *count, bad
        n[:, 3] = np.bincount(owner[left], minlength=len(units))
        # a unit's bytes begin and end groups
        starts = np.append(True, ga[1:] != ga[:-1])[: len(ga)]
        n[:, 2] = np.bincount(owner[starts], minlength=len(units))
        # each group's A ids, then its B ids, each id with the sign that follows it
        last = [np.append(g[1:] != g[:-1], True)[: len(g)] for g in (ga, gb)]
        unit_end = np.zeros(len(gb), bool)
        unit_end[np.cumsum(count[1])[count[1] > 0] - 1] = True
        code = np.concatenate([self.tok.signed(0, ids[0], last[0].astype(np.int64)), self.tok.signed(1, ids[1], last[1] + unit_end.astype(np.int64))])
        order = np.lexsort((np.repeat([0, 1], [len(ga), len(gb)]), np.concatenate([ga, gb])))
        spelled = "".join(map(self.tok.spelled.__getitem__, code[order].tolist())).split("\n")[:-1]
        strings = iter(spelled)
        group = [next(strings) if k else "" for k in count[1].tolist()]
        # filled in
        old, new = len(self.at), len(self.at) + len(units)
        while new + 1 >= len(self.n):
            self.n = np.concatenate([self.n, np.zeros_like(self.n)])
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
        used = int(self.first[old])
        while used + len(link) > len(self.pairs):
            self.pairs = np.concatenate([self.pairs, np.zeros_like(self.pairs)])
        self.n[old:new] = n
        self.pairs[used : used + len(link)] = link
        self.first[old + 1 : new + 1] = used + np.cumsum(n[:, 3])
        self.spelled += group
        self.at.update(zip(units, range(old, new), strict=True))

    def places(self, docs: list[list[str]]) -> list[np.ndarray]:
        """Each document's units, as places in the tables; units not met before are encoded together."""
        distinct = set().union(*docs)
        missing = [u for u in distinct if u not in self.at]
        if len(self.at) + len(missing) > self.most:
            self.reset()
            missing = list(distinct)
        if missing:
            self._add(missing)
        look = self.at.__getitem__
        return [np.fromiter(map(look, d), np.int64, len(d)) for d in docs]

    def linked(self, places: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, pair, occurrences) of the distinct linked pairs of each document."""
        doc = np.repeat(np.arange(len(places)), [len(p) for p in places])
        unit, times = np.unique(doc << 32 | np.concatenate([*places, np.zeros(0, np.int64)]), return_counts=True)
        doc, unit = unit >> 32, unit & 0xFFFFFFFF
        bad = np.zeros(len(places), bool)
        bad[doc[self.n[unit, 4] > 0]] = True
        live = ~bad[doc]
        doc, unit, times = doc[live], unit[live], times[live]
        n = self.n[unit, 3]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[unit], n)
        pair, back = np.unique(np.repeat(doc, n) << 32 | self.pairs[at].astype(np.int64), return_inverse=True)
        return pair >> 32, pair & 0xFFFFFFFF, np.bincount(back, weights=np.repeat(times, n), minlength=len(pair)).astype(np.int64)

    def totals(self, places: list[np.ndarray]) -> tuple[np.ndarray, list[str]]:
        """(documents, 4) sums over the documents' units, and the digests of their groups; zeros and '' where a unit's bytes differ."""
        out, digest = np.zeros((len(places), 4), np.int64), []
        for k, p in enumerate(places):
            n = self.n[p].sum(0)
            if not len(p) or n[4]:
                digest.append("")
                continue
            out[k] = n[:4]
            digest.append(hashlib.sha256(";".join(map(self.spelled.__getitem__, p.tolist())).encode()).hexdigest())
        return out, digest


_COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def _units(a: str, b: str, cache: int, counts=None) -> Units:
    return Units(worker_global(f"both {a} {b}", lambda: Tokenizers(a, b)), cache, counts)


_COUNTED = ("n_a", "n_b", "n_groups", "n_links")


def _packed(pair: np.ndarray, times: np.ndarray) -> bytes:
    """A document's pairs, in order, and how often each occurs."""
    return zstandard.compress(np.concatenate([np.diff(pair, prepend=0), times]).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    x = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1).T.copy().view("<u4").reshape(-1).astype(np.int64)
    return np.cumsum(x[: len(x) // 2]), x[len(x) // 2 :]


def tokenized(docs: DataFrame, a: str, b: str, id_col: str = "doc_id", text_col: str = "text", cache: int = 300_000) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, links) of each row's whole text; links: its distinct linked pairs and their numbers of occurrences, packed. A pair is the A id times 2^15 plus the B id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units(worker_global(f"both {a} {b}", lambda: Tokenizers(a, b)), cache)
        for batch in grouped(batches):
            places = units.places([units.tok.split(t) if t else [] for t in texts(batch)])
            n, digest = units.totals(places)
            doc, pair, times = units.linked(places)
            cuts = np.searchsorted(doc, np.arange(len(places) + 1)).tolist()
            links = [_packed(pair[p:q], times[p:q]) for p, q in zip(cuts, cuts[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in n.T), pa.array(digest, pa.string()), pa.array(links, pa.binary())], names=["doc_id", *_COUNTED, "groups_sha256", "links"])

    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return own.mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, " + ", ".join(f"{c} long" for c in _COUNTED) + ", groups_sha256 string, links binary")


def pair_counts(rows: DataFrame, held: int = 1 << 22) -> DataFrame:
    """(pair, n): how many of the rows of tokenized() hold each pair. Tasks add up what they meet, `held` entries at a time, before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, n = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            pair, times = np.unique(np.concatenate(met), return_counts=True)
            for i in range(0, len(pair), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(pair[i : i + 100_000], pa.int64()), pa.array(times[i : i + 100_000], pa.int64())], names=["pair", "n"])

        for b in batches:
            for x in b.column(0).to_pylist():
                met.append(_unpacked(x)[0])
                n += len(met[-1])
                if n >= held:
                    yield from flush()
                    met, n = [], 0
        if met:
            yield from flush()

    return rows.select("links").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def alignments(docs: DataFrame, a: str, b: str, id_col: str = "doc_id", text_col: str = "text", cache: int = 300_000, most_pairs: int = 1 << 23) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each row's whole text.

    A's tokens are of space + text, B's of the text. Texts fall into units, words with the space before
    them and line breaks, that both tokenizers encode apart; a worker aligns a unit once and keeps it in
    its cache. White space of other forms could join units, so such texts are one unit each. Texts are
    tokenized once; each one's linked pairs are written, packed. Their counts of documents are
    broadcast if there are at most most_pairs (140 MB); beyond, each document's pairs meet them by a join.

    Null and empty texts, and those whose A or B tokens' bytes differ from space + text, have zeros and
    ''. Each repeated row counts as a document. Null ids stay null; ids are of any type; other columns are not read. No rows
    give no rows.
    """
    rows = materialize(tokenized(docs, a, b, id_col, text_col, cache).withColumn("row", F.monotonically_increasing_id()), "aligned-rows")
    counts = materialize(pair_counts(rows), "aligned-pairs")
    # at most one row for each id of A
    highest = counts.groupBy(F.shiftright("pair", 15).alias("a")).agg(F.max("n").alias("most"))
    known = counts.withColumn("a", F.shiftright("pair", 15)).join(highest, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    out = ["doc_id", *_COUNTED, "n_best", "count_sum", "groups_sha256"]
    schema = f"row long, doc_id {rows.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{c} long" for c in _COUNTED) + ", groups_sha256 string"
    if counts.count() <= most_pairs:
        got = known.toArrow()
        order = np.argsort(pair := got["pair"].to_numpy(), kind="stable")
        shared = docs.sparkSession.sparkContext.broadcast((pair[order], got["n"].to_numpy()[order], got["best"].to_numpy()[order]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pairs, n, best = shared.value
            for batch in batches:
                sums = []
                for x in batch.column("links").to_pylist():
                    pair, times = _unpacked(x)
                    at = np.searchsorted(pairs, pair)
                    sums.append((int(times[best[at]].sum()), int((times * n[at]).sum())))
                names = [*(c for c in batch.schema.names if c != "links"), "n_best", "count_sum"]
                cols = list(zip(*sums, strict=True)) or [[], []]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:-2]), *(pa.array(c, pa.int64()) for c in cols)], names=names)

        return rows.select("row", "doc_id", *_COUNTED, "groups_sha256", "links").mapInArrow(run, f"{schema}, n_best long, count_sum long").select(*out)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                pair, times = _unpacked(x)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), k), pa.int64()), pa.array(pair, pa.int64()), pa.array(times, pa.int64())], names=["row", "pair", "times"])

    each = rows.select("row", "links").mapInArrow(listed, "row long, pair long, times long")
    # written, so that the join can be split by a common pair
    met = each.join(materialize(known, "aligned-known").hint("merge"), "pair")
    sums = met.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum"))
    return rows.drop("links").join(sums.hint("merge"), "row", "left").fillna(0, ["n_best", "count_sum"]).select(*out)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
