"""Alignment: against whole texts encoded by both libraries and a plain walk over the bytes."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tesserae.llm import alignment as A

PATHS = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
a_tok = Tokenizer.from_file(PATHS[0])
a_tok.encode_special_tokens = True
b_tok = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
#: Bytes that byte-level vocabularies spell as themselves.
PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
REST = [b for b in range(256) if b not in PLAIN]
VALUE = {chr(b): b for b in PLAIN} | {chr(256 + k): b for k, b in enumerate(REST)}


def tokens(text):
    a = a_tok.encode(" " + text, add_special_tokens=False)
    left = [(i, bytes(VALUE[c] for c in t)) for i, t in zip(a.ids, a.tokens, strict=True)]
    pieces = [(i, b_tok.id_to_piece(i)) for i in b_tok.encode(text)]
    right = [(i, bytes([int(p[3:5], 16)]) if b_tok.is_byte(i) else p.replace("\u2581", " ").encode()) for i, p in pieces]
    return left, right


def walked(text):
    """Groups of ids, and the pairs of tokens that share a byte."""
    if not text:
        return [], [], 0, 0
    left, right = tokens(text)
    whole = (" " + text).encode()
    if b"".join(x[1] for x in left) != whole or b"".join(x[1] for x in right) != whole:
        return [], [], 0, 0
    of_a = [k for k, x in enumerate(left) for _ in x[1]]
    of_b = [k for k, x in enumerate(right) for _ in x[1]]
    links = sorted(set(zip(of_a, of_b, strict=True)))
    groups, now = [], ([], [])
    for at in range(len(whole)):
        if at == 0 or of_a[at] != of_a[at - 1]:
            now[0].append(left[of_a[at]][0])
        if at == 0 or of_b[at] != of_b[at - 1]:
            now[1].append(right[of_b[at]][0])
        if at + 1 == len(whole) or (of_a[at + 1] != of_a[at] and of_b[at + 1] != of_b[at]):
            groups.append(now)
            now = ([], [])
    return groups, [(left[i][0], right[j][0]) for i, j in links], len(left), len(right)


def plain(rows):
    found = [walked(t) for _, t in rows]
    count = Counter(p for f in found for p in set(f[1]))
    most = {}
    for (a, _), n in count.items():
        most[a] = max(most.get(a, 0), n)
    out = []
    for (i, _), (groups, links, n_a, n_b) in zip(rows, found, strict=True):
        spelled = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((str(i), n_a, n_b, len(groups), len(links), sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links), hashlib.sha256(spelled.encode()).hexdigest() if groups else ""))
    return sorted(out)


def aligned(df, **k):
    return sorted((str(r.doc_id), *r[1:]) for r in A.alignments(df, *PATHS, **k).collect())


def odd_texts():
    r, out = random.Random(3), []
    parts = ["word", "Words", "it's", "1234", "naïve", "日本語", "Ωμέγα", "\u2581", "<0x41>", "<|endoftext|>", "<s>", "</s>", "<unk>", "e\u0301", "\ufb01", "\x00", "😀", "\u200b", "…", "don't", "a\u00adb", "###", "'", "'s"]
    gaps = [" ", " ", " ", " ", "\n", "\n\n", "\n\n\n", "", "  ", "\t", "\n ", " \n", "\r\n", "\u00a0", "\u3000", "\x1c", "\u0085"]
    for k in range(500):
        few = gaps[:8] if k % 2 else gaps
        out.append("".join(r.choice(parts) + r.choice(few) for _ in range(r.randrange(9))))
    return [*out, " ", "\n", " a", "a ", "\na", "a\n", "", None]


def test_odd_texts_match_a_plain_walk(spark):
    rows = list(enumerate(odd_texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumns({"row": F.lit("x"), "pair": F.lit(1), "n_a": F.lit("y")})
    want = plain(rows)
    assert aligned(df) == want and sum(x[4] == 0 for x in want) < 200
    assert aligned(df, cache=40) == want
    assert aligned(df, most_pairs=0) == want


def test_documents_match_a_plain_walk(spark, data):
    df = spark.read.parquet(f"{data}/documents.parquet")
    assert aligned(df) == plain([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])


def test_odd_rows(spark):
    long = "lorem ipsum dolor sit amet " * 5000
    rows = [(1, "one two"), (1, "one two"), (None, "two one"), (2, None), (3, ""), (4, long), (5, "x" * 30_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert aligned(df) == aligned(df, most_pairs=0) == plain(rows)
    assert aligned(df.where("false")) == aligned(df.where("false"), most_pairs=-1) == []
    named = df.select(F.col("doc_id").cast("string").alias("name"), "text")
    assert sorted(str(r.doc_id) for r in A.alignments(named, *PATHS, id_col="name").collect()) == sorted(str(i) for i, _ in rows)


@pytest.mark.parametrize("seed", range(5))
def test_align(seed):
    r = np.random.default_rng(seed)
    total = int(r.integers(1, 60))
    cut = lambda: np.diff([0, *sorted({*r.integers(1, total + 1, r.integers(1, 30)).tolist(), total})])
    a, b = cut(), cut()
    ga, gb, left, right = A.align(a, b)
    of = [np.repeat(np.arange(len(x)), x) for x in (a, b)]
    assert sorted(zip(left.tolist(), right.tolist(), strict=True)) == sorted({*zip(of[0].tolist(), of[1].tolist(), strict=True)})
    both = sorted(set(np.cumsum(a)) & set(np.cumsum(b)))
    assert ga.tolist() == [int(np.searchsorted(both, e)) for e in np.cumsum(a)] and gb.tolist() == [int(np.searchsorted(both, e)) for e in np.cumsum(b)]
