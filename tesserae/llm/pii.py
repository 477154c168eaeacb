"""Personal data by weak supervision: labelers vote on candidate spans, their reliabilities are estimated, a classifier decides."""

from __future__ import annotations

import bisect
import hashlib
import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm.common import grouped, slices, table, texts
from tesserae.plans.materialize import materialize

#: Kinds in the order in which spans are listed: the four base kinds, then those that the labelers add.
KINDS = ("email", "ip", "card", "phone", "secret", "id_number")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match always ends with its run of digits, so the next can only begin where a run begins
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]").search
_NOT_DIGIT = re.compile("[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) << (i & 1)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the email pattern, found from their @ signs, so that long runs cost no retries."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(done, at + 1))
    return out


def matches(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, passed) of the base patterns' matches, by kind and start; passed: whether the kind's own check holds."""
    if "@" in text:
        for a, z in emails(text):
            yield "email", a, z, True
    if _DIGIT(text):
        for m in _IP.finditer(text):
            yield "ip", *m.span(), all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))
        for m in _CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", m[0])
            yield "card", *m.span(), 13 <= len(digits) <= 19 and luhn(digits)
        if "+" in text:
            for m in _PHONE.finditer(text):
                yield "phone", *m.span(), 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base kinds, by kind and start."""
    return [m[:3] for m in matches(text) if m[3]]


def spell(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{z}" for k, a, z in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


#: Where a span of an added kind may be: a value given to a name, a long token, or digits in groups.
_NAMED = re.compile(r"(?i)\b(?:password|passwd|pwd|passphrase|secret|token|api[_-]?key|access[_-]?key|auth|credential)s?\b\s*[:=]\s*[\"'`]?([^\s\"'`,;]{4,})")
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z0-9+/=_-]*[0-9])[A-Za-z0-9+/_-]{16,}={0,2}(?![A-Za-z0-9+/=_-])")
_PHONE_LIKE = r"(?:\+?[0-9]{1,3}[ .-])?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}"
_GROUPS = re.compile(rf"(?<![0-9A-Za-z.+-])(?:[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}|(?P<phone>{_PHONE_LIKE})|[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{3,7}}[A-Z0-9]{{0,3}})(?![0-9A-Za-z-])")
_OPENED = re.compile(r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])")
_NAMES = ("password", "passwd", "pwd", "passphrase", "secret", "token", "key", "auth", "credential")

#: Gazetteers: known openings of keys; words that go with personal data; words that go with harmless numbers.
_OPENINGS = ("AKIA", "ASIA", "AIza", "ghp_", "gho_", "sk-", "sk_live_", "pk_live_", "xoxb-", "xoxp-", "eyJ", "glpat-")
_PERSONAL = frozenset("password passwd pwd passphrase secret token key api access auth credential credentials login ssn social security iban account tel phone mobile fax call cell passport tax email mail contact card visa host server client address".split())
_HARMLESS = frozenset("version isbn issn doi commit sha sha1 sha256 md5 digest checksum build revision license page pages chapter figure table vol volume no serial model".split())
_WORD = re.compile(r"[a-z0-9]+")

#: What the votes are called, in the order of their places in a pattern.
LABELERS = ("regex_opening", "regex_hex", "regex_mixed", "regex_groups", "regex_luhn", "gazetteer_personal", "gazetteer_harmless", "context_named", "context_quoted", "context_word_like", "regex_base", "regex_digest", "regex_isbn", "context_number")


def entropy(s: str) -> float:
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())


def _numeric(s: str) -> bool:
    """Only the digits 0 to 9: other scripts' digits and superscripts are no numbers here."""
    return s.isascii() and s.isdigit()


def votes(text: str, start: int, end: int, named: bool, passed: int = 2) -> list[int]:
    """Each labeler's vote on a span: 1 personal, 0 harmless, 2 none. passed: 1 for a base span, 0 for a base pattern's match that failed its check."""
    s, before = text[start:end], text[max(0, start - 40) : start].lower()
    near = set(_WORD.findall(before)[-4:])
    small, big, digit = any(c.islower() for c in s), any(c.isupper() for c in s), bool(_DIGIT(s))
    return [
        1 if s.startswith(_OPENINGS) else 2,
        1 if len(s) >= 16 and digit and re.fullmatch("[0-9a-f]+|[0-9A-F]+", s) and not _numeric(s) else 2,
        1 if len(s) >= 16 and digit and (small or big) and entropy(s) >= 3.3 else 0 if entropy(s) < 2.0 else 2,
        1 if _GROUPS.fullmatch(s) else 2,
        (1 if 13 <= len(s) <= 19 and luhn(s) else 0) if _numeric(s) else 2,
        1 if near & _PERSONAL else 2,
        0 if near & _HARMLESS else 2,
        1 if named else 2,
        1 if text[start - 1 : start] in ("'", '"', "`") and text[end : end + 1] == text[start - 1 : start] and digit else 2,
        0 if not s.startswith(_OPENINGS) and (not digit or re.fullmatch(r"[A-Za-z]+(?:[-_/+][A-Za-z]+)*[0-9]{0,2}", s)) else 2,
        passed,
        # lengths of common digests; thirteen digits of a book; a number in a list of others
        0 if len(s) in (32, 40, 64) and re.fullmatch("[0-9a-f]+", s) else 2,
        0 if _isbn(_NOT_DIGIT.sub("", s)) and not re.search("[A-Za-z]", s) else 2,
        0 if _NUMBERED.search(before) else 2,
    ]


#: What stands right before numbers of things.
_NUMBERED = re.compile(r"(?:\b(?:no|nr|order|orders|invoice|ticket|ref|reference|item|sku|part|issue|build|version|commit|revision|isbn|v)[.:#]*|#)\s*$")


def _isbn(digits: str) -> bool:
    """Whether thirteen digits are a book's number, check digit included."""
    return len(digits) == 13 and digits[:3] in ("978", "979") and sum(int(c) * (3 if i % 2 else 1) for i, c in enumerate(digits)) % 10 == 0


def _near(c: str) -> int:
    """Kind of the character beside a span: none, space, quote, a name's sign, letter or digit, other."""
    return 0 if not c else 1 if c.isspace() else 2 if c in "\"'`" else 3 if c in "=:" else 4 if c.isalnum() else 5


#: Sizes of the classifier's features, each a choice among few: length, characters, first two characters, entropy,
#: check digit, the characters before and after, the words before.
FIELDS = (8, 16, 16, 4, 3, 6, 6, 3)


def features(text: str, start: int, end: int) -> int:
    """A span's form and surroundings, one choice of each of FIELDS, as a number in that mixed base."""
    s = text[start:end]
    kind = lambda c: 0 if "0" <= c <= "9" else 1 if c.isupper() else 2 if c.islower() else 3
    kinds = [kind(c) for c in s]
    near = set(_WORD.findall(text[max(0, start - 40) : start].lower())[-4:])
    digits = _NOT_DIGIT.sub("", s)
    out = 0
    for size, value in zip(FIELDS, (min(7, len(s).bit_length()), sum(1 << k for k in set(kinds)), 4 * kinds[0] + kinds[min(1, len(s) - 1)], min(3, int(entropy(s))), (1 + luhn(digits)) if 13 <= len(digits) <= 19 and len(digits) + 8 >= len(s) else 0, _near(text[start - 1 : start]), _near(text[end : end + 1]), 1 if near & _PERSONAL else 2 if near & _HARMLESS else 0), strict=True):
        out = out * size + value
    return out


def candidates(text: str, found_base: list[tuple[str, int, int, bool]]) -> list[tuple[str, int, int, int, int, bool]]:
    """(kind, start, end, votes in base 3, features, open) of a text's spans that the labelers vote on.

    Base spans are among them, not open, as they stay whatever the votes. Open ones are spans of added
    kinds, leftmost first, and matches of base patterns that failed their check; they do not overlap
    each other, and a base span only if they hold all of it.
    """
    code = lambda a, z, named, passed: sum(v * 3**i for i, v in enumerate(votes(text, a, z, named, passed)))
    out = [(k, a, z, code(a, z, False, 1), features(text, a, z), False) for k, a, z, ok in found_base if ok]
    digit, named = bool(_DIGIT(text)), "=" in text or ":" in text
    opened = "AKIA" in text or "ASIA" in text
    if not digit and not named and not opened:
        return out
    found = [("secret", *m.span(), False) for m in _OPENED.finditer(text)] if opened else []
    if named:
        low = text.lower()
        if any(n in low for n in _NAMES):
            found += [("secret", *m.span(1), True) for m in _NAMED.finditer(text)]
    if digit:
        found += [("phone" if m["phone"] else "id_number", *m.span(), False) for m in _GROUPS.finditer(text)]
        found += [("card" if m[0].isdigit() else "secret", *m.span(), False) for m in _TOKEN.finditer(text)]
    fixed = sorted(c[1:3] for c in out)
    reach = [0, *itertools.accumulate((z for _, z in fixed), max)]
    order = [(k, a, z, n, 2) for k, a, z, n in sorted(found, key=lambda c: (c[1], not c[3], -c[2]))] + [(k, a, z, False, 0) for k, a, z, ok in found_base if not ok and (k != "card" or sum(map(str.isdigit, text[a:z])) >= 13)]
    taken: list[tuple[int, int]] = []
    for kind, a, z, is_named, passed in order:
        i = bisect.bisect_left(taken, (z, 0))
        free, j = i == 0 or taken[i - 1][1] <= a, bisect.bisect_left(fixed, (z, 0))
        while free and j and reach[j] > a:
            j -= 1
            free = fixed[j][1] <= a or fixed[j][0] >= a and fixed[j][1] <= z
        if free:
            taken.insert(i, (a, z))
            out.append((kind, a, z, code(a, z, is_named, passed), features(text, a, z), True))
    return out


def unpack(patterns: np.ndarray) -> np.ndarray:
    """(patterns, labelers) votes: 1, 0 or 2 for none."""
    return patterns[:, None] // 3 ** np.arange(len(LABELERS)) % 3


def reliabilities(patterns: np.ndarray, n: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """How often each labeler is right, and each pattern's probability, by expectation-maximisation.

    A labeler is right in a share of its votes, whichever way; abstaining says nothing. Pseudo-counts
    of nine right votes in ten hold rare labelers near their start.
    """
    v = unpack(patterns)
    yes, no = (v == 1).astype(float), (v == 0).astype(float)
    right, prior, q = np.full(len(LABELERS), 0.9), 0.3, np.full(len(patterns), 0.3)
    for _ in range(rounds if len(patterns) else 0):
        weight = np.log(right / (1 - right))
        q = 1 / (1 + np.exp(-np.clip(np.log(prior / (1 - prior)) + (yes - no) @ weight, -50, 50)))
        right = np.clip(((n * q) @ yes + (n * (1 - q)) @ no + 9) / (n @ (yes + no) + 10), 0.55, 0.99)
        prior = float(np.clip((q @ n + 3) / (n.sum() + 10), 0.05, 0.45))
    return right, q


class SpanModel:
    """Logistic classifier of spans by their form and surroundings, taught by the votes' posterior."""

    def __init__(self, codes: np.ndarray, q: np.ndarray, n: np.ndarray, right: np.ndarray, rounds: int = 60):
        """codes: distinct feature numbers, each with its mean posterior q and how often it occurs. Weighted logistic regression by damped Newton steps."""
        self.right = right
        x, weight = self._one_hot(codes), n / max(1.0, n.sum())
        c = np.zeros(x.shape[1])
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
            hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(len(c))
            c -= np.clip(np.linalg.solve(hess, x.T @ (weight * (p - q)) + 1e-4 * c), -3, 3)
        self.coef = c

    @staticmethod
    def _one_hot(codes: np.ndarray) -> np.ndarray:
        out, at = [np.ones((len(codes), 1))], codes.astype(np.int64)
        for size in reversed(FIELDS):
            out.append(np.eye(size)[at % size])
            at = at // size
        return np.concatenate(out, 1)

    def probability(self, codes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._one_hot(codes) @ self.coef, -30, 30)))


_SPAN = ("kind", "start", "end", "votes", "features", "open")
_FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base_spans string, candidates array<struct<kind:string,start:long,end:long,votes:long,features:long,open:boolean>>"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: its base spans as text, and the candidates with their labelers' votes and features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct(list(zip(_SPAN, (pa.string(), *[pa.int64()] * 4, pa.bool_()), strict=True))))
        for b in grouped(batches):
            whole = texts(b)
            met = [list(matches(t)) for t in whole]
            base = [[m[:3] for m in ms if m[3]] for ms in met]
            spelled = [spell(s) for s in base]
            found = [[dict(zip(_SPAN, c, strict=True)) for c in candidates(t, ms)] for t, ms in zip(whole, met, strict=True)]
            counts = [pa.array([sum(x[0] == k for x in s) for s in base], pa.int64()) for k in KINDS[:4]]
            yield pa.RecordBatch.from_arrays([b.column(0), *counts, pa.array([hashlib.sha256(s.encode()).hexdigest() for s in spelled], pa.string()), pa.array(spelled, pa.string()), pa.array(found, kind)], names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base_spans", "candidates"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, {_FOUND}")


def learn(scanned: DataFrame) -> SpanModel:
    """Reliabilities from the vote patterns of all candidates, then the classifier from each feature number's mean posterior.

    Both go to the driver as counts by pattern: at most 3 to the number of labelers, and the product of
    FIELDS; few of them occur, whatever the corpus.
    """
    seen = scanned.select(F.explode("candidates").alias("c")).groupBy("c.votes", "c.features").agg(F.count("*").alias("n")).toPandas().sort_values(["votes", "features"])
    votes_, of = np.unique(seen["votes"].to_numpy(np.int64), return_inverse=True)
    n = seen["n"].to_numpy(float)
    right, q = reliabilities(votes_, np.bincount(of, weights=n, minlength=len(votes_)))
    codes, at = np.unique(seen["features"].to_numpy(np.int64), return_inverse=True)
    total = np.bincount(at, weights=n, minlength=len(codes))
    return SpanModel(codes, np.bincount(at, weights=n * q[of], minlength=len(codes)) / total, total, right)


def _accepted(found: list[dict], model: SpanModel) -> list[tuple[str, int, int]]:
    found = [c for c in found if c["open"]]
    if not found:
        return []
    p = model.probability(np.array([c["features"] for c in found], np.int64))
    return [(c["kind"], c["start"], c["end"]) for c, x in zip(found, p, strict=True) if x >= 0.5]


def _unspell(spans: str) -> list[tuple[str, int, int]]:
    return [(k, int(a), int(z)) for k, a, z in (x.split(":") for x in spans.split(",") if x)]


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, counts and digest of the base spans, all spans as text, and the number of added ones.

    Texts are read once; what goes on is a few numbers for each candidate. Spans added do not
    overlap each other, and a base span only if they hold all of it; all are listed by kind, then start. Null and empty texts have no spans;
    repeated rows are alike; null ids stay null; other columns are not read. No rows give no rows.
    """
    scanned = materialize(scan(docs, id_col, text_col), "pii")
    shared = docs.sparkSession.sparkContext.broadcast(learn(scanned))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 4096):
            names = b.schema.names
            base, found = b.column(names.index("base_spans")).to_pylist(), b.column(names.index("candidates")).to_pylist()
            out, n = [], []
            for s, c in zip(base, found, strict=True):
                added = _accepted(c or [], shared.value)
                out.append(spell(_unspell(s) + added) if added else s)
                n.append(len(added))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(6)), pa.array(out, pa.string()), pa.array(n, pa.int64())], names=[*names[:6], "spans", "n_added"])

    return scanned.mapInArrow(decide, f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def redact_text(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind; spans that overlap are replaced together, under the first one's kind."""
    out, done = [], 0
    for kind, a, z in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"[{kind.upper()}]"]
        done = max(done, z)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, model: SpanModel, text_col: str = "text") -> DataFrame:
    """docs with the spans in their texts replaced; all columns stay, null texts stay null."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            i = b.schema.get_field_index(text_col)
            new = []
            for t in b.column(i).to_pylist():
                if t:
                    met = list(matches(t))
                    spans = [m[:3] for m in met if m[3]] + _accepted([dict(zip(_SPAN, c, strict=True)) for c in candidates(t, met)], shared.value)
                    t = redact_text(t, spans) if spans else t
                new.append(t)
            yield b.set_column(i, b.schema.field(i), pa.array(new, b.schema.field(i).type))

    return docs.mapInArrow(run, docs.schema)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))
