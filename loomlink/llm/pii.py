"""Personal data by weak supervision.

Candidate spans come from broad patterns. Five labelers vote on each, for (+1), against (-1) or not at all (0): a strict
pattern, a checksum, gazetteers (issuer prefixes, key prefixes, country codes, mail providers, given names), words in
the context before it, and its shape. For each kind, expectation-maximisation over the counts of vote patterns estimates
how reliable each labeler is for each class, without labels; its posteriors train a logistic classifier of spans on
votes, kind and form. Spans that the base patterns find stay whatever it says; it decides on all others.

Only counts of vote patterns leave the tasks: at most kinds * 3^5 * forms rows, whatever the input. The texts are read
twice, once for these counts and once for the spans.

Defined results: null and empty texts have no spans. Repeated rows are judged each. An empty table gives an empty one.
Other columns are ignored. Texts of any length are taken whole, in time linear in them.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlink.llm.common import documents

BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "iban", "ssn", "secret", "name"]
Span = tuple[str, int, int]
#: What P(-1), P(0), P(+1) are expected to be for false and true spans, and how many spans of a class that counts for,
#: whatever the number of spans: it settles which class is the true one and what is said of votes that nobody casts.
PRIOR, STRENGTH = np.array([[0.35, 0.6, 0.05], [0.05, 0.35, 0.6]]), 20.0
#: Bounds of the share of true spans.
SHARE = (0.05, 0.95)
#: Weight of the classifier's ridge against the mean loss of a span.
RIDGE = 1e-4

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A start within a run of digits matches only if the run's start does.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{16,}={0,2}(?![A-Za-z0-9+/_=-])")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+.)-])(?:\+[0-9]{1,3}\x20)?\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])")
_NAME = re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof)\.?\x20([A-Z][a-z]+(?:\x20[A-Z][a-z]+)?)")
_TITLE = re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof)\b")
_HEX = re.compile(r"(?:[0-9a-f]{32,}|[0-9A-F]{32,})\Z")
_MIXED = re.compile(r"(?=[^a-z]*[a-z])(?=[^A-Z]*[A-Z])(?=[^0-9]*[0-9]).{24,}", re.S)
#: Words that tell of a kind before it, prefixes and names that are known for it.
CONTEXT = {
    "email": ("mail", "contact", "write to", "reach"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "credit", "pay"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "account", "bank"),
    "ssn": ("ssn", "social security"),
    "secret": ("token", "secret", "password", "passwd", "api_key", "apikey", "api key", "bearer", "credential"),
    "name": ("dear", "signed", "regards", "contact"),
}
GAZETTEER = {
    "email": ("gmail.com", "yahoo.com", "outlook.com", "hotmail.com", "example.com", "example.org"),
    "card": ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65"),
    "phone": ("+1", "+33", "+34", "+39", "+44", "+49", "+61", "+81", "+86", "+91"),
    "secret": ("AKIA", "ASIA", "ghp_", "gho_", "sk-", "sk_", "xox", "eyJ", "AIza", "glpat-"),
    "name": ("James", "Mary", "John", "Maria", "Anna", "Peter", "Paul", "Hans", "Marie", "Juan", "Jean", "Carlos"),
}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches of the pattern: at each @ the run of local characters before it, then a domain."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield "email", start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Spans of the base patterns that hold, and card-like ones that don't."""
    found, failed = list(_emails(text)), []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(x.lstrip("0")) <= 3 and int(x[-4:]) <= 255 for x in m.group().split(".")):
                found.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19:
                (found if luhn(digits) else failed).append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                    found.append(("phone", *m.span()))
    order = {k: n for n, k in enumerate(KINDS)}
    return sorted(found, key=lambda s: (s[1], order[s[0]])), failed


def _iban(text: str) -> bool:
    x = text.replace(" ", "")
    return 15 <= len(x) <= 34 and int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1


def candidates(text: str) -> tuple[list[Span], list[Span]]:
    """(base spans, other candidates); the others overlap no base span and no candidate before them."""
    base, other = base_spans(text)
    if _DIGIT.search(text):
        for m in _IBAN.finditer(text):
            other.append(("iban", *m.span()))
        other += [("ssn", *m.span()) for m in _SSN.finditer(text)]
        other += [("phone", *m.span()) for m in _LOCAL_PHONE.finditer(text)]
        other += [("secret", *m.span()) for m in _TOKEN.finditer(text) if _DIGIT.search(m.group()) and re.search("[A-Za-z]", m.group())]
    if _TITLE.search(text):
        other += [("name", *m.span(1)) for m in _NAME.finditer(text)]
    starts, reach, most = [s[1] for s in base], [], 0
    for s in base:
        most = max(most, s[2])
        reach.append(most)
    free, last = [], 0
    for s in sorted(other, key=lambda s: (s[1], -s[2], KINDS.index(s[0]))):
        k = bisect_left(starts, s[2])
        if s[1] >= last and not (k and reach[k - 1] > s[1]):
            free.append(s)
            last = s[2]
    return base, free


def votes(text: str, span: Span) -> tuple[int, ...]:
    """What pattern, checksum, gazetteer, context and shape say of a span."""
    kind, start, end = span
    own = text[start:end]
    digits = "".join(c for c in own if "0" <= c <= "9")
    pattern = check = known = 0
    if kind == "secret":
        pattern = 1 if _HEX.match(own) or _MIXED.match(own) else 0
        known = int(own.startswith(GAZETTEER["secret"]))
    elif kind == "card":
        pattern = int(len(digits) in (15, 16))
        check = 1 if luhn(digits) else -1
        known = int(digits.startswith(GAZETTEER["card"]))
    elif kind == "phone":
        pattern = int(own.startswith("+"))
        known = int(own.startswith(GAZETTEER["phone"]))
    elif kind == "email":
        pattern = 1
        known = int(own.lower().endswith(GAZETTEER["email"]))
    elif kind == "ip":
        pattern, check = 1, 1
    elif kind == "iban":
        check = 1 if _iban(own) else -1
    elif kind == "ssn":
        pattern = 0 if own.startswith(("000", "666", "9")) or "-00-" in own or own.endswith("-0000") else 1
    else:
        known = int(any(w in GAZETTEER["name"] for w in own.split()))
    before = text[max(0, start - 24) : start].lower()
    context = int(any(w in before for w in CONTEXT[kind]))
    glued = (start and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum())
    quoted = start and end < len(text) and text[start - 1] in "\"'`" and text[end] == text[start - 1]
    shape = 1 if quoted else -1 if glued or len(set(own)) < 4 else 0
    return pattern, check, known, context, shape


def form(text: str, span: Span) -> tuple[int, int]:
    """Classes of length and of the share of digits."""
    own = text[span[1] : span[2]]
    return min(len(own).bit_length(), 8), 4 * sum("0" <= c <= "9" for c in own) // len(own)


def reliabilities(counts: dict[tuple[int, ...], float], rounds: int = 100) -> tuple[float, np.ndarray, dict[tuple[int, ...], float]]:
    """Dawid-Skene for two classes, with a prior of fixed weight: the share of true spans, P(vote | class) by labeler, and each pattern's posterior."""
    patterns = list(counts)
    x, n = np.array(patterns) + 1, np.array([counts[p] for p in patterns], float)
    post = 1 / (1 + np.exp(-1.5 * (x - 1).sum(1) + 0.75))
    for _ in range(rounds):
        share = float(np.clip((n * post).sum() / n.sum(), *SHARE))
        table = np.empty((2, x.shape[1], 3))
        for c, w in enumerate((n * (1 - post), n * post)):
            for j in range(x.shape[1]):
                table[c, j] = np.bincount(x[:, j], weights=w, minlength=3) + STRENGTH * PRIOR[c]
            table[c] /= table[c].sum(1, keepdims=True)
        odds = np.log(share / (1 - share)) + sum(np.log(table[1, j, x[:, j]] / table[0, j, x[:, j]]) for j in range(x.shape[1]))
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
    return share, table, dict(zip(patterns, post.tolist(), strict=True))


def vector(kind: str, vote: tuple[int, ...], shape: tuple[int, int]) -> np.ndarray:
    x = np.zeros(1 + 2 * len(vote) + len(KINDS) + 9 + 5)
    x[0] = 1
    for j, v in enumerate(vote):
        if v:
            x[1 + 2 * j + (v > 0)] = 1
    at = 1 + 2 * len(vote)
    x[at + KINDS.index(kind)] = 1
    x[at + len(KINDS) + shape[0]] = 1
    x[at + len(KINDS) + 9 + shape[1]] = 1
    return x


def fit(rows: list[tuple[str, tuple[int, ...], tuple[int, int], int]]) -> np.ndarray:
    """Weights of the span classifier, from rows (kind, votes, form, count), by Newton's method on the mean loss."""
    if not rows:
        return np.zeros(len(vector("email", (0,) * 5, (0, 0))))
    counts: dict[str, Counter] = {}
    for kind, vote, _, n in rows:
        counts.setdefault(kind, Counter())[vote] += n
    post = {kind: reliabilities(own)[2] for kind, own in counts.items()}
    x = np.array([vector(k, v, f) for k, v, f, _ in rows])
    y = np.array([post[k][v] for k, v, _, _ in rows])
    n = np.array([r[3] for r in rows], float)
    n /= n.sum()
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(w)), x.T @ (n * (y - p)) - RIDGE * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(df: DataFrame) -> np.ndarray:
    """Weights from the vote patterns of all texts of df (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    base, other = candidates(text)
                    counts.update((s[0], *votes(text, s), *form(text, s)) for s in base + other)
        rows = list(counts.items())
        yield pa.RecordBatch.from_arrays([pa.array([list(map(str, k)) for k, _ in rows], pa.list_(pa.string())), pa.array([n for _, n in rows], pa.int64())], ["seen", "n"])

    told = df.select("text").mapInArrow(run, "seen array<string>, n long").groupBy("seen").agg(F.sum("n").alias("n")).orderBy("seen").collect()
    return fit([(r["seen"][0], tuple(map(int, r["seen"][1:6])), (int(r["seen"][6]), int(r["seen"][7])), r["n"]) for r in told])


def found(text: str, weights: np.ndarray) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans) of a text, by start and kind."""
    base, other = candidates(text)
    more = [s for s in other if vector(s[0], votes(text, s), form(text, s)) @ weights > 0]
    return base, sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0]))) if more else base


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping ones, the first's."""
    out, at = [], 0
    for kind, start, end in spans:
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def detect(df: DataFrame, weights: np.ndarray) -> DataFrame:
    """(doc_id, base, spans) of the texts; both lists as kind:start:end, joined by commas."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [tuple(map(written, found(t, weights))) if t else ("", "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([b[0] for b in both], pa.string()), pa.array([b[1] for b in both], pa.string())], ["doc_id", "base", "spans"])

    schema = T.StructType([df.schema["doc_id"], T.StructField("base", T.StringType()), T.StructField("spans", T.StringType())])
    return df.select("doc_id", "text").mapInArrow(run, schema)


def redact(df: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """df with all spans of text replaced by their kind; other columns as they are."""
    weights = train(df) if weights is None else weights
    place = df.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [masked(t, found(t, weights)[1]) if t else t for t in batch.column(place).to_pylist()]
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))

    plain = [f"c{k}" for k in range(len(df.columns))]  # as names may hold dots
    schema = T.StructType([T.StructField(c, f.dataType) for c, f in zip(plain, df.schema, strict=True)])
    return df.toDF(*plain).mapInArrow(run, schema).toDF(*df.columns)


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    told = detect(docs, train(docs))
    counts = [F.regexp_count("base", F.lit(f"(^|,){k}:")).cast("long").alias(f"n_{k}") for k in BASE]
    return told.select("doc_id", *counts, F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


QUERIES = {"op5_personal_data": op5_personal_data}
SQL: dict[str, str] = {}
