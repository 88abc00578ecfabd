"""Personal data: weak labelers vote, expectation-maximisation weighs them, a classifier decides."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapline.llm.common import small_batches, text_of

KINDS = ("email", "ip", "card", "phone")

# The base patterns. The digit patterns start where a run of digits starts, and the
# email is built around its @, so no text makes them slow; the matches are those of
#   email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+    ip [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   card [0-9]([\x20-]?[0-9])+                                  phone \+[0-9][\x20().0-9-]+[0-9]
_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
# Looser shapes that only become spans when the classifier accepts them.
_MORE = (
    ("email", re.compile(r"(?<![\w.%+-])[\w.%+-]{1,64}\x20?[\[(]\x20?at\x20?[\])]\x20?[A-Za-z0-9-]{1,63}"
                         r"(?:\x20?(?:\.|[\[(]\x20?dot\x20?[\])])\x20?[A-Za-z0-9-]{1,63}){1,5}")),
    ("ip", re.compile(r"(?<![\w:])(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}(?![\w:])")),
    ("phone", re.compile(r"(?<![\w+.(-])(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-][0-9]{3,4}[\x20.-][0-9]{4}(?![\w-])")),
)
_CUE = re.compile(r"[\[(]\x20?at\x20?[\])]|[0-9a-fA-F]:[0-9a-fA-F]|[0-9]{3}\)?[\x20.-][0-9]{3}")
# Gazetteers (top-level domains, issuer prefixes) and words near each kind.
DOMAINS = frozenset("com org net edu gov mil int info biz io co de fr es uk it nl eu us ca au ch at be "
                    "pl se no dk fi pt ie ru jp cn in br mx example test".split())
ISSUERS = ("34", "35", "36", "37", "38", "4", "50", "51", "52", "53", "54", "55", "6011", "62", "64", "65")
NEAR = {
    "email": frozenset("mail email contact write address reply correo courriel schreiben".split()),
    "ip": frozenset("ip host server address login from network adresse".split()),
    "card": frozenset("card visa mastercard credit payment pay karte carte tarjeta".split()),
    "phone": frozenset("tel phone call mobile fax telefon telephone telefono whatsapp number".split()),
}
FAR = frozenset("version license licensed by-nc by-sa isbn issn order invoice section release chapter doi "
                "page build revision".split())
_WORDS = re.compile(r"[A-Za-z-]+")


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int
    base: bool


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(t: str) -> Iterator[tuple[int, int]]:
    done, k = 0, t.find("@")
    while k >= 0:
        m = _HOST.match(t, k + 1)
        a = k
        if m:
            while a > done and _LOCAL_END.match(t[a - 1]):
                a -= 1
        if m and a < k:
            yield a, m.end()
            done = m.end()
        else:
            done = max(done, k + 1) if m is None else k + 1
        k = t.find("@", max(k + 1, done))


def base_spans(t: str) -> list[Span]:
    """Matches of the base patterns that pass their checks, by start and kind."""
    out = [Span("email", a, b, True) for a, b in _emails(t)] if "@" in t else []
    if _DIGIT.search(t):
        for m in _IP.finditer(t):
            if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
                out.append(Span("ip", *m.span(), True))
        for m in _CARD.finditer(t):
            d = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(d) <= 19 and luhn(d):
                out.append(Span("card", *m.span(), True))
        if "+" in t:
            for m in _PHONE.finditer(t):
                if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                    out.append(Span("phone", *m.span(), True))
    return sorted(out, key=lambda s: (s.start, KINDS.index(s.kind)))


def candidates(t: str) -> list[Span]:
    """Base spans, and looser shapes that touch none of them, by start and kind."""
    out = base_spans(t)
    if _CUE.search(t):
        taken = np.array([(s.start, s.end) for s in out], np.int64).reshape(-1, 2)
        for kind, pattern in _MORE:
            for m in pattern.finditer(t):
                if not np.any((taken[:, 0] < m.end()) & (taken[:, 1] > m.start())):
                    out.append(Span(kind, *m.span(), False))
                    taken = np.vstack([taken, [m.span()]])
    return sorted(out, key=lambda s: (s.start, KINDS.index(s.kind)))


LABELERS = ("shape", "check", "gazetteer", "context", "edges", "company")


def votes(t: str, s: Span) -> tuple[int, ...]:
    """Each labeler's vote on a candidate: 1 personal data, -1 not, 0 no opinion."""
    v = t[s.start:s.end]
    digits = "".join(c for c in v if "0" <= c <= "9")
    near = {w.lower() for w in _WORDS.findall(t[max(0, s.start - 40):s.start])}
    before = t[s.start - 1:s.start]
    after = t[s.end:s.end + 1]
    if s.kind == "email":
        top = re.split(r"[.\s)\]]", v)[-1].lower()
        check = 1 if top.isalpha() and len(top) > 1 else -1
        gazetteer = 1 if top in DOMAINS else 0
    elif s.kind == "ip":
        check = 1 if s.base else 0
        gazetteer = -1 if v.split(".")[0] in ("0", "127", "255") else 0
    elif s.kind == "card":
        check = 1 if luhn(digits) else -1
        gazetteer = 1 if digits.startswith(ISSUERS) else -1
    else:
        check = 1 if 9 <= len(digits) <= 15 else -1
        gazetteer = 1 if v.startswith("+") and digits[0] != "0" else 0
    context = 1 if near & NEAR[s.kind] else -1 if near & FAR else 0
    edges = -1 if before.isalnum() or after.isalnum() else 1 if before in "" or before in " \n\t(:<\"'" else 0
    rest = t[max(0, s.start - 12):s.start] + t[s.end:s.end + 12]
    company = -1 if sum(c.isdigit() for c in rest) > 6 else 0
    return (1 if s.base else 0, check, gazetteer, context, edges, company)


def shape_of(t: str, s: Span) -> tuple[int, ...]:
    """Features of the classifier beyond the votes, in a few bins each."""
    v = t[s.start:s.end]
    digits = sum(c.isdigit() for c in v)
    return (min(digits // 4, 4), min(len(v) // 8, 4), min(sum(not c.isalnum() for c in v), 4))


def _tally(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        seen: Counter = Counter()
        for t in pdf["text"]:
            for s in candidates(t):
                seen[(KINDS.index(s.kind), *votes(t, s), *shape_of(t, s))] += 1
        if seen:
            yield pd.DataFrame({"row": [list(k) for k in seen], "n": list(seen.values())})


def expect_votes(table: np.ndarray, weight: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Probability of each row of votes (kind, votes...) being right, by expectation-maximisation.

    Every labeler has, per kind, its own distribution of votes for right and for wrong
    candidates; a kind has a prior. Starts from the sum of votes.
    """
    kind, vote = table[:, 0], table[:, 1:] + 1
    p = 1 / (1 + np.exp(-(vote - 1).sum(1).astype(float)))
    for _ in range(rounds):
        score = np.zeros(len(p))
        for k in np.unique(kind):
            of = kind == k
            w1, w0 = weight[of] * p[of], weight[of] * (1 - p[of])
            prior = (w1.sum() + 1) / (w1.sum() + w0.sum() + 2)
            s = np.full(of.sum(), np.log(prior / (1 - prior)))
            for j in range(vote.shape[1]):
                a = np.bincount(vote[of, j], w1, 3) + 0.5
                b = np.bincount(vote[of, j], w0, 3) + 0.5
                ratio = np.log(a / a.sum()) - np.log(b / b.sum())
                ratio[1] = 0.0 if j else ratio[1]          # no opinion says nothing
                s += ratio[vote[of, j]]
            score[of] = s
        new = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        if np.abs(new - p).max() < 1e-6:
            break
        p = new
    return p


def _inputs(rows: np.ndarray) -> np.ndarray:
    kind = np.eye(len(KINDS))[rows[:, 0]]
    shapes = [np.eye(5)[rows[:, 7 + i]] for i in range(3)]
    return np.hstack([kind, rows[:, 1:7], *shapes]).astype(float)


def train(docs: DataFrame, *, text: str = "text", rounds: int = 300) -> np.ndarray:
    """Weights of the span classifier: logistic regression on votes and shape, fitted to the
    probabilities that expectation-maximisation gives the candidates of all documents.

    Candidates are counted by (kind, votes, shape): at most 4 * 3**6 * 5**3 combinations, a bound
    of the code and not of the data, and only these counts come to the driver.
    """
    small_batches(docs.sparkSession)
    got = (docs.select(text_of(text).alias("text"))
           .mapInPandas(_tally, "row array<int>, n long")
           .groupBy("row").agg(F.sum("n").alias("n")).orderBy("row").collect())
    if not got:
        return np.zeros(0)
    rows = np.array([r["row"] for r in got], np.int64)
    n = np.array([r["n"] for r in got], float)
    target = expect_votes(rows[:, :7], n)
    x = _inputs(rows)
    w = np.zeros(x.shape[1])
    share = n / n.sum()
    for _ in range(rounds):                                 # Newton steps with a ridge
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (share * (p - target)) + 1e-3 * w
        hess = (x * (share * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def find(t: str, weights: np.ndarray, accept: float = 0.9) -> list[Span]:
    """All spans of a text: base ones, and those the classifier accepts."""
    out = []
    for s in candidates(t):
        if not s.base:
            if not len(weights):
                continue
            x = _inputs(np.array([[KINDS.index(s.kind), *votes(t, s), *shape_of(t, s)]]))
            if 1 / (1 + np.exp(-float(x[0] @ weights))) < accept:
                continue
        out.append(s)
    return out


def listed(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def detect(docs: DataFrame, *, text: str = "text", accept: float = 0.9) -> DataFrame:
    """``docs`` with ``pii``, an array of (kind, start, end, base) of each whole text in order of
    start and kind; places are code points, ends exclusive.

    Two passes over the texts: one counts how the labelers vote on all candidates, the other
    applies the classifier trained from that. Documents are independent and nothing but the
    counts is shuffled. Null and empty texts have an empty array, repeated rows equal ones; a column named
    ``pii`` is replaced, all others stay. No rows, no result.
    """
    weights = train(docs, text=text)
    keep = [f for f in docs.schema.fields if f.name != "pii"]
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                         T.StructField("end", T.IntegerType()), T.StructField("base", T.BooleanType())])
    schema = T.StructType([*keep, T.StructField("pii", T.ArrayType(span))])

    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [[{"kind": s.kind, "start": s.start, "end": s.end, "base": s.base} for s in find(t, weights, accept)]
                     if t else [] for t in b.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, kind)], [*b.schema.names, "pii"])

    return docs.select(*[f.name for f in keep]).mapInArrow(run, schema)


def mask(t: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans go together."""
    out, at = [], 0
    for s in spans:
        if s.start >= at:
            out += [t[at:s.start], f"[{s.kind.upper()}]"]
        at = max(at, s.end)
    return "".join([*out, t[at:]])


def redact(docs: DataFrame, *, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` with personal data in ``text`` replaced by [EMAIL], [IP], [CARD] or [PHONE], and
    ``length``, if there is such a column, brought up to date where the text changed. Null texts stay null."""
    weights = train(docs, text=text)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            old = b.column(text).to_pylist()
            new = [mask(t, find(t, weights)) if t else t for t in old]
            cols = {**dict(zip(b.schema.names, b.columns)), text: pa.array(new, b.schema.field(text).type)}
            if length in cols:
                cols[length] = pa.array([n if x == y else len(y) for x, y, n in zip(old, new, cols[length].to_pylist())],
                                        b.schema.field(length).type)
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    return docs.mapInArrow(run, docs.schema)


def _is(kind: str):
    return lambda s: s["kind"] == kind


def digest(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, counts and checksum of its base spans, and all its spans as text."""
    one = F.transform("pii", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    base = F.filter("pii", lambda s: s["base"])
    as_text = F.array_join(F.transform(base, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    found = detect(docs.select("doc_id", "text"))
    return found.select(
        "doc_id", *[F.size(F.filter(base, _is(k))).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(as_text, 256).alias("base_sha256"), F.array_join(one, ",").alias("spans"))
