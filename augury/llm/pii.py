"""Personal data: labelers vote on candidate spans, and a classifier learns from their agreement."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from augury.llm.shared import rows_of

KINDS = ("email", "ip", "card", "phone")
#: Characters of context looked at on either side of a candidate.
CONTEXT = 40
THRESHOLD = 0.5
EM_ROUNDS = 50

# --- base patterns ------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# The leading test only saves second looks at the same digits; it changes no match.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# --- looser candidates -----------------------------------------------------------

_HIDDEN_EMAIL = re.compile(
    r"[A-Za-z0-9._%+-]{1,64} ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}(?: ?[\[(]dot[\])] ?[A-Za-z0-9-]{1,63}|\.[A-Za-z0-9-]{1,63})+"
)
_IPV6 = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}(?![0-9.-])")

# --- gazetteer and context -------------------------------------------------------

_ENDINGS = frozenset(
    "com org net edu gov mil int info biz io co us uk de fr es it nl eu ch at be se no dk fi pl pt ru cn jp in br au ca".split()
)
_NEAR = {
    "email": "mail email e-mail contact write reply address correo courriel".split(),
    "ip": "ip host server address client login dirección adresse".split(),
    "card": "card visa mastercard amex credit debit payment tarjeta carte karte".split(),
    "phone": "phone tel call mobile cell fax dial telefon teléfono téléphone".split(),
}
_AGAINST = "isbn issn version build checksum sha md5 serial invoice order ticket doi hash".split()
_NEAR_PATTERN = {k: re.compile(r"\b(?:" + "|".join(map(re.escape, v)) + r")\b", re.I) for k, v in _NEAR.items()}
_AGAINST_PATTERN = re.compile(r"\b(?:" + "|".join(_AGAINST) + r")\b", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each ``@``: a long run of letters is looked at once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        end = _DOMAIN.match(text, at + 1) if start < at else None
        if end:
            yield start, end.end()
            done = end.end()
        else:
            done = at + 1
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, in order; kinds by number."""
    found = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        if "." in text:
            for m in _IP.finditer(text):
                if all(len(p) <= 3 and int(p or 0) <= 255 for p in (q.lstrip("0") for q in m.group().split("."))):
                    found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The base spans, and what looser patterns find that touches none of them."""
    found: list[tuple[int, int, int]] = []
    if "at]" in text or "at)" in text:
        found += [(m.start(), 0, m.end()) for m in _HIDDEN_EMAIL.finditer(text)]
    if _DIGIT.search(text):
        if text.count(":") >= 7:
            found += [(m.start(), 1, m.end()) for m in _IPV6.finditer(text)]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13 and 13 <= sum(c.isdigit() for c in m.group()) <= 19:
                found.append((m.start(), 2, m.end()))
        found += [(m.start(), 3, m.end()) for m in _LOCAL_PHONE.finditer(text)]
    starts, ends = [b[0] for b in base], list(accumulate((b[2] for b in base), max))

    def free(c: tuple[int, int, int]) -> bool:
        before = bisect_left(starts, c[2])
        return not before or ends[before - 1] <= c[0]

    return sorted(set(base) | {c for c in found if free(c)})


# --- labelers --------------------------------------------------------------------

LABELERS = ("pattern", "checksum", "gazetteer", "context", "surroundings", "shape")


def votes(text: str, span: tuple[int, int, int], base: set[tuple[int, int, int]]) -> tuple[int, ...]:
    """1 for, -1 against, 0 no opinion, of each labeler.

    Regex labelers: the base pattern; a check sum or value range. Gazetteer: domain endings,
    issuer and network prefixes. Context: telling words nearby; words that tell against, and
    what touches the span. Shape: groups as people write them.
    """
    start, kind, end = span
    own = text[start:end]
    digits = "".join(c for c in own if "0" <= c <= "9")
    near = text[max(0, start - CONTEXT) : start] + " " + text[end : end + CONTEXT]
    pattern = 1 if span in base else -1
    if kind == 0:
        ending = re.split(r"[.\s\])]+", own.lower().rstrip(".])"))[-1]
        checksum = 1 if not own.startswith(".") and ".." not in own else -1
        gazetteer = 1 if ending in _ENDINGS else -1
        shape = 1 if 6 <= len(own) <= 80 else -1
    elif kind == 1:
        parts = own.split(".")
        checksum = 0 if ":" in own else (1 if all(p == "0" or not p.startswith("0") for p in parts) else -1)
        first = int(parts[0]) if len(parts) == 4 and len(parts[0]) < 4 else -1
        gazetteer = 0 if first < 0 else (1 if 0 < first < 240 and first != 127 else -1)
        shape = 1 if len(own) >= 7 else -1
    elif kind == 2:
        checksum = 1 if luhn(digits) else -1
        issuer = digits[0] in "3456" and (digits[:2] in ("34", "35", "36", "37", "38") or digits[0] != "3")
        gazetteer = 1 if issuer else -1
        shape = 1 if len(digits) in (15, 16) else -1
    else:
        checksum = 1 if 10 <= len(digits) <= 15 else 0
        gazetteer = 1 if own[0] == "+" and digits[0] != "0" else 0
        shape = 1 if own[0] in "+(" or own.count("-") + own.count(".") >= 2 else -1
    context = 1 if _NEAR_PATTERN[KINDS[kind]].search(near) else 0
    before, after = text[start - 1 : start] if start else "", text[end : end + 1]
    touched = before.isalnum() or after.isalnum() or before in ("#", "/", "=", "\"") and before != ""
    surroundings = -1 if touched or _AGAINST_PATTERN.search(near) else 1
    return pattern, checksum, gazetteer, context, surroundings, shape


# --- the model --------------------------------------------------------------------


@dataclass(frozen=True)
class SpanModel:
    """Weights of the span classifier, by kind, and what the labelers turned out to be worth."""

    weights: np.ndarray
    reliabilities: np.ndarray

    def probability(self, kind: int, vote: tuple[int, ...]) -> float:
        return float(1 / (1 + np.exp(-_features(np.array([kind]), np.array([vote])) @ self.weights))[0])


def _features(kind: np.ndarray, vote: np.ndarray) -> np.ndarray:
    """A constant and the votes for each kind by itself."""
    out = np.zeros((len(kind), len(KINDS), 1 + len(LABELERS)))
    out[np.arange(len(kind)), kind, 0] = 1
    out[np.arange(len(kind)), kind, 1:] = vote
    return out.reshape(len(kind), len(KINDS) * (1 + len(LABELERS)))


def fit(kind: np.ndarray, vote: np.ndarray, count: np.ndarray) -> SpanModel:
    """From how often each pattern of votes occurs, to a span classifier.

    Expectation-maximisation for each kind: how likely a labeler votes for, against or not at
    all on a true and on a false span, starting from labelers that are right four times in
    five, and how many spans are true. Its posteriors are then the soft labels from which a
    logistic regression over the votes is trained.
    """
    reliable = np.zeros((len(KINDS), 2, len(LABELERS), 3))
    soft = np.full(len(kind), 0.5)
    for k in range(len(KINDS)):
        own = kind == k
        onehot = np.stack([vote[own] == v for v in (-1, 0, 1)], axis=2).astype(float)
        weight = count[own].astype(float)
        theta = np.array([[[0.7, 0.1, 0.2]] * len(LABELERS), [[0.2, 0.1, 0.7]] * len(LABELERS)])
        share = 0.5
        for _ in range(EM_ROUNDS):
            log = np.einsum("nlv,clv->nc", onehot, np.log(theta)) + np.log([1 - share, share])
            after = np.exp(log - log.max(axis=1, keepdims=True))
            after /= after.sum(axis=1, keepdims=True)
            mass = after * weight[:, None]
            # A few imagined votes in the starting proportions keep rare cases sober.
            start = np.array([[[0.7, 0.1, 0.2]], [[0.2, 0.1, 0.7]]]) * 10
            theta = np.einsum("nc,nlv->clv", mass, onehot) + start
            theta /= theta.sum(axis=2, keepdims=True)
            share = (mass[:, 1].sum() + 5) / (mass.sum() + 10)
        reliable[k] = theta
        if own.any():
            soft[own] = after[:, 1]
    x, weight = _features(kind, vote), count.astype(float)
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - soft)) + w
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.eye(len(w))
        w -= np.linalg.solve(curve, slope)
    return SpanModel(w, reliable)


def _vote_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The votes on a task's candidates, already counted by pattern."""
    for batch in batches:
        seen: dict[tuple[int, ...], int] = {}
        for text in batch.column("text"):
            text = text.as_py() or ""
            base = base_spans(text)
            known = set(base)
            for span in candidates(text, base):
                key = (span[1], *votes(text, span, known))
                seen[key] = seen.get(key, 0) + 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in seen], pa.int32()),
                pa.array([list(k[1:]) for k in seen], pa.list_(pa.int32())),
                pa.array(list(seen.values()), pa.int64()),
            ],
            ["kind", "vote", "n"],
        )


def fit_span_model(docs: DataFrame, text_col: str = "text") -> SpanModel:
    """Votes over all documents, summed up by pattern: at most 4 x 3^6 rows reach the driver."""
    texts = docs.select(docs[text_col].cast("string").alias("text"))
    counted = texts.mapInArrow(_vote_rows, "kind int, vote array<int>, n long").groupBy("kind", "vote")
    rows = sorted((r["kind"], tuple(r["vote"]), r["n"]) for r in counted.agg(F.sum("n").alias("n")).collect())
    return fit(
        np.array([r[0] for r in rows], np.int64),
        np.array([r[1] for r in rows], np.int64).reshape(-1, len(LABELERS)),
        np.array([r[2] for r in rows], np.int64),
    )


def judged_spans(text: str, model: SpanModel, known: dict) -> tuple[list, list]:
    """Base spans, and base spans with those that the classifier adds, both in order."""
    base = base_spans(text)
    own, out = set(base), list(base)
    for span in candidates(text, base):
        if span not in own:
            key = (span[1], votes(text, span, own))
            if key not in known:
                known[key] = model.probability(*key)
            if known[key] >= THRESHOLD:
                out.append(span)
    return base, sorted(out)


def find_personal_data(docs: DataFrame, model: SpanModel | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, counts of the base spans by kind, ``base_spans`` and ``spans``.

    Spans are (kind, start, end), in code points, the end exclusive, ordered by start, then
    kind. ``spans`` has the base ones and those that the classifier adds; it is fitted to the
    votes over all of ``docs`` unless given. Null is the empty text and has none. Ids and
    repeated rows pass through; an empty table gives no rows.
    """
    model = model or fit_span_model(docs, text_col)
    rows = rows_of(docs, id_col, text_col).withColumnRenamed(text_col, "text")
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            counts, first, full = [], [], []
            for text in batch.column("text"):
                base, spans = judged_spans(text.as_py() or "", model, known)
                counts.append([sum(k == kind for _, k, _ in base) for kind in range(len(KINDS))])
                first.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in base])
                full.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans])
            columns = [pa.array([c[k] for c in counts], pa.int64()) for k in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns, pa.array(first, pa.list_(span)), pa.array(full, pa.list_(span))],
                ["doc_id", *[f"n_{k}" for k in KINDS], "base_spans", "spans"],
            )

    each = "array<struct<kind: string, start: int, end: int>>"
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return rows.mapInArrow(run, f"doc_id long, {counts}, base_spans {each}, spans {each}")


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span, or run of overlapping ones, as its first kind in brackets."""
    out, done = [], 0
    for start, kind, end in spans:
        if start >= done:
            out += [text[done:start], f"<{KINDS[kind]}>"]
            done = end
        else:
            done = max(done, end)
    return "".join([*out, text[done:]])


def mask_personal_data(docs: DataFrame, model: SpanModel | None = None, text_col: str = "text") -> DataFrame:
    """The same columns and rows with personal data masked in ``text_col``; null stays null."""
    model = model or fit_span_model(docs, text_col)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            texts = batch.column(at).to_pylist()
            clean = [None if t is None else masked(t, judged_spans(t, model, known)[1]) for t in texts]
            columns = list(batch.columns)
            columns[at] = pa.array(clean, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def digest(found: DataFrame) -> DataFrame:
    """Span lists as text, ``kind:start:end`` joined by commas, the base ones as a digest."""

    def joined(spans: str):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    counts = [f"n_{k}" for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined("base_spans"), 256).alias("base_sha256"), joined("spans").alias("spans"))
