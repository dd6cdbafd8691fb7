"""Guidance records of a text: what the column expressions of ``functions.guidance`` say, for whole texts.

Runs inside tasks, on Arrow batches, where the sentences are located. As lambdas over arrays, which
are not compiled, the same steps took several times as long, and sentences with their contexts went
to Python and back. Words, patterns and windows are those of ``fixed_values``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from unicodedata import category

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T

from augury.functions import fixed_values as fixed
from augury.functions.sentences import located, parts_of
from augury.functions.text import ODD_LETTERS, any_of, openings

RECORD = pa.struct(
    [
        ("metric", pa.string()), ("val1", pa.float64()), ("val2", pa.float64()), ("is_range", pa.bool_()),
        ("pdicity", pa.string()), ("fiscal_year", pa.int32()), ("action", pa.string()), ("sentence", pa.string()),
        ("sent_ord", pa.int32()), ("metric_ord", pa.int32()),
    ]
)
RECORD_TYPE = T.StructType(
    [
        T.StructField("metric", T.StringType()), T.StructField("val1", T.DoubleType()), T.StructField("val2", T.DoubleType()),
        T.StructField("is_range", T.BooleanType()), T.StructField("pdicity", T.StringType()),
        T.StructField("fiscal_year", T.IntegerType()), T.StructField("action", T.StringType()),
        T.StructField("sentence", T.StringType()), T.StructField("sent_ord", T.IntegerType()),
        T.StructField("metric_ord", T.IntegerType()),
    ]
)


class Words:
    """Alternatives to look for in folded text: their opening letters, and their pattern."""

    def __init__(self, name: str, alternatives: list[str], after: str = ""):
        self.name = name
        self.letters = openings(alternatives)
        self.regex = re.compile((any_of(alternatives) + after).lower())

    def find(self, folded: str, letters: list[str]) -> re.Match[str] | None:
        """The first match. ``letters`` are the opening letters that may be there: the search begins at the first."""
        first = -1
        for opening in letters:
            at = folded.find(opening)
            if at >= 0 and (first < 0 or at < first):
                first = at
        return self.regex.search(folded, first) if first >= 0 else None

    def find_whole(self, folded: str, letters: list[str]) -> re.Match[str] | None:
        """The first match of whole words: only its last letter may end a word, so no shorter one is tried."""
        m = self.find(folded, letters)
        while m and (
            m.start() and _is_word(folded, m.start() - 1) or m.end() < len(folded) and _is_word(folded, m.end())
        ):
            m = self.regex.search(folded, m.start() + 1)
        return m


def _there(several: list[Words], folded: str) -> list[tuple[int, Words, list[str]]]:
    """Whose opening letters stand somewhere in a text, and which; looked for once for all its sentences."""
    return [
        (order, words, letters) for order, words in enumerate(several)
        if (letters := [opening for opening in words.letters if opening in folded])
    ]


VERBS = [Words("verb", fixed.GUIDANCE_VERBS, r"\s")]
METRICS = [Words(name, forms) for name, forms in fixed.METRICS.items()]
PERIODS = [Words(name, forms) for name, forms in fixed.PERIODS.items()]
ACTIONS = [Words(name, forms) for name, forms in fixed.ACTIONS.items()]
AMOUNT = re.compile(fixed.AMOUNT_PATTERN.lower())
RANGE = re.compile((fixed.AMOUNT_PATTERN + fixed.RANGE_LINK_PATTERN + fixed.AMOUNT_PATTERN).lower())
FISCAL_YEAR = re.compile(fixed.FISCAL_YEAR_PATTERN)


def fold(text: str) -> str:
    """Lower case, character by character; see :func:`augury.functions.text.fold`."""
    if not text.isascii():
        for odd, plain in zip(*ODD_LETTERS):
            text = text.replace(odd, plain)
    return text.lower()


def _is_word(text: str, at: int) -> bool:
    """A letter, a decimal digit, ``_``, or a mark on one of the first two, as Java ends words."""
    c = text[at]
    if c == "_" or c.isalpha() or c.isdecimal():
        return True
    while category(text[at]) == "Mn":
        at -= 1
        if at < 0:
            return False
        if text[at].isalpha() or text[at].isdecimal():
            return True
    return False


def _scaled(number: str, word: str | None) -> float:
    return float(number.replace(",", "")) * fixed.SCALE_FACTORS.get(word or "", 1.0)


def amounts(snippet: str) -> tuple[float, float, bool] | None:
    """(val1, val2, is_range) of a folded text: the first range, else the first single amount."""
    m = RANGE.search(snippet)
    if m:
        left, right = _scaled(m[1], m[2] or m[4]), _scaled(m[3], m[4] or m[2])
        return min(left, right), max(left, right), True
    m = AMOUNT.search(snippet)
    if m:
        value = _scaled(m[1], m[2])
        return value, value, False
    return None


def _window(folded: str, at: int, size: tuple[int, int]) -> str:
    return folded[max(at - size[0], 0) : at + size[1]]


def records_of(text: str) -> list[tuple]:
    """The records of a text, each (metric, val1, val2) once: that of the earliest sentence.

    Labels are read for these only.
    """
    folded, found = fold(text), {}
    verbs, metrics = _there(VERBS, folded), _there(METRICS, folded)
    if not verbs or not metrics:
        return []
    _, verb, verb_letters = verbs[0]
    for number, piece, start, _, _ in located(text, priced=True):
        sentence = folded[start : start + len(piece)]  # an earlier copy has the same letters
        if not verb.find(sentence, verb_letters):
            continue
        for order, words, letters in metrics:
            mention = words.find(sentence, letters)
            values = amounts(_window(folded, start + mention.start(), fixed.VALUE_WINDOW)) if mention else None
            if values:
                found.setdefault((order, *values[:2]), (number, piece, start, words.name, values[2]))
    if not found:
        return []
    periods, actions = _there(PERIODS, folded), _there(ACTIONS, folded)
    out, labels = [], {}
    for (order, low, high), (number, piece, start, metric, is_range) in sorted(found.items()):
        if number not in labels:
            around, close = _window(folded, start, fixed.PERIOD_WINDOW), _window(folded, start, fixed.ACTION_WINDOW)
            year = FISCAL_YEAR.search(around)
            labels[number] = (
                next((w.name for _, w, letters in periods if w.find(around, letters)), fixed.PERIOD_DEFAULT),
                int(year.group()) if year else None,
                next((w.name for _, w, letters in actions if w.find_whole(close, letters)), fixed.ACTION_DEFAULT),
            )
        out.append((metric, low, high, is_range, *labels[number], piece.strip()[: fixed.SENTENCE_CHARS], number, order))
    return out


def record_batches(text: str):
    """Arrow batches with ``text`` replaced by the columns of :data:`RECORD`, a row for each record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in parts_of(whole, whole.schema.names.index(text))):
            at = batch.schema.names.index(text)
            rows, origins = [], []
            for i, value in enumerate(batch.column(at)):
                found = records_of(value.as_py()) if value.is_valid else []
                rows.extend(found)
                origins.extend([i] * len(found))
            fields = list(zip(*rows)) or [()] * RECORD.num_fields
            own = [pa.array(f, k.type) for f, k in zip(fields, RECORD)]
            beside = batch.drop_columns([text]).take(pa.array(np.array(origins, np.int64)))
            yield pa.RecordBatch.from_arrays([*beside.columns, *own], [*beside.schema.names, *(k.name for k in RECORD)])

    return run
