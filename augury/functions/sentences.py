"""Sentences of a text with their places, in time that follows the text's length.

Runs inside tasks, on Arrow batches: places are running sums over the pieces, which
column expressions cannot carry along an array.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from augury.functions import fixed_values as fixed

_BREAK = re.compile(r"(?<=[.!?])\s+")
_STOP = re.compile(r"[.!?]")
#: Longest ending by which earlier copies of a sentence are looked up.
_LONGEST_KEY = 1024
#: Text whose sentences are held at a time.
_PART_BYTES = 1 << 20

LOCATED = pa.list_(
    pa.struct(
        [
            ("sent_ord", pa.int32()), ("sentence", pa.string()), ("sent_start", pa.int32()),
            ("context_start", pa.int32()), ("context", pa.string()),
        ]
    )
)
LOCATED_DDL = (
    "array<struct<sent_ord: int, sentence: string, sent_start: int, context_start: int, context: string>>"
)


def pieces_of(text: str) -> list[tuple[int, str]]:
    """Pieces and where they start; white space after ``.``, ``!`` or ``?`` separates them."""
    out, at = [], 0
    for gap in _BREAK.finditer(text):
        out.append((at, text[at : gap.start()]))
        at = gap.end()
    out.append((at, text[at:]))
    return out


class FirstPlaces:
    """Where a piece of a text occurs first, which may be inside or at the end of an earlier one.

    Every piece but the last ends at a stop, so an earlier copy of it does as well. The stops
    are indexed by the characters that lead up to them, of a length that is a power of two no
    longer than the piece; whoever shares that ending is compared in full, in order.
    """

    def __init__(self, text: str):
        self.text = text
        self.stops: list[int] | None = None
        self.endings: dict[int, dict[str, list[int]]] = {}
        self.known: dict[str, int] = {}

    def find(self, own: int, piece: str, last: bool) -> int:
        if piece not in self.known:
            self.known[piece] = self.text.find(piece) if last or not piece else self._before(own, piece)
        return self.known[piece]

    def _before(self, own: int, piece: str) -> int:
        if self.stops is None:
            self.stops = [m.end() for m in _STOP.finditer(self.text)]
        n = len(piece)
        size = min(_LONGEST_KEY, 1 << (n.bit_length() - 1))
        if size not in self.endings:
            index: dict[str, list[int]] = {}
            for end in self.stops:
                if end >= size:
                    index.setdefault(self.text[end - size : end], []).append(end)
            self.endings[size] = index
        for end in self.endings[size].get(piece[-size:], ()):
            if end >= own + n:
                break
            if end >= n and self.text.startswith(piece, end - n):
                return end - n
        return own


def located(text: str, priced: bool) -> Iterator[tuple[int, str, int, int, str]]:
    """(number, sentence, start, context start, context) of each piece.

    All windows read later lie in the context. With ``priced``, only pieces with a dollar sign
    in their context.
    """
    before, after = fixed.PERIOD_WINDOW
    reach = fixed.VALUE_WINDOW[1]
    pieces, places = pieces_of(text), FirstPlaces(text)
    dollars = [m.start() for m in re.finditer(r"\$", text)] if priced else []
    for number, (own, piece) in enumerate(pieces):
        start = places.find(own, piece, number == len(pieces) - 1)
        first = max(start - before, 0)
        stop = max(start + after, start + len(piece) + reach)
        if priced:
            at = bisect_left(dollars, first)
            if at == len(dollars) or dollars[at] >= stop:
                continue
        yield number, piece, start, first, text[first:stop]


def parts_of(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``_PART_BYTES`` of text, at least one row each."""
    widths = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(np.diff(np.cumsum(widths, dtype=np.int64) // _PART_BYTES)) + 1
    ends = [*cuts.tolist(), batch.num_rows]
    for start, end in zip([0, *ends], ends):
        yield batch.slice(start, end - start)


def locate_batches(text: str, priced: bool):
    """Arrow batches with ``text`` replaced by ``located``; a null text has no sentences.

    Contexts of neighbours overlap, so sentences weigh several times their text: a batch leaves
    in parts, and a task holds one part or one long text at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in parts_of(whole, whole.schema.names.index(text))):
            at = batch.schema.names.index(text)
            rows, ends = [], [0]
            for value in batch.column(at):
                whole = value.as_py()
                if whole is not None:
                    rows.extend(located(whole, priced))
                ends.append(len(rows))
            fields = list(zip(*rows)) or [()] * 5
            items = pa.StructArray.from_arrays(
                [pa.array(f, k.type) for f, k in zip(fields, LOCATED.value_type)], fields=list(LOCATED.value_type)
            )
            column = pa.ListArray.from_arrays(pa.array(np.array(ends, np.int32)), items)
            others = [c for i, c in enumerate(batch.columns) if i != at]
            names = [n for i, n in enumerate(batch.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays([*others, column], [*names, "located"])

    return run
