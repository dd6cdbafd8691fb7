"""Token sequences of bounded length, filled by best-two-fit."""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from augury.llm.shared import kept, rows_of, written

CAPACITY = 2048
#: Chunks between white space that a worker remembers the ids of.
REMEMBER = 800_000

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, place long"


#: Chunks of which it is known how the tokenizer's normaliser and splitter treat them: printable
#: ASCII and the letters of Latin-1, which lower-casing and composing leave single characters.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {**{b: chr(b) for b in own}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Remembered(dict):
    """Values made as they are asked for; twice ``size`` are kept, those asked for last."""

    def __init__(self, make: Callable[[str], bytes], size: int):
        super().__init__()
        self.make, self.size = make, size
        self.before: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        if len(self) >= self.size:
            self.before = dict(self)
            self.clear()
        value = self.before.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


class WordTokenizer:
    """Ids of whole texts as packed unsigned 32-bit numbers, by the given tokenizer file.

    The tokenizer drops white space and never joins across it, so a text's ids are those of its
    chunks between spaces, one after the other; chunks come back often and are remembered. A
    plain chunk is split as the tokenizer splits it, and the parts are remembered too; all
    others go through the whole tokenizer.
    """

    def __init__(self, path: str, remember: int = REMEMBER):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.known = _Remembered(self._chunk, max(1, remember // 2))
        self.parts = _Remembered(self._part, max(1, remember // 2))
        self.letters = _byte_letters()

    def _part(self, part: str) -> bytes:
        # Printable ASCII stands for itself among the letters of bytes.
        own = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
        return _packed([token.id for token in self.model.tokenize(own)])

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha():
            return self.parts[chunk.lower()]
        if _PLAIN.fullmatch(chunk):
            return b"".join(map(self.parts.__getitem__, _PARTS.findall(chunk.lower())))
        return _packed(self.tokenizer.encode(chunk, add_special_tokens=False).ids)

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.known.__getitem__, text.replace("\n", " ").split(" ")))


def _tokenizer(path: str) -> WordTokenizer:
    """A worker keeps its tokenizer, and what it remembers, until another operator's work begins."""
    return kept(("words", path), lambda: WordTokenizer(path))


def _cut(path: str, capacity: int, end_id: int):
    """Pieces of each document, numbered within their task by length."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, task, seen = _tokenizer(path), TaskContext.get().partitionId(), {}
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = tokenizer.encode(text.as_py() or "") + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    length = len(part) // 4
                    place = seen.get(length, 0)
                    seen[length] = place + 1
                    rows.append((doc_id, piece, at // 4, length, zlib.crc32(part), task, place))
            columns = list(zip(*rows)) or [()] * 7
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "task", "place"],
            )

    return run


@dataclass
class Plan:
    """Where the pieces of each length go, in runs of sequences filled alike.

    An entry says: of its length, the pieces from ``rank`` on go to sequences from ``sequence``
    on, ``copies`` in each, the first at ``offset``. Entries are sorted by length, then rank.
    """

    length: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    copies: np.ndarray
    offset: np.ndarray

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the piece with this number among those of its length."""
        entry = np.empty(len(length), np.int64)
        for value in np.unique(length):
            own = slice(*np.searchsorted(self.length, [value, value + 1]))
            hit = length == value
            entry[hit] = own.start + np.searchsorted(self.rank[own], rank[hit], "right") - 1
        number = rank - self.rank[entry]
        each = self.copies[entry]
        return self.sequence[entry] + number // each, self.offset[entry] + number % each * length


def _fill(count: np.ndarray, capacity: int) -> list[int]:
    """Lengths of one sequence, taken from ``count``: greedy best fit, then two for the smallest."""
    bin_, gap = [], capacity

    def fitting(room: int) -> int:
        some = np.flatnonzero(count[1 : room + 1])
        return int(some[-1]) + 1 if len(some) else 0

    def fill() -> None:
        nonlocal gap
        while gap and (best := fitting(gap)):
            bin_.append(best)
            count[best] -= 1
            gap -= best

    fill()
    while gap and len(bin_) > 1:
        small = min(bin_)
        room = gap + small
        some = np.flatnonzero(count[: room + 1])
        if not len(some):
            break
        # For each first length the largest second one that still fits beside it.
        at = np.searchsorted(some, room - some, "right") - 1
        ok = at >= 0
        first, second = some[ok], some[at[ok]]
        same = (first == second) & (count[first] < 2)
        if same.any():
            lower = np.where(at[ok] > 0, some[np.maximum(at[ok] - 1, 0)], 0)
            second = np.where(same, lower, second)
        total = np.where(second > 0, first + second, 0)
        if not len(total) or total.max() <= small:
            break
        best = int(np.argmax(total))
        bin_.remove(small)
        count[small] += 1
        for length in (int(first[best]), int(second[best])):
            bin_.append(length)
            count[length] -= 1
        gap = room - int(total[best])
        fill()
    return bin_


def best_two_fit(lengths: dict[int, int], capacity: int = CAPACITY) -> tuple[Plan, int]:
    """Plan for so many pieces of each length, and the number of sequences.

    A sequence starts with the largest piece left and is filled greedily with the largest that
    fits. Then, as long as that fills it more tightly, its smallest piece makes room for two
    pieces. As the choice only depends on which lengths are left, sequences are filled alike
    until one of their lengths runs out: the work, and the plan, follow the number of different
    lengths (at most ``capacity``), not the number of pieces.
    """
    count = np.zeros(capacity + 1, np.int64)
    for length, n in lengths.items():
        count[length] = n
    used = np.zeros(capacity + 1, np.int64)
    entries, sequence = [], 0
    while count.any():
        before = count.copy()
        bin_ = sorted(_fill(count, capacity), reverse=True)
        need = before - count
        some = np.flatnonzero(need)
        # A piece that was only tried needs no more than one of its length to be there.
        times = int((before[some] // need[some]).min())
        offset = 0
        for length in dict.fromkeys(bin_):
            copies = int(need[length])
            entries.append((length, int(used[length]), sequence, copies, offset))
            offset += length * copies
        count = before - need * times
        used += need * times
        sequence += times
    table = np.array(sorted(entries), np.int64).reshape(-1, 5)
    return Plan(*table.T.copy()), sequence


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces and their places: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A document is its tokens, then ``end_id``; null is the empty text, which is ``end_id``
    alone. Only longer documents than ``capacity`` are cut. No sequence holds more than
    ``capacity`` ids, and places in it are gapless from 0. Rows that repeat an id are packed
    once per row; a missing id stays missing. An empty table gives no rows. ``tokenizer`` is a
    file that every executor has.

    The tokens are read once. Pieces are numbered by length within their task, and the tasks'
    counts of each length are added up; the driver only sees one number per length, from which
    it plans.
    """
    rows = rows_of(docs, id_col, text_col).withColumnRenamed(text_col, "text")
    pieces = written(rows.mapInArrow(_cut(tokenizer, capacity, end_id), _PIECES), "pieces")
    per_task = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    starts = written(
        per_task.select("task", "length", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")), "starts"
    )
    totals = {r["length"]: r["n"] for r in starts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan, _ = best_two_fit(totals, capacity)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = plan.place(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    ranked = pieces.join(starts.drop("n"), ["task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("place")).alias("rank")
    )
    return ranked.mapInArrow(
        places,
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
