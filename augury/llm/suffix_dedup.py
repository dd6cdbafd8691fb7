"""Repeated passages by sparse suffix arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from augury.llm.shared import bit_map, in_map, rows_of, written
from augury.llm.words import blocks, buffer_of, mixed, run_hashes, word_hashes
from augury.session import freeze

#: Passages of at least so many words are found.
PASSAGE = 50
#: Words whose hash selects a suffix. Of any PASSAGE - GRAM + 1 successive runs the least is kept.
GRAM = 16
SPAN = PASSAGE - GRAM + 1
#: Words looked at on either side of a kept run.
SIDE = SPAN - 1
#: Windows that a task passes on at a time.
WINDOWS = 1 << 18

#: Rows without id are numbered from the least number upwards; ids of documents start here.
FIRST_ID = -(2**62)

_KEPT = "doc_id long, pos long, before long, after long, gram long, full long"


def owners(hashes: np.ndarray, span: int = SPAN) -> np.ndarray:
    """For each window of ``span`` the place whose hash is the least; of equal ones the first.

    Two texts that share a passage share its windows, and so the places in them.
    """
    if len(hashes) < span:
        return np.zeros(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(hashes, span)
    step = 1 << 14
    picked = [np.argmin(windows[a : a + step], axis=1) + np.arange(a, min(a + step, len(windows))) for a in range(0, len(windows), step)]
    return np.concatenate(picked)


def minimisers(hashes: np.ndarray, span: int = SPAN) -> np.ndarray:
    """The places that are the least of some window."""
    return np.unique(owners(hashes, span))


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _context_hash(words: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of words[start:stop] for each pair, wherever they stand, by sums of powers over the whole text."""
    total = np.zeros(len(words) + 1, np.uint64)
    total[1:] = np.add.accumulate(words * _powers(_BASE, len(words)))
    moved = (total[stop] - total[start]) * _powers(_INVERSE, len(words) + 1)[start]
    return mixed(moved + (stop - start).astype(np.uint64))


def _suffixes(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each text with a full passage: row, words, place of each passage, kept places, hashes there, context hashes.

    A context's hash also tells where in it the run stands: near the ends of a text two runs
    have the same words around them.
    """
    data, offsets = buffer_of(batch.column("text"))
    for a, b in blocks(offsets):
        words, per_text = word_hashes(data, offsets[a : b + 1], lower=False)
        at = 0
        for row, n in enumerate(per_text.tolist(), a):
            own = words[at : at + n]
            at += n
            if n < PASSAGE:
                continue
            grams, _ = run_hashes(own, np.array([n]), GRAM)
            owner = owners(grams)
            places = np.unique(owner)
            full = _context_hash(own, np.maximum(places - SIDE, 0), np.minimum(places + GRAM + SIDE, n))
            full = mixed(full ^ np.minimum(places, SIDE).astype(np.uint64))
            yield row, own, owner, places, grams[places], full


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id").to_numpy()
        columns: list[list[np.ndarray]] = [[] for _ in range(6)]
        for row, words, _, places, grams, full in _suffixes(batch):
            values = (
                np.full(len(places), ids[row]), places, np.minimum(places, SIDE),
                np.minimum(len(words) - places - GRAM, SIDE), grams.view(np.int64), full.view(np.int64),
            )
            for column, value in zip(columns, values):
                column.append(value)
        arrays = [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for c in columns]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "pos", "before", "after", "gram", "full"])


def _windows(packed: np.ndarray):
    """The passages around the places whose contexts are asked for: context, hash, words before the run.

    Each passage of a text belongs to one kept run, the least in it. Equal ones of a block
    become one row.
    """

    def out(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        full, window, left = (np.concatenate([h[k] for h in held]) if held else np.zeros(0, np.int64) for k in range(3))
        _, at = np.unique(full ^ mixed(left.view(np.uint64)).view(np.int64), return_index=True)
        return pa.RecordBatch.from_arrays([pa.array(x[at]) for x in (full, window, left)], ["full", "window", "left_words"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for _, words, owner, places, _, full in _suffixes(batch):
                hit = in_map(packed, full.view(np.int64))
                if not hit.any():
                    continue
                of = np.searchsorted(places, owner)
                start = np.flatnonzero(hit[of])
                window = _context_hash(words, start, start + PASSAGE)
                held.append((full[of[start]].view(np.int64), window.view(np.int64), owner[start] - start))
                size += len(start)
                if size > WINDOWS:
                    yield out(held)
                    held, size = [], 0
            yield out(held)

    return run


def _numbered(rows: DataFrame) -> DataFrame:
    """A number of its own for each row without id; those rows are written, so that it lasts."""
    number = F.monotonically_increasing_id() + F.lit(-(2**63))
    alone = written(rows.filter("doc_id is null").withColumn("doc_id", number), "without-id")
    return rows.filter("doc_id is not null").unionByName(alone)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of each document, sorted by start, joined where they touch; in one pass."""
    for batch in batches:
        out = []
        for spans in batch.column("all"):
            flat = spans.values
            start, stop = (flat.field(name).to_numpy() for name in ("start", "stop"))
            reach = np.maximum.accumulate(stop)
            first = np.flatnonzero(np.append(True, start[1:] > reach[:-1]))
            ends = reach[np.append(first[1:], len(start)) - 1]
            out.append([{"start": a, "stop": b} for a, b in zip(start[first].tolist(), ends.tolist())])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, kind)], ["doc_id", "spans"])


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_repeated, spans`` per row: passages that other documents have too.

    ``spans`` are (start, stop) in words, the stop exclusive, merged and in order; every passage
    of 50 words or more that another document has lies in them. Words are runs of anything but
    ASCII white space, and case counts. Null, empty and shorter texts have none. Rows that
    repeat an id are one document, whose spans they share; each row without id is a document of
    its own. Ids are at least -2**62. An empty table gives no rows.

    * Of every 35 successive runs of 16 words the one with the least hash is kept, so that any
      shared passage of 50 words shares a kept run.
    * Where a run and the 34 words on both sides are the same in two documents, that is known
      by grouping. Of the other contexts of a run, one each, the windows of 50 words around it
      are grouped by their hash: those that two documents have are passages. Longer passages
      are chains of such windows.
    * No partner is left out, however many others share the run. Runs, contexts and windows are
      known by 64 bits of hash.
    """
    rows = rows_of(docs, id_col, text_col).withColumnRenamed(text_col, "text")
    rows = _numbered(rows)
    kept = written(rows.mapInArrow(_kept, _KEPT), "suffixes")
    ends = [F.min("doc_id").alias("low"), F.max("doc_id").alias("high")]
    shared = freeze(kept.groupBy("gram").agg(*ends).filter("low <> high").select("gram"))
    kept = written(kept.join(shared, "gram", "left_semi"), "shared")

    groups = freeze(kept.groupBy("gram", "full").agg(*ends))
    several = groups.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram")
    open_groups = freeze(groups.join(several, "gram", "left_semi"))
    packed = bit_map(open_groups, F.col("full"))
    windows = rows.mapInArrow(_windows(packed), "full long, window long, left_words long").distinct()
    windows = written(windows.join(open_groups.select("full", "low", "high"), "full"), "windows")
    passages = windows.groupBy("window").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    passages = freeze(passages.filter("low <> high").select("window"))
    best = windows.join(passages, "window").groupBy("full").agg(
        F.max("left_words").alias("left_words"), (PASSAGE - GRAM - F.min("left_words")).alias("right_words")
    )

    whole = kept.join(groups.filter("low <> high").select("gram", "full"), ["gram", "full"])
    whole = whole.filter(F.col("before") + GRAM + F.col("after") >= PASSAGE)
    part = kept.join(freeze(best), "full")
    spans = whole.select("doc_id", (F.col("pos") - F.col("before")).alias("start"), (F.col("pos") + GRAM + F.col("after")).alias("stop"))
    spans = spans.union(
        part.select("doc_id", F.col("pos") - F.col("left_words"), F.col("pos") + GRAM + F.col("right_words"))
    )
    merged = spans.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("all"))
    empty = F.array().cast("array<struct<start: bigint, stop: bigint>>")
    merged = merged.mapInArrow(_merged, "doc_id long, spans array<struct<start: long, stop: long>>")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffer_of(batch.column("text"))
            n = [word_hashes(data, offsets[a : b + 1], lower=False)[1] for a, b in blocks(offsets)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.concatenate(n) if n else np.zeros(0, np.int64), pa.int64())], ["doc_id", "n_words"]
            )

    sizes = rows.mapInArrow(counted, "doc_id long, n_words long")
    spans = F.coalesce("spans", empty)
    total = F.aggregate(spans, F.lit(0).cast("long"), lambda t, s: t + s["stop"] - s["start"])
    return sizes.join(merged, "doc_id", "left").select(
        F.when(F.col("doc_id") >= FIRST_ID, F.col("doc_id")).alias("doc_id"), "n_words", total.alias("n_repeated"), spans.alias("spans")
    )
