"""Exact top-k by inner product, reading sorted lists without random access.

Rows lie in blocks of up to 4096. A block holds, for each component, its rows sorted by it:
read from the end that the query's sign asks for, a list gives falling contributions to the
score. All lists of a block are read side by side, some places at a time. What was read of a
row, plus the least that its unread lists can give, is a lower bound; plus what these lists
have come down to, an upper one. Reading stops when no unread row and only a few read ones can
still reach the k-th best; these few get their final scores from the rows as stored. The k-th
best score of the blocks before is where the next block starts from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK, QUERIES = 4096, 64
#: Most rows whose lists one task holds (about 110 MB at 64 components), and queries it serves.
GROUP, SECTION = 65_536, 65_536
#: Parts in which a list is read; rows that are resolved rather than read on for; at which share of the
#: k-th best score, as the most that unread rows can reach, the rows read are first looked at.
PARTS, FEW, LOOK = 16, 512, 0.6
LARGEST = 1 << 23


class Block:
    """Rows of a block, and for each component two lists of them: falling and, behind all those, rising."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, rising: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.rows, self.width = vectors.shape
        values = np.take_along_axis(vectors.T, rising.astype(np.int64), axis=1)
        self.lists = np.concatenate([rising[:, ::-1], rising])
        self.values = np.concatenate([values[:, ::-1], values])
        self.unread = np.ones((self.width, self.rows), np.uint8)
        own_row = np.arange(self.width)[:, None] * self.rows
        #: Places of the lists' rows in ``unread``.
        self.marks = self.lists + np.concatenate([own_row, own_row])


class Best:
    """The k best so far: highest scores, ties to smaller ids."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def full(self) -> bool:
        return len(self.scores) == self.k

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        first = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[first], ids[first]


def search(block: Block, own: int, query: np.ndarray, best: Best) -> int:
    """Bring ``best`` up to date with a block; returns how many places of each list were read."""
    components = np.flatnonzero(query[: block.width])
    weights = query[components]
    lists = components + np.where(weights < 0, block.width, 0)
    falls = weights.astype(float)[:, None]
    least = block.values[lists, -1] * falls[:, 0]
    known = np.zeros(block.rows)
    unread, marks = block.unread, block.unread.ravel()
    marks[:] = 1
    alive = np.flatnonzero(block.ids != own)
    step = -(-block.rows // PARTS)
    at = 0
    while at < block.rows and len(components) and len(alive):
        stop = min(at + step, block.rows)
        if best.full:  # while rows that were never read can be better, no look at the others is worth it
            onset = best.scores[-1] - (1 - LOOK) * abs(best.scores[-1])
            while stop < block.rows and block.values[lists, stop - 1] @ weights > onset:
                stop = min(stop + step, block.rows)
        else:
            stop = min(at + 4 * step, block.rows)
        adds = block.values[lists, at:stop] * falls
        known += np.bincount(block.lists[lists, at:stop].ravel(), adds.ravel(), minlength=block.rows)
        marks[block.marks[lists, at:stop].ravel()] = 0
        at, frontier = stop, adds[:, -1].copy()
        few = len(alive) * 4 <= block.rows
        open_lists = (unread[:, alive] if few else unread)[components].astype(float)
        bounds = np.stack([frontier, least]) @ open_lists + (known[alive] if few else known)
        upper, lower = bounds if few else bounds[:, alive]
        bar, tie = -np.inf, np.iinfo(np.int64).max
        if len(alive) >= best.k:
            bar = np.partition(lower, len(lower) - best.k)[len(lower) - best.k]
        if best.full and best.scores[-1] >= bar:
            bar, tie = float(best.scores[-1]), best.ids[-1]
        alive = alive[(upper > bar) | ((upper == bar) & (block.ids[alive] <= tie))]
        if len(alive) <= FEW and frontier.sum() < bar:
            break
    scores = block.vectors[alive][:, components].astype(np.int64) @ weights
    best.add(scores, block.ids[alive])
    return at


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column, shorter ones filled up with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
    width = int(lengths.max(initial=0))
    out = np.zeros((len(lengths), width), np.int32)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


PACKED = "place long, ids binary, width int, vectors binary, lists binary"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows with their lists; blocks of queries are smaller and have their hashes in this place."""
    place = TaskContext.get().partitionId()
    kinds = [pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.binary()]
    names = [c.split()[0] for c in PACKED.split(", ")]
    for batch in batches:
        size = QUERIES if "query_hash" in batch.schema.names else BLOCK
        for a in range(0, batch.num_rows, size):
            part = batch.slice(a, size)
            vectors = _matrix(part.column("vector"))
            ids, *hashes = (part.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in part.schema.names if c != "vector")
            lists = hashes[0] if hashes else np.argsort(vectors.T, axis=1, kind="stable").astype(np.uint16)
            values = [place, ids.tobytes(), vectors.shape[1], vectors.tobytes(), lists.tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)
            place += 1


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], np.int64)
    return ids, np.frombuffer(row["vectors"], np.int32).reshape(len(ids), row["width"])


FOUND = "query_id long, query_hash long, vec_id long, score long"


def _searched(k: int):
    def run(queries: pa.Table, lists: pa.Table) -> pa.Table:
        blocks = []
        for row in lists.to_pylist():
            ids, vectors = _unpacked(row)
            blocks.append(Block(ids, vectors, np.frombuffer(row["lists"], np.uint16).reshape(row["width"], len(ids))))
        out: list[list[np.ndarray]] = []
        for row in queries.to_pylist() if blocks else []:
            ids, vectors = _unpacked(row)
            hashes = np.frombuffer(row["lists"], np.int64)
            for own, query_hash, vector in zip(ids, hashes, vectors.astype(np.int64)):
                best = Best(k)
                for block in blocks:
                    search(block, own, vector, best)
                n = len(best.ids)
                out.append([np.full(n, own), np.full(n, query_hash), best.ids, best.scores])
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 4
        return pa.table(columns, names=[c.split()[0] for c in FOUND.split(", ")])

    return run


#: Stands for a missing id, behind all others.
NO_ID = (1 << 63) - 1


def whole_numbers(rows: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``id, vector``: components times ``scale``, rounded down; rows with a bad component are left out."""
    x = rows[vector_col]
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    largest = F.lit(float(LARGEST))
    numbers = F.transform(x, lambda v: F.greatest(-largest, F.least(largest, F.floor(v.cast("double") * scale).cast("double"))).cast("int"))
    ids = F.coalesce(rows[id_col].cast("long"), F.lit(NO_ID))
    return rows.filter(x.isNotNull() & finite).select(ids.alias("id"), numbers.alias("vector"))


def exact_top_k(
    rows: DataFrame, wanted: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that fits ``wanted`` the k best other rows.

    Scores are inner products of the components times ``scale``, rounded down to whole numbers.
    Ties go to the smaller id; fewer rows give fewer results. Vectors that are null or hold a
    null or non-finite component take no part. Components beyond 2^23 after scaling count as
    that, so that scores stay exact. Of vectors of different lengths the shorter ones count as
    filled up with zeros. A query does not meet rows of its own id; repeated rows are candidates
    as often as they stand there; a repeated query is asked once, and different vectors under
    one id are one query each. A missing id comes last in ties, and rows without ids are not told
    apart from each other as queries. Other columns, whatever their names, are not looked at; an
    empty table gives no rows.

    Every query meets every block, in cells of bounded size: up to ``GROUP`` rows and ``SECTION``
    queries. That product is the work that an exact search over a share of all rows asks for.
    Cells send k rows a query; of these, Spark keeps k a query and task before it shuffles.
    """
    spark = rows.sparkSession
    numbers = whole_numbers(rows, id_col, vector_col, scale)
    n = max(1, rows.count())
    n_queries = rows.filter(wanted).count()
    groups = -(-n // GROUP)
    # A query goes on from the best of the blocks before: tasks differ by queries first, then by rows.
    spread = min(2 * spark.sparkContext.defaultParallelism, -(-n_queries // (2 * QUERIES)))
    sections = max(1, spread, -(-n_queries // SECTION))
    queries = whole_numbers(rows.filter(wanted), id_col, vector_col, scale).withColumn("query_hash", F.xxhash64("id", "vector")).distinct()
    asked = queries.mapInArrow(_packed, PACKED).select(
        "*", F.pmod("place", F.lit(sections)).alias("section"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")
    )
    listed = numbers.mapInArrow(_packed, PACKED).select(
        "*", F.pmod("place", F.lit(groups)).cast("int").alias("group"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(sections - 1).cast("long"))).alias("section")
    )
    cells = asked.groupBy("group", "section").cogroup(listed.groupBy("group", "section")).applyInArrow(_searched(k), FOUND)
    in_order = Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), "vec_id")
    best = cells.withColumn("rank", F.row_number().over(in_order)).filter(F.col("rank") <= k)
    known = [F.nullif(F.col(c), F.lit(NO_ID)).alias(c) for c in ("query_id", "vec_id")]
    return best.select(known[0], "rank", known[1], "score")
