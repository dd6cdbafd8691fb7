"""What the operators have in common: written tables, bounded bit maps, rows without extra columns."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from augury.bitmaps import packed_bits
from augury.session import fresh_folder

MAP_BITS = 1 << 26


def rows_of(docs: DataFrame, id_col: str, *columns: str, **types: str) -> DataFrame:
    """Only the named columns, by position safe against clashing names; the id comes as ``doc_id``."""
    picked = [docs[id_col].cast("long").alias("doc_id")]
    return docs.select(*picked, *[docs[c].cast(types.get(c, "string")).alias(c) for c in columns])


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the cluster's shared folder and read back: lineage ends there, for good.

    The files are compressed and columnar, so texts take less room than in a checkpoint.
    """
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_KEPT: dict[Hashable, Any] = {}


def kept(name: Hashable, make: Callable[[], Any]) -> Any:
    """What a worker keeps from task to task: one thing, that of the operator that asked last."""
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = make()
    return _KEPT[name]


def forget() -> None:
    """Give back what an earlier operator keeps in this worker, and memory that is free again."""
    _KEPT.clear()
    pa.default_memory_pool().release_unused()


#: Text that a task folds, hashes or lists at a time.
PART_BYTES = 4 << 20


def in_parts(batches: Iterator[pa.RecordBatch], column: str | int, size: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``size`` bytes of a text column, at least one row each.

    A batch has 10,000 rows whatever their lengths are; what is made of its texts takes several
    times their room, in each worker. A batch without rows passes as it is.
    """
    for batch in batches:
        widths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.diff(np.cumsum(widths, dtype=np.int64) // size)) + 1
        ends = [*cuts.tolist(), batch.num_rows]
        for start, end in zip([0, *ends], ends):
            yield batch.slice(start, end - start)


def bit_map(keys: DataFrame, hashed: Column, bits: int = MAP_BITS) -> np.ndarray:
    """A bit for each hash in ``keys``, packed; never more than ``bits`` bits, 8 MB by default.

    The map only saves work: a set bit sends a row on into a join, where equality decides.
    The more keys there are, the more bits are set, and the less it saves.
    """
    return np.frombuffer(packed_bits(keys, hashed, bits), np.uint8)


def in_map(packed: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Which of the hashes (int64, as Spark has them) have their bit set."""
    at = np.mod(hashed.astype(np.int64), np.int64(len(packed) * 8))
    return (packed[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


# --- long vectors of counts, summed over tasks ------------------------------------

BLOCK = 1 << 16
#: Vectors that are added at a time, and how often: enough for 16 million tasks.
FAN_IN, LEVELS = 64, 4
VECTOR = "block int, part int, counts binary"


def vector_rows(counts: np.ndarray) -> pa.RecordBatch:
    """A task's counts, in blocks."""
    part = TaskContext.get().partitionId()
    blocks = [counts[a : a + BLOCK].astype("<u8").tobytes() for a in range(0, len(counts), BLOCK)]
    return pa.RecordBatch.from_arrays(
        [pa.array(range(len(blocks)), pa.int32()), pa.array([part] * len(blocks), pa.int32()), pa.array(blocks, pa.binary())],
        ["block", "part", "counts"],
    )


def _added(table: pa.Table) -> pa.Table:
    total: np.ndarray | int = 0
    for counts in table.column("counts"):
        total = total + np.frombuffer(counts.as_py(), "<u8")
    first = table.slice(0, 1)
    return pa.table({"block": first.column("block"), "part": first.column("part"), "counts": pa.array([total.tobytes()], pa.binary())})


def summed(vectors: DataFrame, length: int) -> np.ndarray:
    """The sum of all tasks' vectors; one vector of a fixed length reaches the driver.

    Vectors are added up in levels, ``FAN_IN`` to a group: a group's blocks take 32 MB however
    many tasks there are.
    """
    sums = vectors
    for _ in range(LEVELS):
        sums = sums.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int"))
        sums = sums.groupBy("block", "part").applyInArrow(_added, VECTOR)
    out = np.zeros(length, np.uint64)
    for row in sums.select("block", "counts").toLocalIterator():
        own = np.frombuffer(bytes(row["counts"]), "<u8")
        out[row["block"] * BLOCK : row["block"] * BLOCK + len(own)] = own
    return out
