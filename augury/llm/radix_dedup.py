"""Exact duplicates by distributed radix partitioning, most significant byte first."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from augury.bitmaps import map_table, meet
from augury.llm.shared import bit_map, forget, in_map, in_parts, rows_of, written
from augury.session import freeze

#: Bytes that the first split looks at; each later one looks at this many times more.
FIRST_BYTES = 64
WIDEN = 4
#: A group of at most this many rows and bytes is split to its end within one task.
LOCAL_ROWS = 256
LOCAL_BYTES = 32 << 20

#: Seed of Spark's ``xxhash64``.
SEED = 42

_HEADS = "doc_id long, head binary, text_sha256 string"
_TEXTS = "head binary, folded binary, members array<long>, text_sha256 string"


def _folded(column: pa.Array) -> pa.Array:
    """A to Z in lower case, nothing else touched; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    return pc.ascii_lower(column).cast(pa.binary())


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()
    for batch in in_parts(batches, "text"):
        texts = _folded(batch.column("text")).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([t[:FIRST_BYTES] for t in texts], pa.binary()),
                pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
            ],
            ["doc_id", "head", "text_sha256"],
        )


def _chosen(packed: np.ndarray):
    """Texts whose first bytes other rows may share; equal ones of a part become one row.

    Its ``members`` are the ids, largest first. The hash of the head picks rows only: a false
    hit is dropped by the join on the head itself.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches, "text"):
            folded = _folded(batch.column("text"))
            heads = [xxhash.xxh64_intdigest(t.as_py(), SEED) for t in pc.binary_slice(folded, 0, FIRST_BYTES)]
            hit = pa.array(in_map(packed, np.array(heads, np.uint64).view(np.int64)))
            coded = folded.filter(hit).dictionary_encode()
            code = coded.indices.to_numpy()
            ids = batch.column("doc_id").filter(hit)
            rank = ids.fill_null(-(2**63)).to_numpy()
            ids = ids.take(pa.array(np.lexsort((-1 - rank, code)), pa.int64()))
            sizes = np.bincount(code, minlength=len(coded.dictionary))
            ends = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
            texts = coded.dictionary.to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([t[:FIRST_BYTES] for t in texts], pa.binary()),
                    coded.dictionary.cast(pa.binary()),
                    pa.ListArray.from_arrays(ends, ids),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                ],
                ["head", "folded", "members", "text_sha256"],
            )

    return run


def split_to_end(texts: list[bytes], start: int) -> Iterator[list[int]]:
    """Groups of equal texts, by splitting on successive bytes; all agree before ``start``."""
    open_groups = [(list(range(len(texts))), start, FIRST_BYTES)]
    while open_groups:
        group, at, width = open_groups.pop()
        if len(group) == 1:
            yield group
            continue
        parts: dict[bytes, list[int]] = {}
        for i in group:
            parts.setdefault(texts[i][at : at + width], []).append(i)
        for key, part in parts.items():
            if len(part) == 1 or len(key) < width:
                yield part
            else:
                open_groups.append((part, at + width, width * WIDEN))


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Split the groups of a task, which lie together, to their ends; name each by its least row."""

    def settled(rows: list[tuple[int, bytes]], start: int) -> Iterator[tuple[int, int]]:
        for part in split_to_end([t for _, t in rows], start):
            least = min(rows[i][0] for i in part)
            yield from ((rows[i][0], least) for i in part)

    def out(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
        uid, group = zip(*pairs) if pairs else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(uid, pa.int64()), pa.array(group, pa.int64())], ["uid", "final"])

    held: list[tuple[int, bytes]] = []
    current, start = None, 0
    for batch in batches:
        done: list[tuple[int, int]] = []
        for gid, uid, text, depth in zip(*(batch.column(c).to_pylist() for c in ("gid", "uid", "folded", "depth"))):
            if gid != current:
                done.extend(settled(held, start))
                held, current, start = [], gid, depth
            held.append((uid, text))
        yield out(done)
    yield out(list(settled(held, start)))


def radix_groups(texts: DataFrame, heads: DataFrame) -> DataFrame:
    """Rows (uid, head, folded) to (uid, final): equal texts, and only they, share ``final``.

    Rows with a head not in ``heads`` are dropped.

    Each level looks at the next bytes, four times as many as the level before. A group that
    is a single row, or whose bytes ended, is done. A small one is done within a task; a large
    one is split again over the cluster. Counts are added up ahead of each shuffle, and the
    joins are ones whose hot keys Spark splits, so a head shared by a third of all rows stays
    spread out.
    """
    least = texts.groupBy("head").agg(
        F.min("uid").alias("gid"), F.count(F.lit(1)).alias("n"), F.sum(F.length("folded")).alias("size")
    )
    # Frozen, so that the join below deals both sides anew and may split a hot head.
    least = freeze(least.join(heads, "head", "left_semi"))
    open_rows = texts.join(least, "head").select(
        "uid", "folded", "gid", "n", "size", F.lit(FIRST_BYTES).alias("depth"),
        (F.length("head") < FIRST_BYTES).alias("ended"),
    )
    results, width, depth = [], FIRST_BYTES * WIDEN, FIRST_BYTES
    local = (F.col("n") <= LOCAL_ROWS) & (F.col("size") <= LOCAL_BYTES)
    open_rows = written(open_rows, "radix")
    while True:
        done = (F.col("n") == 1) | F.col("ended")
        results.append(open_rows.filter(done).select("uid", F.col("gid").alias("final")))
        near = open_rows.filter(~done & local).select("gid", "uid", "folded", "depth")
        near = near.repartition("gid").sortWithinPartitions("gid", "uid")
        results.append(near.mapInArrow(_finish, "uid long, final long"))
        far = open_rows.filter(~done & ~local)
        if far.isEmpty():
            break
        cut = F.substring("folded", depth + 1, width)
        far = far.select("uid", "folded", F.col("gid").alias("outer"), cut.alias("cut"))
        inner = freeze(far.groupBy("outer", "cut").agg(
            F.min("uid").alias("gid"), F.count(F.lit(1)).alias("n"), F.sum(F.length("folded")).alias("size")
        ))
        depth += width
        open_rows = written(
            far.join(inner, ["outer", "cut"]).select(
                "uid", "folded", "gid", "n", "size", F.lit(depth).alias("depth"),
                (F.length("cut") < width).alias("ended"),
            ),
            "radix",
        )
        width *= WIDEN
    out = results[0]
    for more in results[1:]:
        out = out.union(more)
    return out


def radix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A to Z; null is the empty text. Of equal
    texts the row with the largest id stays; a missing id counts as the smallest. Rows that
    repeat an id and its text are rows of one group, of which one stays. Every row takes part,
    with its whole text; an empty table gives an empty result. Other columns are not looked at.

    The first bytes of all texts are counted; a row whose head is its own is alone. The
    remaining texts are split by successive bytes. No digest decides: ``text_sha256`` is output.
    """
    rows = rows_of(docs, id_col, text_col).withColumnRenamed(text_col, "text")
    heads = written(rows.mapInArrow(_heads, _HEADS), "heads")
    shared = freeze(heads.groupBy("head").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("head"))
    packed = bit_map(shared, F.xxhash64("head"))

    alone = heads.join(shared, "head", "left_anti").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256",
    )
    texts = rows.mapInArrow(_chosen(packed), _TEXTS).withColumn("uid", F.monotonically_increasing_id())
    texts = written(texts, "texts")
    finals = radix_groups(texts.select("uid", "head", "folded"), shared)
    several = texts.select("uid", "members", "text_sha256").join(finals, "uid")
    best = F.max(F.struct(F.get("members", F.lit(0)).alias("id"), (-F.col("uid")).alias("uid")))
    groups = several.groupBy("final").agg(best.alias("best"), F.sum(F.size("members")).alias("group_size"))
    several = several.join(groups, "final").select(
        F.posexplode("members").alias("place", "doc_id"), F.col("best.id").alias("keep_id"),
        "group_size", ((-F.col("best.uid")) == F.col("uid")).alias("holds"), "text_sha256",
    )
    return alone.unionByName(
        several.select("doc_id", "keep_id", "group_size", (F.col("holds") & (F.col("place") == 0)).alias("kept"), "text_sha256")
    )


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; of rows that repeat an id and its text, one.

    Rows are told apart by id and digest of the text; rows without an id by the digest alone.
    Only rows that a bit map finds among copies are moved; all others pass where they lie.
    Columns may have any names.
    """
    found = radix_dedup(docs, id_col, text_col).filter("group_size > 1")
    copies = found.groupBy("doc_id", "text_sha256").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    copies = written(copies.filter("not kept or n > 1").withColumn("key", F.xxhash64("doc_id", "text_sha256")), "copies")
    copies = copies.select(*[F.col(c).alias(f"_copy_{c}") for c in copies.columns])
    own = docs[id_col].cast("long")
    digest = F.sha2(F.translate(F.coalesce(docs[text_col].cast("string"), F.lit("")), _UPPER, _LOWER), 256)
    # The whole row as one field, so that no name of its own can clash; the digest is made once a row.
    told = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), own.alias("own"), digest.alias("digest"))
    buckets, hashed = map_table(copies, F.col("_copy_key")), F.xxhash64("own", "digest")
    rows = meet(told, buckets, hashed, "left_semi")
    same = rows["own"].eqNullSafe(copies["_copy_doc_id"]) & (rows["digest"] == copies["_copy_text_sha256"])
    met = rows.join(copies, same, "left")
    unique = met.filter("_copy_kept is null").select("row.*")
    repeated = met.filter("_copy_kept").dropDuplicates(["own", "digest"]).select("row.*")
    return meet(told, buckets, hashed, "left_anti").select("row.*").union(unique).union(repeated)
