"""Self-join of documents on the Jaccard similarity of their word shingles, by vertical partitioning."""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from augury.bitmaps import map_table, meet
from augury.llm.graph import components
from augury.llm.shared import VECTOR, bit_map, forget, in_map, in_parts, rows_of, summed, vector_rows, written
from augury.llm.words import SHINGLE, mixed, text_shingles
from augury.session import freeze

PERCENT = 75
#: Counters of how often shingles occur. A larger corpus fills them; the order then says less,
#: and the join sees more candidates, but no pair is lost.
COUNTERS = 1 << 20
#: The global order is cut into so many fragments of equal weight.
FRAGMENTS = 8
_HASH_BITS = 58
#: Shingles of sets that a task turns into rows at a time, in bytes.
POSTING_BYTES = 1 << 20
#: Numbers of a sketch. Long sets fill it; it then rules out less, but no pair is lost.
_SKETCH = tuple(f"sketch{k}" for k in range(4))

_HEAD = "doc_id long, key long, n long, node long, rare long, last long, tokens binary"


# --- the global order ---------------------------------------------------------


@dataclass(frozen=True)
class Order:
    """Shingles in order: rarer ones first, equally frequent ones by their hash.

    A shingle's number has its frequency class (the logarithm of its counter) in the top bits
    and its hash below. ``pivots`` cut the numbers into fragments that hold equally many
    occurrences.
    """

    classes: np.ndarray
    pivots: np.ndarray

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The sorted numbers of a set of shingles."""
        found = self.classes[(hashes >> np.uint64(44)).astype(np.int64)].astype(np.uint64)
        return np.sort(found << np.uint64(_HASH_BITS) | hashes >> np.uint64(64 - _HASH_BITS))


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each counter's shingles occur in this task's documents."""
    forget()
    counts = np.zeros(COUNTERS, np.uint32)
    for batch in in_parts(batches, "text"):
        held, size = [], 0
        for own in text_shingles(batch.column("text")):
            held.append(own)
            size += len(own)
            if size > COUNTERS:
                counts += np.bincount((np.concatenate(held) >> np.uint64(44)).astype(np.int64), minlength=COUNTERS).astype(np.uint32)
                held, size = [], 0
        if held:
            counts += np.bincount((np.concatenate(held) >> np.uint64(44)).astype(np.int64), minlength=COUNTERS).astype(np.uint32)
    yield vector_rows(counts)


def global_order(rows: DataFrame) -> Order:
    """Count every shingle of every document; what comes back is one number per counter."""
    counts = summed(rows.mapInArrow(_tally, VECTOR), COUNTERS)
    classes = np.minimum(np.log2(counts.astype(np.float64) + 1), 31).astype(np.uint8)
    weight = np.bincount(classes, counts.astype(np.float64), minlength=64)
    ends = np.cumsum(weight)
    pivots = []
    for k in range(1, FRAGMENTS):
        want = ends[-1] * k / FRAGMENTS
        level = int(np.searchsorted(ends, want))
        inside = (want - (ends[level] - weight[level])) / max(weight[level], 1.0)
        pivots.append((level << _HASH_BITS) + int(min(max(inside, 0.0), 0.999999) * (1 << _HASH_BITS)))
    return Order(classes, np.array(pivots, np.uint64))


# --- sets, prefixes, segments ---------------------------------------------------


def prefix_length(n: int, percent: int) -> int:
    """So many of the first shingles: two similar sets share at least one of them."""
    return n - -(-n * percent // 100) + 1 if n else 0


def _node(numbers: np.ndarray) -> int:
    """One number for a whole set."""
    total = mixed(numbers ^ np.uint64(0x5BF03635F0A31B5D)).sum(dtype=np.uint64)
    return int(mixed(np.array([total + np.uint64(len(numbers))], np.uint64)).view(np.int64)[0])


def _heads(order, percent: int, size: int):
    """Each document's set: its size, its number, and its first shingles in the global order.

    ``rare`` tells how rare its shingles are on average. Of many near copies, the text they were
    made from has the least: what they changed is theirs alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches, "text"):
            n, node, rare, last, tokens = [], [], [], [], []
            for own in text_shingles(batch.column("text"), size=size):
                numbers = order.value.numbers(own)
                first = numbers[: prefix_length(len(numbers), percent)]
                n.append(len(numbers))
                node.append(_node(numbers))
                common = (numbers >> np.uint64(_HASH_BITS)).sum(dtype=np.uint64)
                rare.append(-int(common) * 1000 // max(1, len(numbers)))
                last.append(int(first[-1:].view(np.int64)[0]) if len(first) else 0)
                tokens.append(first.tobytes())
            kept = [batch.column("doc_id"), batch.column("key")]
            columns = [*[pa.array(c, pa.int64()) for c in (n, node, rare, last)], pa.array(tokens, pa.binary())]
            yield pa.RecordBatch.from_arrays([*kept, *columns], ["doc_id", "key", "n", "node", "rare", "last", "tokens"])

    return run


def _postings(packed: np.ndarray | None):
    """A row for each of a set's first shingles; of equal sets in a batch one is enough.

    They leave in parts: a batch of 10,000 sets has a million and more.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, at = np.unique(batch.column("node").to_numpy(), return_index=True)
            for part in in_parts([batch.take(pa.array(at))], "tokens", POSTING_BYTES):
                sizes = pc.binary_length(part.column("tokens")).to_numpy().astype(np.int64) // 8
                tokens = np.frombuffer(b"".join(part.column("tokens").to_pylist()), np.int64)
                columns = {"token": tokens} | {
                    name: np.repeat(part.column(name).to_numpy(), sizes)
                    for name in (("node", "rare", "n") if packed is None else ("node", "n", "last"))
                }
                if packed is not None:
                    columns["at"] = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                    keep = in_map(packed, tokens)
                    columns = {name: c[keep] for name, c in columns.items()}
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))

    return run


def _segments(order, packed: np.ndarray, size: int):
    """Whole sets of the rows asked for, cut into the fragments of the order; a task gives each set once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in in_parts(batches, "text"):
            batch = batch.filter(pa.array(in_map(packed, batch.column("key").to_numpy())))
            nodes, fragment, tokens = [], [], []
            for own in text_shingles(batch.column("text"), size=size):
                numbers = order.value.numbers(own)
                node = _node(numbers)
                if node in seen:
                    continue
                seen.add(node)
                cuts = np.searchsorted(numbers, order.value.pivots)
                for k, part in enumerate(np.split(numbers, cuts)):
                    if len(part):
                        nodes.append(node)
                        fragment.append(k)
                        tokens.append(part.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(fragment, pa.int32()), pa.array(tokens, pa.binary())],
                ["node", "fragment", "tokens"],
            )

    return run


def _partial_overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many shingles two sets share within a fragment."""
    for batch in batches:
        shared = []
        for left, right in zip(batch.column("left"), batch.column("right")):
            x, y = np.frombuffer(left.as_py(), np.uint64), np.frombuffer(right.as_py(), np.uint64)
            if len(x) > len(y):
                x, y = y, x
            at = np.searchsorted(y, x)
            at[at == len(y)] = 0
            shared.append(int((y[at] == x).sum()))
        kept = [batch.column(c) for c in ("x", "y", "n_x", "n_y", "fragment")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(shared, pa.int64())], ["x", "y", "n_x", "n_y", "fragment", "shared"])


def verified(rows: DataFrame, nodes: DataFrame, pairs: DataFrame, order, percent: int, size: int) -> DataFrame:
    """Those pairs (x, y, n_x, n_y) of nodes whose sets are similar enough, as links (a, b).

    The sets of all nodes in pairs are made again from one of their rows' texts, cut into
    fragments; the overlaps of a pair are counted fragment by fragment, then summed. A node in
    many pairs is a hot key of joins that Spark splits.
    """
    wanted = pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct()
    packed = bit_map(nodes.select("node", F.col("least.key").alias("key")).join(wanted, "node"), F.col("key"))
    segments = rows.mapInArrow(_segments(order, packed, size), "node long, fragment int, tokens binary")
    # Rows that repeat id and text give their set once a task; the pairs meet it once.
    segments = written(segments.dropDuplicates(["node", "fragment"]), "segments")
    left = segments.select(F.col("node").alias("x"), "fragment", F.col("tokens").alias("left"))
    right = segments.select(F.col("node").alias("y"), "fragment", F.col("tokens").alias("right"))
    cut = pairs.withColumn("fragment", F.explode(F.array(*[F.lit(k) for k in range(FRAGMENTS)])))
    both = cut.join(left, ["x", "fragment"]).join(right, ["y", "fragment"])
    both = both.select("x", "y", "n_x", "n_y", "fragment", "left", "right")
    counted = both.mapInArrow(_partial_overlaps, "x long, y long, n_x long, n_y long, fragment int, shared long")
    total = counted.groupBy("x", "y", "n_x", "n_y").agg(F.sum("shared").alias("shared"))
    enough = 100 * F.col("shared") >= percent * (F.col("n_x") + F.col("n_y") - F.col("shared"))
    return total.filter(enough).select(F.col("x").alias("a"), F.col("y").alias("b"))


# --- the join -------------------------------------------------------------------


def _ratio(a: str, b: str, percent: int):
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _sketch(column: str) -> list[Column]:
    """Aggregates that set a bit for each value of a column, 64 bits to a number."""
    hashed = F.xxhash64(column)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(hashed, F.lit(64)).cast("int"))
    word = F.pmod(F.floor(hashed / 64), F.lit(len(_SKETCH)))
    return [F.bit_or(F.when(word == k, bit).otherwise(F.lit(0).cast("long"))).alias(name) for k, name in enumerate(_SKETCH)]


def _missing(a: str, b: str) -> Column:
    """How many bits of one side's sketch the other lacks: so many of its values at least."""
    return reduce(operator.add, [F.bit_count(F.col(f"{s}_{a}").bitwiseAND(F.bitwise_not(F.col(f"{s}_{b}")))) for s in _SKETCH])


def crossing_rows(open_hits: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y, n_x, n_y) of nodes in different components that may be similar, once or more each.

    ``open_hits`` has the places of first shingles that stand in several components, with the
    shingle's largest component (token, top, node, n, last, at, component).
    """
    # How many of its first shingles a node can share with another component at most, and their bits.
    sketches = freeze(open_hits.groupBy("node").agg(F.count(F.lit(1)).alias("chances"), *_sketch("token")))
    met = open_hits.join(sketches, "node")
    sides = ("node", "n", "last", "at", "component", "chances", *_SKETCH)
    l = met.filter("component <> top").select("token", *[F.col(c).alias(f"{c}_l") for c in sides])
    r = met.select("token", "top", *[F.col(c).alias(f"{c}_r") for c in sides])
    needed = F.ceil((F.col("n_l") + F.col("n_r")) * percent / (100 + percent) - 1e-9)
    # The first shingle that two sets share has all others behind it, in both. A pair needs to meet there only.
    early = F.least(F.col("n_l") - F.col("at_l"), F.col("n_r") - F.col("at_r")) >= needed
    # Whichever first part ends earlier in the order shares no more of itself than the open shingles
    # whose bits the other has too, and of its other part no more than all.
    rest = lambda n: F.floor(F.col(n) * percent / 100 + 0.999) - 1
    alike = F.least(F.col("chances_l") - _missing("l", "r"), F.col("chances_r") - _missing("r", "l"))
    at_most = alike + F.when(F.col("last_l") <= F.col("last_r"), rest("n_l")).otherwise(rest("n_r"))
    crossing = l.join(r, "token").filter(
        (F.col("component_l") != F.col("component_r"))
        & ((F.col("component_r") == F.col("top")) | (F.col("node_l") < F.col("node_r")))
        & _ratio("n_l", "n_r", percent)
        & early
        & (at_most >= needed)
    )
    turn = F.col("node_l") < F.col("node_r")
    one = lambda c: F.when(turn, F.col(f"{c}_l")).otherwise(F.col(f"{c}_r"))
    two = lambda c: F.when(turn, F.col(f"{c}_r")).otherwise(F.col(f"{c}_l"))
    return crossing.select(one("node").alias("x"), two("node").alias("y"), one("n").alias("n_x"), two("n").alias("n_y"))


def grouped(docs: DataFrame, percent: int, size: int, id_col: str, text_col: str) -> DataFrame:
    """One row per input row: ``doc_id, key, n_shingles, component_id, least``.

    ``key`` is ``xxhash64`` of the id and the text; ``least`` holds for the rows whose id is the
    smallest of their component (without any id: whose key is), and for rows linked with nothing.
    """
    rows = rows_of(docs, id_col, text_col).withColumnRenamed(text_col, "text")
    rows = rows.withColumn("key", F.xxhash64("doc_id", "text"))
    order = rows.sparkSession.sparkContext.broadcast(global_order(rows))
    heads = written(rows.mapInArrow(_heads(order, percent, size), _HEAD), "heads")
    some = heads.filter("n > 0")
    first_row = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("least")
    nodes = written(some.groupBy("node").agg(first_row, F.first("n").alias("n")), "nodes")

    shared = written(
        some.mapInArrow(_postings(None), "token long, node long, rare long, n long").groupBy("token")
        .agg(F.min(F.struct("rare", "node", "n")).alias("least"), F.count(F.lit(1)).alias("rows"))
        .filter("rows > 1").select("token", F.col("least.node").alias("least"), F.col("least.n").alias("n_least")),
        "shared",
    )
    packed = bit_map(shared, F.col("token"))
    hits = written(
        some.mapInArrow(_postings(packed), "token long, node long, n long, last long, at long"), "hits"
    )

    star = hits.join(shared, "token").filter((F.col("node") != F.col("least")) & _ratio("n", "n_least", percent))
    star = star.groupBy(F.col("least").alias("x"), F.col("node").alias("y"), F.col("n_least").alias("n_x"), F.col("n").alias("n_y"))
    star = star.agg(F.count(F.lit(1)).alias("common")).filter(32 * F.col("common") >= F.col("n_y"))
    # With the one it shares most with: a second leader would mostly say the same.
    star = star.groupBy("y", "n_y").agg(F.max(F.struct("common", "x", "n_x")).alias("best"))
    star = written(star.select("best.x", "y", "best.n_x", "n_y"), "star")
    links = written(verified(rows, nodes, star, order, percent, size), "links")
    labels = freeze(
        nodes.select("node").join(components(links), "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    )

    # Only shingles that stand in several components can bring two of them together.
    labelled = hits.join(labels, "node")
    tops = labelled.groupBy("token", "component").agg(F.count(F.lit(1)).alias("n")).groupBy("token")
    tops = tops.agg(F.max(F.struct("n", "component"))["component"].alias("top"), F.count(F.lit(1)).alias("parts"))
    tops = freeze(tops.filter("parts > 1").select("token", "top"))
    open_hits = written(labelled.join(tops, "token").dropDuplicates(["token", "node"]), "open")
    crossing = written(crossing_rows(open_hits, percent).distinct(), "crossing")
    more = written(verified(rows, nodes, crossing, order, percent, size), "more")

    last = nodes.select("node", "least").join(components(links.union(more)), "node", "left")
    last = freeze(last.select("node", "least", F.coalesce("component", "node").alias("component")))
    best = last.groupBy("component").agg(F.min("least").alias("best"))
    named = freeze(last.join(best, "component").select("node", "best"))
    least = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("key") == F.col("best.key"))
    empty = heads.filter("n = 0").select(
        "doc_id", "key", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(True).alias("least")
    )
    return some.select("doc_id", "key", "n", "node").join(named, "node").select(
        "doc_id", "key", F.col("n").alias("n_shingles"), F.col("best.doc_id").alias("component_id"), least.alias("least")
    ).union(empty)


def similar_documents(
    docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id``.

    A document's set has the distinct runs of ``size`` words, A to Z in lower case; with fewer
    words, the run of all; without words, or with a null text, it is empty and linked with
    nothing. Two documents link when they share at least ``percent`` of their sets' union, and
    ``component_id`` is the smallest id that links reach. Rows without an id are documents of
    their own and no one's smallest id unless all are missing; so are rows that repeat an id
    with another text. An empty table gives no rows; other columns are not looked at.

    * Shingles are counted over all documents, which gives the global order, rare ones first.
    * Equal sets are one node, and everything up to the result is named by nodes. Two similar
      sets share one of their first shingles in the order.
    * First, every node is compared with one leader: of each shingle it shares, the node whose
      shingles are the most common is a candidate, and the one it shares most with is taken.
      Most links are found so, however many copies there are, and become components.
    * Then whoever is not in a shingle's largest component is compared with the nodes of other
      components there, unless the shared part of their first shingles rules it out: by its
      place (a pair must meet at the first shingle it shares, and too few may be left behind
      that), or because too few of a node's first shingles stand in another component at all
      or, by a sketch of 256 bits, in the other set.
      A pair in one component needs no comparison, so no group is expanded into all its pairs,
      and no pair in different components is left out.

    Shingles and sets are known by 58 and 64 bits of hash: a pair of a billion sets is confused
    with a probability of about 3 %.
    """
    return grouped(docs, percent, size, id_col, text_col).select("doc_id", "n_shingles", "component_id")


def one_of_each_group(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose id is the smallest of their component, with all their columns.

    In a component without any id, the row whose id and text have the smallest hash stays. Rows
    that repeat an id and its text stay or go together. Rows that share no hash with one to be
    dropped, by a bit map, pass without a shuffle.
    """
    found = written(grouped(docs, percent, SHINGLE, id_col, text_col).filter("not least").select("doc_id", "key").distinct(), "dropped")
    gone = found.select(F.col("doc_id").alias("_gone_id"), F.col("key").alias("_gone_key"))
    own_id, own_text = docs[id_col].cast("long"), docs[text_col].cast("string")
    # The whole row as one field, so that no name of its own can clash.
    told = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), own_id.alias("own"), F.xxhash64(own_id, own_text).alias("hash"))
    buckets = map_table(gone, F.col("_gone_key"))
    looked_at = meet(told, buckets, F.col("hash"), "left_semi")
    same = looked_at["own"].eqNullSafe(gone["_gone_id"]) & (looked_at["hash"] == gone["_gone_key"])
    kept = looked_at.join(gone, same, "left_anti")
    return meet(told, buckets, F.col("hash"), "left_anti").union(kept).select("row.*")
