"""Scores by cross-entropy difference of two matched n-gram models."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from augury.llm.shared import bit_map, in_map, rows_of, written
from augury.llm.words import blocks, buffer_of, word_hashes

#: A word or pair of words is known to both models if the target has it at least so often.
LEAST_COUNT = 2
#: So many entries, those most frequent in all documents, are sent to the tasks, which add them
#: up where the texts lie. All others are joined: results do not depend on it. With more of them
#: a small corpus has few others, and a larger one many times as many.
HOT = 1 << 14
#: Weight of the one-word model within the two-word model, and of the even one within that.
PAIR_PRIOR = 20.0
WORD_PRIOR = 0.5

#: The key under which all words are counted.
TOTAL = 0
_TARGET_COUNTS = "key long, first long, n long"
_COUNTS = "key long, n long"
_EVENTS = "key long, ref long, head struct<doc_id: long, n_tokens: long, target: double, background: double>"
#: An entry's share of the two losses wherever it occurs, and wherever a word follows it.
_VALUES = ("target_own", "background_own", "target_next", "background_next")


@dataclass(frozen=True)
class Hot:
    """The most frequent entries by key; a column of values for each of ``_VALUES``."""

    keys: np.ndarray
    values: tuple[np.ndarray, ...]

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Where each key stands; -1 where it does not."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)


def _maps(entries: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Two maps of the keys, by different bits of them: few other keys are in both."""
    return bit_map(entries, F.col("key")), bit_map(entries, F.shiftrightunsigned("key", 32))


def _in_maps(maps: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> np.ndarray:
    at = np.flatnonzero(in_map(maps[0], keys))
    return at[in_map(maps[1], (keys[at].view(np.uint64) >> np.uint64(32)).view(np.int64))]


def _pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The hash of a pair, from which and the first word the second one follows."""
    first = first.view(np.uint64)
    return (first << np.uint64(17) | first >> np.uint64(47)).view(np.int64) ^ second


def second_word(key: Column, first: Column) -> Column:
    return key.bitwiseXOR(F.shiftleft(first, 17).bitwiseOR(F.shiftrightunsigned(first, 47)))


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of texts: first row, word hashes, words of each text, place of each pair's first word, pair hashes."""
    data, offsets = buffer_of(batch.column("text"))
    for a, b in blocks(offsets):
        words, per_text = word_hashes(data, offsets[a : b + 1], lower=True)
        words = words.view(np.int64)
        inner = np.ones(len(words), bool)
        inner[np.cumsum(per_text)[per_text > 0] - 1] = False
        at = np.flatnonzero(inner)
        yield a, words, per_text, at, _pair_keys(words[at], words[at + 1])


def _target_counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a block's words and pairs, and of all words. Only pairs have a first word."""
    for batch in batches:
        for _, words, _, at, pairs in _texts(batch):
            single, n = np.unique(words, return_counts=True)
            pair, one, m = np.unique(pairs, return_index=True, return_counts=True)
            none = np.zeros(len(single) + 1, np.int64)
            columns = (
                pa.array(np.concatenate([[TOTAL], single, pair]), pa.int64()),
                pa.array(np.concatenate([none, words[at[one]]]), mask=np.arange(len(none) + len(pair)) < len(none)),
                pa.array(np.concatenate([[len(words)], n, m]), pa.int64()),
            )
            yield pa.RecordBatch.from_arrays(list(columns), ["key", "first", "n"])


def _counted(maps: tuple[np.ndarray, np.ndarray]):
    """Counts of a block's words and pairs that are in the maps, and of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, words, _, _, pairs in _texts(batch):
                keys = np.concatenate([words, pairs])
                key, n = np.unique(keys[_in_maps(maps, keys)], return_counts=True)
                columns = [pa.array(np.append(TOTAL, key), pa.int64()), pa.array(np.append(len(words), n), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "n"])

    return run


def count_entries(target: DataFrame, rows: DataFrame) -> tuple[DataFrame, int, int]:
    """Known words and pairs (key, first, target, background), and the sums of all words.

    A pair that the target has twice has words that it has twice. Counts are added up by task
    before the shuffle; all of them are tables. The second word of a pair follows from its key.
    """
    none = rows.sparkSession.range(1).select(F.lit(TOTAL).cast("long").alias("key"), F.lit(None).cast("long").alias("first"), F.lit(0).cast("long").alias("n"))
    own = target.mapInArrow(_target_counted, _TARGET_COUNTS).unionByName(none).groupBy("key")
    own = own.agg(F.first("first").alias("first"), F.sum("n").alias("target"))
    own = written(own.filter((F.col("target") >= LEAST_COUNT) | (F.col("key") == TOTAL)), "target-counts")
    everywhere = rows.mapInArrow(_counted(_maps(own)), _COUNTS).groupBy("key").agg(F.sum("n").alias("background"))
    counts = written(own.join(everywhere, "key"), "counts")
    total = counts.filter(F.col("key") == TOTAL).select("target", "background").first()
    return counts.filter(F.col("key") != TOTAL), *(total or (0, 0))


def entry_values(counts: DataFrame, target_total: int, background_total: int) -> tuple[DataFrame, tuple[float, float]]:
    """(key, background, ``_VALUES``) of all entries, and the two losses of an unknown word.

    A loss is that of an unknown word behind an unknown one, to which a word adds what its
    own probability changes, and what it changes for the word after it; so does a pair.
    """
    words, pairs = counts.filter("first is null"), counts.filter("first is not null")
    pairs = pairs.withColumn("second", second_word(F.col("key"), F.col("first")))
    size = words.count() + 1
    known = words.agg(F.sum("target").alias("target"), F.sum("background").alias("background")).first()
    values, unknown = {}, []
    for name, total in (("target", target_total), ("background", background_total)):
        whole = total + WORD_PRIOR * size
        word = lambda n, whole=whole: (n + F.lit(WORD_PRIOR)) / F.lit(whole)
        other = (total - (known[name] or 0) + WORD_PRIOR) / whole
        unknown.append(float(-np.log(other)))
        values[name] = (word, other)
    context = pairs.groupBy(F.col("first").alias("key")).agg(*[F.sum(n).alias(f"{n}_context") for n in values])
    own = words.join(context, "key", "left").select(
        "key", "background",
        *[F.log(F.lit(other) / word(F.col(n))).alias(f"{n}_own") for n, (word, other) in values.items()],
        *[F.log((F.coalesce(f"{n}_context", F.lit(0)) + F.lit(PAIR_PRIOR)) / PAIR_PRIOR).alias(f"{n}_next") for n in values],
    )
    second = words.select(F.col("key").alias("second"), *[F.col(n).alias(f"{n}_second") for n in values])
    prior = lambda n, word: F.lit(PAIR_PRIOR) * word(F.col(f"{n}_second"))
    both = pairs.join(second, "second").select(
        "key", "background",
        *[F.log(prior(n, word) / (F.col(n) + prior(n, word))).alias(f"{n}_own") for n, (word, _) in values.items()],
        *[F.lit(0.0).alias(f"{n}_next") for n in values],
    )
    return written(own.unionByName(both), "entries"), tuple(unknown)


def hot_entries(entries: DataFrame) -> Hot:
    """The most frequent entries, ``HOT`` at most, chosen by a small table of how many are how frequent."""
    grade = F.floor(F.log2("background") * 16)
    found, least = 0, None
    for row in sorted(entries.groupBy(grade.alias("grade")).count().collect(), reverse=True):
        found += row["count"]
        if found > HOT:
            break
        least = row["grade"]
    top = entries.filter(F.lit(False) if least is None else grade >= least).select("key", *_VALUES).toArrow().sort_by("key")
    return Hot(top.column("key").to_numpy(), tuple(top.column(c).to_numpy() for c in _VALUES))


def _events(maps: tuple[np.ndarray, np.ndarray], shared, unknown: tuple[float, float]):
    """A row for each text, with what its hot entries add up to, and one for each time that it may have another entry.

    ``ref`` has the row's number, and in its last bit whether a word follows. Texts have a head,
    and their number as key, so that they are spread.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, uid = shared.value, TaskContext.get().partitionId() << 33
        for batch in batches:
            ids = batch.column("doc_id")
            for row, words, per_text, at, pairs in _texts(batch):
                size = len(per_text)
                doc = np.repeat(np.arange(size), per_text)
                follows = np.zeros(len(words), np.int64)
                follows[at] = 1
                keys, of = np.concatenate([words, pairs]), np.concatenate([doc, doc[at]])
                follows = np.append(follows, np.zeros(len(pairs), np.int64))
                kept = _in_maps(maps, keys)
                keys, of, follows = keys[kept], of[kept], follows[kept]
                place = hot.places(keys)
                here = place >= 0
                sums = [
                    loss * per_text
                    + np.bincount(of[here], hot.values[k][place[here]] + follows[here] * hot.values[k + 2][place[here]], minlength=size)
                    for k, loss in enumerate(unknown)
                ]
                keys, of, follows = keys[~here], of[~here], follows[~here]
                own = uid + np.arange(size)
                names = ["doc_id", "n_tokens", "target", "background"]
                heads = pa.StructArray.from_arrays([ids.slice(row, size), pa.array(per_text, pa.int64()), *map(pa.array, sums)], names)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.append(own, keys), pa.int64()),
                        pa.array(np.append(own, uid + of) * 2 + np.append(np.zeros(size, np.int64), follows), pa.int64()),
                        pa.concat_arrays([heads, pa.nulls(len(keys), heads.type)]),
                    ],
                    ["key", "ref", "head"],
                )
                uid += size

    return run


def score_documents(
    docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_tokens, target_loss, background_loss, score`` per row.

    Both models have the same vocabulary, order and smoothing. The target model counts the
    documents in ``target_ids`` (doc_id), the background model all documents; all their words
    count. Losses are per token, in nats; ``score`` is the background's minus the target's:
    the higher, the more a document is like the target. Words are runs of anything but ASCII
    white space, A to Z in lower case.

    Null and empty texts have no tokens and losses and scores of 0. Ids and repeated rows pass
    through. Without target documents both models are flat over unknown words, and scores
    follow the background alone. An empty table gives no rows.

    A word or pair is known if the target has it at least twice, however many there are. Texts
    stay where they lie, but for the target's. Counts and what entries add to losses are tables;
    a bounded number of the most frequent entries is sent to the texts, the others meet the
    documents' words and pairs in a join. They are known by 64 bits of hash. Rows are numbered by
    task and place: the documents' rows come in the same order whenever they are read.
    """
    rows = rows_of(docs, id_col, text_col).withColumnRenamed(text_col, "text")
    wanted = target_ids.select(target_ids["doc_id"].cast("long").alias("doc_id")).dropna().distinct()
    packed = bit_map(wanted, F.xxhash64("doc_id"))

    def maybe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_map(packed, batch.column("hash").to_numpy()))).select(["doc_id", "text"])

    target = rows.withColumn("hash", F.xxhash64("doc_id")).mapInArrow(maybe, "doc_id long, text string")
    counts, *totals = count_entries(target.join(wanted, "doc_id", "left_semi"), rows)
    entries, unknown = entry_values(counts, *totals)
    shared = rows.sparkSession.sparkContext.broadcast(hot_entries(entries))
    events = rows.mapInArrow(_events(_maps(entries), shared, unknown), _EVENTS)

    # Heads go through the join as they are; an event whose key is no entry adds nothing.
    values = entries.select(F.col("key").alias("entry"), *_VALUES)
    met = events.join(values, (F.col("key") == F.col("entry")) & F.col("head").isNull(), "left")
    follows = F.col("ref").bitwiseAND(F.lit(1))
    loss = lambda m: F.coalesce(f"head.{m}", F.col(f"{m}_own") + follows * F.col(f"{m}_next"))
    found = met.groupBy(F.shiftright("ref", 1).alias("uid")).agg(
        F.max("head.doc_id").alias("doc_id"), F.max("head.n_tokens").alias("n_tokens"),
        *[F.sum(loss(m)).alias(m) for m in ("target", "background")],
    )
    loss = lambda m: F.col(m) / F.greatest("n_tokens", F.lit(1))
    found = found.select("doc_id", "n_tokens", loss("target").alias("target_loss"), loss("background").alias("background_loss"))
    return found.withColumn("score", F.col("background_loss") - F.col("target_loss"))
