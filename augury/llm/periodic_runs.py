"""Periodic runs of words, by longest common extensions from suffix trees.

For the word sequence and for its reversal Ukkonen's suffix tree is built. An Euler tour of a
tree, kept as the leaves in order and the depth of the lowest common ancestor between each two
neighbours, answers "how far do the sequences from i and from j agree" by one range minimum of
a sparse table, in constant time. A run's Lyndon root starts somewhere at a position whose
longest Lyndon word, under the order of words or under the reversed order, is that root; the
longest Lyndon word at i ends where the next smaller suffix starts, which the tour's ranks
tell. So there are two candidates a position; each is extended to the right by the tree, to
the left by the reversal's tree, and is a run if it comes out long enough.

Four consecutive words of a run, beyond its first period, were seen one period before. So only
stretches where each such group was last seen (by a hash, which errs to one side only) within
a third of the stretch's length are given trees, with what precedes them by a third; where
these overlap they are one. No run is lost or cut by that, and in a run nothing is skipped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from augury.llm.shared import rows_of

LEAST_WORDS, LEAST_PERIODS = 6, 4
#: No distance: no stretch is as long.
_FAR = 1 << 56
_MIX = np.uint64(0x9E3779B97F4A7C15)
RUNS = "array<struct<start:long,length:long,period:long>>"


class SuffixTree:
    """Ukkonen's tree of a sequence of numbers from 1 on; 0 is put at its end.

    Memory is some 500 bytes a number; time is linear but for the sort of the edges.
    """

    def __init__(self, sequence: list[int]):
        s = [*sequence, 0]
        n, width = len(s), max(s) + 1
        start, stop, link, parent = [0], [0], [0], [0]
        edges: dict[int, int] = {}
        leaves = []
        node = edge = length = pending = 0
        for i, c in enumerate(s):
            pending += 1
            last = 0
            while pending:
                if not length:
                    edge = i
                key = node * width + s[edge]
                below = edges.get(key)
                if below is None:
                    edges[key] = len(start)
                    leaves.append(len(start))
                    start.append(i), stop.append(n), link.append(0), parent.append(node)
                    if last:
                        link[last] = node
                        last = 0
                else:
                    end = stop[below]
                    own = (end if end <= i else i + 1) - start[below]
                    if length >= own:
                        edge += own
                        length -= own
                        node = below
                        continue
                    at = start[below] + length
                    if s[at] == c:
                        length += 1
                        if last:
                            link[last] = node
                        break
                    split = len(start)
                    edges[key] = split
                    start.append(start[below]), stop.append(at), link.append(0), parent.append(node)
                    edges[split * width + s[at]] = below
                    start[below] = at
                    parent[below] = split
                    edges[split * width + c] = split + 1
                    leaves.append(split + 1)
                    start.append(i), stop.append(n), link.append(0), parent.append(split)
                    if last:
                        link[last] = split
                    last = split
                pending -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - pending + 1
        self.n, self.width, self.parent = n, width, parent
        self.lengths = [b - a for a, b in zip(start, stop)]
        self.suffix = dict(zip(leaves, range(n)))
        self.keys = np.fromiter(edges.keys(), np.int64, len(edges))
        self.below = np.fromiter(edges.values(), np.int64, len(edges))

    def tour(self, backwards: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in order, and the depth at which each parts from the one in front.

        ``backwards`` takes the numbers in reversed order; the end stays the least.
        """
        node, number = np.divmod(self.keys, self.width)
        if backwards:
            number = np.where(number > 0, self.width - number, 0)
        order = np.lexsort((-number, node))  # the least child lies on top of the stack
        children = self.below[order].tolist()
        bounds = np.searchsorted(node[order], np.arange(len(self.parent) + 1)).tolist()
        depth, parent, lengths = [0] * len(self.parent), self.parent, self.lengths
        suffixes, common = [], []
        stack, after_leaf = [0], False
        while stack:
            v = stack.pop()
            above = depth[parent[v]]
            if after_leaf:
                common.append(above)
            a, b = bounds[v], bounds[v + 1]
            after_leaf = a == b
            if after_leaf:
                suffixes.append(self.suffix[v])
            else:
                depth[v] = above + lengths[v]
                stack += children[a:b]
        return np.array(suffixes, np.int64), np.array(common, np.int64)


class CommonExtension:
    """How many numbers agree from i and from j on, for arrays of pairs."""

    def __init__(self, suffixes: np.ndarray, common: np.ndarray):
        self.rank = np.empty(len(suffixes), np.int64)
        self.rank[suffixes] = np.arange(len(suffixes))
        self.levels = [common.astype(np.int32)]
        step = 1
        while 2 * step <= len(common):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = np.minimum(self.rank[i], self.rank[j]), np.maximum(self.rank[i], self.rank[j])
        level = np.frexp((b - a).astype(float))[1] - 1
        out = np.zeros(len(a), np.int64)
        for k in np.unique(level).tolist():
            at = level == k
            table = self.levels[k]
            out[at] = np.minimum(table[a[at]], table[b[at] - (1 << k)])
        return out


def _next_smaller(rank: list[int]) -> np.ndarray:
    """For each position the next one whose suffix is smaller; the last has none."""
    out, stack = [0] * (len(rank) - 1), []
    for j, r in enumerate(rank):
        while stack and rank[stack[-1]] > r:
            out[stack.pop()] = j
        stack.append(j)
    return np.array(out, np.int64)


def runs_of(sequence: list[int], least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> np.ndarray:
    """Rows (start, length, period) of a sequence of numbers from 1 on, in this order."""
    n = len(sequence)
    tree = SuffixTree(sequence)
    suffixes, common = tree.tour()
    right = CommonExtension(suffixes, common)
    backward_rank = np.empty(n + 1, np.int64)
    backward_rank[tree.tour(backwards=True)[0]] = np.arange(n + 1)
    left = CommonExtension(*SuffixTree(sequence[::-1]).tour())
    found = []
    for rank in (right.rank, backward_rank):
        j = _next_smaller(rank.tolist())
        i = np.arange(n)
        period = j - i
        stop = j + right(i, j)
        start = i.copy()
        inner = i > 0
        start[inner] -= left(n - i[inner], n - j[inner])
        length = stop - start
        fits = (length >= least) & (length >= periods * period)
        found.append(np.stack([start, length, period], axis=1)[fits])
    both = np.concatenate(found)
    # One run has a root in one order at most; several of its positions find it.
    return np.unique(both, axis=0)


def _looked_at(least: int, periods: int) -> int:
    """How many words are compared at a time: every run holds as many beyond its first period."""
    return min(4, min(max(least - q, (periods - 1) * q) for q in range(1, least + 1)))


def last_seen(words: list, size: int) -> np.ndarray:
    """For each group of ``size`` words how far back it was last seen, by hash; far if never."""
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    n = len(words) - size + 1
    group = hashes[:n].copy()
    for k in range(1, size):
        group = group * _MIX + hashes[k : k + n]
    order = np.argsort(group, kind="stable")
    again = np.flatnonzero(group[order[1:]] == group[order[:-1]])
    seen = np.full(n, _FAR, np.int64)
    seen[order[again + 1]] = order[again + 1] - order[again]
    return seen


def _bounds(ok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(ok.astype(np.int8), prepend=0, append=0))
    return edge[::2], edge[1::2]


def stretches(seen: np.ndarray, size: int, periods: int = LEAST_PERIODS) -> list[tuple[int, int]]:
    """Where runs can lie, as (start, stop) of words, by how far back each group was seen."""
    beyond = periods - 1
    ok = seen * beyond <= len(seen) + size - 1
    while ok.any():
        first, last = _bounds(ok)
        allowed = np.zeros(len(seen), np.int64)
        allowed[ok] = np.repeat(last - first + size - 1, last - first)
        fewer = ok & (seen * beyond <= allowed)
        settled = np.count_nonzero(fewer) * 8 >= np.count_nonzero(ok) * 7  # the rest is not worth another look
        ok = fewer
        if settled:
            break
    out: list[tuple[int, int]] = []
    for a, b in zip(*(x.tolist() for x in _bounds(ok))):
        b += size - 1
        a = max(0, a - (b - a) // beyond)
        while out and out[-1][1] > a:
            a = min(a, out.pop()[0])
        out.append((a, b))
    return out


def runs_in_words(words: list, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """All runs of a list of words as (start, length, period), by start, then period."""
    if len(words) < least:
        return []
    size = _looked_at(least, periods)
    out = []
    for a, b in stretches(last_seen(words, size), size, periods):
        numbers: dict = {}
        part = [numbers.setdefault(w, len(numbers) + 1) for w in words[a:b]]
        out += [(a + s, length, period) for s, length, period in runs_of(part, least, periods).tolist()]
    return sorted(out, key=lambda run: (run[0], run[2]))


def without_repeats(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words that no run holds beyond its first period."""
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    keep = np.flatnonzero(np.cumsum(gone[:-1]) == 0)
    return [words[i] for i in keep.tolist()]


def _found(least: int, periods: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, runs, texts = [], [], []
            for text in batch.column("text"):
                words = (text.as_py() or "").encode().split()  # at the six ASCII spaces only
                own = runs_in_words(words, least, periods)
                count.append(len(words))
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in own])
                texts.append(b" ".join(without_repeats(words, own) if own else words))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            columns = [batch.column("doc_id"), pa.array(count, pa.int64()), pa.array(runs, kind)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"]
            )

    return run


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    least: int = LEAST_WORDS, periods: int = LEAST_PERIODS,
) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` per row of ``docs``.

    Words are runs of characters other than space and 0x09 to 0x0D, numbered from 0. ``runs``
    has (start, length, period) of each stretch with that smallest period that no word beside
    it extends and that is at least ``least`` words and ``periods`` periods long, by start,
    then period. ``collapsed`` has the words that no run holds beyond its first period,
    joined by one space.

    Null and blank texts have no words, no runs and an empty ``collapsed``. Ids, null ones too,
    and repeated rows pass through as they are; other columns, whatever their names, are not
    looked at; an empty table gives no rows. One narrow stage: memory follows the longest text
    (about a kilobyte for each word of its longest stretch), never the number of rows.
    """
    if least < 2 or periods < 2:
        raise ValueError("a run has at least two periods and two words")
    rows = rows_of(docs, id_col, text_col).withColumnRenamed(text_col, "text")
    return rows.mapInArrow(_found(least, periods), f"doc_id long, n_words long, runs {RUNS}, collapsed string")
