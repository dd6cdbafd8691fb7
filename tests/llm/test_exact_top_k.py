"""Top-k against brute force, and how the reading stops."""

import math
import random

import numpy as np

from augury.llm import exact_top_k as module
from augury.llm.exact_top_k import Best, Block, exact_top_k, search

SCHEMA = "vec_id long, embedding array<float>, score long, rank string"


def whole(vector):
    return [min(max(math.floor(256 * float(np.float32(x))), -(1 << 23)), 1 << 23) for x in vector]


def brute(rows, wanted, k=5):
    fit = [(i, whole(v)) for i, v, *_ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for own, q in sorted({(i, tuple(v)) for i, v in fit if i is not None and wanted(i)}):
        last = [(-sum(a * b for a, b in zip(q, v)), i is None, i) for i, v in fit if i != own]
        last = sorted(last, key=lambda x: (x[0], x[1], x[2] or 0))[:k]
        out += [(own, n, i, -s) for n, (s, _, i) in enumerate(last, 1)]
    return sorted(out, key=str)


def found(spark, rows, k=5):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)
    return sorted(map(tuple, exact_top_k(df, df["vec_id"] % 50 == 0, k).collect()), key=str)


def test_equals_brute_force_with_ties_nulls_and_odd_lengths(spark):
    r = random.Random(1)
    rows = [(i, [r.gauss(0, 0.2) for _ in range(8)]) for i in range(300)]
    rows += [(i, [0.5] * 8) for i in range(300, 420)]  # very many equal rows, a query among them
    rows += [(1000, None), (1050, [0.1, None]), (1100, [float("nan")] * 8), (1150, [float("inf"), 1.0]), (2000, [0.0] * 8), (2050, []),
             (2100, [1.0, 2.0]), (2101, [0.3] * 11), (2150, [1e30, -1e30] + [0.0] * 6), (None, [0.5] * 8), (50, [0.25] * 8), rows[7], rows[100]]
    assert found(spark, rows) == brute(rows, lambda i: i % 50 == 0)
    assert found(spark, rows, k=1) == brute(rows, lambda i: i % 50 == 0, 1)


def test_cells_of_queries_and_groups(spark, monkeypatch):
    """Many groups and sections give what one gives."""
    for name, value in (("BLOCK", 16), ("GROUP", 32), ("SECTION", 2)):
        monkeypatch.setattr(module, name, value)
    r = random.Random(3)
    rows = [(i, [r.gauss(0, 0.3) for _ in range(6)]) for i in range(401)]
    assert found(spark, rows) == brute(rows, lambda i: i % 50 == 0)


def test_fewer_rows_than_asked_for(spark):
    assert found(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 256 * 512)]
    assert found(spark, [(0, [1.0])]) == []
    assert found(spark, []) == []


def block_of(vectors):
    return Block(np.arange(len(vectors)), vectors, np.argsort(vectors.T, axis=1, kind="stable").astype(np.uint16))


def test_reading_stops_when_outsiders_cannot_qualify():
    r = np.random.default_rng(5)
    vectors = r.integers(-20, 20, (4000, 16)).astype(np.int32)
    vectors[:6] = 200 - np.arange(6)[:, None]
    block, best = block_of(vectors), Best(5)
    read = search(block, 0, vectors[0].astype(np.int64), best)
    assert best.ids.tolist() == [1, 2, 3, 4, 5] and read < 4000 / 2
    # A later block is read no deeper than the best so far asks for.
    poor = block_of(r.integers(-20, 20, (4000, 16)).astype(np.int32))
    assert search(poor, -1, vectors[0].astype(np.int64), best) == 250
    assert best.ids.tolist() == [1, 2, 3, 4, 5]
