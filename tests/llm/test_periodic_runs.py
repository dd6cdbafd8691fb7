"""Runs against brute force: every period, every start."""

import hashlib
import random
import re
import zlib

import pytest

from augury.llm import queries
from augury.llm.periodic_runs import periodic_runs, runs_in_words, runs_of, without_repeats

from .conftest import SMALL


def brute(words, least=6, periods=4):
    n, found = len(words), []
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, periods * q):
                part = words[i : i + length]
                if all(any(x != y for x, y in zip(part, part[p:])) for p in range(1, q)):
                    found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("least, periods", [(6, 4), (2, 2), (4, 3)])
def test_runs_equal_brute_force(least, periods):
    r = random.Random(least)
    for _ in range(1500):
        letters = r.choice([1, 2, 3, 6])
        words = [r.randint(1, letters) for _ in range(r.randint(0, 50))]
        if words and r.random() < 0.6:
            a, p = r.randrange(len(words)), r.randint(1, 9)
            words += (words[a : a + p] * 9)[: r.randint(1, 60)] + [r.randint(1, letters + 3) for _ in range(r.randint(0, 9))]
        assert runs_in_words(words, least, periods) == brute(words, least, periods)


def test_stretches_lose_nothing_that_trees_of_all_words_find():
    r = random.Random(2)
    for _ in range(60):
        words = [r.randint(1, 40) for _ in range(r.randint(10, 400))]
        for _ in range(r.randint(0, 3)):
            p, a = r.randint(1, 30), r.randrange(len(words))
            words[a:a] = (words[a : a + p] * 7)[: r.randint(p, 6 * p)]
        assert runs_in_words(words) == [tuple(x) for x in runs_of(words).tolist()]


def test_long_run_is_found_whole():
    words = [f"w{i % 900}" for i in range(30_000)]
    assert runs_in_words(["x", *words, "y"]) == [(1, 30_000, 900)]
    assert without_repeats(["x", *words, "y"], [(1, 30_000, 900)]) == ["x", *words[:900], "y"]


def test_odd_rows(odd, nothing):
    rows = periodic_runs(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert (by_id[3]["n_words"], by_id[3]["runs"], by_id[3]["collapsed"]) == (0, [], "")
    assert by_id[5]["collapsed"] == by_id[4]["collapsed"] == ""
    assert by_id[8]["collapsed"] == "É é 漢字 😀 \x1c x"  # 0x1C is no white space here
    assert [tuple(x) for x in by_id[9]["runs"]] == [(0, 40_000, 7000)]
    assert [tuple(x) for x in by_id[10]["runs"]] == [(0, 40_000, 7000)]
    assert periodic_runs(nothing).count() == 0


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    held = {i for s, length, q in runs for i in range(s + q, s + length)}
    digest = [hashlib.sha256(t.encode()).hexdigest() for t in (
        "".join(f"{s},{length},{q}\n" for s, length, q in runs), " ".join(w for i, w in enumerate(words) if i not in held))]
    best = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *best, *digest)


def test_query_equals_brute_force(spark, tmp_path, documents):
    picked = [(r["doc_id"], r["text"]) for r in documents.collect() if len(r["text"] or "") < 4000]
    odd = [(10**6 + i, t) for i, t in enumerate([None, "", " \n", "a a a a a a", "a b a b a b a b", "one"] * 40)]
    rows = picked + odd + odd[:3]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op11_suffix_tree_runs(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {t for c, t in out.dtypes if c.endswith("256")} == {"string"} and {t for c, t in out.dtypes if not c.endswith("256")} == {"bigint"}
    assert sorted(map(tuple, out.collect()), key=str) == sorted((expected(*r) for r in rows), key=str)


def test_planted_texts_have_runs(spark):
    out = queries.op11_suffix_tree_runs(spark, SMALL)
    planted = [r["n_runs"] for r in out.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0]
    assert sum(n > 0 for n in planted) > len(planted) / 2
