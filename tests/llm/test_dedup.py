"""Exact dedup, the Jaccard join and repeated passages, against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from augury.llm import ngram_join
from augury.llm.graph import components
from augury.llm.ngram_join import crossing_rows, one_of_each_group, prefix_length, similar_documents
from augury.llm.queries import op8_sparse_suffix_passages
from augury.llm.radix_dedup import drop_copies, radix_dedup, split_to_end
from augury.llm.suffix_dedup import repeated_passages

from .conftest import SMALL

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_copies(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(FOLD)].append(doc_id)
    out = Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        out.update((i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids)
    return out


def shingles(text, size=5):
    own = words((text or "").translate(FOLD))
    if len(own) < size:
        return frozenset([tuple(own)] if own else [])
    return frozenset(tuple(own[i : i + size]) for i in range(len(own) - size + 1))


def brute_components(rows, percent=75):
    sets = {}
    for doc_id, text in rows:
        sets[doc_id] = shingles(text)
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in ids}


def brute_passages(rows, size=50):
    where = defaultdict(set)
    for doc_id, text in rows:
        own = words(text)
        for i in range(len(own) - size + 1):
            where[tuple(own[i : i + size])].add(doc_id)
    out = {}
    for doc_id, text in rows:
        own, covered = words(text), set()
        for i in range(len(own) - size + 1):
            if len(where[tuple(own[i : i + size])]) > 1:
                covered.update(range(i, i + size))
        out[doc_id] = covered
    return out


def covered(spans):
    return {i for s in spans for i in range(s["start"], s["stop"])}


def plain(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_exact_dedup_equals_brute_force(documents, odd):
    for table in (documents, odd):
        found = radix_dedup(table).collect()
        assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found) == brute_copies(plain(table))
        kept = Counter(r["text_sha256"] for r in found if r["kept"])
        assert set(kept.values()) == {1} and len(kept) == len({r["text_sha256"] for r in found})


def test_large_groups_are_split_over_the_cluster(spark, monkeypatch):
    from augury.llm import radix_dedup as module

    monkeypatch.setattr(module, "LOCAL_ROWS", 2)
    head = "same beginning of every text " * 20
    rows = [(i, head + ("a" if i % 3 else "b" * (i % 4))) for i in range(60)]
    found = radix_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found) == brute_copies(rows)


def test_split_to_end():
    texts = [b"a" * 64 + b"x" * 1000, b"a" * 64 + b"x" * 1000, b"a" * 64 + b"x" * 999, b"a" * 64]
    assert sorted(sorted(g) for g in split_to_end(texts, 64)) == [[0, 1], [2], [3]]


def test_drop_copies_keeps_columns_and_one_of_repeated_rows(odd):
    left = drop_copies(odd)
    assert left.columns == odd.columns
    assert sorted(r["doc_id"] for r in left.filter("doc_id is not null").collect()) == [2, 4, 5, 7, 8, 9, 10, 11, 12]


def test_drop_copies_passes_a_column_named_as_its_own_on(odd):
    left = drop_copies(odd.withColumn("group_size", F.lit(7)))
    assert {r["group_size"] for r in left.collect()} == {7} and left.columns == [*odd.columns, "group_size"]


def test_drop_copies_passes_private_names_and_repeated_rows(spark):
    rows = [(1, "Same text"), (2, "same TEXT"), (2, "same TEXT"), (3, "other"), (3, "other"), (None, "same text"), (None, "n"), (None, "N"), (4, None), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for name in ("_copy_digest", "_copy_kept", "own", "row", "key"):
        df = df.withColumn(name, F.lit(name))
    left = drop_copies(df)
    assert left.columns == df.columns
    found = sorted(((r["doc_id"] or 0), (r["text"] or "").lower(), r["own"]) for r in left.collect())
    assert found == [(0, "n", "own"), (2, "same text", "own"), (3, "other", "own"), (5, "", "own")]


def test_jaccard_components_equal_brute_force(documents):
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in similar_documents(documents).collect()}
    assert found == brute_components(plain(documents))


def test_jaccard_at_the_limit_and_chains(spark):
    base = [f"w{i}" for i in range(104)]
    rows = [(10, " ".join(base))]
    for k in range(1, 6):  # each differs from the last by a few words: a chain of links
        base[k * 15] = f"v{k}"
        base[k * 15 + 7] = f"u{k}"
        rows.append((10 - k, " ".join(base)))
    rows += [(20, "a b c d"), (21, "A B C D"), (22, "a b c"), (23, ""), (24, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in similar_documents(df).collect()}
    assert found == brute_components(rows)
    assert found[24] == (0, 24) and found[21] == (1, 20)


def test_jaccard_odd_rows(odd):
    rows = similar_documents(odd).collect()
    assert len(rows) == odd.count()
    of = {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] is not None}
    assert of[1] == of[2] == 1 and of[6] == of[7] == 6 and of[9] == of[10] == 9 and of[3] == 3 and of[4] == 4
    assert sorted((r["n_shingles"], r["component_id"] is None) for r in rows if r["doc_id"] is None) == [(0, True), (2, False)]
    stay = one_of_each_group(odd)
    assert stay.columns == odd.columns
    assert {r["doc_id"] for r in stay.collect()} == {1, 3, 4, 5, 6, 8, 9, 11, 12, None}


def test_rows_without_id_or_with_the_same_id_link_nobody_else(spark):
    def near(k, end):
        return " ".join(f"t{k}w{i}" for i in range(60)) + end

    rows = [(1, near(1, " a")), (2, near(2, " a")), (None, near(1, " b")), (None, near(2, " b"))]
    rows += [(7, near(3, " a")), (7, near(4, " a")), (5, near(4, " b")), (None, near(5, " a")), (None, near(5, " b"))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in similar_documents(df).collect())
    assert found == [(0, 0), (0, 0), (0, 1), (0, 2), (1, 1), (2, 2), (5, 5), (7, 5), (7, 7)]
    stay = [(r["doc_id"], r["text"]) for r in one_of_each_group(df).collect()]
    assert sorted(s for s in stay if s[0]) == [(1, rows[0][1]), (2, rows[1][1]), (5, rows[6][1]), (7, rows[4][1])]
    assert len([s for s in stay if s[0] is None]) == 1


def test_near_copies_of_many_kinds_equal_brute_force(spark):
    import random

    rng = random.Random(5)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for k in range(260):  # changed a little or a lot, some in the same way
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 5, 8])):
            words[rng.randrange(80)] = f"c{rng.randrange(6) if k % 2 else k}"
        rows.append((k, " ".join(words[: rng.choice([80, 80, 70, 62])] + [f"e{k % 9}x{i}" for i in range(rng.choice([0, 4, 12]))])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in similar_documents(df).collect()}
    expected = brute_components(rows)
    assert found == expected and 3 < len({c for _, c in expected.values()}) < 200


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 100])
def test_similar_sets_share_a_first_shingle(n):
    least = -(-75 * n // 100)
    assert n - prefix_length(n, 75) == least - 1


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 100), (7, 7), (200, 150), (150, 300)]
    df = spark.createDataFrame(links, "a long, b long")
    found = {r["node"]: r["component"] for r in components(df).collect()}
    assert found == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100, 150: 150, 200: 150, 300: 150}
    assert components(df.limit(0)).count() == 0


def test_repeated_passages_equal_brute_force(documents):
    rows = plain(documents)
    expected = brute_passages(rows)
    found = repeated_passages(documents).collect()
    assert {r["doc_id"]: covered(r["spans"]) for r in found} == expected
    assert all(r["n_repeated"] == len(expected[r["doc_id"]]) for r in found)


def test_a_passage_of_exactly_fifty_words(spark):
    own = lambda k, n: [f"d{k}x{i}" for i in range(n)]
    passage = [f"p{i}" for i in range(50)]
    rows = [(k, " ".join(own(k, 20 + k) + passage + own(k + 100, 30))) for k in range(6)]
    rows += [(50, " ".join(own(50, 40) + passage[:49] + own(51, 40)))]
    found = {r["doc_id"]: covered(r["spans"]) for r in repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert found == brute_passages(rows)


def test_no_partner_is_hidden_by_others_that_share_the_run(spark):
    own = lambda k, n: [f"d{k}x{i}" for i in range(n)]
    passage = [f"p{i}" for i in range(50)]
    # One document with a passage in 100 surroundings; another with one copy.
    rows = [(1, " ".join(w for k in range(100) for w in own(k, 60) + passage)), (2, " ".join(own(200, 45) + passage + own(201, 45)))]
    # Boilerplate with slots on both sides; only some agree in a whole passage.
    plate = [f"b{i}" for i in range(30)]
    rows += [(10 + k, " ".join([f"s{k % 9}u{i}" for i in range(40)] + plate + [f"s{k % 7}v{i}" for i in range(40)])) for k in range(120)]
    rows += [(300 + k, " ".join([f"l{k}y{i}" for i in range(40)] + plate + [f"l{k}z{i}" for i in range(40)])) for k in range(60)]
    # Short texts, in which two runs have the same words around them.
    rows += [(400 + k, " ".join([f"q{i}" for i in range(52)] + ["end"] * k)) for k in range(3)]
    found = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r["doc_id"]: covered(r["spans"]) for r in found} == brute_passages(rows)


def test_rows_without_id_share_passages(spark):
    same = " ".join(f"p{i}" for i in range(60))
    rows = [(None, same), (None, same + " end"), (None, "x " * 10), (4, "other words"), (None, None)]
    found = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((r["doc_id"] is None, r["n_words"], r["n_repeated"]) for r in found) == [
        (False, 2, 0), (True, 0, 0), (True, 10, 0), (True, 60, 60), (True, 61, 60)
    ]
    alike = repeated_passages(spark.createDataFrame([(None, same)] * 2, "doc_id long, text string")).collect()
    assert [r["n_repeated"] for r in alike] == [60, 60]


def test_the_query_reports_documents_without_passages_too(spark, documents):
    found = op8_sparse_suffix_passages(spark, SMALL).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(r["doc_id"] for r in documents.collect())
    assert {r["spans"] == "" for r in found if r["n_repeated"] == 0} == {True}


def test_passages_of_odd_rows_and_empty_tables(odd, nothing):
    found = repeated_passages(odd).collect()
    assert len(found) == odd.count()
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[9]["n_repeated"] == 40_000 == by_id[10]["n_repeated"]
    assert by_id[4]["spans"] == [] and by_id[4]["n_words"] == 0
    for operator in (repeated_passages, similar_documents, radix_dedup, drop_copies, one_of_each_group):
        assert operator(nothing).count() == 0


def test_dedup_plans_do_not_spell_maps_out(odd):
    for operator in (drop_copies, one_of_each_group):
        assert len(operator(odd)._jdf.queryExecution().toString()) < 200_000


def test_texts_are_hashed_in_bounded_parts():
    import pyarrow as pa

    from augury.llm.radix_dedup import _heads

    rows = [None, "A" * 3_000_000, "b", "c" * 9_000_000, "", "D" * 3_000_000] * 2
    batch = pa.RecordBatch.from_arrays([pa.array(range(12), pa.int64()), pa.array(rows, pa.string())], ["doc_id", "text"])
    out = list(_heads(iter([batch, batch.slice(0, 0)])))
    assert len(out) > 4 and [i for b in out for i in b.column("doc_id").to_pylist()] == [*range(12)]
    whole = [h for b in out for h in b.column("text_sha256").to_pylist()]
    assert whole == [hashlib.sha256((t or "").lower().encode()).hexdigest() for t in rows]


def test_pairs_cross_only_where_enough_shingles_are_left(spark):
    # Two sets of 100 shingles that share their first 26; 86 must be shared, so they may first meet at 0 to 14.
    hits = [(k, 1, node, 100, 25, k, node) for k in range(26) for node in (1, 2)]
    rows = crossing_rows(spark.createDataFrame(hits, "token long, top long, node long, n long, last long, at long, component long"), 75)
    assert [tuple(r) for r in rows.collect()] == [(1, 2, 100, 100)] * 15


def test_postings_leave_in_bounded_parts(monkeypatch):
    monkeypatch.setattr(ngram_join, "POSTING_BYTES", 800)
    sets = [np.arange(k, k + 25, dtype=np.int64).tobytes() for k in range(40)] + [b""]
    count = np.arange(41)
    batch = pa.record_batch({"node": count, "n": count, "rare": count, "last": count, "tokens": pa.array(sets, pa.binary())})
    parts = list(ngram_join._postings(None)(iter([batch, batch.slice(0, 0)])))
    assert max(p.num_rows for p in parts) <= 200 and len(parts) > 9
    tokens = pa.concat_arrays([p.column("token") for p in parts]).to_pylist()
    assert tokens == [k + i for k in range(40) for i in range(25)]
    every = np.full(1 << 10, 255, np.uint8)
    places = [at for p in ngram_join._postings(every)(iter([batch])) for at in p.column("at").to_pylist()]
    assert places == list(range(25)) * 40
