"""Host rules, personal data, toxicity, language-model scores and archives."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from augury.llm import pii, toxicity, warc
from augury.llm.host_rules import MAX_HOST_RATE, Prior, fit_prior, host_quality, judge_hosts
from augury.llm.lm_score import score_documents
from augury.llm.suffix_dedup import minimisers

from .conftest import SMALL


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_features(text):
    text = text or ""
    own = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    runs = [tuple(own[i : i + 8]) for i in range(len(own) - 7)]
    often, covered = Counter(runs), set()
    for i, run in enumerate(runs):
        if often[run] > 1:
            covered.update(range(i, i + 8))
    return len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_features_equal_brute_force(documents, odd):
    for table in (documents, odd):
        found = Counter(
            (r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
            for r in host_quality(table).collect()
        )
        assert found == Counter((r["doc_id"], *brute_features(r["text"])) for r in table.collect())


def test_bad_hosts_take_their_documents_along(spark, nothing):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, good if i % 10 else "short", "fine") for i in range(200)]
    rows += [(1000 + i, good if i % 10 == 0 else "short", "bad") for i in range(200)]
    rows += [(5000, good, None), (5001, "short", "once")]
    out = {r["doc_id"]: r for r in host_quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert out[1]["kept"] and not out[10]["kept"]
    assert not out[1000]["kept"] and not out[1000]["base_failed"]
    assert out[5000]["kept"] and len(out) == len(rows)
    # One failure does not make a rate of one.
    assert out[5001]["host_rate"] < 1
    assert host_quality(nothing).count() == 0


def test_prior_shrinks_small_hosts_most(spark):
    hosts = spark.createDataFrame([("a", 1000, 100), ("b", 1000, 120), ("c", 1, 1), ("d", 500, 400)], "host string, documents long, failed long")
    prior = fit_prior(hosts)
    rate = {r["host"]: r["host_rate"] for r in judge_hosts(hosts, prior).collect()}
    assert abs(rate["a"] - 0.1) < 0.01 and rate["c"] < 0.9 and rate["d"] > MAX_HOST_RATE
    assert fit_prior(hosts.limit(0)) == Prior(1.0, 1.0)


PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == 1 and max(map(int, m.group().split("."))) > 255:
                continue
            if kind == 2 and not (14 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == 3 and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_equal_the_plain_patterns(documents):
    r = random.Random(5)
    texts = ["".join(r.choice("ab1.2@-+ ()45.@1") for _ in range(r.randint(0, 40))) for _ in range(20_000)]
    texts += [row["text"] for row in documents.collect()]
    for text in texts:
        assert pii.base_spans(text) == plain_spans(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "@" * 300_000, "a@" * 100_000, "+1" + "(" * 300_000):
        pii.judged_spans(text, pii.fit(np.zeros(0, int), np.zeros((0, 6), int), np.zeros(0, int)), {})


def test_personal_data_rows(documents, odd, nothing):
    found = pii.digest(pii.find_personal_data(documents)).collect()
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    for r in found:
        base = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in plain_spans(texts[r["doc_id"]]))
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(r["spans"].split(","))
    assert pii.find_personal_data(odd).count() == odd.count()
    assert pii.find_personal_data(nothing).count() == 0
    assert pii.mask_personal_data(nothing).count() == 0


def test_labelers_agree_on_hidden_addresses_and_numbers(spark):
    rows = [(i, f"write to anna{i}@mail.com or call +1 (555) 010-{1000 + i} now") for i in range(40)]
    rows += [(100, "mail: bob [at] corp [dot] com please"), (101, "phone (555) 010-1234 today"), (102, "order 4111111111111112 build"), (103, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r["doc_id"]: r["spans"] for r in pii.digest(pii.find_personal_data(df)).collect()}
    assert spans[0].startswith("email:9:") and spans[100].startswith("email:6:") and spans[101].startswith("phone:6:")
    assert spans[102] == "" and spans[103] == ""
    masked = {r["doc_id"]: r["text"] for r in pii.mask_personal_data(df).collect()}
    assert masked[100] == "mail: <email> please" and masked[103] is None and "@" not in masked[3]


def test_expectation_maximisation_finds_reliable_labelers():
    r = np.random.default_rng(1)
    truth = r.random(4000) < 0.4
    right = np.array([0.95, 0.9, 0.6, 0.5, 0.9, 0.85])
    vote = np.where((r.random((4000, 6)) < right) == truth[:, None], 1, -1)
    model = pii.fit(np.zeros(4000, int), vote, np.ones(4000, int))
    p = np.array([model.probability(0, tuple(v)) for v in vote])
    assert ((p >= 0.5) == truth).mean() > 0.95
    assert model.reliabilities[0, 1, 0, 2] > 0.9 and model.reliabilities[0, 1, 3, 2] < 0.6


# --- toxicity ------------------------------------------------------------------


def distance_one(a, b):
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    edits = {a[:i] + a[i + 1 :] for i in range(len(a))}
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return b in edits if len(a) > len(b) else a in {b[:i] + b[i + 1 :] for i in range(len(b))}


def test_automata_equal_edit_distance():
    terms = ("idiot", "moron", "loser", "stupid", "scum", "lowei")
    matcher = toxicity.Matcher(tuple((t, t == "lowei") for t in terms))
    r = random.Random(2)
    tried = list(terms)
    for t in terms:
        for _ in range(300):
            w = list(t)
            for _ in range(r.randint(0, 2)):
                at = r.randrange(len(w) + 1)
                w[at : at + r.randint(0, 1)] = r.choice(["", "x", "o", "i"])
            tried.append("".join(w) + r.choice(["", "", "e"]))
    for word in filter(None, tried):
        matcher._last = matcher.start
        found = matcher.find(word)
        if word in terms[:5]:
            assert found == (toxicity.EXACT, terms.index(word))
        elif word.startswith("lowei"):
            assert found == (toxicity.STEM, 5)
        elif any(distance_one(word, t) for t in terms[:5] if len(t) >= toxicity.MIN_FUZZY):
            assert found is not None and found[0] == toxicity.FUZZY
        else:
            assert found is None, word


def test_quotation_is_told_from_abuse():
    scorer = toxicity.Scorer(toxicity.ToxicityModel(tuple((t, False) for t in toxicity.SEEDS), tuple(toxicity._PRIOR.tolist())))
    index = dict(zip(toxicity.FEATURES, range(8)))
    abuse = scorer.features("you are an idiot and a loser!")
    quote = scorer.features('the article says that the word "idiot" once had a clinical meaning')
    assert abuse[index["abusive"]] == math.log1p(2) and quote[index["quoted"]] > 0 and quote[index["abusive"]] == 0
    assert scorer.score("you are an idi0t, a losser and a stupid moron") > scorer.score("a quiet day at the sea")


def test_learned_scores_hold_on_the_left_out_fold(spark):
    base = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.score_toxicity(docs, labels).join(labels, "doc_id").filter("held_out").select("predicted", "toxic").collect()
    hits = sum(r["predicted"] and r["toxic"] for r in rows)
    assert hits / sum(r["predicted"] for r in rows) > 0.9 and hits / sum(r["toxic"] for r in rows) > 0.75


def one_edit(word, term, r):
    """The term within a word with one random edit behind its first letter."""
    at = word.index(term) + r.randrange(1, len(term))
    return word[:at] + r.choice(["", word[at] * 2, r.choice("qxzv0134")]) + word[at + 1 :]


def test_terms_with_an_edit_have_contexts_and_stems():
    model = toxicity.ToxicityModel((("idiot", False), ("moron", False), ("vermin", True)), tuple(toxicity._PRIOR.tolist()), frozenset({"oron"}))
    scorer, of = toxicity.Scorer(model), dict(zip(toxicity.FEATURES, range(8)))
    x = scorer.features("you are an idi0t and a mor0n")
    assert min(x[of[k]] for k in ("fuzzy", "abusive", "distinct", "share")) > 0 and x[of["exact"]] == 0
    assert scorer.features('the word "idi0t" is quoted')[of["quoted"]] > 0
    assert scorer.features("vermine")[of["stem"]] > 0 and scorer.features("verminn")[of["fuzzy"]] == 0
    assert scorer.features("vrminous")[of["fuzzy"]] > 0 and scorer.features("oron")[of["fuzzy"]] == 0


def test_altered_terms_of_the_left_out_fold_are_found(spark):
    base, r = "/root/testdata/sf0.1", random.Random(8)
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit_toxicity(docs.select("doc_id", "text"), labels)
    assert model.weights[toxicity.FEATURES.index("fuzzy")] >= 0
    scorer, found = toxicity.Scorer(model), {0: [], 1: []}
    for row in docs.join(labels, "doc_id").filter(toxicity.held_out(F.col("doc_id"))).select("text", "toxic").collect():
        own, changed = row["text"].lower().split(), False
        for at, word in enumerate(own):
            hit = [t for t, stem in model.terms if len(t) > 5 - (not stem) and (word.startswith(t) if stem else toxicity.plain(word) == t)]
            if hit:
                own[at], changed = one_edit(word, hit[0], r), True
        if changed or not row["toxic"]:
            found[row["toxic"]].append(scorer.score(" ".join(own)) >= toxicity.THRESHOLD)
    assert len(found[1]) > 90 and sum(found[1]) > 0.75 * len(found[1])
    assert sum(found[0]) < 0.02 * len(found[0])


def test_toxicity_of_odd_rows_and_without_labels(spark, odd, nothing):
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    rows = toxicity.score_toxicity(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] < 0.3 for r in rows)
    assert toxicity.score_toxicity(nothing, labels).count() == 0
    bad = spark.createDataFrame([(1, "you stupid idiot, worthless scum"), (2, "hello"), (3, None)], "doc_id long, text string")
    model = toxicity.fit_toxicity(bad, labels)
    assert [r["doc_id"] for r in toxicity.drop_toxic(bad, model).orderBy("doc_id").collect()] == [2, 3]
    import zlib

    held = {r["doc_id"]: r["held_out"] for r in toxicity.score_toxicity(bad, model=model).collect()}
    assert held == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in (1, 2, 3)}


# --- language-model scores ---------------------------------------------------------


def brute_losses(docs, target_ids):
    """The two models by dictionaries."""
    own = {d: [w.translate(_FOLD) for w in words(t)] for d, t in docs}
    single, double = Counter(), Counter()
    for d in target_ids:
        single.update(own[d])
    known = {w for w, n in single.items() if n >= 2}
    mapped = {d: [w if w in known else None for w in ws] for d, ws in own.items()}
    pairs = lambda ws: [(a, b) for a, b in zip(ws, ws[1:]) if a is not None and b is not None]
    for d in target_ids:
        double.update(pairs(mapped[d]))
    kept = {p for p, n in double.items() if n >= 2}

    def model(ids):
        one, two = Counter(), Counter()
        for d in ids:
            one.update(mapped[d])
            two.update(p for p in pairs(mapped[d]) if p in kept)
        total, context = sum(one.values()), Counter()
        for (a, _), n in two.items():
            context[a] += n

        def loss(ws):
            out = 0.0
            for i, w in enumerate(ws):
                p1 = (one[w] + 0.5) / (total + 0.5 * (len(known) + 1))
                before = ws[i - 1] if i else None
                out -= math.log((two[(before, w)] + 20 * p1) / (context[before] + 20))
            return out / max(1, len(ws))

        return loss

    target, background = model(target_ids), model(list(own))
    return {d: (len(ws), target(ws), background(ws)) for d, ws in mapped.items()}


_FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_losses_equal_brute_force(spark, documents):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").filter("quality = 1")
    expected = brute_losses([(r["doc_id"], r["text"]) for r in documents.collect()], [r["doc_id"] for r in labels.collect()])
    for r in score_documents(documents.repartition(3), labels).collect():
        n, a, b = expected[r["doc_id"]]
        assert r["n_tokens"] == n
        assert r["target_loss"] == pytest.approx(a) and r["background_loss"] == pytest.approx(b) and r["score"] == pytest.approx(b - a)


def test_losses_with_more_words_than_any_table_sent_to_tasks(spark, monkeypatch):
    from augury.llm import lm_score

    r = random.Random(3)
    rare = [f"r{i}" for i in range(70_000)]
    rows = [(i, " ".join(["the", "common", *rare[i * 700 : i * 700 + 700]] * 2)) for i in range(100)]
    rows += [(100 + i, " ".join(r.choice(rare + ["the"] * 40_000) for _ in range(300))) for i in range(50)]
    rows += [(200, " ".join(rare[-300:])), (201, "nobody has these"), (202, None), (203, "The")]
    expected = brute_losses(rows, range(100))
    assert len({w for i in range(100) for w in words(rows[i][1])}) > 1 << 16
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    target = spark.createDataFrame([(i,) for i in range(100)], "doc_id long")
    for hot in (lm_score.HOT, 1000, 0):
        monkeypatch.setattr(lm_score, "HOT", hot)
        found = score_documents(docs, target).collect()
        assert len(found) == len(rows)
        for row in found:
            n, a, b = expected[row["doc_id"]]
            assert row["n_tokens"] == n and (row["target_loss"], row["background_loss"]) == pytest.approx((a, b))


def test_rare_entries_grow_with_the_documents_and_are_not_written(spark):
    import glob

    from augury.llm import lm_score

    pairs = np.random.default_rng(1).integers(-(2**63), 2**63, (2, 1000))
    keys = lm_score._pair_keys(*pairs)
    back = spark.createDataFrame([(int(k), int(a)) for k, a in zip(keys, pairs[0])], "key long, first long")
    back = back.select(lm_score.second_word(F.col("key"), F.col("first")).alias("second"))
    assert [r["second"] for r in back.collect()] == pairs[1].tolist()
    assert lm_score.HOT < 1 << 17

    base = spark.conf.get("spark.checkpoint.dir")
    rows = score_documents(spark.createDataFrame([(1, "a b a b"), (2, "a b c")], "doc_id long, text string"), spark.range(3).toDF("doc_id"))
    assert rows.count() == 2 and not glob.glob(f"{base}/events-*")
    counts = [p for p in glob.glob(f"{base}/target-counts-*")]
    assert counts and all("second" not in spark.read.parquet(p).columns for p in counts[-1:])


def test_scores_of_odd_rows(spark, odd, nothing):
    ids = spark.createDataFrame([(1,), (9,), (None,), (77,)], "doc_id long")
    rows = score_documents(odd, ids).collect()
    assert len(rows) == odd.count() and all(math.isfinite(r["score"]) for r in rows)
    assert [r["score"] for r in rows if r["n_tokens"] == 0] == [0.0] * 4
    assert score_documents(odd, ids.limit(0)).count() == odd.count()
    assert score_documents(nothing, ids).count() == 0


def test_minimisers_are_content_selected():
    r = np.random.default_rng(0)
    shared = r.integers(0, 2**63, 60).astype(np.uint64)
    a = np.concatenate([r.integers(0, 2**63, 100).astype(np.uint64), shared])
    b = np.concatenate([r.integers(0, 2**63, 37).astype(np.uint64), shared])
    assert {int(a[i]) for i in minimisers(a)} & {int(b[i]) for i in minimisers(b)} & set(map(int, shared))
    assert np.diff(minimisers(a)).max() <= 35


# --- archives -------------------------------------------------------------------------


def test_archives_round_trip(spark):
    rows = [
        (3, "http://a/", "<p>é 漢</p>"), (1, "http://b/", "<p>é 漢</p>"), (2, "http://c/", "WARC/1.1\r\n\r\nother\r\n\r\n"),
        (4, None, None), (5, "http://d e\n", ""), (None, "http://f/", "<p>é 漢</p>"), (7, "http://g/", "x" * 200_000), (7, "http://g/", "x" * 200_000),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2)
    out = warc.round_trip(pages.withColumn("record_id", F.lit(1)).withColumn("archive", F.lit("z"))).collect()
    assert len(out) == len(rows)
    by_id = {r["page_id"]: r for r in out}
    assert by_id[1]["record_type"] == "response" and bytes(by_id[1]["response"]["payload"]).decode() == "<p>é 漢</p>"
    assert (by_id[3]["record_type"], by_id[3]["refers_to"]) == ("revisit", 1) == (by_id[None]["record_type"], by_id[None]["refers_to"])
    assert (by_id[5]["record_type"], by_id[5]["refers_to"], by_id[4]["record_type"]) == ("revisit", 4, "response")
    assert bytes(by_id[2]["response"]["payload"]) == rows[2][2].encode()
    assert sorted(r["record_type"] for r in out if r["page_id"] == 7) == ["response", "revisit"]
    for r in out:
        text = (dict((x[0], x[2]) for x in rows)[r["page_id"]] or "").encode()
        assert r["payload_bytes"] == len(text) and r["payload_digest"] == warc.base32_sha1(text)
        assert r["request"]["block"].startswith("GET ") and r["metadata"]["block"].startswith("page-id:")
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_incomplete_transactions(spark):
    def rec(i, kind, to=None, refers=None):
        return (i, kind, to, refers, "u", "d", "D" if kind in ("response", "revisit") else None, 3 if kind == "response" else None, "page-id: 9", None)

    records = [rec("a", "response"), rec("b", "request", "a"), rec("c", "request", "zz"), rec("d", "revisit", None, "gone"), rec("e", "metadata", None)]
    out = {r["response"]["record_id"]: r for r in warc.assemble(spark.createDataFrame(records, warc._RECORD)).collect()}
    assert set(out) == {"a", "d"} and out["a"]["request"]["record_id"] == "b" and out["a"]["metadata"] is None
    assert out["d"]["payload_bytes"] is None and out["d"]["payload_digest"] == "D"


def test_damaged_archives_are_refused():
    whole = "\r\n".join(["WARC/1.1", "WARC-Type: metadata", "WARC-Record-ID: <x>", "Content-Length: 3", "", "abc", "", ""]).encode()
    assert [b for _, b in warc.parse_archive(whole * 2)] == [b"abc", b"abc"]
    for broken in (whole[:-6], b"x" + whole):
        with pytest.raises(ValueError):
            list(warc.parse_archive(broken))


def test_address_parts_may_have_any_number_of_leading_zeros():
    from augury.llm.pii import base_spans

    long = "0" * 2500 + "1.2.3.004"
    assert base_spans(long) == [(0, 1, len(long))]
    assert base_spans("0" * 6000 + ".0.0.255") == [(0, 1, 6008)]
    assert base_spans("0" * 2500 + "256.2.3.4") == [] and base_spans("1.2.3." + "9" * 5000) == []
