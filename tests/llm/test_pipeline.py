"""The pipeline, stage by stage, against what the stages promise."""

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from augury.llm.shared import bit_map, in_map, written

from .conftest import SMALL
from .test_dedup import brute_components, plain


@pytest.fixture(scope="module")
def stages(spark, documents):
    docs, out = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SMALL), name)
        out[name] = docs
    return out


def test_stages_keep_the_columns(stages, documents):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "pii", "packing"]
    for name in ("toxicity", "exact_dedup", "near_dedup", "pii"):
        assert stages[name].dtypes == documents.dtypes


def test_stages_do_what_they_say(stages, documents):
    before = dict(plain(stages["toxicity"]))
    after = dict(plain(stages["exact_dedup"]))
    assert len(set(t.lower() for t in after.values())) == len(after) and set(t.lower() for t in before.values()) == set(t.lower() for t in after.values())
    expected = brute_components(list(after.items()))
    assert sorted(dict(plain(stages["near_dedup"]))) == sorted(d for d, (_, c) in expected.items() if c == d)
    assert stages["pii"].count() == stages["near_dedup"].count()
    assert stages["pii"].filter(F.col("n_chars") != F.length("text")).count() == 0
    assert stages["pii"].filter(F.col("text").rlike(r"@mail[0-9]\.example\.com")).count() == 0
    assert {r["doc_id"] for r in stages["packing"].select("doc_id").collect()} == set(dict(plain(stages["pii"])))


def test_run_equals_the_stages(spark, stages):
    own = corpus_pipeline.run(spark, SMALL).groupBy("doc_id").agg(F.sum("length").alias("n"), F.sum("ids_crc32").alias("c")).collect()
    theirs = stages["packing"].groupBy("doc_id").agg(F.sum("length").alias("n"), F.sum("ids_crc32").alias("c")).collect()
    assert sorted(map(tuple, own)) == sorted(map(tuple, theirs))


def test_bit_maps_have_no_false_misses(spark):
    keys = spark.range(0, 5000).select(F.xxhash64("id").alias("h"))
    packed = bit_map(keys, F.col("h"), bits=1 << 16)
    hashes = np.array([r["h"] for r in keys.collect()])
    assert in_map(packed, hashes).all()
    assert in_map(packed, np.arange(10_000, dtype=np.int64) * 7919).mean() < 0.2
    assert not in_map(bit_map(keys.limit(0), F.col("h"), bits=1 << 16), hashes).any()
