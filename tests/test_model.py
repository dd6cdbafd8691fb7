"""The model path with an offline client."""

import json

import pytest
from pyspark.sql import functions as F

from augury.operators import model, panel, profile
from augury.plans.model_guidance import build_guidance_model, call_model, processed_ledger
from augury.session import fresh_folder

ITEM = {
    "forecast_metric": "EBIT", "time_horizon": "Q1", "fiscal_year": 2025, "estimate_type": "range",
    "value_low": 1.0, "value_high": 3.0, "value_point": None, "unit": "millions", "direction": "raises",
    "confidence_language": "expects", "is_adjusted": True, "context_sentence": "s" * 600,
}


def prefiltered(spark, text):
    return spark.createDataFrame([(text,)], "t string").select(model.prefilter_text(F.col("t"))).first()[0]


def test_prefilter_has_three_outcomes(spark):
    exact = " \n".join(["word"] * 3000) + " "
    assert prefiltered(spark, exact) == exact
    quiet = "expect " * 1500 + "\n\nword" * 1501
    assert prefiltered(spark, quiet) == " ".join(["expect"] * 1500)
    telling = "word\n" * 2999 + "x Quarterly y"
    assert prefiltered(spark, telling) == " ".join(["word"] * 2999 + ["x"])
    two_words = "word\n" * 2000 + "call\n\nfor " + "word " * 1000
    assert prefiltered(spark, two_words) == " ".join(["word"] * 2000 + ["call", "for"] + ["word"] * 998)
    assert prefiltered(spark, "") == ""


def test_requests(spark, texts):
    row = model.render_requests(texts("Body.")).first()
    assert row["request"] == "Company: ACME\nFiling date: 2025-02-03\n\nPress release text:\nBody."
    bare = spark.createDataFrame([("a", "Body.")], "accession_number string, text string")
    assert model.render_requests(bare).first()["request"].startswith("Company: Unknown\nFiling date: Unknown")


def parsed(spark, *answers):
    rows = [(str(i), a) for i, a in enumerate(answers)]
    return model.parse_responses(spark.createDataFrame(rows, "accession_number string, response string"))


def test_answers_without_items(spark):
    assert parsed(spark, '{"guidance_items": []}', "{}", "no json", None, '{"guidance_items": null}').count() == 0


def test_problems_are_named(spark):
    answers = [
        {**ITEM, "forecast_metric": "Backlog"}, {**ITEM, "unit": None}, {k: v for k, v in ITEM.items() if k != "is_adjusted"}, ITEM,
    ]
    rows = parsed(spark, json.dumps({"guidance_items": answers})).orderBy("item_ord").collect()
    assert [r["problem"] for r in rows] == ["forecast_metric", "unit", "is_adjusted", None]
    items = parsed(spark, json.dumps({"guidance_items": answers}))
    assert model.accepted_items(items).count() == 1


def test_a_mistyped_field_spoils_nothing_else(spark):
    answers = [{**ITEM, "value_low": "about two", "fiscal_year": "2026", "unit": "euros"}, ITEM]
    rows = parsed(spark, json.dumps({"guidance_items": answers})).orderBy("item_ord").collect()
    assert [(r["value_low"], r["value_high"], r["fiscal_year"], r["problem"]) for r in rows] == [
        (None, 3.0, 2026, "unit"), (1.0, 3.0, 2025, None),
    ]


@pytest.mark.parametrize(
    "kind, low, high, point, values",
    [
        ("range", 1.0, 3.0, None, (1.0, 3.0, 2.0, 2.0)),
        ("range", 3.0, 1.0, None, (1.0, 3.0, 2.0, 2.0)),
        ("range", 3.0, None, None, (3.0, None, 1.5, 0.0)),
        ("range", None, 3.0, None, (None, 3.0, None, 0.0)),
        ("point", None, None, 4.0, (4.0, 4.0, 4.0, 0.0)),
        ("point", 1.0, 2.0, None, (None, None, None, 0.0)),
    ],
)
def test_mapping(spark, kind, low, high, point, values):
    item = {**ITEM, "estimate_type": kind, "value_low": low, "value_high": high, "value_point": point}
    row = model.map_to_guidance(model.accepted_items(parsed(spark, json.dumps({"guidance_items": [item]})))).first()
    assert (row["val1"], row["val2"], row["midpoint"], row["range_width"]) == values
    assert (row["metric"], row["pdicity"], row["action"], len(row["sentence"])) == ("EBITDA", "Q1", "raises", 500)


def test_costs_and_cap(spark):
    usage = spark.createDataFrame(
        [(f"k{i:04d}", "gpt-4o" if i % 2 else "nobody knows", 1_000_000, 0) for i in range(10)],
        "accession_number string, model string, tokens_in bigint, tokens_out bigint",
    )
    costs = {r["model"]: r["cost"] for r in profile.usage_cost(usage).collect()}
    assert costs == {"gpt-4o": 12.5, "nobody knows": 0.75}
    chunked = panel.chunk_rows(usage, ["accession_number"], 2)
    kept = [r["accession_number"] for r in model.cost_cap(chunked, 0.6).orderBy("accession_number").collect()]
    assert kept == ["k0000", "k0001", "k0002", "k0003"]
    assert model.cost_cap(chunked, 0.0).count() == 10
    far = usage.withColumn("chunk_no", F.substring("accession_number", 2, 4).cast("bigint") * 700)
    assert model.cost_cap(far, 0.6).count() == 4


def make_client():
    # A local class travels to the tasks by value.
    import json as j

    item = ITEM

    class Client:
        def complete(self, instructions, request):
            if "broken" in request:
                return "{", 100, 1
            if "fails" in request:
                raise RuntimeError
            return j.dumps({"guidance_items": [item]}), 1_000_000, 0

    return Client


Client = make_client()


STORY = "Quarterly results. " + "We like our work. " * 6 + "We expect revenue of $5 million to $6 million in Q2 2026."


def test_failures_fall_back_and_stay_open(spark, texts):
    df = texts("fine", "fails " + STORY, "broken " + STORY, "fine too")
    path = fresh_folder(spark, "outcomes")
    rows = build_guidance_model(df, Client, path, fallback=True, wait=0.0)
    got = sorted((r["accession_number"], r["metric"], r["val1"], r["unit"]) for r in rows.collect())
    assert got == [
        ("a-0000", "EBITDA", 1.0, "millions"), ("a-0001", "Revenue", 5e6, None),
        ("a-0002", "Revenue", 5e6, None), ("a-0003", "EBITDA", 1.0, "millions"),
    ]
    ledger = processed_ledger(spark.read.parquet(path))
    assert sorted(r["accession_number"] for r in ledger.collect()) == ["a-0000", "a-0003"]
    again = build_guidance_model(df, Client, fresh_folder(spark, "outcomes"), ledger=ledger, wait=0.0)
    assert again.count() == 0


def test_cost_cap_stops_further_waves(spark, texts):
    df = texts(*["fine"] * 9)
    out = call_model(df, Client, fresh_folder(spark, "outcomes"), max_cost=0.5, wave_rows=3, wait=0.0)
    assert sorted(r["accession_number"] for r in out.collect()) == [f"a-{i:04d}" for i in range(6)]


def test_a_later_answer_replaces_a_failure(spark, texts):
    path = fresh_folder(spark, "outcomes")
    first, second = texts("fails " + STORY, "fine"), texts("well now " + STORY, "fine")
    got = build_guidance_model(first, Client, path, fallback=True, wait=0.0).collect()
    assert sorted((r["accession_number"], r["metric"]) for r in got) == [("a-0000", "Revenue"), ("a-0001", "EBITDA")]
    open_ones = processed_ledger(spark.read.parquet(path))
    again = build_guidance_model(second, Client, path, ledger=open_ones, fallback=True, wait=0.0).collect()
    assert [(r["accession_number"], r["metric"]) for r in again] == [("a-0000", "EBITDA")]
    assert model.settle_outcomes(spark.read.parquet(path)).count() == 2


def test_a_spent_cap_calls_nobody(spark, texts):
    path = fresh_folder(spark, "outcomes")
    call_model(texts(*["fine"] * 6), Client, path, max_cost=0.3, wave_rows=3, wait=0.0)
    before = spark.read.parquet(path).count()
    out = call_model(texts(*["fine"] * 9), Client, path, max_cost=0.3, wave_rows=3, wait=0.0)
    assert before == 3 and out.count() == 3


def test_waves_commit_as_they_end(spark, texts, monkeypatch):
    from augury.plans import model_guidance as plan

    monkeypatch.setattr(plan, "COMMIT_CHUNKS", 1)
    path, done = fresh_folder(spark, "outcomes"), []
    write = plan.write_parquet_table

    def failing(df, where, mode):
        if len(done) == 2:
            raise RuntimeError("lost")
        done.append(write(df, where, mode=mode))

    monkeypatch.setattr(plan, "write_parquet_table", failing)
    with pytest.raises(RuntimeError, match="lost"):
        call_model(texts(*["fine"] * 9), Client, path, wave_rows=3, wait=0.0)
    assert spark.read.parquet(path).count() == 6


def test_a_wave_is_asked_on_all_cores_and_rendered_once(spark, texts, monkeypatch):
    from augury.plans import model_guidance as plan

    monkeypatch.setattr(plan, "COMMIT_CHUNKS", 16)
    rendered = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            rendered.add(batch.num_rows)
            yield batch

    many = texts(*["fine"] * 200)
    requests = model.render_requests(many)
    asked = plan.staged_requests(requests.mapInArrow(counted, requests.schema), 5)
    # Once for the numbers' range sample, once for the numbers, and once for the requests themselves.
    assert rendered.value == 3 * 200
    assert asked.select("accession_number").distinct().count() == asked.count() == 200
    assert asked.groupBy("chunk_no").count().filter("count <> 5").count() == 0
    wave = asked.filter("commit_no = 1").drop("commit_no")
    assert wave.count() == 80 and wave.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    sizes = [n for n in wave.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n]
    assert max(sizes) <= 20 and len(sizes) == spark.sparkContext.defaultParallelism


def test_a_filing_that_comes_twice_is_asked_twice(spark, texts):
    from augury.plans.model_guidance import staged_requests

    twice = model.render_requests(texts("fine", "fine", "fine")).withColumn("accession_number", F.lit("a"))
    asked = staged_requests(twice, 2).collect()
    assert len(asked) == 3 and {r["chunk_no"] for r in asked} == {0}


def test_requests_are_answered_each_once_by_so_many_at_a_time(spark, texts, tmp_path):
    folder = str(tmp_path)

    class Slow:
        def complete(self, instructions, request):
            import os, threading, time

            open(f"{folder}/{os.getpid()}-{threading.get_ident()}", "w").close()
            time.sleep(0.02)
            return request[-4:], 1, 1

    asked = model.render_requests(texts(*[f"{i:04d}" for i in range(60)])).coalesce(1)
    rows = model.extract_with_model(asked, Slow, concurrency=5, wait=0.0).collect()
    assert [int(r["response"]) for r in rows] == [int(r["accession_number"][2:]) for r in rows]
    assert sorted(int(r["response"]) for r in rows) == list(range(60)) and len(list(tmp_path.iterdir())) == 5


def test_texts_without_content_are_not_asked(spark, texts):
    df = texts("fine", None)
    assert call_model(df, Client, fresh_folder(spark, "outcomes"), wait=0.0).count() == 1
    assert call_model(df.limit(0), Client, fresh_folder(spark, "outcomes"), wait=0.0).count() == 0


def test_no_item_is_lost(spark, texts):
    item = ITEM

    class Odd:
        def complete(self, instructions, request):
            import json as j

            return j.dumps({"guidance_items": [{**item, "unit": "euros"}, {**item, "forecast_metric": "Backlog"}, {**item, "value_low": []}]}), 1, 1

    rows = build_guidance_model(texts("x"), Odd, fresh_folder(spark, "outcomes"), wait=0.0).orderBy("sent_ord").collect()
    assert [(r["metric"], r["problem"]) for r in rows] == [("EBITDA", "unit"), ("Backlog", "forecast_metric"), ("EBITDA", None)]
    assert rows[2]["val1"] is None


def test_accepted_and_rejected_items_are_all_items_each_once(spark, tmp_path):
    item = {
        "forecast_metric": "EPS", "time_horizon": "Q1", "fiscal_year": 2025, "estimate_type": "point", "value_low": None,
        "value_high": None, "value_point": 1.5, "unit": "per_share", "direction": "issues", "confidence_language": "expects",
        "is_adjusted": False, "context_sentence": "We expect.",
    }
    answers = [
        ("a", json.dumps({"guidance_items": [item, {**item, "unit": "euros"}, {**item, "is_adjusted": None}]})),
        ("a", json.dumps({"guidance_items": [item]})), ("b", "no json"), ("c", json.dumps({"guidance_items": []})), ("d", None),
    ]
    df = spark.createDataFrame(answers, "accession_number string, response string")
    manifest = model.store_items(df, f"{tmp_path}/t")
    assert manifest == {f"rejected_{n}": 0 for n in model._REQUIRED} | {
        "accepted": 2, "rejected": 2, "rejected_unit": 1, "rejected_is_adjusted": 1,
    }
    assert spark.read.parquet(f"{tmp_path}/t/manifest").first().asDict() == manifest
    good, bad = (model.read_items(spark, f"{tmp_path}/t", accepted) for accepted in (True, False))
    whole = model.parse_responses(df)
    assert good.columns == [c for c in whole.columns if c != "problem"] and bad.columns == whole.columns
    both = good.withColumn("problem", F.lit(None).cast("string")).unionByName(bad)
    assert sorted(map(str, both.select(whole.columns).collect())) == sorted(map(str, whole.collect()))
    empty = model.store_items(df.filter("false"), f"{tmp_path}/none")
    assert empty["accepted"] == empty["rejected"] == 0


def test_rejected_items_are_read_without_the_accepted_ones_files(spark, tmp_path):
    item = {"forecast_metric": "Tea"}
    df = spark.createDataFrame([("a", json.dumps({"guidance_items": [item]}))], "accession_number string, response string")
    model.store_items(df, f"{tmp_path}/t")
    plan = model.read_items(spark, f"{tmp_path}/t", accepted=False)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(accepted" in plan
