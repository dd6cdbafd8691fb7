"""Incremental runs equal one whole run."""

import pytest
from pyspark.sql import functions as F

from augury import schemas
from augury.plans.guidance import build_guidance
from augury.session import fresh_folder
from augury.streaming import guidance_stream
from augury.streaming.guidance_stream import state_rows, stream_guidance

STORY = "Quarterly results. " + "We like our work. " * 6 + "We expect revenue of ${} million to $600 million in Q2 2026."


def exhibits(texts, numbers):
    df = texts(*[STORY.format(n) for n in numbers])
    return df.withColumns(
        {
            "accession_number": F.regexp_extract("text", r"\$([0-9]+)", 1),
            "exhibit_filename": F.lit("b"), "exhibit_description": F.lit("d"), "items": F.lit(""),
            "text_length": F.length("text"),
        }
    ).select(schemas.EXHIBITS.fieldNames())


def test_two_arrivals_equal_one_batch(spark, texts):
    source, target, progress = (fresh_folder(spark, n) for n in ("arrivals", "streamed", "progress"))
    for numbers in (range(1, 30), range(30, 60)):
        exhibits(texts, numbers).write.mode("append").parquet(source)
        stream_guidance(spark, source, target, progress).awaitTermination()
    stream_guidance(spark, source, target, progress).awaitTermination()
    streamed = spark.read.schema(schemas.GUIDANCE).parquet(target)
    whole = build_guidance(spark.read.schema(schemas.EXHIBITS).parquet(source))
    assert sorted(map(str, streamed.collect())) == sorted(map(str, whole.select(streamed.columns).collect()))
    assert streamed.count() == 59


def test_late_and_repeated_deliveries_lose_and_repeat_nothing(spark, texts):
    source, target, progress = (fresh_folder(spark, n) for n in ("arrivals", "streamed", "progress"))
    dates = ("2025-06-01", "2025-03-01", "2024-01-01")
    for date, numbers in zip(dates, (range(1, 10), range(5, 15), range(15, 20))):
        exhibits(texts, numbers).withColumn("date_filed", F.lit(date)).write.mode("append").parquet(source)
        stream_guidance(spark, source, target, progress, dedup=True).awaitTermination()
    rows = spark.read.schema(schemas.GUIDANCE).parquet(target).collect()
    assert sorted(int(r["accession_number"]) for r in rows) == list(range(1, 20))
    assert {r["date_filed"] for r in rows if int(r["accession_number"]) >= 15} == {"2024-01-01"}


class Run:
    """A stream's folders, and runs over what has arrived."""

    def __init__(self, spark, **options):
        self.spark, self.options = spark, options
        self.source, self.target, self.progress = (fresh_folder(spark, n) for n in ("arrivals", "streamed", "progress"))

    def arrive(self, rows, date):
        rows.withColumn("date_filed", F.lit(date)).write.mode("append").parquet(self.source)

    def go(self):
        query = stream_guidance(self.spark, self.source, self.target, self.progress, dedup=True, **self.options)
        query.awaitTermination()
        return query

    def told(self):
        rows = self.spark.read.schema(schemas.GUIDANCE).parquet(self.target).collect()
        return sorted((int(r["accession_number"]), r["date_filed"]) for r in rows)


def parts(spark, numbers):
    """Parts in which filings with these numbers lie."""
    df = spark.createDataFrame([(str(n),) for n in numbers], "a string")
    return df.select(F.pmod(F.xxhash64("a"), F.lit(guidance_stream.PARTS))).distinct().count()


def test_state_forgets_old_filings_and_the_target_settles_them(spark, texts, monkeypatch):
    looked_up = []

    def watched(records, target, real=guidance_stream.append_new):
        looked_up.append(sorted({r["date_filed"] for r in records.collect()}, key=str))
        real(records, target)

    monkeypatch.setattr(guidance_stream, "append_new", watched)
    run = Run(spark, retention_days=30)
    run.arrive(exhibits(texts, range(1, 11)), "2025-01-10")
    assert state_rows(run.go()) == parts(spark, range(1, 11))
    # Told again while remembered: nothing new, and no date to look up in the target.
    run.arrive(exhibits(texts, range(5, 13)), "2025-01-10")
    assert state_rows(run.go()) == parts(spark, range(1, 13)) and not any(looked_up)
    # The clock goes on; the old filings are forgotten, the new ones remembered.
    run.arrive(exhibits(texts, range(20, 23)), "2025-06-01")
    run.go()
    run.arrive(exhibits(texts, range(23, 25)), "2025-06-01")
    assert state_rows(run.go()) == parts(spark, range(20, 25))
    # Old ones again, and others as old: settled by the target, which is read for their dates only.
    looked_up.clear()
    run.arrive(exhibits(texts, [*range(1, 4), 13]), "2025-01-10")
    run.arrive(exhibits(texts, [30]), "not a date")
    run.arrive(exhibits(texts, [22, 31]), "2025-06-01")
    assert state_rows(run.go()) == parts(spark, [*range(20, 25), 31])
    assert [d for d in looked_up if d] == [["2025-01-10", "not a date"]]
    old, new = [(n, "2025-01-10") for n in range(1, 14)], [(n, "2025-06-01") for n in (*range(20, 25), 31)]
    assert run.told() == sorted(old + new + [(30, "not a date")])


def test_batch_that_failed_after_it_was_written_is_told_once(spark, texts, monkeypatch):
    run = Run(spark)

    def broken(records, target, real=guidance_stream.append_new):
        real(records, target)
        raise RuntimeError("lost after the write")

    run.arrive(exhibits(texts, range(1, 8)), "2025-01-10")
    with monkeypatch.context() as m:
        m.setattr(guidance_stream, "append_new", broken)
        with pytest.raises(Exception, match="lost after the write"):
            run.go()
    assert len(run.told()) == 7
    run.arrive(exhibits(texts, range(6, 10)), "2025-01-10")
    run.go()
    run.go()
    assert run.told() == [(n, "2025-01-10") for n in range(1, 10)]


def test_a_part_is_read_as_frames_and_its_first_records_told():
    import pandas as pd

    class State:
        value = None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    class Handle:
        timers = []

        def getValueState(self, name, schema):
            return State()

        def registerTimer(self, at):
            self.timers.append(at)

    class Clock:
        def getCurrentWatermarkInMs(self):
            return 100

    def frame(*rows):
        names = ["accession_number", "exhibit_url", "metric", "val1", "val2", "sent_ord", "metric_ord", "filed_ms"]
        return pd.DataFrame([dict(zip(names, r)) for r in rows])

    told = guidance_stream.FirstRecords()
    told.init(Handle())
    late, new = ("a", "u", "EPS", 1.0, 2.0, 5, 0, 300), ("a", None, "EPS", 1.0, 2.0, 3, 0, 200)
    old, undated = ("a", "u", "EPS", 1.0, 2.0, 9, 0, 50), (None, "u", "EPS", 1.0, 2.0, 1, 0, None)
    out = pd.concat(told.handleInputRows((0,), iter([frame(late, old), frame(new, undated, undated)]), Clock()))
    rows = [(r.accession_number, r.sent_ord, bool(r.settled)) for r in out.itertuples()]
    # The first in order is told; what is behind the watermark or has no date goes on unsettled, each time.
    assert rows == [(None, 1, False), (None, 1, False), ("a", 3, True), ("a", 9, False)]
    assert told.told.value == (["'a'|'EPS'|1.0|2.0"], [200]) and Handle.timers == [200]
    again = pd.concat(told.handleInputRows((0,), iter([frame(late)]), Clock()))
    assert len(again) == 0 and told.told.value[1] == [200]
