"""Guidance from exhibits as they arrive."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from augury import schemas
from augury.plans.guidance import build_guidance
from augury.session import fresh_folder, importable


def read_exhibit_stream(
    spark: SparkSession, source: str, files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schemas.EXHIBITS)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(source)


KEY = ("accession_number", "metric", "val1", "val2")
#: How long after its filing date a filing's records are remembered, by the latest date seen.
RETENTION_DAYS = 120

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def guidance_stream(exhibits: DataFrame) -> DataFrame:
    """Stateless extraction; a filing of any date is taken whenever it arrives."""
    return build_guidance(exhibits)


#: Filings are remembered in so many parts; each is read and written as one value. Fixed for a checkpoint.
PARTS = 1024
_OWN = ("filed_ms", "part", "settled")
_ORDER = ("accession_number", "exhibit_url", "sent_ord", "metric_ord")


class FirstRecords(StatefulProcessor):
    """The records told so far of a part of all filings, until their dates fall behind the watermark.

    A record told before is left out. One whose date is behind the watermark may have been told
    and forgotten: it goes on as ``settled = false``, for a look at the target. Rows come and go as
    frames: one by one, each cost some 200 microseconds on its way.
    """

    STATE = "records array<string>, filed array<long>"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.told = handle.getValueState("told", self.STATE)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        state = self.told.get() or ([], [])
        known = {r: filed for r, filed in zip(*state) if filed > watermark}
        before, last = len(known), max(known.values(), default=watermark)
        batch = pd.concat(list(rows), ignore_index=True)
        batch["settled"] = batch["filed_ms"].gt(watermark)  # false for a missing date
        order = list(zip(*[batch[c].tolist() for c in _ORDER]))
        told = [batch[c].tolist() for c in (*KEY, "filed_ms", "settled")]
        kept = []
        for at in sorted(range(len(batch)), key=lambda i: (str(order[i][0]), order[i][1] or "", *order[i][2:])):
            *record, filed, settled = (column[at] for column in told)
            if settled:
                record = "|".join(map(repr, record))
                if record in known:
                    continue
                known[record] = int(filed)
            kept.append(at)
        yield batch.iloc[kept]
        if len(known) > before:
            self.told.update((list(known), list(known.values())))
            if max(known.values()) > last:
                self.handle.registerTimer(max(known.values()))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state = self.told.get()
        if state and max(state[1]) <= expiredTimerInfo.getExpiryTimeInMs():
            self.told.clear()
        return iter(())

    def close(self) -> None:
        pass


def first_records(records: DataFrame, retention_days: int = RETENTION_DAYS) -> DataFrame:
    """The stream's records that were not told before, and those that the target has to settle.

    The clock is the latest filing date seen less ``retention_days``. The date itself stays below
    the watermark's operator, so that Spark drops no late row: late ones come out unsettled.
    """
    importable(records.sparkSession)
    dated = records.withColumn("_filed", F.try_to_timestamp(F.col("date_filed").cast("string")))
    marked = dated.withWatermark("_filed", f"{retention_days} days")
    filed = F.unix_millis("_filed")
    part = F.pmod(F.xxhash64("accession_number"), F.lit(PARTS))
    plain = marked.withColumns({"filed_ms": filed, "part": part}).drop("_filed")
    schema = T.StructType([*plain.schema.fields, T.StructField("settled", T.BooleanType())])
    return plain.groupBy("part").transformWithStateInPandas(
        FirstRecords(), outputStructType=schema, outputMode="Append", timeMode="EventTime"
    )


def append_new(records: DataFrame, target: str) -> None:
    """Append the records whose key the target does not have, the first of each key.

    Only the target's rows of the dates at hand are read. A batch that is repeated after a
    failure adds nothing a second time.
    """
    span = records.agg(F.min("date_filed").alias("low"), F.max("date_filed").alias("high"), F.count(F.lit(1)).alias("n")).first()
    if not span["n"]:
        return
    dates = F.col("date_filed").between(span["low"], span["high"]) | F.col("date_filed").isNull()
    there = records.sparkSession.read.schema(records.schema).parquet(target).filter(dates).select(*KEY).distinct()
    w = W.partitionBy(*KEY).orderBy("date_filed", "exhibit_url", "sent_ord", "metric_ord")
    first = records.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")
    known = there.select(*[F.col(c).alias(f"_{c}") for c in KEY])
    same = [first[c].eqNullSafe(known[f"_{c}"]) for c in KEY]
    first.join(known, reduce(and_, same), "left_anti").write.mode("append").parquet(target)


def _unfinished(spark: SparkSession, checkpoint: str) -> int:
    """The batch that was planned but not committed when the stream last stopped; -1 without one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(checkpoint)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())

    def last(name: str) -> int:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path, name)
        found = files.listStatus(folder) if files.exists(folder) else []
        return max((int(f.getPath().getName()) for f in found if f.getPath().getName().isdigit()), default=-1)

    planned = last("offsets")
    return planned if planned > last("commits") else -1


def settle(batch: DataFrame, target: str, repeated: bool) -> None:
    """Append a batch: what is settled as it is, the rest after a look at the target.

    A batch that may have been written before it failed is looked up as a whole.
    """
    spark = batch.sparkSession
    staged = fresh_folder(spark, "batch")
    batch.write.parquet(staged)  # the state is asked once
    rows = spark.read.schema(batch.schema).parquet(staged)
    sure = F.col("settled") & F.lit(not repeated)
    told = [c for c in batch.columns if c not in _OWN]
    rows.filter(sure).select(told).write.mode("append").parquet(target)
    append_new(rows.filter(~sure).select(told), target)


def stream_guidance(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    dedup: bool = False,
    files_per_trigger: int | None = None,
    retention_days: int = RETENTION_DAYS,
) -> StreamingQuery:
    """Read what is new, append its records, stop. The checkpoint is the ledger.

    Without ``dedup`` the file sink commits a batch's files at once, so a run that is repeated
    after a failure leaves no copies, but a filing delivered twice does; D2 downstream removes
    them. A target is fed one way or the other.

    With ``dedup`` records that were told before are left out. Those of filings up to
    ``retention_days`` older than the latest one are remembered in a RocksDB store, so a batch
    of such filings does not read the target, however large it is; older ones are compared with
    the target's rows of their dates. A filing may come again under another date while it is
    remembered; one that was forgotten and then gets a recent date is taken for a new one.
    """
    records = guidance_stream(read_exhibit_stream(spark, source, files_per_trigger))
    if not dedup:
        writer = records.writeStream.format("parquet").outputMode("append").option("path", target)
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    spark.createDataFrame([], records.schema).write.mode("append").parquet(target)
    repeated = _unfinished(spark, checkpoint)
    first = first_records(records, retention_days)
    writer = first.writeStream.foreachBatch(lambda batch, number: settle(batch, target, number == repeated))
    provider = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)  # the query keeps the settings it starts with
    try:
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(_PROVIDER, provider)


def state_rows(query: StreamingQuery) -> int:
    """Parts, ``PARTS`` at most, that remember filings after the query's last batch."""
    progress = query.lastProgress
    return sum(op["numRowsTotal"] for op in progress["stateOperators"]) if progress else 0
