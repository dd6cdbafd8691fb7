"""Exhibits to guidance records through an injected model client."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from augury import schemas
from augury.functions import fixed_values as fixed
from augury.operators.joins import exclude_processed
from augury.operators.model import (
    ModelClient, extract_with_model, fallback_regex, map_to_guidance, parse_responses,
    render_requests, settle_outcomes, with_parsed_response,
)
from augury.operators.panel import chunk_rows
from augury.operators.profile import usage_cost
from augury.session import fresh_folder
from augury.sources.tables import write_parquet_table

#: What is kept of each call.
OUTCOMES = T.StructType(
    [T.StructField(name, T.StringType()) for name in schemas.FILING_KEYS]
    + [T.StructField(name, T.StringType()) for name in ("response", "status", "model", "run_id")]
    + [T.StructField(name, T.LongType()) for name in ("tokens_in", "tokens_out", "chunk_no")]
    + [T.StructField("called_at", T.TimestampType())]
)


#: Chunks that one commit holds while no cost cap makes it smaller.
COMMIT_CHUNKS = 64


def outcomes_so_far(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(OUTCOMES).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise


def _cost(outcomes: DataFrame | None) -> float:
    return (usage_cost(outcomes).agg(F.sum("cost")).first()[0] or 0.0) if outcomes is not None else 0.0


def staged_requests(requests: DataFrame, wave_rows: int) -> DataFrame:
    """The requests with their ``chunk_no``, as written: a folder for each commit of chunks.

    The chunks of a commit are dealt over as many files as there are cores, so that a wave keeps
    all of them busy. They are dealt by hash: dealing by ranges would render all requests once more.
    A filing that comes several times is asked that often, all of it in its first chunk.
    """
    spark = requests.sparkSession
    cores = spark.sparkContext.defaultParallelism
    chunks = chunk_rows(requests.select("accession_number"), ["accession_number"], wave_rows)
    first = chunks.groupBy("accession_number").agg(F.min("chunk_no").alias("chunk_no"))
    dealt = requests.join(first, "accession_number").withColumn("commit_no", F.floor(F.col("chunk_no") / COMMIT_CHUNKS))
    path = fresh_folder(spark, "requests")
    rows = -(-COMMIT_CHUNKS * wave_rows // cores)
    dealt.repartition("commit_no", F.pmod("chunk_no", F.lit(cores))).write.option("maxRecordsPerFile", rows).partitionBy(
        "commit_no"
    ).parquet(path)
    return spark.read.schema(dealt.schema).parquet(path)


def call_model(
    exhibits: DataFrame,
    client_factory: Callable[[], ModelClient],
    outcomes_path: str,
    concurrency: int = fixed.MODEL_CONCURRENCY,
    model: str = fixed.DEFAULT_MODEL,
    max_cost: float = 0.0,
    wave_rows: int = fixed.MODEL_BATCH_ROWS,
    wait: float = 2.0,
) -> DataFrame:
    """Append every outcome to a table and read it back.

    Calls are paid for, so nothing downstream may repeat them, and a job that fails keeps what
    it has. Requests are written once, by their chunk of ``wave_rows`` filings. A wave of chunks
    reads its own folder of them, on all cores, and commits as it ends. With a cost cap, no wave starts
    once the outcomes, those of earlier runs with them, have cost as much; a wave is as many
    chunks as half of what is left should pay for, by the price of the chunks before it, and
    the first is one chunk. Its cost is read from its own rows.
    """
    spark = exhibits.sparkSession
    asked = staged_requests(render_requests(exhibits), wave_rows)
    last = asked.agg(F.max("chunk_no")).first()[0]
    spent, run_id = _cost(outcomes_so_far(spark, outcomes_path)) if max_cost > 0 else 0.0, uuid.uuid4().hex
    before, following = spent, 0
    while last is not None and following <= last and (max_cost <= 0 or spent < max_cost):
        size = COMMIT_CHUNKS
        if max_cost > 0:
            paid = (spent - before) / following if following else None
            size = 1 if not paid else max(1, min(size, int((max_cost - spent) / paid / 2)))
        wave = (F.col("chunk_no") >= following) & (F.col("chunk_no") < following + size)
        folders = F.col("commit_no").between(following // COMMIT_CHUNKS, (following + size - 1) // COMMIT_CHUNKS)
        out = extract_with_model(asked.filter(folders & wave).drop("commit_no"), client_factory, concurrency, wait=wait)
        checked = with_parsed_response(out.withColumn("answer", F.col("response")), "answer")
        broken = (F.col("status") == "ok") & ~F.col("is_json")
        settled = checked.withColumns(
            {
                "status": F.when(broken, F.lit("failed")).otherwise(F.col("status")),
                "model": F.lit(model),
                "run_id": F.lit(run_id),
                "called_at": F.current_timestamp(),
            }
        )
        for field in OUTCOMES:
            if field.name not in settled.columns:
                settled = settled.withColumn(field.name, F.lit(None).cast(field.dataType))
        write_parquet_table(settled.select(OUTCOMES.fieldNames()), outcomes_path, mode="append")
        if max_cost > 0:
            own = outcomes_so_far(spark, outcomes_path).filter((F.col("run_id") == run_id) & wave)
            spent += _cost(own)
        following += size
    found = outcomes_so_far(spark, outcomes_path)
    return spark.createDataFrame([], OUTCOMES) if found is None else found


def build_guidance_model(
    exhibits: DataFrame,
    client_factory: Callable[[], ModelClient],
    outcomes_path: str,
    ledger: DataFrame | None = None,
    fallback: bool = False,
    **calling,
) -> DataFrame:
    """J2, X1-X7. Failed filings give no records, or those read from their wording.

    Only filings that are still to do give records. Of several tries of a filing an answer
    wins; wording serves only who has none. Every item gives a record; ``problem`` names the
    first field that breaks the rules, if any.
    """
    todo = exclude_processed(exhibits, ledger) if ledger is not None else exhibits
    outcomes = call_model(todo, client_factory, outcomes_path, **calling)
    keys = todo.select("accession_number").distinct()
    settled = settle_outcomes(outcomes.join(keys, "accession_number", "left_semi"))
    answered = settled.filter(F.col("status") == "ok").select(*schemas.FILING_KEYS, "response")
    records = map_to_guidance(parse_responses(answered))
    if fallback:
        records = records.unionByName(fallback_regex(todo, settled), allowMissingColumns=True)
    return records


def processed_ledger(outcomes: DataFrame) -> DataFrame:
    """Keys that need no further call: failed ones stay out, so they are tried again."""
    return outcomes.filter(F.col("status") == "ok").select("accession_number", "status").distinct()
