"""Model-assisted extraction. The client is injected; nothing here knows a service."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from augury import schemas
from augury.functions import fixed_values as fixed
from augury.functions.text import WORD_BREAK, let, strip
from augury.operators.guidance import extract_guidance
from augury.operators.joins import lookup_metric
from augury.sources.tables import write_parquet_table

INSTRUCTIONS = (
    "Extract each forward-looking guidance statement of the press release, one item per "
    "metric, period and fiscal year. Leave out reported results. Ranges fill value_low and "
    "value_high, single figures fill value_point. Answer with JSON: "
    '{"guidance_items": [...]}; an empty list if there is no guidance.'
)


class ModelClient(Protocol):
    def complete(self, instructions: str, request: str) -> tuple[str, int, int]:
        """Response text, input tokens, output tokens; raises on failure."""


# --- requests ---------------------------------------------------------------


def prefilter_text(text: Column) -> Column:
    """Up to 3,000 words unchanged; longer texts are cut by what the rest holds."""
    stems = "|".join(fixed.PREFILTER_STEMS)
    head = fixed.PREFILTER_HEAD_WORDS

    def cut(words: Column) -> Column:
        rest = F.lower(F.array_join(F.slice(words, head + 1, F.size(words)), " "))
        keep = F.when(rest.rlike(stems), F.lit(fixed.PREFILTER_MAX_WORDS)).otherwise(head)
        return F.when(F.size(words) <= fixed.PREFILTER_MAX_WORDS, text).otherwise(
            F.array_join(F.slice(words, F.lit(1), keep), " ")
        )

    # A word and its gap take two characters at least, so that short texts need no count of words.
    short = F.length(text) <= 2 * fixed.PREFILTER_MAX_WORDS
    return F.when(short, text).otherwise(let(F.split(strip(text), WORD_BREAK, -1), cut))


def render_requests(exhibits: DataFrame) -> DataFrame:
    """Filing keys and the ``request`` text; the full text stays behind.

    Filings without a text ask nothing and are left out.
    """

    def field(name: str) -> Column:
        if name not in exhibits.columns:
            return F.lit("Unknown")
        return F.coalesce(F.col(name).cast("string"), F.lit("None"))

    request = F.concat(
        F.lit("Company: "), field("company_name"),
        F.lit("\nFiling date: "), field("date_filed"),
        F.lit("\n\nPress release text:\n"), prefilter_text(F.col("text")),
    )
    keys = [c for c in exhibits.columns if c in schemas.FILING_KEYS]
    return exhibits.filter(F.col("text").isNotNull()).select(*keys, request.alias("request"))


# --- the call ---------------------------------------------------------------


def extract_with_model(
    requests: DataFrame,
    client_factory: Callable[[], ModelClient],
    concurrency: int = fixed.MODEL_CONCURRENCY,
    attempts: int = fixed.MODEL_ATTEMPTS,
    wait: float = 2.0,
) -> DataFrame:
    """Adds ``response``, ``status`` (ok, failed) and the tokens used.

    One client per task and ``concurrency`` calls at a time in it. Write the result
    before using it twice: a recomputed task calls again.
    """

    def call(client: ModelClient, request: str) -> tuple[str | None, str, int, int]:
        for attempt in range(attempts):
            try:
                content, used_in, used_out = client.complete(INSTRUCTIONS, request)
                return content, "ok", int(used_in), int(used_out)
            except Exception:
                pause = wait ** (attempt + 1) if attempt + 1 < attempts else 0.0
                if pause > 0:  # a sleep of no time would still change threads
                    time.sleep(pause)
        return None, "failed", 0, 0

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = client_factory()
        with ThreadPoolExecutor(max_workers=concurrency) as pool:
            for batch in batches:
                # Each thread takes the next request: handing them out one by one costs more than short calls.
                waiting, answers = deque(enumerate(batch["request"])), [None] * len(batch)

                def work(_: int) -> None:
                    while waiting:
                        try:
                            at, request = waiting.popleft()
                        except IndexError:  # another thread took the last one
                            return
                        answers[at] = call(client, request)

                list(pool.map(work, range(concurrency)))
                out = batch.drop(columns="request")
                out[["response", "status", "tokens_in", "tokens_out"]] = pd.DataFrame(
                    answers, index=batch.index, columns=["r", "s", "i", "o"]
                )
                yield out

    outcome = [
        T.StructField("response", T.StringType()), T.StructField("status", T.StringType()),
        T.StructField("tokens_in", T.LongType()), T.StructField("tokens_out", T.LongType()),
    ]
    schema = T.StructType([f for f in requests.schema if f.name != "request"] + outcome)
    return requests.mapInPandas(run, schema)


# --- responses --------------------------------------------------------------

_ENUMS = {
    "forecast_metric": list(fixed.MODEL_METRICS),
    "time_horizon": fixed.HORIZONS,
    "estimate_type": fixed.ESTIMATE_TYPES,
    "unit": fixed.UNITS,
    "direction": fixed.DIRECTIONS,
}
_REQUIRED = [*_ENUMS, "confidence_language", "is_adjusted", "context_sentence"]


def with_parsed_response(responses: DataFrame, column: str = "response") -> DataFrame:
    """Adds ``items`` (array) and ``is_json``; no list gives no items.

    Fields are read one by one: one of the wrong type is NULL, the others and the other items stay.
    """

    def typed(item: Column) -> Column:
        return F.struct(*[item[f.name].try_cast(f.dataType).alias(f.name) for f in schemas.MODEL_ITEM])

    return (
        responses.withColumn("_parsed", F.from_json(F.col(column), schemas.MODEL_RESPONSE))
        .withColumn(
            "is_json", F.col("_parsed").isNotNull() & F.col("_parsed._corrupt_record").isNull()
        )
        .withColumn("items", F.when(F.col("is_json"), F.transform("_parsed.guidance_items", typed)))
        .drop("_parsed", column)
    )


def parse_responses(responses: DataFrame, column: str = "response") -> DataFrame:
    """One row per item, with ``problem`` naming the first broken field, if any."""
    parsed = with_parsed_response(responses, column)
    keys = [c for c in parsed.columns if c not in ("items", "is_json")]
    rows = parsed.select(
        *keys,
        F.explode(
            F.transform("items", lambda x, i: F.struct(i.alias("item_ord"), x.alias("item")))
        ).alias("e"),
    ).select(*keys, "e.item_ord", "e.item.*")
    problem = F.lit(None).cast("string")
    for name in reversed(_REQUIRED):
        broken = F.col(name).isNull()
        if name in _ENUMS:
            broken = broken | ~F.col(name).isin(_ENUMS[name])
        problem = F.when(broken, F.lit(name)).otherwise(problem)
    return rows.withColumn("problem", problem)


def accepted_items(items: DataFrame) -> DataFrame:
    """Items without a problem, for who wants no others; the jobs keep all, with theirs named."""
    return items.filter(F.col("problem").isNull()).drop("problem")


def store_items(responses: DataFrame, path: str, column: str = "response") -> dict[str, int]:
    """All items of the answers in two tables under ``path``, by one reading of the answers.

    ``path/items/accepted=true`` has those without a problem, ``accepted=false`` the others with
    the name of the first field that broke the rules. The counts of the manifest are taken by the
    tasks that write, returned, and kept in ``path/manifest``.
    """
    told = Observation("items")
    good = F.col("accepted")
    items = parse_responses(responses, column).withColumn("accepted", F.col("problem").isNull())
    counted = items.observe(
        told, F.count_if(good).alias("accepted"), F.count_if(~good).alias("rejected"),
        *[F.count_if(F.col("problem") == name).alias(f"rejected_{name}") for name in _REQUIRED],
    )
    write_parquet_table(counted, f"{path}/items", ["accepted"])
    manifest = dict(told.get)
    row = ", ".join(f"{name} long" for name in manifest)
    spark = responses.sparkSession
    write_parquet_table(spark.createDataFrame([tuple(manifest.values())], row).coalesce(1), f"{path}/manifest")
    return manifest


def read_items(spark: SparkSession, path: str, accepted: bool) -> DataFrame:
    """One of the two tables of :func:`store_items`; the other one's files are not opened."""
    rows = spark.read.parquet(f"{path}/items").filter(F.col("accepted") == accepted).drop("accepted")
    return rows.drop("problem") if accepted else rows


def map_to_guidance(items: DataFrame) -> DataFrame:
    """Items to guidance columns, enriched columns beside them.

    Names that the panel does not know pass through. Values keep their unit: ``millions`` does not rescale them.
    """
    is_range = F.col("estimate_type") == "range"
    low = F.when(is_range, F.col("value_low")).otherwise(F.col("value_point"))
    high = F.when(is_range, F.col("value_high")).otherwise(F.col("value_point"))
    swapped = low > high
    ordered = lookup_metric(items).withColumns(
        {
            "is_range": is_range,
            "val1": F.when(swapped, high).otherwise(low),
            "val2": F.when(swapped, low).otherwise(high),
        }
    )
    both = F.col("val1").isNotNull() & F.col("val2").isNotNull()
    return ordered.withColumns(
        {
            "midpoint": F.when(
                F.col("val1").isNotNull(),
                (F.col("val1") + F.coalesce("val2", F.lit(0.0))) / 2,
            ),
            "range_width": F.when(
                F.col("is_range") & both, F.col("val2") - F.col("val1")
            ).otherwise(0.0),
            "pdicity": F.col("time_horizon"),
            "action": F.col("direction"),
            "sentence": F.substring(
                F.coalesce("context_sentence", F.lit("")), 1, fixed.SENTENCE_CHARS
            ),
        }
    ).drop("time_horizon", "context_sentence").withColumnRenamed("item_ord", "sent_ord")


# --- cost -------------------------------------------------------------------

_CHUNKS_PER_BLOCK = 1000


def cost_cap(usage: DataFrame, max_cost: float, model: str = fixed.DEFAULT_MODEL) -> DataFrame:
    """Rows of chunks that start before earlier chunks have cost ``max_cost`` (0: all).

    ``usage`` has ``chunk_no`` and the tokens. Token sums run in two levels, blocks of
    chunks and chunks of a block, so no task sees all chunks.
    """
    if max_cost <= 0:
        return usage
    price_in, price_out = fixed.MODEL_PRICES.get(model, fixed.MODEL_PRICES[fixed.DEFAULT_MODEL])
    block = F.floor(F.col("chunk_no") / _CHUNKS_PER_BLOCK).alias("block")
    sums = [F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out")]
    chunks = usage.groupBy("chunk_no", block).agg(*sums)
    blocks = chunks.groupBy("block").agg(*sums)

    def ahead(column: str, w) -> Column:
        return F.coalesce(F.sum(column).over(w), F.lit(0))

    over = W.orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    before = blocks.select(
        "block",
        ahead("tokens_in", over).alias("block_in"),
        ahead("tokens_out", over).alias("block_out"),
    )
    within = W.partitionBy("block").orderBy("chunk_no").rowsBetween(W.unboundedPreceding, -1)
    spent = chunks.join(before, "block").select(
        "chunk_no",
        (
            (F.col("block_in") + ahead("tokens_in", within)) / 1e6 * price_in
            + (F.col("block_out") + ahead("tokens_out", within)) / 1e6 * price_out
        ).alias("spent"),
    )
    allowed = spent.filter(F.col("spent") < max_cost).select("chunk_no")
    return usage.join(allowed, "chunk_no", "left_semi")


# --- outcomes ---------------------------------------------------------------


def settle_outcomes(outcomes: DataFrame) -> DataFrame:
    """One row per filing however often it was tried: an answer if there is one, else the latest."""
    w = W.partitionBy("accession_number").orderBy(
        (F.col("status") == "ok").desc(), F.col("called_at").desc(), "status"
    )
    return outcomes.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


# --- fallback ---------------------------------------------------------------


def fallback_regex(exhibits: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Records by wording for the filings that no call answered.

    ``outcomes`` may hold several tries of a filing: one that was answered is not failed.
    """
    answered = F.max((F.col("status") == "ok").cast("int"))
    tried = outcomes.groupBy("accession_number").agg(answered.alias("answered"))
    failed = tried.filter("answered = 0").select("accession_number")
    again = exhibits.join(failed, "accession_number", "left_semi")
    return extract_guidance(again.select(*schemas.FILING_KEYS, "text"))
