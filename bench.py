"""Time the headline jobs. Prints one JSON line.

Inputs are derived from the given tables and staged as Parquet first, as filings would
lie; staging is not timed. Every job reads and computes its whole input and writes the
result to the noop sink. One pass at a small scale warms the JVM up. Besides seconds, the line
has the megabytes of text that extraction reads per second, over short and over long texts
(tens of kilobytes, as press releases have), and the bytes each job shuffles.
"""

from __future__ import annotations

import json
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from augury.functions.markup import strip_html  # noqa: E402
from augury.operators.model import map_to_guidance, parse_responses  # noqa: E402
from augury.operators.profile import summarise_panel  # noqa: E402
from augury.plans.exhibits import build_exhibits  # noqa: E402
from augury.plans.filing_index import build_filing_index, filing_index  # noqa: E402
from augury.plans.guidance import build_guidance, guidance_from_bodies  # noqa: E402
from augury.plans.panel import build_panel  # noqa: E402
from augury.session import local_session  # noqa: E402
from augury.sources.index import parse_index_lines  # noqa: E402
from checks import inputs  # noqa: E402
from checks import queries as q  # noqa: E402


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def long_texts(exhibits: DataFrame) -> DataFrame:
    """Every fiftieth filing with a text of tens of kilobytes: its own, sixty times, numbered."""
    chosen = exhibits.filter(F.pmod(F.xxhash64("accession_number"), F.lit(50)) == 0)
    parts = F.transform(F.sequence(F.lit(1), F.lit(60)), lambda i: F.concat(F.col("text"), F.lit(" Part "), i.cast("string"), F.lit(". ")))
    return chosen.withColumn("text", F.array_join(parts, ""))


def megabytes(df: DataFrame) -> float:
    return (df.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / 1e6


def shuffled(spark: SparkSession) -> int:
    """Bytes that all stages so far have written for shuffles."""
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def jobs(spark: SparkSession, d: str) -> dict:
    """Job by name; building one stages its inputs, running it does the work."""
    exhibits = q.press(spark, d)
    bodies = q.staged(spark, d, "bodies", inputs.BODIES)
    listings = q.staged(spark, d, "listings", inputs.LISTINGS)
    lines = q.staged(spark, d, "lines", inputs.INDEX_LINES)
    answers = q.staged(spark, d, "answers", inputs.RESPONSES)
    index = q.written(q.press_index(spark, d), "index")
    tickers = q.written(q.tickers(spark, d), "tickers")
    guidance = q.written(build_guidance(exhibits), "guidance")
    panel = q.written(build_panel(guidance, tickers, ordered=False), "panel")
    files = q.write_index_files(spark, d)
    long = q.written(long_texts(exhibits), "long")
    return {
        "z1_filing_index": lambda: run(filing_index(parse_index_lines(lines))),
        "z1_index_files_sorted": lambda: run(build_filing_index(spark, files, 1990, 2030)),
        "e7_strip_html": lambda: run(
            q.table(spark, d, "pages").select("page_id", strip_html(F.col("html")))
        ),
        "z2_exhibits": lambda: run(build_exhibits(index, listings, bodies)),
        "z3_guidance": lambda: run(build_guidance(exhibits)),
        "z3_guidance_long_texts": lambda: run(build_guidance(long)),
        "z3_guidance_from_bodies": lambda: run(guidance_from_bodies(index, listings, bodies)),
        "x3_x4_model_answers": lambda: run(map_to_guidance(parse_responses(answers))),
        "z5_panel": lambda: run(build_panel(guidance, tickers)),
        "a1_summary": lambda: run(summarise_panel(panel)),
        "z3_z5_a1_texts_to_summary": lambda: run(
            summarise_panel(build_panel(build_guidance(exhibits), tickers, ordered=False))
        ),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    small = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(small):
        for job in jobs(spark, small).values():
            job()
    timed, moved = {}, {}
    for name, job in jobs(spark, sf_dir).items():
        before, start = shuffled(spark), time.perf_counter()
        job()
        timed[name] = round(time.perf_counter() - start, 3)
        moved[name] = round((shuffled(spark) - before) / 1e6, 1)
    short, long = megabytes(q.press(spark, sf_dir)), megabytes(long_texts(q.press(spark, sf_dir)))
    documents = q.press(spark, sf_dir).count()
    print(
        json.dumps(
            {
                "metric": "headline jobs, total",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "documents": documents,
                "cores": cores,
                "shuffle_mb": moved,
                "z3_mb_per_sec": round(short / timed["z3_guidance"], 1),
                "z3_long_mb": round(long, 1),
                "z3_long_mb_per_sec": round(long / timed["z3_guidance_long_texts"], 1),
                "z3_documents_per_sec": round(documents / timed["z3_guidance"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
