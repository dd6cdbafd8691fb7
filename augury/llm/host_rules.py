"""Quality rules of documents, summed up by host and joined back. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from augury.functions.text import let
from augury.llm.shared import rows_of, written

SPACE = r"[\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: A document fails by symbols if it has more than this many for 100 words.
MAX_SYMBOL_PERCENT = 10
#: A host is rejected if its shrunk rate of failed documents is above this.
MAX_HOST_RATE = 0.5
#: The prior counts as at least so many, and at most so many, documents of a host.
LEAST_PRIOR, MOST_PRIOR = 2.0, 1000.0


@dataclass(frozen=True)
class Prior:
    """Beta prior of the hosts' failure rates."""

    alpha: float
    beta: float


def repeated_window_words(words: Column, size: int = WINDOW) -> Column:
    """Words that lie in a run of ``size`` words found twice or more in the text.

    Runs are compared by a 64-bit hash of their words. Only if some are equal are they sorted,
    with their places; covered words are then added up from place to place.
    """

    def covered(places: Column) -> Column:
        lengths = F.transform(
            places, lambda p, i: F.least(F.lit(size), F.coalesce(F.get(places, i + 1) - p, F.lit(size)))
        )
        return F.aggregate(lengths, F.lit(0).cast("long"), lambda total, n: total + n)

    def repeated(ranked: Column) -> Column:
        same = F.filter(
            ranked,
            lambda r, i: (r["h"] == F.get(ranked, i + 1)["h"]) | (r["h"] == F.get(ranked, i - 1)["h"]),
        )
        return let(F.array_sort(F.transform(same, lambda r: r["at"])), covered)

    def counted(runs: Column) -> Column:
        placed = F.transform(runs, lambda h, i: F.struct(h.alias("h"), i.alias("at")))
        return F.when(
            F.size(F.array_distinct(runs)) < F.size(runs), let(F.array_sort(placed), repeated)
        ).otherwise(F.lit(0).cast("long"))

    runs = F.transform(
        F.sequence(F.lit(1), F.size(words) - size + 1), lambda i: F.xxhash64(F.slice(words, i, size))
    )
    return F.when(F.size(words) > size, let(runs, counted)).otherwise(F.lit(0).cast("long"))


def features(docs: DataFrame) -> DataFrame:
    """``doc_id, host`` and the counts of each text, which itself stays behind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select(
        "doc_id", "host", text.alias("text"),
        F.filter(F.split(text, SPACE + "+", -1), lambda w: w != "").alias("words"),
    )
    lines = F.filter(F.split("text", "\n", -1), lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]")))
    symbols = F.length("text") - F.length(F.regexp_replace("text", SYMBOL, ""))
    return split.select(
        "doc_id", "host",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
        let(lines, lambda own: F.size(own) - F.size(F.array_distinct(own))).cast("long").alias("n_dup_lines"),
        repeated_window_words(F.col("words")).alias("n_repeat_words"),
    )


def fit_prior(hosts: DataFrame) -> Prior:
    """Moments of the hosts' failure rates, each host weighing by its documents.

    The variance between hosts is what exceeds the sampling variance. Without hosts, or
    without a spread, the prior is the mean rate at the bound of its weight. One row comes back.
    """
    rate = F.col("failed") / F.col("documents")
    row = hosts.agg(
        F.sum("documents").alias("n"), F.sum("failed").alias("failed"), F.count(F.lit(1)).alias("hosts"),
        F.sum(F.col("documents") * rate * rate).alias("squares"),
        F.sum(F.col("documents").cast("double") ** 2).alias("n2"),
    ).first()
    if not row["n"]:
        return Prior(LEAST_PRIOR / 2, LEAST_PRIOR / 2)
    n, mean = row["n"], (row["failed"] + 1) / (row["n"] + 2)
    raw = row["failed"] / n
    between = max(0.0, row["squares"] - n * raw * raw) - (row["hosts"] - 1) * raw * (1 - raw)
    spread = between / max(1.0, n - row["n2"] / n)
    weight = mean * (1 - mean) / spread - 1 if spread > 0 else MOST_PRIOR
    weight = min(MOST_PRIOR, max(LEAST_PRIOR, weight))
    return Prior(mean * weight, (1 - mean) * weight)


def judge_hosts(hosts: DataFrame, prior: Prior) -> DataFrame:
    """Adds the shrunk failure rate and the verdict of each host."""
    rate = (F.col("failed") + prior.alpha) / (F.col("documents") + prior.alpha + prior.beta)
    return hosts.withColumn("host_rate", rate).withColumn("host_kept", F.col("host_rate") <= MAX_HOST_RATE)


def host_quality(
    docs: DataFrame, host_col: str = "source", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Counts, failures and the verdict of every row.

    ``base_failed``: fewer than 20 words, or over 30 % of them in repeated runs.
    ``symbols_failed``: more than 10 symbols for 100 words. A host's failures are the rows that
    fail by either; its rate is shrunk towards all hosts by a beta prior fitted to them. A row
    is kept if neither it nor its host fails.

    A null text has no words. A null host is a host of its own. Ids and repeated rows pass
    through; every row counts. An empty table gives no rows.

    Texts are read once and do not move: only counts are written, added up by host within each
    task before the shuffle, and joined with the verdicts.
    """
    rows = rows_of(docs, id_col, text_col, host_col).toDF("doc_id", "text", "host")
    base = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    symbols = 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("n_words")
    counted = written(
        features(rows).withColumn("base_failed", base).withColumn("symbols_failed", symbols)
        .withColumn("host", F.coalesce(F.concat(F.lit("="), "host"), F.lit(""))),
        "features",
    )
    failed = (F.col("base_failed") | F.col("symbols_failed")).cast("long")
    hosts = counted.groupBy("host").agg(F.count(F.lit(1)).alias("documents"), F.sum(failed).alias("failed"))
    verdicts = judge_hosts(hosts, fit_prior(hosts))
    return counted.join(verdicts, "host").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~F.col("symbols_failed") & F.col("host_kept")).alias("kept"),
        "symbols_failed", "host_rate",
    )
