"""The registered queries: each operator on its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from augury.llm.byte_bpe import encode_and_decode
from augury.llm.conversation_repair import repair_conversations
from augury.llm.exact_top_k import exact_top_k
from augury.llm.host_rules import host_quality
from augury.llm.lm_score import score_documents
from augury.llm.ngram_join import similar_documents
from augury.llm.packing import pack
from augury.llm.periodic_runs import RUNS, periodic_runs
from augury.llm.pii import digest, find_personal_data
from augury.llm.radix_dedup import radix_dedup
from augury.llm.suffix_dedup import repeated_passages
from augury.llm.toxicity import score_toxicity
from augury.llm.warc import round_trip
from augury.session import importable

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_two_fit_packing(spark: SparkSession, d: str) -> DataFrame:
    return pack(table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_host_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return host_quality(table(spark, d, "documents")).withColumn("host_rate", F.round("host_rate", 6))


def op3_weak_supervision_pii(spark: SparkSession, d: str) -> DataFrame:
    return digest(find_personal_data(table(spark, d, "documents")))


def op4_warc_transactions(spark: SparkSession, d: str) -> DataFrame:
    captures = round_trip(table(spark, d, "pages"), with_payload=False)
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_radix_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    return radix_dedup(table(spark, d, "documents"))


def op6_vertical_jaccard_join(spark: SparkSession, d: str) -> DataFrame:
    return similar_documents(table(spark, d, "documents"))


def op7_cross_entropy_difference(spark: SparkSession, d: str) -> DataFrame:
    good = table(spark, d, "labels").filter("quality = 1")
    return score_documents(table(spark, d, "documents"), good)


def op8_sparse_suffix_passages(spark: SparkSession, d: str) -> DataFrame:
    """Every document, with the passages it shares with another, if any."""
    found = repeated_passages(table(spark, d, "documents"))
    text = F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["stop"].cast("string")))
    return found.select("doc_id", "n_words", "n_repeated", F.size("spans").alias("n_spans"), F.array_join(text, ",").alias("spans"))


def op9_sentencepiece_byte_bpe(spark: SparkSession, d: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return encode_and_decode(table(spark, d, "documents"), ranks, public_tokenizers.PATTERN)


def op10_levenshtein_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return score_toxicity(table(spark, d, "documents"), table(spark, d, "labels"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: a tenth of the texts repeat themselves from some word on.

    Which ones, from where and with which period follows from the id. Rows without id stay as
    they are.
    """
    h = F.crc32(docs["doc_id"].cast("string"))
    g = F.floor(h / 10)
    words = F.filter(F.split(docs["text"].cast("string"), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def repeated(w: Column) -> Column:
        a = F.pmod(g, F.size(w))
        p = 1 + F.floor((F.size(w) - a) / (3 + F.pmod(g, F.lit(8))))
        # Bound to a name each, so that nothing is computed again for every word.
        places = F.array(F.struct(w.alias("w"), a.alias("a"), p.alias("p")))
        return F.transform(
            places, lambda s: F.transform(s["w"], lambda x, i: F.when(i < s["a"], x).otherwise(F.get(s["w"], (s["a"] + F.pmod(i - s["a"], s["p"])).cast("int"))))
        )[0]

    text = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, F.array_join(repeated(w), " ")))[0]
    return docs.select("doc_id", F.when(F.pmod(h, F.lit(10)) == 0, text).otherwise(docs["text"]).alias("text"))


def op11_suffix_tree_runs(spark: SparkSession, d: str) -> DataFrame:
    found = periodic_runs(with_planted_periods(table(spark, d, "documents")))
    none = F.lit(None).cast(RUNS.removeprefix("array<").removesuffix(">"))
    # Runs come by start, then period: of equal exponents the first stays.
    best = F.aggregate("runs", none, lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    line = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_sorted_list_top_k(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings")
    return exact_top_k(vectors, vectors["vec_id"] % 50 == 0)


def with_planted_faults(rows: DataFrame) -> DataFrame:
    """Some rows go, lose their text or its ends, are repeated, or become the user's; by id and turn."""
    known = [F.coalesce(rows[c].cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    conv_id, turn, role, text = known
    fault = F.pmod(F.crc32(F.concat(conv_id, F.lit(":"), turn)), F.lit(20))
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(fault == 4, "user").otherwise(role)
    times = F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1)
    again = F.explode(F.array_repeat(F.lit(1), times)).alias("again")
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), again).drop("again")


def op13_path_ranked_repair(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations")
    return repair_conversations(with_planted_faults(rows), known=rows)


def registry() -> dict[str, Query]:
    found = {k: v for k, v in globals().items() if k.startswith("op") and k[2].isdigit()}
    return dict(sorted(found.items(), key=lambda item: int(item[0][2:].split("_")[0])))
