"""One registered query per operator; every one reads whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from augury import schemas
from augury.functions import fixed_values as fixed
from augury.functions import guidance as g
from augury.functions import keys
from augury.functions.markup import strip_html
from augury.functions.text import elements
from augury.operators import derive, exhibits, filings, guidance, joins, model, panel, profile
from augury.plans import exhibits as exhibit_plan
from augury.plans import filing_index as index_plan
from augury.plans import guidance as guidance_plan
from augury.plans import model_guidance, publish
from augury.plans import panel as panel_plan
from augury.session import fresh_folder, spread
from augury.sources import dimensions, index, tables
from augury.sources import filings as staged_filings
from augury.streaming.guidance_stream import stream_guidance
from checks import inputs

Query = Callable[[SparkSession, str], DataFrame]

#: Staged files hold so many rows at most. Texts that are alike take little room, and splits are
#: cut by bytes: a file counts as 4 MB at least, so that no task reads more than 32 of them.
FILE_ROWS = 20_000

TABLES = ["customer", "orders", "supplier"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run shared SQL over the given Parquet tables."""
    for name in TABLES:
        if name in sql:
            table(spark, sf_dir, name).createOrReplaceTempView(name)
    return spark.sql(sql)


# --- shared inputs ------------------------------------------------------------

_STAGED: dict[tuple[str, str, str], DataFrame] = {}


def staged(spark: SparkSession, sf_dir: str, name: str, sql: str) -> DataFrame:
    """A derived input, written once per application to the shared folder, as real ones lie."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STAGED:
        _STAGED[key] = written(view(spark, sf_dir, sql), name)
    return _STAGED[key]


def press(spark: SparkSession, d: str) -> DataFrame:
    return staged(spark, d, "press", inputs.PRESS)


def press_guidance(spark: SparkSession, d: str) -> DataFrame:
    return guidance_plan.build_guidance(press(spark, d))


def ticker_rows(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, inputs.TICKER_ROWS)


def ticker_documents(spark: SparkSession, d: str) -> DataFrame:
    entry = F.struct("cik_str", "ticker", "title")
    return (
        ticker_rows(spark, d)
        .groupBy("document")
        .agg(F.collect_list(F.struct(F.col("position").cast("string"), entry)).alias("entries"))
        .select("document", F.to_json(F.map_from_entries("entries")).alias("value"))
    )


def tickers(spark: SparkSession, d: str) -> DataFrame:
    return dimensions.parse_tickers(ticker_documents(spark, d))


def index_lines(spark: SparkSession, d: str) -> DataFrame:
    return index.parse_index_lines(view(spark, d, inputs.INDEX_LINES))


def index_rows(spark: SparkSession, d: str) -> DataFrame:
    return index_plan.filing_index(index_lines(spark, d))


def listings(spark: SparkSession, d: str) -> DataFrame:
    raw = staged(spark, d, "listings", inputs.LISTINGS)
    return raw.withColumn("filing_url", keys.filing_url(F.col("cik"), F.col("accession_key")))


def json_listings(spark: SparkSession, d: str) -> DataFrame:
    return staged_filings.parse_listing_json(listings(spark, d))


def html_listings(spark: SparkSession, d: str) -> DataFrame:
    return staged_filings.parse_listing_html(json_listings(spark, d).filter(~F.col("is_json")))


def bodies(spark: SparkSession, d: str) -> DataFrame:
    return staged_filings.body_text(staged(spark, d, "bodies", inputs.BODIES))


def press_index(spark: SparkSession, d: str) -> DataFrame:
    """One index row per order, shaped as the filing index."""
    rows = view(
        spark, d,
        f"SELECT {inputs._s('c_custkey')} AS cik, c_name AS company_name, '8-K' AS form_type, "
        f"CAST(o_orderdate AS DATE) AS date_filed, {inputs.ACCESSION} AS accession_number "
        f"FROM {inputs.ORDERS}",
    )
    return rows


def co_filed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Index, staged listings and staged bodies in which every tenth filing has a second filer.

    Every other one of these has copies of its own, of which the body says so.
    """
    index = press_index(spark, d).unionByName(view(spark, d, inputs.CO_INDEX))
    listed, raw = staged(spark, d, "listings", inputs.LISTINGS), staged(spark, d, "bodies", inputs.BODIES)
    own = F.expr(inputs.CO_STAGED)
    second = (F.col("cik").cast("bigint") + 1).cast("string")
    markup = F.lower("filename").rlike("\\.html?$")
    said = F.when(markup, F.concat(F.lit("<p>co</p>"), "value")).otherwise(F.concat(F.lit("co\n"), "value"))
    return (
        index,
        listed.unionByName(listed.filter(own).withColumn("cik", second)),
        raw.unionByName(raw.filter(own).withColumn("cik", second).withColumn("value", said)),
    )


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back."""
    path = fresh_folder(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    return tables.read_parquet_table(df.sparkSession, path, df.schema)


def ledger(spark: SparkSession, d: str) -> DataFrame:
    """Every third order counts as processed."""
    return view(
        spark, d,
        f"SELECT {inputs.ACCESSION} AS accession_number FROM {inputs.ORDERS} "
        f"WHERE o_orderstatus = 'F'",
    )


# --- sources ------------------------------------------------------------------


def write_index_files(spark: SparkSession, d: str) -> str:
    """Index files as staged: one per quarter, with the header ahead of the data lines."""
    path = fresh_folder(spark, "index")
    headers = view(spark, d, inputs.INDEX_HEADERS).withColumn("part", F.lit(0))
    lines = headers.unionByName(view(spark, d, inputs.INDEX_LINES).withColumn("part", F.lit(1)))
    lines = lines.repartition("year", "quarter").sortWithinPartitions("year", "quarter", "part").drop("part")
    lines.write.partitionBy("year", "quarter").text(path)
    return path


def s1_scan_master_index(spark: SparkSession, d: str) -> DataFrame:
    return index.scan_master_index(spark, f"{write_index_files(spark, d)}/year=*/quarter=*")


def s2_scan_index_range(spark: SparkSession, d: str) -> DataFrame:
    return index.scan_index_range(spark, write_index_files(spark, d), 1996, 1999)


def s3_read_parquet_table(spark: SparkSession, d: str) -> DataFrame:
    docs = tables.read_parquet_table(spark, f"{d}/documents.parquet")
    return docs.select("doc_id", "lang")


def s4_write_parquet_table(spark: SparkSession, d: str) -> DataFrame:
    filed = index_rows(spark, d).select("cik", "filename", "year", "quarter")
    path = fresh_folder(spark, "filings")
    tables.write_parquet_table(filed, path, partition_by=["year"])
    back = tables.read_parquet_table(spark, path, filed.schema)
    return back.groupBy("year").agg(
        F.count("*").alias("n_rows"), F.countDistinct("cik").alias("n_ciks")
    )


def s5_write_csv(spark: SparkSession, d: str) -> DataFrame:
    texts = press(spark, d).select("accession_number", "company_name", "text")
    path = fresh_folder(spark, "csv")
    tables.write_csv(texts, path)
    return tables.read_csv(spark, path, texts.schema)


def s6_scan_tickers(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_folder(spark, "tickers")
    ticker_documents(spark, d).select("value").write.text(path)
    # One document per line here; a staged mapping is one document per file.
    return dimensions.parse_tickers(spark.read.text(path))


def s7_scan_exhibit_files(spark: SparkSession, d: str) -> DataFrame:
    return bodies(spark, d)


def s8_scan_filing_index_json(spark: SparkSession, d: str) -> DataFrame:
    found = json_listings(spark, d).filter("is_json")
    return found.select(
        "accession_key", F.size("documents").cast("bigint").alias("n_documents"),
        F.array_join(F.transform("documents", lambda x: x["name"]), ";").alias("names"),
        F.array_join(F.transform("documents", lambda x: x["type"]), ";").alias("types"),
    )


def s9_scan_filing_index_html(spark: SparkSession, d: str) -> DataFrame:
    return html_listings(spark, d).select("accession_key", F.inline(elements(F.col("rows")))).select(
        "accession_key", F.col("n_cells").cast("bigint").alias("n_cells"), "description", "href"
    )


def s10_scan_company_metadata(spark: SparkSession, d: str) -> DataFrame:
    return dimensions.parse_company_metadata(view(spark, d, inputs.METADATA))


def s11_compact_batches(spark: SparkSession, d: str) -> DataFrame:
    rows = press_index(spark, d)
    source, target = fresh_folder(spark, "batches"), fresh_folder(spark, "compact")
    tables.write_parquet_table(rows.filter("form_type = '8-K'"), source)
    tables.write_parquet_table(rows, source, mode="append")
    compact = tables.compact_batches(spark, source, target, rows.schema)
    return compact.groupBy("cik").agg(F.count("*").alias("n_rows"))


# --- filings ------------------------------------------------------------------


def f1_filter_form_type(spark: SparkSession, d: str) -> DataFrame:
    return filings.filter_form_type(index_lines(spark, d)).select("filename", "form_type")


def f2_extract_accession(spark: SparkSession, d: str) -> DataFrame:
    lines = filings.extract_accession(index_lines(spark, d)).select("filename", "accession_number")
    either = keys.accession_of(F.col("filename"), fixed.ACCESSION_PATTERN_ANY)
    return lines.withColumn("accession_either", either)


def f3_pad_cik(spark: SparkSession, d: str) -> DataFrame:
    return filings.add_padded_cik(index_lines(spark, d)).select("cik", "cik_padded").distinct()


def f4_coerce_date(spark: SparkSession, d: str) -> DataFrame:
    return filings.coerce_dates(index_lines(spark, d)).select("filename", "date_filed")


def f5_require_accession(spark: SparkSession, d: str) -> DataFrame:
    return filings.require_accession(index_rows(spark, d)).select("accession_number", "form_type")


def f6_filing_url(spark: SparkSession, d: str) -> DataFrame:
    kept = filings.require_accession(index_rows(spark, d))
    return filings.add_filing_url(kept).select("accession_number", "filing_url")


def f7_filter_min_length(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return filings.filter_min_length(docs).select("doc_id")


def f8_earnings_gate(spark: SparkSession, d: str) -> DataFrame:
    return filings.earnings_gate(bodies(spark, d)).select("accession_key", "filename")


def f9_text_length(spark: SparkSession, d: str) -> DataFrame:
    docs = filings.add_text_length(table(spark, d, "documents"))
    return docs.select("doc_id", F.col("text_length").cast("bigint").alias("text_length"))


def f10_select_contract(spark: SparkSession, d: str) -> DataFrame:
    return panel_table(spark, d).drop("date_filed")


def f11_slice_panel(spark: SparkSession, d: str) -> DataFrame:
    cut = filings.slice_panel(
        panel_table(spark, d), metric="EPS", pdicity="FY", ranges_only=True,
        actions=["raises", "lowers"],
    )
    return cut.select("cik", "accession_number", "val1", "val2", "action")


def f12_document_key(spark: SparkSession, d: str) -> DataFrame:
    plain = filings.add_document_key(table(spark, d, "pages").select("page_id", "url"))
    with_params = keys.document_key(F.col("url"), {"page": 2, "form": "8-K"})
    return plain.withColumn("key_with_params", with_params).drop("url")


# --- exhibits -----------------------------------------------------------------


def _exhibit_rows(df: DataFrame) -> DataFrame:
    return df.select("accession_key", F.posexplode(elements(F.col("exhibits"))).alias("pos", "e")).select(
        "accession_key", F.col("pos").cast("bigint").alias("pos"), "e.url", "e.description",
        "e.filename",
    )


def e1_match_exhibits_json(spark: SparkSession, d: str) -> DataFrame:
    return _exhibit_rows(exhibits.match_exhibits_json(json_listings(spark, d).filter("is_json")))


def e2_match_exhibits_html(spark: SparkSession, d: str) -> DataFrame:
    return _exhibit_rows(exhibits.match_exhibits_html(html_listings(spark, d)))


def e3_primary_document(spark: SparkSession, d: str) -> DataFrame:
    found = exhibits.primary_document(html_listings(spark, d))
    return found.select("accession_key", "primary_doc")


def e4_resolve_url(spark: SparkSession, d: str) -> DataFrame:
    rows = html_listings(spark, d).select("accession_key", "filing_url", F.inline(elements(F.col("rows"))))
    return rows.select(
        "accession_key", "href", keys.resolve_url(F.col("href"), F.col("filing_url")).alias("url")
    )


def e5_first_exhibit(spark: SparkSession, d: str) -> DataFrame:
    chosen = exhibit_plan.chosen_exhibits(listings(spark, d))
    return chosen.select(
        "accession_key", "exhibit_url", "exhibit_filename", "exhibit_description", "items"
    )


def e6_extract_items(spark: SparkSession, d: str) -> DataFrame:
    return html_listings(spark, d).select("accession_key", "items")


def e7_strip_html(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", strip_html(F.col("html")).alias("text"))


# --- guidance -----------------------------------------------------------------


def sentences(spark: SparkSession, d: str) -> DataFrame:
    long_enough = filings.filter_min_length(press(spark, d).select("accession_number", "text"))
    return guidance.split_sentences(long_enough)


def mentions(spark: SparkSession, d: str) -> DataFrame:
    return guidance.detect_metrics(guidance.filter_guidance_sentences(sentences(spark, d)))


def valued(spark: SparkSession, d: str) -> DataFrame:
    return guidance.extract_values(mentions(spark, d))


def g0_extract_guidance(spark: SparkSession, d: str) -> DataFrame:
    return press_guidance(spark, d)


def g1_split_sentences(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return guidance.split_sentences(docs).select(
        "doc_id", F.col("sent_ord").cast("bigint").alias("sent_ord"), "sentence",
        F.col("sent_start").cast("bigint").alias("sent_start"),
    )


def g1_split_press(spark: SparkSession, d: str) -> DataFrame:
    return sentences(spark, d).select(
        "accession_number", F.col("sent_ord").cast("bigint").alias("sent_ord"), "sentence",
        F.col("sent_start").cast("bigint").alias("sent_start"),
    )


def g2_filter_guidance_sentences(spark: SparkSession, d: str) -> DataFrame:
    kept = guidance.filter_guidance_sentences(sentences(spark, d))
    return kept.select("accession_number", F.col("sent_ord").cast("bigint").alias("sent_ord"))


def g3_detect_metrics(spark: SparkSession, d: str) -> DataFrame:
    return mentions(spark, d).select(
        "accession_number", F.col("sent_ord").cast("bigint").alias("sent_ord"), "metric",
        F.col("metric_offset").cast("bigint").alias("metric_offset"),
    )


def g4_extract_values(spark: SparkSession, d: str) -> DataFrame:
    return valued(spark, d).select(
        "accession_number", F.col("sent_ord").cast("bigint").alias("sent_ord"), "metric",
        "val1", "val2", "is_range",
    )


def g4a_parse_range(spark: SparkSession, d: str) -> DataFrame:
    ranged = valued(spark, d).filter("is_range")
    return ranged.groupBy("metric").agg(
        F.count("*").alias("n"), F.min("val1").alias("lowest"), F.max("val2").alias("highest")
    )


def g4b_parse_per_share_range(spark: SparkSession, d: str) -> DataFrame:
    """Per-share ranges are plain ranges below 100 on both sides."""
    ranged = valued(spark, d).filter("is_range AND val1 < 100 AND val2 < 100")
    return ranged.select("accession_number", "metric", "val1", "val2").distinct()


def g4c_parse_amount(spark: SparkSession, d: str) -> DataFrame:
    single = valued(spark, d).filter("NOT is_range")
    return single.select("accession_number", "metric", "val1").distinct()


def g4d_scale_amount(spark: SparkSession, d: str) -> DataFrame:
    """Every price of the orders under every scale word."""
    words = F.explode(F.array(*[F.lit(w) for w in ["", *fixed.SCALE_WORDS]])).alias("scale")
    whole = F.format_number(F.floor("o_totalprice"), 0)
    rows = table(spark, d, "orders").select("o_orderkey", whole.alias("number"), words)
    return rows.select(
        "o_orderkey", "scale", g.scale_amount(F.col("number"), F.col("scale")).alias("amount")
    )


def g5_detect_period(spark: SparkSession, d: str) -> DataFrame:
    return guidance.detect_period(valued(spark, d)).select(
        "accession_number", F.col("sent_ord").cast("bigint").alias("sent_ord"), "metric", "pdicity"
    )


def g6_detect_fiscal_year(spark: SparkSession, d: str) -> DataFrame:
    return guidance.detect_fiscal_year(valued(spark, d)).select(
        "accession_number", F.col("sent_ord").cast("bigint").alias("sent_ord"), "metric",
        "fiscal_year",
    )


def g7_detect_action(spark: SparkSession, d: str) -> DataFrame:
    return guidance.detect_action(valued(spark, d)).select(
        "accession_number", F.col("sent_ord").cast("bigint").alias("sent_ord"), "metric", "action"
    )


def g8_truncate_sentence(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.col("text").alias("sentence"))
    return guidance.truncate_sentence(docs)


def d1_dedup_in_document(spark: SparkSession, d: str) -> DataFrame:
    kept = guidance.dedup_in_document(valued(spark, d))
    return kept.select(
        "accession_number", F.col("sent_ord").cast("bigint").alias("sent_ord"), "metric",
        "val1", "val2",
    )


# --- derived columns ------------------------------------------------------------


def items_as_guidance(spark: SparkSession, d: str) -> DataFrame:
    """Records with missing bounds: the model's, which the wording never gives."""
    return model.map_to_guidance(model.accepted_items(model.parse_responses(
        view(spark, d, inputs.RESPONSES))))


def c1_midpoint(spark: SparkSession, d: str) -> DataFrame:
    rows = items_as_guidance(spark, d).select("accession_number", "sent_ord", "val1", "val2")
    as_parsed = derive.add_parse_midpoint(rows).withColumnRenamed("midpoint", "parse_midpoint")
    return derive.add_midpoint(as_parsed)


def c2_range_width(spark: SparkSession, d: str) -> DataFrame:
    return press_guidance(spark, d).select(
        "accession_number", "metric", "val1", "val2", "range_width"
    )


def c3_file_period(spark: SparkSession, d: str) -> DataFrame:
    dated = derive.add_file_period(index_rows(spark, d))
    return dated.select("filename", "file_year", "file_quarter", "file_yearq")


def c4_is_per_share(spark: SparkSession, d: str) -> DataFrame:
    rows = items_as_guidance(spark, d)
    return derive.add_is_per_share(rows).select(
        "accession_number", "sent_ord", "metric", "val1", "val2", "is_per_share"
    )


# --- joins ----------------------------------------------------------------------


def _padded_guidance(spark: SparkSession, d: str) -> DataFrame:
    return filings.coerce_dates(filings.add_padded_cik(press_guidance(spark, d)))


def j1_join_tickers(spark: SparkSession, d: str) -> DataFrame:
    joined = joins.join_tickers(_padded_guidance(spark, d), tickers(spark, d))
    return joined.select(
        "cik_padded", "accession_number", "metric", "val1", "ticker", "company_name_sec"
    )


def j2_exclude_processed(spark: SparkSession, d: str) -> DataFrame:
    todo = joins.exclude_processed(press(spark, d), ledger(spark, d))
    return todo.select("accession_number", "form_type")


def j3_lookup_metric(spark: SparkSession, d: str) -> DataFrame:
    items = model.parse_responses(view(spark, d, inputs.RESPONSES))
    return joins.lookup_metric(items).select(
        "accession_number", "item_ord", "forecast_metric", "metric"
    )


def j4_lookup_ticker_literal(spark: SparkSession, d: str) -> DataFrame:
    # One ticker per unpadded CIK.
    names = ticker_rows(spark, d).filter("position % 2 = 0").select(
        F.col("cik_str").cast("string").alias("cik"), "ticker"
    )
    return joins.lookup_ticker_literal(press_index(spark, d), names).select(
        "cik", "accession_number", "ticker"
    )


def j5_enrich_company(spark: SparkSession, d: str) -> DataFrame:
    metadata = dimensions.parse_company_metadata(view(spark, d, inputs.METADATA))
    joined = joins.enrich_company(filings.add_padded_cik(press_index(spark, d)), metadata)
    return joined.select("accession_number", "cik_padded", "sic", "exchange", "category")


def j6_attach_exhibit(spark: SparkSession, d: str) -> DataFrame:
    index, listed, raw = co_filed(spark, d)
    joined = joins.attach_exhibit(
        index, exhibit_plan.chosen_exhibits(listed), staged_filings.body_text(raw), listed, raw
    )
    return joined.select("cik", "accession_number", "exhibit_filename", "text")


# --- aggregates -------------------------------------------------------------------


def panel_table(spark: SparkSession, d: str) -> DataFrame:
    return panel_plan.build_panel(press_guidance(spark, d), tickers(spark, d), ordered=False)


def a1_summarise_panel(spark: SparkSession, d: str) -> DataFrame:
    summary = profile.summarise_panel(panel_table(spark, d))
    return summary.select(
        "file_year", "metric", "n_guidance", "n_firms", F.round("pct_range", 6).alias("pct_range"),
        F.round(F.col("avg_midpoint") / 1e6, 4).alias("avg_midpoint_mm"),
    )


def a2_value_counts(spark: SparkSession, d: str) -> DataFrame:
    return profile.all_value_counts(panel_table(spark, d), ["metric", "action", "pdicity"])


def a3_table_profile(spark: SparkSession, d: str) -> DataFrame:
    return profile.table_profile(panel_table(spark, d))


def a3_index_profile(spark: SparkSession, d: str) -> DataFrame:
    return profile.table_profile(index_rows(spark, d))


def a4_ticker_match_rate(spark: SparkSession, d: str) -> DataFrame:
    joined = joins.join_tickers(_padded_guidance(spark, d), tickers(spark, d))
    rate = profile.ticker_match_rate(joined)
    return rate.withColumn("pct_matched", F.round("pct_matched", 6))


def a5_extraction_funnel(spark: SparkSession, d: str) -> DataFrame:
    return profile.extraction_funnel(press(spark, d), press_guidance(spark, d))


def a6_dedup_report(spark: SparkSession, d: str) -> DataFrame:
    return profile.dedup_report(joins.join_tickers(_padded_guidance(spark, d), tickers(spark, d)))


def a7_filings_per_quarter(spark: SparkSession, d: str) -> DataFrame:
    return profile.filings_per_quarter(index_rows(spark, d))


def a8_usage_cost(spark: SparkSession, d: str) -> DataFrame:
    costs = profile.usage_cost(view(spark, d, inputs.USAGE))
    return costs.withColumn("cost", F.round("cost", 6))


def a9_flag_total(spark: SparkSession, d: str) -> DataFrame:
    return profile.flag_total(items_as_guidance(spark, d))


# --- dedup, order, numbering --------------------------------------------------------


def d2_dedup_panel(spark: SparkSession, d: str) -> DataFrame:
    joined = joins.join_tickers(_padded_guidance(spark, d), tickers(spark, d))
    return panel.dedup_panel(joined).select(
        "cik_padded", "date_filed", "metric", "val1", "val2", "accession_number", "ticker"
    )


def d3_dedup_ledger(spark: SparkSession, d: str) -> DataFrame:
    return panel.dedup_ledger(ledger(spark, d), press(spark, d))


def o1_sort_index(spark: SparkSession, d: str) -> DataFrame:
    return panel.sort_index(index_rows(spark, d)).select("date_filed", "cik", "filename")


def o2_sort_panel(spark: SparkSession, d: str) -> DataFrame:
    return panel.sort_panel(panel_table(spark, d)).select(
        "ticker", "date_filed", "metric", "cik", "accession_number", "val1", "val2"
    )


def o3_head_sample(spark: SparkSession, d: str) -> DataFrame:
    return panel.head_sample(panel_table(spark, d)).select(
        "ticker", "date_filed", "metric", "cik", "accession_number", "val1", "val2"
    )


def o4_limit_filings(spark: SparkSession, d: str) -> DataFrame:
    todo = index_rows(spark, d).filter("accession_number IS NOT NULL")
    return panel.limit_filings(todo, 1000).select("accession_number", "cik", "date_filed")


def o5_chunk_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = press(spark, d).select("accession_number")
    return panel.chunk_rows(rows, ["accession_number"], fixed.EXHIBIT_BATCH_ROWS)


def u1_union_quarters(spark: SparkSession, d: str) -> DataFrame:
    """All quarters of a range arrive in one read, missing ones skipped."""
    lines = index.scan_index_range(spark, write_index_files(spark, d), 1990, 2030)
    return profile.filings_per_quarter(index_plan.filing_index(lines))


def u2_union_batches(spark: SparkSession, d: str) -> DataFrame:
    rows = press_index(spark, d).select("accession_number", "cik")
    path = fresh_folder(spark, "batches")
    for status in ("F", "O", "P"):
        part = view(
            spark, d,
            f"SELECT {inputs.ACCESSION} AS accession_number, {inputs._s('c_custkey')} AS cik "
            f"FROM {inputs.ORDERS} WHERE o_orderstatus = '{status}'",
        )
        tables.write_parquet_table(part, path, mode="append")
    return tables.read_parquet_table(spark, path, rows.schema)


# --- model path ---------------------------------------------------------------------


def refusing_client() -> type:
    """Never answers: what there is must come from the outcomes of earlier runs."""

    class RefusingClient:
        def complete(self, instructions: str, request: str) -> tuple[str, int, int]:
            raise RuntimeError("no answer")

    return RefusingClient


def echo_client(fails: tuple[int, ...] = (13,)) -> type:
    """Offline stand-in: answers with one item that measures its request.

    Some items have a metric or a unit that no one knows, or a value that is no number.
    """
    import json

    class EchoClient:  # local, so that it travels to the tasks by value
        def complete(self, instructions: str, request: str) -> tuple[str, int, int]:
            size = len(request)
            if any(size % n == 0 for n in fails):
                raise RuntimeError("no answer")
            item = {
                "forecast_metric": "Backlog" if size % 7 == 0 else "Revenue", "time_horizon": "FY", "fiscal_year": 2025,
                "estimate_type": "point", "value_low": None, "value_high": None,
                "value_point": "much" if size % 11 == 0 else float(size),
                "unit": "euros" if size % 5 == 0 else "dollars", "direction": "issues",
                "confidence_language": "expects", "is_adjusted": False,
                "context_sentence": request[:20],
            }
            return json.dumps({"guidance_items": [item]}), size, 10

    return EchoClient


def x1_prefilter_text(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return docs.select("doc_id", model.prefilter_text(F.col("text")).alias("text"))


def x2_render_requests(spark: SparkSession, d: str) -> DataFrame:
    return model.render_requests(press(spark, d)).select("accession_number", "request")


def x3_parse_responses(spark: SparkSession, d: str) -> DataFrame:
    return model.parse_responses(view(spark, d, inputs.RESPONSES))


def x3_rejected_items(spark: SparkSession, d: str) -> DataFrame:
    """Accepted and rejected items, written by one reading of the answers; the rejected ones."""
    path = fresh_folder(spark, "answers")
    model.store_items(view(spark, d, inputs.RESPONSES), path)
    return model.read_items(spark, path, accepted=False)


def x3_accepted_items(spark: SparkSession, d: str) -> DataFrame:
    """The accepted ones of the same two tables."""
    path = fresh_folder(spark, "answers")
    model.store_items(view(spark, d, inputs.RESPONSES), path)
    return model.read_items(spark, path, accepted=True)


def x3_item_manifest(spark: SparkSession, d: str) -> DataFrame:
    """How many items were accepted, and rejected for which field."""
    path = fresh_folder(spark, "answers")
    model.store_items(view(spark, d, inputs.RESPONSES), path)
    return spark.read.parquet(f"{path}/manifest")


def j2_large_ledger(spark: SparkSession, d: str) -> DataFrame:
    """J2 as it runs against a ledger that is not proven small."""
    todo = joins.exclude_processed(press(spark, d), ledger(spark, d), max_rows=0)
    return todo.select("accession_number", "form_type")


def x4_map_to_guidance(spark: SparkSession, d: str) -> DataFrame:
    return items_as_guidance(spark, d)


def x5_extract_with_model(spark: SparkSession, d: str) -> DataFrame:
    answers = model.extract_with_model(model.render_requests(press(spark, d)), echo_client(), wait=0.0)
    return answers.select("accession_number", "status", "tokens_in", "tokens_out")


def x6_cost_cap(spark: SparkSession, d: str) -> DataFrame:
    usage = view(spark, d, inputs.USAGE)
    chunked = panel.chunk_rows(usage, ["accession_number"], 100)
    return model.cost_cap(chunked, max_cost=1.0).select("accession_number", "chunk_no")


def x7_fallback_regex(spark: SparkSession, d: str) -> DataFrame:
    texts = press(spark, d)
    status = F.when(F.col("text").startswith("C"), F.lit("failed")).otherwise(F.lit("ok"))
    outcomes = texts.select("accession_number", status.alias("status"))
    return model.fallback_regex(texts, outcomes).select(
        "accession_number", "metric", "val1", "val2", "pdicity", "action"
    )


# --- composites -----------------------------------------------------------------------


def z1_build_filing_index(spark: SparkSession, d: str) -> DataFrame:
    return index_plan.build_filing_index(spark, write_index_files(spark, d), 1995, 2001)


def z2_build_exhibits(spark: SparkSession, d: str) -> DataFrame:
    return exhibit_plan.build_exhibits(
        *co_filed(spark, d), ledger(spark, d)
    ).withColumn("text_length", F.col("text_length").cast("bigint"))


def z3_build_guidance(spark: SparkSession, d: str) -> DataFrame:
    texts = press(spark, d).withColumn("text_length", F.length("text"))
    return guidance_plan.build_guidance(written(texts, "exhibits")).drop("sent_ord", "metric_ord")


def z3_guidance_from_bodies(spark: SparkSession, d: str) -> DataFrame:
    return guidance_plan.guidance_from_bodies(
        press_index(spark, d), listings(spark, d).drop("filing_url"), staged(spark, d, "bodies", inputs.BODIES)
    ).select("accession_number", "exhibit_url", "metric", "val1", "val2", "pdicity", "action")


def z4_build_guidance_model(spark: SparkSession, d: str) -> DataFrame:
    """Two runs over one table of outcomes: the first gets a third of the answers it asks for."""
    path, done = fresh_folder(spark, "outcomes"), ledger(spark, d)
    model_guidance.call_model(press(spark, d), echo_client(fails=(13, 2, 3)), path, wait=0.0)
    answered = model_guidance.processed_ledger(model_guidance.outcomes_so_far(spark, path))
    both = model_guidance.call_model(
        joins.exclude_processed(press(spark, d), answered), echo_client(), path, wait=0.0
    )
    assert both.count() > answered.count()
    records = model_guidance.build_guidance_model(
        press(spark, d), refusing_client(), path, ledger=done, fallback=True, wait=0.0
    )
    return records.select("accession_number", "metric", "val1", "val2", "pdicity", "action")


def z5_build_panel(spark: SparkSession, d: str) -> DataFrame:
    return panel_plan.build_panel(press_guidance(spark, d), tickers(spark, d))


def z6_publish(spark: SparkSession, d: str) -> DataFrame:
    paths = publish.publish(panel_table(spark, d), fresh_folder(spark, "published"))
    summary = (
        spark.read.option("header", True)
        .schema("file_year int, metric string, n_guidance bigint, n_firms bigint, "
                "pct_range double, avg_midpoint double")
        .csv(paths["summary"])
    )
    return summary.select(
        "file_year", "metric", "n_guidance", "n_firms", F.round("pct_range", 6).alias("pct_range"),
        F.round(F.col("avg_midpoint") / 1e6, 4).alias("avg_midpoint_mm"),
    )


def r1_stream_guidance(spark: SparkSession, d: str) -> DataFrame:
    source, target = fresh_folder(spark, "arrivals"), fresh_folder(spark, "streamed")
    texts = press(spark, d).withColumns(
        {
            "exhibit_filename": F.lit("ex991.htm"), "exhibit_description": F.lit("EX-99.1"),
            "items": F.lit(""), "text_length": F.length("text"),
        }
    )
    progress = fresh_folder(spark, "progress")
    # Three arrivals, the latest dates first, every fifth filing delivered twice.
    late, again = F.month("date_filed") <= 4, F.pmod(F.xxhash64("accession_number"), F.lit(5)) == 0
    whole = texts.select(schemas.EXHIBITS.fieldNames())
    for part in (whole.filter(~late), whole.filter(late), whole.filter(again)):
        part.write.mode("append").parquet(source)
        stream_guidance(spark, source, target, progress, dedup=True).awaitTermination()
    return tables.read_parquet_table(spark, target, schemas.GUIDANCE).drop("sent_ord", "metric_ord")


def registry() -> dict[str, Query]:
    """Queries by name: functions named after an operator id of the survey."""
    import re

    named = re.compile(r"^[a-z][0-9]+[a-d]?_")
    return {
        name: fn for name, fn in globals().items() if callable(fn) and named.match(name)
    }
