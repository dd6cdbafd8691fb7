"""The same results as SQL for DuckDB, from the fixed values and the shared inputs.

RE2 has no look-behind, so sentences are cut at a mark put after each stop. Offsets
are the length of the text before the first match.
"""

from __future__ import annotations

from augury import schemas
from augury.functions import fixed_values as fixed
from augury.functions.markup import ELEMENT, HIDDEN
from augury.functions.text import WHITE
from checks import inputs


def q(text: str) -> str:
    """A SQL literal."""
    return "'" + text.replace("'", "''") + "'"


def rx(text: str, fold: bool = True) -> str:
    """A fixed pattern as a SQL literal for RE2."""
    wide = text.replace(r"\s", WHITE)
    return q(f"(?i){wide}" if fold else wide)


def one_of(forms: list[str]) -> str:
    return f"(?:{'|'.join(forms)})"


def strip(expr: str) -> str:
    return f"regexp_replace({expr}, {rx(r'^\s+|\s+\z', False)}, '', 'g')"


def first_label(expr: str, labels: dict[str, list[str]], default: str, edge: str = "") -> str:
    arms = " ".join(
        f"WHEN regexp_matches({expr}, {rx(edge + one_of(forms) + edge)}) THEN '{name}'"
        for name, forms in labels.items()
    )
    return f"CASE {arms} ELSE '{default}' END"


def window(text: str, at: str, before: int, after: int) -> str:
    start = f"greatest({at} - {before}, 0)"
    return f"substring({text}, {start} + 1, {at} + {after} - {start})"


def scaled(number: str, scale: str) -> str:
    big = ", ".join(q(w) for w, f in fixed.SCALE_FACTORS.items() if f == 1e9)
    mid = ", ".join(q(w) for w, f in fixed.SCALE_FACTORS.items() if f == 1e6)
    low = ", ".join(q(w) for w, f in fixed.SCALE_FACTORS.items() if f == 1e3)
    return (
        f"(CAST(replace({number}, ',', '') AS DOUBLE) * CASE WHEN lower({scale}) IN ({big}) THEN 1e9 "
        f"WHEN lower({scale}) IN ({mid}) THEN 1e6 WHEN lower({scale}) IN ({low}) THEN 1e3 ELSE 1e0 END)"
    )


def pad(expr: str) -> str:
    return f"CASE WHEN length({expr}) >= 10 THEN {expr} ELSE lpad({expr}, 10, '0') END"


def chain(*named: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in named) + "\n"


VERB = rx(one_of(fixed.GUIDANCE_VERBS) + r"\s")

# --- guidance steps as named queries --------------------------------------------

RANGE = fixed.AMOUNT_PATTERN + fixed.RANGE_LINK_PATTERN + fixed.AMOUNT_PATTERN


def split_sql(source: str, key: str) -> str:
    cut = (
        f"string_split(regexp_replace(text, {rx(r'([.!?])\s+', False)}, '\\1' || chr(1), 'g'), chr(1))"
    )
    return (
        f"SELECT *, strpos(text, sentence) - 1 AS sent_start FROM (SELECT *, "
        f"unnest(pieces) AS sentence, generate_subscripts(pieces, 1) - 1 AS sent_ord "
        f"FROM (SELECT *, {cut} AS pieces FROM {source} WHERE {key} IS NOT NULL AND text IS NOT NULL))"
    )


def mention_sql(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT *, '{name}' AS metric, {i} AS metric_ord, "
        f"length(regexp_extract(sentence, {rx('(?s)^(.*?)' + one_of(p))}, 1)) AS metric_offset "
        f"FROM {source} WHERE regexp_matches(sentence, {rx(one_of(p))})"
        for i, (name, p) in enumerate(fixed.METRICS.items())
    )


def value_sql(source: str) -> str:
    group = lambda p, i: f"regexp_extract(snippet, {rx(p)}, {i})"
    other = lambda a, b: f"coalesce(nullif({a}, ''), {b})"
    return f"""
SELECT *, CASE WHEN is_range THEN least(a, b) ELSE single END AS val1,
  CASE WHEN is_range THEN greatest(a, b) ELSE single END AS val2
FROM (SELECT *,
    CASE WHEN is_range THEN {scaled('n1', other('s1', 's2'))} END AS a,
    CASE WHEN is_range THEN {scaled('n2', other('s2', 's1'))} END AS b,
    CASE WHEN NOT is_range THEN {scaled('n0', 's0')} END AS single
  FROM (SELECT *, regexp_matches(snippet, {rx(RANGE)}) AS is_range,
      {group(RANGE, 1)} AS n1, {group(RANGE, 2)} AS s1, {group(RANGE, 3)} AS n2, {group(RANGE, 4)} AS s2,
      {group(fixed.AMOUNT_PATTERN, 1)} AS n0, {group(fixed.AMOUNT_PATTERN, 2)} AS s0
    FROM (SELECT *, {window('text', '(sent_start + metric_offset)', *fixed.VALUE_WINDOW)} AS snippet
          FROM {source})
    WHERE regexp_matches(snippet, {rx(r'\$\s*[0-9]', False)})))"""


def label_sql(source: str) -> str:
    around = window("text", "sent_start", *fixed.PERIOD_WINDOW)
    near = window("text", "sent_start", *fixed.ACTION_WINDOW)
    return f"""
SELECT *, {first_label(around, fixed.PERIODS, fixed.PERIOD_DEFAULT)} AS pdicity,
  TRY_CAST(nullif(regexp_extract({around}, {rx(fixed.FISCAL_YEAR_PATTERN, False)}, 0), '') AS INTEGER)
    AS fiscal_year,
  {first_label(near, fixed.ACTIONS, fixed.ACTION_DEFAULT, chr(92) + "b")} AS action
FROM {source}"""


def once_sql(source: str, key: str = "accession_number") -> str:
    return (
        f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key}, metric, val1, val2 "
        f"ORDER BY sent_ord, metric_ord) AS rn FROM {source}) WHERE rn = 1"
    )


def record_sql(source: str) -> str:
    return f"""
SELECT * REPLACE (substring({strip('sentence')}, 1, {fixed.SENTENCE_CHARS}) AS sentence,
    CAST(sent_ord AS INTEGER) AS sent_ord, CAST(metric_ord AS INTEGER) AS metric_ord),
  CASE WHEN val2 <> 0 THEN (val1 + val2) / 2 ELSE val1 END AS midpoint,
  CASE WHEN is_range THEN val2 - val1 ELSE 0e0 END AS range_width
FROM {source}"""


def long_enough(source: str) -> str:
    return f"SELECT * FROM {source} WHERE length(text) >= {fixed.MIN_TEXT_CHARS}"


def guidance_steps(source_sql: str, key: str = "accession_number") -> list[tuple[str, str]]:
    return [
        ("texts", source_sql),
        ("able", long_enough("texts")),
        ("sentences", split_sql("able", key)),
        ("spoken", f"SELECT * FROM sentences WHERE regexp_matches(sentence, {VERB})"),
        ("mentions", mention_sql("spoken")),
        ("valued", value_sql("mentions")),
        ("labelled", label_sql("valued")),
        ("once", once_sql("labelled", key)),
        ("guidance", record_sql("once")),
    ]


GUIDANCE_COLUMNS = ", ".join(
    c for c in schemas.GUIDANCE.fieldNames() if c not in ("sent_ord", "metric_ord")
)
STEPS = guidance_steps(inputs.PRESS)


def from_steps(select: str, upto: str = "guidance", extra: list[tuple[str, str]] | None = None) -> str:
    names = [n for n, _ in STEPS]
    return chain(*STEPS[: names.index(upto) + 1], *(extra or [])) + select


# --- tickers and panel -------------------------------------------------------------

TICKERS = (
    "tickers",
    f"SELECT lpad(CAST(cik_str AS VARCHAR), 10, '0') AS cik, ticker, title AS company_name_sec, "
    f"CAST(position AS INTEGER) AS ticker_ord FROM ({inputs.TICKER_ROWS})",
)
PADDED = (
    "padded",
    f"SELECT *, {pad('cik')} AS cik_padded, TRY_CAST(date_filed AS TIMESTAMP) AS filed FROM guidance",
)
JOINED = (
    "joined",
    "SELECT p.*, t.ticker, t.company_name_sec, t.ticker_ord FROM padded p "
    "LEFT JOIN tickers t ON p.cik_padded = t.cik",
)
UNIQUE = (
    "uniq",
    "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cik_padded, filed, metric, val1, val2 "
    "ORDER BY accession_number, sent_ord, metric_ord, ticker_ord NULLS LAST) AS rank FROM joined) "
    "WHERE rank = 1",
)
PER_SHARE = (
    f"(coalesce(metric IN ('EPS', 'FFO'), false) OR (coalesce(abs(val1) < {fixed.PER_SHARE_LIMIT}, false) "
    f"AND coalesce(abs(val2) < {fixed.PER_SHARE_LIMIT}, false)))"
)
PANEL = (
    "panel",
    f"""SELECT cik_padded AS cik, ticker, company_name, company_name_sec, accession_number,
  filed AS date_filed, CAST(year(filed) AS INTEGER) AS file_year,
  CAST(quarter(filed) AS INTEGER) AS file_quarter,
  CAST(year(filed) AS VARCHAR) || 'Q' || CAST(quarter(filed) AS VARCHAR) AS file_yearq, form_type,
  metric, pdicity, fiscal_year, val1, val2,
  CASE WHEN val2 <> val1 THEN (val1 + val2) / 2 ELSE val1 END AS midpoint, range_width, is_range,
  action, {PER_SHARE} AS is_per_share, sentence, exhibit_url FROM uniq""",
)
PANEL_STEPS = [TICKERS, PADDED, JOINED, UNIQUE, PANEL]
SUMMARY = (
    "SELECT file_year, metric, count(*) AS n_guidance, count(DISTINCT cik) AS n_firms, "
    "round(avg(CAST(is_range AS INTEGER)), 6) AS pct_range, "
    "round(avg(midpoint) / 1e6, 4) AS avg_midpoint_mm FROM panel "
    "WHERE file_year IS NOT NULL AND metric IS NOT NULL GROUP BY file_year, metric"
)


def from_panel(select: str) -> str:
    return from_steps(select, extra=PANEL_STEPS)


# --- index ------------------------------------------------------------------------

_PART = lambda i: strip(f"string_split(value, '|')[{i}]")
PARSED = [
    ("lines", inputs.INDEX_LINES),
    (
        "parsed",
        f"SELECT {_PART(1)} AS cik, {_PART(2)} AS company_name, {_PART(3)} AS form_type, "
        f"{_PART(4)} AS date_filed, {_PART(5)} AS filename, year, quarter FROM lines "
        f"WHERE len(string_split(value, '|')) = 5",
    ),
]
ACC = f"nullif(regexp_extract(filename, {q(fixed.ACCESSION_PATTERN)}, 1), '')"
ACC_ANY = f"nullif(regexp_extract(filename, {q(fixed.ACCESSION_PATTERN_ANY)}, 1), '')"
INDEX = [
    *PARSED,
    (
        "idx",
        f"SELECT cik, company_name, form_type, TRY_CAST(date_filed AS TIMESTAMP) AS date_filed, "
        f"filename, {ACC} AS accession_number, year, quarter, {pad('cik')} AS cik_padded "
        f"FROM parsed WHERE upper(form_type) IN ('8-K', '8-K/A')",
    ),
]
PRESS_INDEX = (
    "press_index",
    f"SELECT {inputs._s('c_custkey')} AS cik, c_name AS company_name, '8-K' AS form_type, "
    f"CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date_filed, {inputs.ACCESSION} AS accession_number, "
    f"{inputs.ACCESSION_KEY} AS accession_key FROM {inputs.ORDERS}",
)
LEDGER = (
    "ledger",
    f"SELECT {inputs.ACCESSION} AS accession_number FROM {inputs.ORDERS} WHERE o_orderstatus = 'F'",
)


def filing_url(accession: str) -> str:
    return f"'{fixed.ARCHIVE_BASE}/edgar/data/' || cik || '/' || replace({accession}, '-', '')"


# --- markup --------------------------------------------------------------------------


def decode(expr: str) -> str:
    """The references that occur in the inputs; the ampersand last."""
    pairs = {
        "&copy;": "©", "&quot;": '"', "&middot;": "·", "&nbsp;": " ", "&#160;": " ",
        "&#150;": "–", "&lt;": "<", "&gt;": ">", "&amp;": "&",
    }
    for name, char in pairs.items():
        expr = f"replace({expr}, {q(name)}, {q(char)})"
    return expr


def strip_html(expr: str) -> str:
    marked = decode(f"regexp_replace({expr}, {q(ELEMENT)}, chr(1), 'g')")
    joined = f"regexp_replace({marked}, '\\x01+', chr(10), 'g')"
    return strip(f"regexp_replace({joined}, '\\n{{3,}}', chr(10) || chr(10), 'g')")


def cell_text(expr: str) -> str:
    body = f"regexp_replace({expr}, '(?s)^[^>]*>', '')"
    marked = decode(f"regexp_replace({body}, {q(ELEMENT)}, chr(1), 'g')")
    return strip(f"regexp_replace({marked}, {rx(r'\s*\x01\s*', False)}, '', 'g')")


HREF = r"(?is)\shref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))"
EXTENSION = "(contains(lower({0}), '.htm') OR contains(lower({0}), '.html') OR contains(lower({0}), '.txt'))"
LIST_ROWS = [
    ("listed", f"SELECT *, {filing_url('accession_key')} AS filing_url FROM ({inputs.LISTINGS})"),
    ("html_listed", "SELECT * FROM listed WHERE NOT json_valid(value)"),
    (
        "grid",
        "SELECT *, lower(regexp_extract(piece, '(?i)^<(/?(?:table|tr|td))\\b', 1)) AS name FROM ("
        "SELECT cik, accession_key, filing_url, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS spot, len(pieces) + 1 AS past "
        f"FROM (SELECT *, string_split(regexp_replace(regexp_extract(regexp_replace(value, {q(HIDDEN)}, '<!>', 'g'), "
        "'(?is)<table\\b.*', 0), '(?i)(</?(?:table|tr|td)\\b)', chr(1) || '\\1', 'g'), chr(1)) AS pieces FROM html_listed))",
    ),
    (
        "levels",
        "SELECT *, sum(CASE name WHEN 'table' THEN 1 WHEN '/table' THEN -1 ELSE 0 END) OVER (PARTITION BY accession_key ORDER BY spot) "
        "+ CASE name WHEN '/table' THEN 1 ELSE 0 END AS level FROM grid",
    ),
    (
        "spans",
        "SELECT *, coalesce(lead(spot) OVER (PARTITION BY accession_key, level ORDER BY spot), past) AS stop, 'td' AS kind FROM levels "
        "WHERE level > 0 AND name IN ('tr', '/tr', '/table', 'td', '/td') UNION ALL "
        "SELECT *, coalesce(lead(spot) OVER (PARTITION BY accession_key, level ORDER BY spot), past) AS stop, 'tr' AS kind FROM levels "
        "WHERE level > 0 AND name IN ('tr', '/tr', '/table')",
    ),
    (
        "trees",
        "SELECT s.cik, s.accession_key, s.filing_url, s.kind, s.spot, s.stop, string_agg(g.piece, '' ORDER BY g.spot) AS tree "
        "FROM spans s JOIN grid g ON g.accession_key = s.accession_key AND g.spot >= s.spot AND g.spot < s.stop "
        "WHERE s.name = s.kind GROUP BY ALL",
    ),
    ("cells", f"SELECT accession_key, spot, {cell_text('tree')} AS text FROM trees WHERE kind = 'td'"),
    (
        "table_rows",
        "SELECT r.cik, r.accession_key, r.filing_url, r.spot AS row_no, regexp_extract(r.tree, '(?is)<a\\b[^>]*>', 0) AS anchor, "
        "count(c.spot) AS n_cells, string_agg(c.text, ' ' ORDER BY c.spot) AS description FROM trees r "
        "LEFT JOIN cells c ON c.accession_key = r.accession_key AND c.spot > r.spot AND c.spot < r.stop WHERE r.kind = 'tr' "
        "GROUP BY ALL",
    ),
    (
        "list_rows",
        f"SELECT * FROM (SELECT cik, accession_key, filing_url, row_no, n_cells, description, "
        f"{decode(f'regexp_extract(anchor, {q(HREF)}, 1) || regexp_extract(anchor, {q(HREF)}, 2) || regexp_extract(anchor, {q(HREF)}, 3)')} AS href "
        f"FROM table_rows) WHERE n_cells >= 3 AND href <> ''",
    ),
    (
        "url_rows",
        "SELECT *, CASE WHEN starts_with(href, '/') THEN 'https://www.sec.gov' || href "
        "WHEN NOT starts_with(href, 'http') THEN filing_url || '/' || href ELSE href END AS url FROM list_rows",
    ),
    (
        "html_found",
        f"SELECT accession_key, url, description, filename, row_number() OVER (PARTITION BY accession_key ORDER BY row_no) - 1 AS pos "
        f"FROM (SELECT accession_key, url, description, string_split(href, '/')[-1] AS filename, "
        f"row_no FROM url_rows "
        f"WHERE regexp_matches(upper(description), {rx(fixed.HTML_EXHIBIT_PATTERN, False)}) "
        f"AND {EXTENSION.format('href')} QUALIFY row_number() OVER (PARTITION BY accession_key, url ORDER BY row_no) = 1)",
    ),
    (
        "json_docs",
        "SELECT accession_key, filing_url, coalesce(x->>'$.name', '') AS name, coalesce(x->>'$.type', '') AS type, item_no "
        "FROM (SELECT accession_key, filing_url, unnest(items) AS x, generate_subscripts(items, 1) AS item_no "
        "FROM (SELECT *, CAST(json_extract(value, '$.directory.item') AS JSON[]) AS items FROM listed "
        "WHERE json_valid(value)))",
    ),
    (
        "json_found",
        f"SELECT accession_key, filing_url || '/' || name AS url, type || ' ' || name AS description, "
        f"name AS filename, row_number() OVER (PARTITION BY accession_key ORDER BY item_no) - 1 AS pos "
        f"FROM json_docs WHERE regexp_matches(upper(type || ' ' || name), 'EX-99|EXHIBIT 99|PRESS') "
        f"AND {EXTENSION.format('name')}",
    ),
    (
        "item_numbers",
        f"SELECT accession_key, array_to_string(list_sort(list_distinct(regexp_extract_all("
        f"{decode(f'regexp_replace(value, {q(ELEMENT)}, {q(chr(0)[:0])}, {q(chr(103))})')}, "
        f"{rx(fixed.ITEM_PATTERN, False)}, 1))), ',') AS items FROM html_listed",
    ),
    (
        "chosen",
        "SELECT f.accession_key, f.url AS exhibit_url, f.filename AS exhibit_filename, "
        "f.description AS exhibit_description, f.items FROM ("
        "SELECT h.*, i.items FROM html_found h JOIN item_numbers i USING (accession_key) "
        "UNION ALL SELECT *, '' AS items FROM json_found) f WHERE f.pos = 0",
    ),
]
BODIES = (
    "bodies",
    f"SELECT accession_key, filename, CASE WHEN lower(filename) LIKE '%.htm' OR lower(filename) LIKE '%.html' "
    f"THEN {strip_html('value')} ELSE value END AS text FROM ({inputs.BODIES})",
)
GATE = f"regexp_matches(upper(substring(text, 1, {fixed.GATE_CHARS})), {q('|'.join(fixed.GATE_TERMS))})"
CO_INDEX = (
    "co_index",
    "SELECT *, false AS co FROM press_index UNION ALL SELECT cik, company_name, form_type, "
    "CAST(date_filed AS VARCHAR), accession_number, replace(accession_number, '-', ''), true "
    f"FROM ({inputs.CO_INDEX})",
)
CO_BODIES = (
    "co_bodies",
    "SELECT *, false AS co FROM bodies UNION ALL SELECT accession_key, filename, 'co' || chr(10) || text, true "
    f"FROM bodies WHERE {inputs.CO_STAGED}",
)
CO_JOIN = (
    "JOIN chosen c USING (accession_key) JOIN co_bodies b ON b.accession_key = c.accession_key "
    f"AND b.filename = c.exhibit_filename AND b.co = (f.co AND {inputs.CO_STAGED.replace('accession_key', 'f.accession_key')})"
)
CO_EXHIBITS = (
    "co_exhibits",
    "SELECT f.cik, f.company_name, f.accession_number, f.date_filed, f.form_type, CASE WHEN f.co THEN replace("
    "c.exhibit_url, 'data/' || CAST(CAST(f.cik AS BIGINT) - 1 AS VARCHAR) || '/' || f.accession_key, "
    "'data/' || f.cik || '/' || f.accession_key) ELSE c.exhibit_url END AS exhibit_url, "
    "c.exhibit_filename, c.exhibit_description, c.items, b.text, length(b.text) AS text_length "
    f"FROM co_index f {CO_JOIN} WHERE {GATE.replace('text', 'b.text')}",
)
EXHIBITS = (
    "made_exhibits",
    f"SELECT f.cik, f.company_name, f.accession_number, f.date_filed, f.form_type, c.exhibit_url, "
    f"c.exhibit_filename, c.exhibit_description, c.items, b.text, length(b.text) AS text_length, "
    f"f.accession_key FROM press_index f JOIN chosen c USING (accession_key) "
    f"JOIN bodies b ON b.accession_key = c.accession_key AND b.filename = c.exhibit_filename WHERE {GATE}",
)

# --- model answers -----------------------------------------------------------------------

ITEMS = [
    ("responses", inputs.RESPONSES),
    (
        "raw_items",
        "SELECT accession_number, cik, unnest(xs) AS x, CAST(generate_subscripts(xs, 1) - 1 AS INTEGER) AS item_ord "
        "FROM (SELECT *, CAST(json_extract(CASE WHEN json_valid(response) THEN response END, "
        "'$.guidance_items') AS JSON[]) AS xs FROM responses)",
    ),
    (
        "fields",
        "SELECT accession_number, cik, item_ord, x->>'$.forecast_metric' AS forecast_metric, "
        "x->>'$.time_horizon' AS time_horizon, CAST(x->>'$.fiscal_year' AS INTEGER) AS fiscal_year, "
        "x->>'$.estimate_type' AS estimate_type, CAST(x->>'$.value_low' AS DOUBLE) AS value_low, "
        "CAST(x->>'$.value_high' AS DOUBLE) AS value_high, CAST(x->>'$.value_point' AS DOUBLE) AS value_point, "
        "x->>'$.unit' AS unit, x->>'$.direction' AS direction, "
        "x->>'$.confidence_language' AS confidence_language, "
        "CAST(x->>'$.is_adjusted' AS BOOLEAN) AS is_adjusted, x->>'$.context_sentence' AS context_sentence "
        "FROM raw_items",
    ),
    (
        "items",
        "SELECT *, CASE "
        + " ".join(
            f"WHEN {name} IS NULL OR {name} NOT IN ({', '.join(q(v) for v in values)}) THEN '{name}'"
            for name, values in {
                "forecast_metric": fixed.MODEL_METRICS, "time_horizon": fixed.HORIZONS,
                "estimate_type": fixed.ESTIMATE_TYPES, "unit": fixed.UNITS,
                "direction": fixed.DIRECTIONS,
            }.items()
        )
        + " WHEN confidence_language IS NULL THEN 'confidence_language' WHEN is_adjusted IS NULL "
        "THEN 'is_adjusted' WHEN context_sentence IS NULL THEN 'context_sentence' END AS problem FROM fields",
    ),
    (
        "bounds",
        f"SELECT *, CASE forecast_metric "
        + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in fixed.MODEL_METRICS.items())
        + " ELSE forecast_metric END AS metric, estimate_type = 'range' AS is_range, "
        "CASE WHEN estimate_type = 'range' THEN value_low ELSE value_point END AS lo, "
        "CASE WHEN estimate_type = 'range' THEN value_high ELSE value_point END AS hi FROM items",
    ),
    (
        "mapped",
        "SELECT *, CASE WHEN val1 IS NOT NULL THEN (val1 + coalesce(val2, 0e0)) / 2 END AS midpoint, "
        "CASE WHEN is_range AND val1 IS NOT NULL AND val2 IS NOT NULL THEN val2 - val1 ELSE 0e0 END AS range_width "
        "FROM (SELECT *, CASE WHEN lo > hi THEN hi ELSE lo END AS val1, "
        "CASE WHEN lo > hi THEN lo ELSE hi END AS val2 FROM bounds WHERE problem IS NULL)",
    ),
]
PREFILTERED = (
    f"CASE WHEN len(ws) <= {fixed.PREFILTER_MAX_WORDS} THEN text WHEN regexp_matches(lower(array_to_string("
    f"ws[{fixed.PREFILTER_HEAD_WORDS + 1}:], ' ')), {q('|'.join(fixed.PREFILTER_STEMS))}) "
    f"THEN array_to_string(ws[1:{fixed.PREFILTER_MAX_WORDS}], ' ') "
    f"ELSE array_to_string(ws[1:{fixed.PREFILTER_HEAD_WORDS}], ' ') END"
)


def words_of(source: str) -> str:
    return f"SELECT *, string_split_regex({strip('text')}, {rx(r'\s+', False)}) AS ws FROM {source}"


REQUESTS = [
    ("texts", inputs.PRESS),
    ("worded", words_of("texts")),
    (
        "requests",
        f"SELECT *, 'Company: ' || company_name || chr(10) || 'Filing date: ' || date_filed || chr(10) || chr(10) "
        f"|| 'Press release text:' || chr(10) || {PREFILTERED} AS request FROM worded WHERE text IS NOT NULL",
    ),
]
CHUNKED = (
    "chunked",
    "SELECT *, CAST(floor((row_number() OVER (ORDER BY accession_number) - 1) / {size}) AS BIGINT) AS chunk_no FROM {source}",
)
PRICES = (
    "prices",
    " UNION ALL ".join(
        f"SELECT {q(m)} AS model, {i} AS price_in, {o} AS price_out"
        for m, (i, o) in fixed.MODEL_PRICES.items()
    ),
)
NOT_EQUAL_13 = "length(request) % 13 <> 0"


def chunked(source: str, size: int) -> tuple[str, str]:
    return CHUNKED[0], CHUNKED[1].format(source=source, size=size)


REQUIRED_FIELDS = [
    "forecast_metric", "time_horizon", "estimate_type", "unit", "direction", "confidence_language", "is_adjusted",
    "context_sentence",
]


def oracles() -> dict[str, str]:
    o: dict[str, str] = {}
    # sources
    lines = chain(*PARSED)
    columns = "cik, company_name, form_type, date_filed, filename, year, quarter"
    o["s1_scan_master_index"] = lines + f"SELECT {columns} FROM parsed"
    o["s2_scan_index_range"] = lines + f"SELECT {columns} FROM parsed WHERE year BETWEEN 1996 AND 1999"
    o["s3_read_parquet_table"] = "SELECT doc_id, lang FROM documents"
    o["s4_write_parquet_table"] = chain(*INDEX) + (
        "SELECT year, count(*) AS n_rows, count(DISTINCT cik) AS n_ciks FROM idx GROUP BY year"
    )
    o["s5_write_csv"] = chain(("press", inputs.PRESS)) + (
        "SELECT accession_number, company_name, text FROM press"
    )
    o["s6_scan_tickers"] = chain(TICKERS) + "SELECT * FROM tickers"
    o["s7_scan_exhibit_files"] = chain(
        ("raw", inputs.BODIES), BODIES
    ) + "SELECT r.cik, r.accession_key, r.filename, b.text FROM raw r JOIN bodies b USING (accession_key, filename)"
    rows = chain(*LIST_ROWS)
    o["s8_scan_filing_index_json"] = rows + (
        "SELECT l.accession_key, count(j.item_no) AS n_documents, "
        "coalesce(string_agg(j.name, ';' ORDER BY j.item_no), '') AS names, "
        "coalesce(string_agg(j.type, ';' ORDER BY j.item_no), '') AS types "
        "FROM listed l LEFT JOIN json_docs j USING (accession_key) WHERE json_valid(l.value) GROUP BY l.accession_key"
    )
    o["s9_scan_filing_index_html"] = rows + "SELECT accession_key, n_cells, description, href FROM list_rows"
    j = lambda p: f"coalesce(value->>'$.{p}', '')"
    metadata = (
        f"SELECT cik, {j('sic')} AS sic, {j('sicDescription')} AS sic_description, "
        f"{j('stateOfIncorporation')} AS state_of_incorporation, {j('fiscalYearEnd')} AS fiscal_year_end, "
        f"{j('exchanges[0]')} AS exchange, {j('category')} AS category FROM ({inputs.METADATA})"
    )
    o["s10_scan_company_metadata"] = metadata
    o["s11_compact_batches"] = chain(PRESS_INDEX) + (
        "SELECT cik, 2 * count(*) AS n_rows FROM press_index GROUP BY cik"
    )
    # filings
    forms = "upper(form_type) IN ('8-K', '8-K/A')"
    o["f1_filter_form_type"] = lines + f"SELECT filename, form_type FROM parsed WHERE {forms}"
    o["f2_extract_accession"] = lines + (
        f"SELECT filename, {ACC} AS accession_number, {ACC_ANY} AS accession_either FROM parsed"
    )
    o["f3_pad_cik"] = lines + f"SELECT DISTINCT cik, {pad('cik')} AS cik_padded FROM parsed"
    o["f4_coerce_date"] = lines + (
        "SELECT filename, TRY_CAST(date_filed AS TIMESTAMP) AS date_filed FROM parsed"
    )
    index = chain(*INDEX)
    o["f5_require_accession"] = index + (
        "SELECT accession_number, form_type FROM idx WHERE accession_number IS NOT NULL"
    )
    o["f6_filing_url"] = index + (
        f"SELECT accession_number, {filing_url('accession_number')} AS filing_url FROM idx "
        "WHERE accession_number IS NOT NULL"
    )
    o["f7_filter_min_length"] = "SELECT doc_id FROM documents WHERE length(text) >= 100"
    o["f8_earnings_gate"] = chain(BODIES) + f"SELECT accession_key, filename FROM bodies WHERE {GATE}"
    o["f9_text_length"] = "SELECT doc_id, length(text) AS text_length FROM documents"
    o["f10_select_contract"] = from_panel("SELECT * EXCLUDE (date_filed) FROM panel")
    o["f11_slice_panel"] = from_panel(
        "SELECT cik, accession_number, val1, val2, action FROM panel WHERE metric = 'EPS' "
        "AND pdicity = 'FY' AND is_range AND action IN ('raises', 'lowers')"
    )
    o["f12_document_key"] = (
        "SELECT page_id, sha256(url || '{}') AS document_key, "
        "sha256(url || '{\"form\": \"8-K\", \"page\": 2}') AS key_with_params FROM pages"
    )
    # exhibits
    o["e1_match_exhibits_json"] = rows + "SELECT accession_key, pos, url, description, filename FROM json_found"
    o["e2_match_exhibits_html"] = rows + "SELECT accession_key, pos, url, description, filename FROM html_found"
    o["e3_primary_document"] = rows + (
        f"SELECT h.accession_key, min_by(u.url, u.row_no) AS primary_doc FROM html_listed h LEFT JOIN url_rows u "
        f"ON h.accession_key = u.accession_key AND contains(upper(u.description), '8-K') "
        f"AND {EXTENSION.format('u.href')} GROUP BY h.accession_key"
    )
    o["e4_resolve_url"] = rows + "SELECT accession_key, href, url FROM url_rows"
    o["e5_first_exhibit"] = rows + (
        "SELECT accession_key, exhibit_url, exhibit_filename, exhibit_description, items FROM chosen"
    )
    o["e6_extract_items"] = rows + "SELECT accession_key, items FROM item_numbers"
    o["e7_strip_html"] = f"SELECT page_id, {strip_html('html')} AS text FROM pages"
    # guidance
    o["g0_extract_guidance"] = from_steps(
        f"SELECT {GUIDANCE_COLUMNS}, sent_ord, metric_ord FROM guidance"
    )
    o["g1_split_sentences"] = chain(("sentences", split_sql("documents", "doc_id"))) + (
        "SELECT doc_id, sent_ord, sentence, sent_start FROM sentences"
    )
    o["g1_split_press"] = from_steps(
        "SELECT accession_number, sent_ord, sentence, sent_start FROM sentences", "sentences"
    )
    o["g2_filter_guidance_sentences"] = from_steps(
        "SELECT accession_number, sent_ord FROM spoken", "spoken"
    )
    o["g3_detect_metrics"] = from_steps(
        "SELECT accession_number, sent_ord, metric, metric_offset FROM mentions", "mentions"
    )
    o["g4_extract_values"] = from_steps(
        "SELECT accession_number, sent_ord, metric, val1, val2, is_range FROM valued", "valued"
    )
    o["g4a_parse_range"] = from_steps(
        "SELECT metric, count(*) AS n, min(val1) AS lowest, max(val2) AS highest FROM valued "
        "WHERE is_range GROUP BY metric", "valued"
    )
    o["g4b_parse_per_share_range"] = from_steps(
        "SELECT DISTINCT accession_number, metric, val1, val2 FROM valued "
        "WHERE is_range AND val1 < 100 AND val2 < 100", "valued"
    )
    o["g4c_parse_amount"] = from_steps(
        "SELECT DISTINCT accession_number, metric, val1 FROM valued WHERE NOT is_range", "valued"
    )
    words = ", ".join(q(w) for w in ["", *fixed.SCALE_WORDS])
    o["g4d_scale_amount"] = (
        f"SELECT o_orderkey, scale, {scaled('number', 'scale')} AS amount FROM (SELECT o_orderkey, "
        f"format('{{:,}}', CAST(floor(o_totalprice) AS BIGINT)) AS number, unnest([{words}]) AS scale FROM orders)"
    )
    for name, column in (
        ("g5_detect_period", "pdicity"), ("g6_detect_fiscal_year", "fiscal_year"),
        ("g7_detect_action", "action"),
    ):
        o[name] = from_steps(
            f"SELECT accession_number, sent_ord, metric, {column} FROM labelled", "labelled"
        )
    o["g8_truncate_sentence"] = (
        f"SELECT doc_id, substring({strip('text')}, 1, {fixed.SENTENCE_CHARS}) AS sentence FROM documents"
    )
    o["d1_dedup_in_document"] = from_steps(
        "SELECT accession_number, sent_ord, metric, val1, val2 FROM once", "once"
    )
    # derived
    mapped = chain(*ITEMS)
    o["c1_midpoint"] = mapped + (
        "SELECT accession_number, item_ord AS sent_ord, val1, val2, "
        "CASE WHEN val2 <> 0 THEN (val1 + val2) / 2 ELSE val1 END AS parse_midpoint, "
        "CASE WHEN val2 <> val1 THEN (val1 + val2) / 2 ELSE val1 END AS midpoint FROM mapped"
    )
    o["c2_range_width"] = from_steps(
        "SELECT accession_number, metric, val1, val2, range_width FROM guidance"
    )
    o["c3_file_period"] = index + (
        "SELECT filename, CAST(year(date_filed) AS INTEGER) AS file_year, "
        "CAST(quarter(date_filed) AS INTEGER) AS file_quarter, "
        "CAST(year(date_filed) AS VARCHAR) || 'Q' || CAST(quarter(date_filed) AS VARCHAR) AS file_yearq FROM idx"
    )
    o["c4_is_per_share"] = mapped + (
        f"SELECT accession_number, item_ord AS sent_ord, metric, val1, val2, {PER_SHARE} AS is_per_share FROM mapped"
    )
    # joins
    o["j1_join_tickers"] = from_panel(
        "SELECT cik_padded, accession_number, metric, val1, ticker, company_name_sec FROM joined"
    )
    o["j2_exclude_processed"] = chain(("press", inputs.PRESS), LEDGER) + (
        "SELECT accession_number, form_type FROM press "
        "WHERE accession_number NOT IN (SELECT accession_number FROM ledger)"
    )
    o["j2_large_ledger"] = o["j2_exclude_processed"]
    o["j3_lookup_metric"] = mapped + (
        "SELECT accession_number, item_ord, forecast_metric, metric FROM bounds"
    )
    o["j4_lookup_ticker_literal"] = chain(PRESS_INDEX) + (
        "SELECT cik, accession_number, CASE WHEN CAST(cik AS BIGINT) % 7 <> 0 THEN 'T' || cik END AS ticker "
        "FROM press_index"
    )
    o["j5_enrich_company"] = chain(PRESS_INDEX, ("metadata", metadata)) + (
        f"SELECT p.accession_number, {pad('p.cik')} AS cik_padded, m.sic, m.exchange, m.category "
        "FROM press_index p LEFT JOIN metadata m ON p.cik = m.cik"
    )
    o["j6_attach_exhibit"] = chain(PRESS_INDEX, CO_INDEX, *LIST_ROWS, BODIES, CO_BODIES) + (
        f"SELECT f.cik, f.accession_number, c.exhibit_filename, b.text FROM co_index f {CO_JOIN}"
    )
    # aggregates
    o["a1_summarise_panel"] = from_panel(SUMMARY)
    o["a2_value_counts"] = from_panel(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS n FROM panel WHERE {c} IS NOT NULL GROUP BY {c}"
            for c in ("metric", "action", "pdicity")
        )
    )
    profile = (
        "min(date_filed) AS first_date, max(date_filed) AS last_date"
    )
    o["a3_table_profile"] = from_panel(
        f"SELECT count(*) AS n_rows, count(DISTINCT cik) AS n_ciks, count(DISTINCT ticker) AS n_tickers, {profile} FROM panel"
    )
    o["a3_index_profile"] = index + (
        f"SELECT count(*) AS n_rows, count(DISTINCT cik) AS n_ciks, {profile} FROM idx"
    )
    o["a4_ticker_match_rate"] = from_panel(
        "SELECT count(ticker) AS n_matched, count(*) AS n_total, "
        "round(100.0 * count(ticker) / nullif(count(*), 0), 6) AS pct_matched FROM joined"
    )
    o["a5_extraction_funnel"] = from_steps(
        "SELECT CAST((SELECT count(*) FROM texts) AS BIGINT) AS n_documents, "
        "count(DISTINCT accession_number) AS n_with_guidance, count(*) AS n_records FROM guidance"
    )
    o["a6_dedup_report"] = from_panel(
        "SELECT CAST((SELECT count(*) FROM joined) AS BIGINT) AS n_before, count(*) AS n_after, "
        "CAST((SELECT count(*) FROM joined) - count(*) AS BIGINT) AS n_removed FROM uniq"
    )
    o["a7_filings_per_quarter"] = index + (
        "SELECT year, quarter, count(*) AS n_filings FROM idx GROUP BY year, quarter"
    )
    default_in, default_out = fixed.MODEL_PRICES[fixed.DEFAULT_MODEL]
    o["a8_usage_cost"] = chain(("usage", inputs.USAGE), PRICES) + (
        "SELECT u.model, CAST(sum(tokens_in) AS BIGINT) AS tokens_in, CAST(sum(tokens_out) AS BIGINT) AS tokens_out, "
        f"round(sum(tokens_in) / 1e6 * coalesce(any_value(price_in), {default_in}) "
        f"+ sum(tokens_out) / 1e6 * coalesce(any_value(price_out), {default_out}), 6) AS cost "
        "FROM usage u LEFT JOIN prices p ON u.model = p.model GROUP BY u.model"
    )
    o["a9_flag_total"] = mapped + (
        "SELECT count(*) FILTER (WHERE is_adjusted) AS n_flagged, count(*) AS n_rows FROM mapped"
    )
    # dedup and order
    o["d2_dedup_panel"] = from_panel(
        "SELECT cik_padded, filed AS date_filed, metric, val1, val2, accession_number, ticker FROM uniq"
    )
    o["d3_dedup_ledger"] = chain(("press", inputs.PRESS), LEDGER) + (
        "SELECT accession_number FROM ledger UNION SELECT accession_number FROM press"
    )
    o["o1_sort_index"] = index + "SELECT date_filed, cik, filename FROM idx"
    panel_sort = (
        "ticker NULLS LAST, date_filed NULLS LAST, metric NULLS LAST, cik, accession_number, val1, val2"
    )
    panel_columns = "ticker, date_filed, metric, cik, accession_number, val1, val2"
    o["o2_sort_panel"] = from_panel(f"SELECT {panel_columns} FROM panel ORDER BY {panel_sort}")
    o["o3_head_sample"] = from_panel(
        f"SELECT {panel_columns} FROM panel ORDER BY {panel_sort} LIMIT {fixed.SAMPLE_ROWS}"
    )
    o["o4_limit_filings"] = index + (
        "SELECT accession_number, cik, date_filed FROM idx WHERE accession_number IS NOT NULL "
        "ORDER BY date_filed NULLS LAST, cik, filename LIMIT 1000"
    )
    o["o5_chunk_rows"] = chain(
        ("press", inputs.PRESS), chunked("press", fixed.EXHIBIT_BATCH_ROWS)
    ) + "SELECT accession_number, chunk_no FROM chunked"
    # Without the exact header rule each header brings one data line along.
    o["u1_union_quarters"] = index + (
        "SELECT year, quarter, count(*) AS n_filings FROM idx GROUP BY year, quarter"
    )
    o["u2_union_batches"] = chain(PRESS_INDEX) + "SELECT accession_number, cik FROM press_index"
    # model path
    o["x1_prefilter_text"] = chain(("worded", words_of("documents"))) + (
        f"SELECT doc_id, {PREFILTERED} AS text FROM worded"
    )
    requests = chain(*REQUESTS)
    o["x2_render_requests"] = requests + "SELECT accession_number, request FROM requests"
    o["x3_parse_responses"] = mapped + "SELECT * FROM items"
    o["x3_rejected_items"] = mapped + "SELECT * FROM items WHERE problem IS NOT NULL"
    o["x3_accepted_items"] = mapped + "SELECT * EXCLUDE (problem) FROM items WHERE problem IS NULL"
    o["x3_item_manifest"] = mapped + (
        "SELECT count(*) FILTER (problem IS NULL) AS accepted, count(*) FILTER (problem IS NOT NULL) AS rejected, "
        + ", ".join(f"count(*) FILTER (problem = {q(n)}) AS rejected_{n}" for n in REQUIRED_FIELDS)
        + " FROM items"
    )
    o["x4_map_to_guidance"] = mapped + (
        f"SELECT accession_number, cik, item_ord AS sent_ord, forecast_metric, fiscal_year, estimate_type, value_low, "
        f"value_high, value_point, unit, direction, confidence_language, is_adjusted, metric, is_range, val1, val2, "
        f"midpoint, range_width, time_horizon AS pdicity, direction AS action, "
        f"substring(coalesce(context_sentence, ''), 1, {fixed.SENTENCE_CHARS}) AS sentence FROM mapped"
    )
    o["x5_extract_with_model"] = requests + (
        f"SELECT accession_number, CASE WHEN {NOT_EQUAL_13} THEN 'ok' ELSE 'failed' END AS status, "
        f"CASE WHEN {NOT_EQUAL_13} THEN length(request) ELSE 0 END AS tokens_in, "
        f"CAST(CASE WHEN {NOT_EQUAL_13} THEN 10 ELSE 0 END AS BIGINT) AS tokens_out FROM requests"
    )
    o["x6_cost_cap"] = chain(
        ("usage", inputs.USAGE), chunked("usage", 100),
        (
            "spent",
            "SELECT chunk_no, coalesce(sum(sum(tokens_in)) OVER w, 0) / 1e6 * "
            f"{default_in} + coalesce(sum(sum(tokens_out)) OVER w, 0) / 1e6 * {default_out} AS spent FROM chunked "
            "GROUP BY chunk_no WINDOW w AS (ORDER BY chunk_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)",
        ),
    ) + "SELECT accession_number, chunk_no FROM chunked JOIN spent USING (chunk_no) WHERE spent < 1.0"
    short = "accession_number, metric, val1, val2, pdicity, action"
    o["x7_fallback_regex"] = from_steps(
        f"SELECT {short} FROM guidance WHERE accession_number IN "
        "(SELECT accession_number FROM texts WHERE text LIKE 'C%')"
    )
    # composites
    o["z1_build_filing_index"] = index + "SELECT * FROM idx WHERE year BETWEEN 1995 AND 2001"
    made = [PRESS_INDEX, *LIST_ROWS, BODIES, EXHIBITS]
    o["z2_build_exhibits"] = chain(PRESS_INDEX, CO_INDEX, *LIST_ROWS, BODIES, CO_BODIES, CO_EXHIBITS, LEDGER) + (
        "SELECT * FROM co_exhibits "
        "WHERE accession_number NOT IN (SELECT accession_number FROM ledger)"
    )
    o["z3_build_guidance"] = from_steps(f"SELECT {GUIDANCE_COLUMNS} FROM guidance")
    o["z3_guidance_from_bodies"] = chain(
        *made, *guidance_steps("SELECT * FROM made_exhibits")
    ) + f"SELECT exhibit_url, {short} FROM guidance"
    o["z4_build_guidance_model"] = chain(*REQUESTS, LEDGER, *[s for s in STEPS if s[0] != "texts"]) + (
        "SELECT accession_number, CASE WHEN length(request) % 7 = 0 THEN 'Backlog' ELSE 'Revenue' END AS metric, "
        "CASE WHEN length(request) % 11 <> 0 THEN CAST(length(request) AS DOUBLE) END AS val1, "
        "CASE WHEN length(request) % 11 <> 0 THEN CAST(length(request) AS DOUBLE) END AS val2, 'FY' AS pdicity, 'issues' AS action FROM requests "
        f"WHERE {NOT_EQUAL_13} AND accession_number NOT IN (SELECT accession_number FROM ledger) UNION ALL "
        f"SELECT {short} FROM guidance WHERE accession_number IN (SELECT accession_number FROM requests "
        f"WHERE NOT {NOT_EQUAL_13} AND accession_number NOT IN (SELECT accession_number FROM ledger))"
    )
    o["z5_build_panel"] = from_panel("SELECT * FROM panel")
    o["z6_publish"] = from_panel(SUMMARY)
    o["r1_stream_guidance"] = from_steps(f"SELECT {GUIDANCE_COLUMNS} FROM guidance")
    return o
