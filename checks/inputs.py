"""Inputs derived from the given tables, as SQL that Spark and DuckDB read alike.

The given tables hold no filings. Each order becomes a filing of its customer, with a
press release, an index line, a listing and a model answer, so the work grows with the
tables. Parts are chosen by the order key, values come from the order's price.
"""

from __future__ import annotations

KEY = "o_orderkey"
N = "CAST(floor(o_totalprice / 1000) AS BIGINT)"


def _s(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def _choice(expr: str, options: list[str]) -> str:
    """SQL CASE over ``expr``; options are SQL text."""
    arms = " ".join(f"WHEN {i} THEN {o}" for i, o in enumerate(options[:-1]))
    return f"CASE {expr} {arms} ELSE {options[-1]} END"


def _texts(options: list[str]) -> list[str]:
    return [f"'{o}'" for o in options]


CENTS = f"lpad({_s(f'{N} % 100')}, 2, '0')"

METRIC = _choice(f"{KEY} % 11", _texts([
    "earnings per diluted share", "total revenue", "net income", "adjusted EBITDA",
    "operating income", "funds from operations", "free cash flow", "capital expenditures",
    "gross margin", "effective tax rate", "net income per share",
]))
VERB = _choice(f"{KEY} % 7", _texts([
    "expects", "anticipates", "raises its outlook for", "lowers its target for",
    "narrows its forecast for", "reaffirms its guidance for", "provides initial guidance for",
]))
PERIOD = _choice(f"{KEY} % 9", _texts([
    "first quarter", "Q2", "3rd quarter", "fourth-quarter", "full-year", "first half", "H2",
    "twelve-month", "coming",
]))
VALUE = _choice(f"{KEY} % 13", [
    f"concat('of $', {_s(N)}, ' million to $', {_s(f'{N} + 3')}, ' million')",
    f"concat('of $', {_s(N)}, ' to $', {_s(f'{N} + 4')}, ' million')",
    f"concat('of $', {_s(N)}, ' million to $1.', {_s(N)}, ' billion')",
    f"concat('of about $', {_s(N)}, ' million')",
    f"concat('of $1.', {CENTS}, ' to $2.', {CENTS})",
    f"concat('between $', {_s(N)}, '.5 billion and $', {_s(f'{N} + 2')}, '.25 billion')",
    f"concat('of ($0.', {CENTS}, ')')",
    f"concat('of ', {_s(N)}, '% to ', {_s(f'{N} + 1')}, '%')",
    f"concat('of $1', {_s(f'{N} + 500')}, ' thousand')",
    f"concat('of $', {_s(N)}, ' more than before')",
    f"concat('of $0.12', {_s(f'{N} + 100')})",
    f"concat('of $1.', {CENTS}, '-2.', {CENTS})",
    f"concat('of $', {_s(N)}, ',250 k – $', {_s(N)}, ',900 k')",
])

NEUTRAL = (
    "The firm makes goods for homes and shops and it has done so for many seasons. "
    "Its people work at many sites in many lands and they like what they do there. "
    "Each site has its own crew and its own way to do the work well and on time. "
    "Goods go out by rail and by road and reach shops within a week or two of an order. "
    "The firm is led by a small board that meets in the old town hall."
)

STATEMENT = (
    f"concat('The company ', {VERB}, ' ', {PERIOD}, ' ', {_s('year(o_orderdate) + 8')}, ' ', "
    f"{METRIC}, ' ', {VALUE}, '.')"
)
SECOND = (
    f"concat(' Management reaffirms its outlook for net sales and capex of $', {_s(f'{N} + 7')},"
    f" ' million for the year ended ', {_s('year(o_orderdate) + 9')}, '!')"
)

TEXT = f"""CASE
    WHEN {KEY} % 97 = 0 THEN NULL
    WHEN {KEY} % 101 = 0 THEN rpad('We expect total revenue of $5 million. ', 99, 'x')
    WHEN {KEY} % 103 = 0 THEN rpad('We expect total revenue of $5 million. ', 100, 'x')
    ELSE concat(
      CASE WHEN {KEY} % 19 = 0 THEN '😀 ' ELSE '' END,
      c_name, ' reports results', chr(10), chr(10),
      CASE WHEN {KEY} % 3 = 0 THEN concat('{NEUTRAL}', chr(10)) ELSE '' END,
      statement,
      CASE WHEN {KEY} % 17 = 0 THEN chr(160) ELSE ' ' END,
      CASE WHEN {KEY} % 4 = 1 THEN {SECOND} ELSE '' END,
      CASE WHEN {KEY} % 5 = 0 THEN concat(' ', statement) ELSE '' END,
      ' Sales increased to $', {_s(N)}, ' million.')
  END"""


def with_text(source: str) -> str:
    """``source`` (orders joined to customers) with the press release as ``text``."""
    return f"SELECT *, {TEXT} AS text FROM (SELECT *, {STATEMENT} AS statement FROM ({source}) s) t"


ACCESSION = (
    f"concat(lpad({_s('c_custkey')}, 10, '0'), '-', substr({_s('year(o_orderdate)')}, 3, 2), "
    f"'-', lpad({_s(KEY)}, 10, '0'))"
)
ACCESSION_KEY = ACCESSION.replace("'-', ", "")

ORDERS = "orders JOIN customer ON o_custkey = c_custkey"

# Every sixth filing is filed again as an amendment: same firm, date and text.
_FILED = f"""
SELECT *, '8-K' AS form_type, '' AS suffix FROM {ORDERS}
UNION ALL
SELECT *, '8-K/A' AS form_type, '9' AS suffix FROM {ORDERS} WHERE {KEY} % 6 = 0"""
PRESS = f"""
SELECT {_s('c_custkey')} AS cik, c_name AS company_name,
  concat({ACCESSION}, suffix) AS accession_number,
  CAST(CAST(o_orderdate AS DATE) AS STRING) AS date_filed, form_type,
  concat('https://www.sec.gov/Archives/edgar/data/', {_s('c_custkey')}, '/', {ACCESSION_KEY}, suffix,
         '/ex991.htm') AS exhibit_url, text
FROM ({with_text(_FILED)}) filed"""

# --- index lines -------------------------------------------------------------

CIK = f"CASE WHEN {KEY} % 47 = 0 THEN concat('9', lpad({_s('c_custkey')}, 10, '0')) ELSE {_s('c_custkey')} END"
FORM = _choice(f"{KEY} % 6", _texts(["8-K", "8-K/A", "8-k", "10-Q", "8-k/a", "8-K"]))
LINE_DATE = (
    f"CASE WHEN {KEY} % 41 = 0 THEN '2025-13-40' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END"
)
PATH = (
    f"CASE WHEN {KEY} % 43 = 0 THEN concat('edgar/data/', {_s('c_custkey')}, '/', {ACCESSION}, '.txt') "
    f"ELSE concat('edgar/data/', {_s('c_custkey')}, '/', {ACCESSION_KEY}, '/filing.txt') END"
)
YEAR = "CAST(year(o_orderdate) AS INT)"
QUARTER = "CAST(quarter(o_orderdate) AS INT)"

INDEX_LINES = f"""
SELECT concat(
    CASE WHEN {KEY} % 37 = 0 THEN ' ' ELSE '' END, {CIK}, '|',
    c_name, CASE WHEN {KEY} % 29 = 0 THEN '|CO' ELSE '' END, '|', {FORM}, '|',
    {LINE_DATE}, CASE WHEN {KEY} % 37 = 0 THEN '  ' ELSE '' END, '|', {PATH},
    CASE WHEN {KEY} % 53 = 0 THEN '|' ELSE '' END,
    CASE WHEN {KEY} % 31 = 0 THEN chr(13) ELSE '' END) AS value,
  {YEAR} AS year, {QUARTER} AS quarter
FROM {ORDERS}"""

# Written in front of the data lines: one header per quarter, with a line that only
# the dashes rule drops.
INDEX_HEADERS = f"""
SELECT DISTINCT concat('Description: index of filings', chr(10),
    '1|ABOVE THE DASHES|8-K|1995-01-02|edgar/data/1/000000000195000001/filing.txt', chr(10),
    'CIK|Company Name|Form Type|Date Filed|Filename', chr(10), '-----------') AS value,
  {YEAR} AS year, {QUARTER} AS quarter
FROM orders"""

# --- listings and bodies -----------------------------------------------------

_JSON_LISTING = _choice(f"{KEY} % 8", [
    """concat('{"directory":{"item":[{"name":"main.htm","type":"8-K"},',
       '{"name":"ex991.htm","type":"EX-99.1"},{"name":"ex992.txt","type":"EX-99.2"}]}}')""",
    """concat('{"directory":{"item":[{"name":"press.pdf","type":"EX-99.1"},',
       '{"name":"Press.HTML","type":"GRAPHIC"}]}}')""",
    """'{"directory":{"item":[{"name":"main.htm","type":"8-K"}]}}'""",
    """'{"directory":{"item":[{"name":"exhibit 99.txt"},{"type":"EX-99"}]}}'""",
    """'{"directory":{}}'""",
    """'{"item":[]}'""",
    """'not a listing'""",
    """'{"directory":{"item":[{"name":"a.htm.zip","type":"ex-99.3"}]}}'""",
])
_HREF = _choice(f"{KEY} % 5", [
    "'ex991.htm'", "'/Archives/x/ex991.htm'", "'http://files.example.com/y/ex991.txt'",
    "'EX991.HTM?a=1&amp;b=2'", "'ex991.pdf'",
])
_LABEL = _choice(f"{KEY} % 7", _texts([
    "EX-99.1", "Exhibit&nbsp;99", "press  release", "<b>Earn</b>ings", "EX-10", "Graphic",
    "EX-99.1 <!-- EX-1 --> R&amp;D",
]))
# Some pages lay their files out by tables: in a cell of a row with a link of its own, or two tables deep.
_NESTED = f"{KEY} % 15"
_LAID_OUT = f"""CASE {_NESTED} WHEN 7 THEN '<table><tr><td>Menu</td><td><a href="main.htm">Form 8-K</a></td><td>'
    WHEN 13 THEN '<table><tr><td>top<table><tbody><tr><td colspan=2>' ELSE '' END"""
_LAID_OUT_END = f"""CASE {_NESTED} WHEN 7
    THEN '</td></tr><tr><td>8</td><td>EX-99.8</td><td><a href="ex991.htm">again</a></td></tr></table><p><a href=x.htm>foot</a>'
    WHEN 13 THEN '</td></tr></tbody></table></td></tr></table><table><tr><td>9<td>Earnings<td><a href="late.htm">z</a></table>'
    ELSE '' END"""
_HTML_LISTING = f"""concat('<html><body><h1>Filing</h1><p>Item 2.02 Results. Item&#160;', '9.01 and <i>Item</i> 7.0',
    {_s(f'{KEY} % 3')}, '</p>', {_LAID_OUT},
    '<table class="files"><tr><th>Seq</th><th>File</th></tr>',
    '<tr><td>1</td><td>Form 8-K</td><td> <a href="main.htm">main.htm</a> </td></tr>',
    '<TR class=x><TD>2<td>', {_LABEL}, '<td><a class="f" href="', {_HREF}, '">file</a></TR>',
    '<tr><td>3</td><td>EX-99.2</td></tr>',
    '<tr><td>4</td><td>EX-99.3</td><td>no link</td></tr>',
    '<tr><td>5</td><td>EX-99.4</td><td><a name="z">x</a></td></tr>',
    CASE WHEN {KEY} % 4 = 3 THEN '<tr><td>6</td><td>EX-99.5</td><td><a href=''more.txt''>m</a></td></tr>' ELSE '' END,
    '</table>', {_LAID_OUT_END}, '</body></html>')"""

LISTINGS = f"""
SELECT {_s('c_custkey')} AS cik, {ACCESSION_KEY} AS accession_key,
  CASE WHEN {KEY} % 2 = 0 THEN {_JSON_LISTING.replace(f'{KEY} % 8', f'({KEY} // 2) % 8')}
       ELSE {_HTML_LISTING} END AS value
FROM {ORDERS}"""
# Integer division is spelled differently in the two engines.
LISTINGS = LISTINGS.replace(f"({KEY} // 2) % 8", f"CAST(floor({KEY} / 2) AS BIGINT) % 8")

# Bodies for the names the listings choose; every ninth order reports nothing.
_BODY_NAMES = ["ex991.htm", "Press.HTML", "exhibit 99.txt", "more.txt", "EX991.HTM?a=1&b=2"]
_NAMED = " UNION ALL ".join(f"SELECT *, '{name}' AS filename FROM {ORDERS}" for name in _BODY_NAMES)
_BODY_TEXT = f"""SELECT *, CASE WHEN {KEY} % 9 = 4
    THEN concat('{NEUTRAL}', ' It is ', {_s(N)}, ' miles away.') ELSE coalesce(text, '') END AS plain
  FROM ({with_text(_NAMED)}) w"""
BODIES = f"""
SELECT {_s('c_custkey')} AS cik, {ACCESSION_KEY} AS accession_key, filename,
  CASE WHEN lower(filename) LIKE '%.htm' OR lower(filename) LIKE '%.html'
    THEN concat('<html><head><title>R</title><style>p {{x}}</style></head><body><div><p>', plain,
      '</p><!-- note --><p>R&amp;D &#150; all</p>', chr(10), chr(10),
      '</div><script>if (a<b) go();</script></body></html>')
    ELSE plain END AS value
FROM ({_BODY_TEXT}) b"""

# Every tenth filing names a second filer; every other one of these has staged copies of its own.
CO_INDEX = f"""
SELECT {_s('c_custkey + 1')} AS cik, concat('CO ', c_name) AS company_name, '8-K' AS form_type,
  CAST(o_orderdate AS DATE) AS date_filed, {ACCESSION} AS accession_number
FROM {ORDERS} WHERE {KEY} % 10 = 0"""
CO_STAGED = "CAST(substr(accession_key, -10) AS BIGINT) % 20 = 0"

# --- dimensions --------------------------------------------------------------

# Each ticker document covers up to 100 customers, so no group grows with the tables.
# Every fifth firm has two tickers, every seventh none.
TICKER_ROWS = f"""
SELECT CAST(floor(c_custkey / 100) AS BIGINT) AS document, 2 * c_custkey AS position,
  c_custkey AS cik_str, concat('T', {_s('c_custkey')}) AS ticker, upper(c_name) AS title
FROM customer WHERE c_custkey % 7 <> 0
UNION ALL
SELECT CAST(floor(c_custkey / 100) AS BIGINT) AS document, 2 * c_custkey + 1 AS position,
  c_custkey AS cik_str, concat('T', {_s('c_custkey')}, '-B') AS ticker, upper(c_name) AS title
FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey % 5 = 0"""

METADATA = f"""
SELECT {_s('s_suppkey')} AS cik, concat('{{"sic":"', {_s('1000 + s_suppkey % 9000')}, '"',
    CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE concat(',"sicDescription":"', s_name, '"') END,
    ',"stateOfIncorporation":"', {_choice('s_suppkey % 3', _texts(['DE', 'NV', '']))}, '"',
    ',"fiscalYearEnd":"1231"',
    {_choice('s_suppkey % 4', _texts(['', ',"exchanges":[]', ',"exchanges":null',
                                      ',"exchanges":["NYSE","Nasdaq"]']))},
    CASE WHEN s_suppkey % 5 = 0 THEN ',"category":null' ELSE ',"category":"filer"' END,
    '}}') AS value
FROM supplier"""

# --- model answers and usage -------------------------------------------------

_ITEM_METRIC = _choice(f"{KEY} % 9", _texts([
    "EPS", "Revenue", "NetIncome", "EBIT", "GrossProfit", "FreeCashFlow", "AdjustedEBITDA",
    "Other", "Backlog",
]))
_BOUNDS = _choice(f"{KEY} % 6", [
    f"""concat('"range","value_low":', {_s(N)}, ',"value_high":', {_s(f'{N} + 5')}, '.5,"value_point":null')""",
    f"""concat('"range","value_low":', {_s(f'{N} + 5')}, ',"value_high":', {_s(N)}, ',"value_point":null')""",
    f"""concat('"range","value_low":', {_s(N)}, ',"value_high":null,"value_point":null')""",
    f"""concat('"range","value_low":null,"value_high":', {_s(N)}, ',"value_point":null')""",
    f"""concat('"point","value_low":null,"value_high":null,"value_point":', {_s(N)}, '.25')""",
    """'"point","value_low":null,"value_high":null,"value_point":null'""",
])
_ITEM = f"""concat('{{"forecast_metric":"', {_ITEM_METRIC}, '","time_horizon":"',
      {_choice(f'{KEY} % 5', _texts(['Q1', 'Q3', 'FY', 'H2', 'month']))}, '","fiscal_year":',
      CASE WHEN {KEY} % 10 = 0 THEN 'null' ELSE {_s('year(o_orderdate) + 8')} END,
      ',"estimate_type":', {_BOUNDS}, ',"unit":"',
      {_choice(f'{KEY} % 4', _texts(['dollars', 'millions', 'per_share', 'percent']))},
      '","direction":"', {_choice(f'{KEY} % 7', _texts(['issues', 'raises', 'lowers', 'narrows',
                                                       'reaffirms', 'initiates', 'withdraws']))},
      '","confidence_language":"expects","is_adjusted":',
      CASE WHEN {KEY} % 3 = 0 THEN 'true' ELSE 'false' END,
      ',"context_sentence":"', rpad('Sentence ', CASE WHEN {KEY} % 8 = 0 THEN 600 ELSE 40 END, 'ab c'), '"}}')"""
RESPONSE = f"""CASE
    WHEN {KEY} % 61 = 0 THEN '{{"guidance_items":[]}}'
    WHEN {KEY} % 67 = 0 THEN '{{"note":"none"}}'
    WHEN {KEY} % 71 = 0 THEN 'no json here'
    WHEN {KEY} % 4 = 2 THEN concat('{{"guidance_items":[', {_ITEM}, ',', {_ITEM}, ']}}')
    ELSE concat('{{"guidance_items":[', {_ITEM}, ']}}') END"""
RESPONSES = f"""
SELECT {ACCESSION} AS accession_number, {_s('c_custkey')} AS cik, {RESPONSE} AS response
FROM {ORDERS}"""

MODEL = _choice(f"{KEY} % 6", _texts([
    "gpt-4o-mini", "gpt-4o", "gpt-4.1-mini", "gpt-4.1", "gpt-4.1-nano", "another",
]))
USAGE = f"""
SELECT {ACCESSION} AS accession_number, {MODEL} AS model, {N} * 10 AS tokens_in,
  CAST({KEY} % 400 AS BIGINT) AS tokens_out
FROM {ORDERS}"""
