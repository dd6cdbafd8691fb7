"""Everything here must hold exactly for results to be right.

Patterns are written in the subset that Java and RE2 read alike. ``\\s`` stands
for every Unicode white space and is widened by :func:`augury.functions.text.pattern`.
"""

# --- filings ---------------------------------------------------------------

FORM_TYPES = ["8-K", "8-K/A"]

# The accession is a directory of its own in the path.
ACCESSION_PATTERN = r"edgar/data/\d+/([\d-]+)/"
# Wider form: also accepts paths whose file is named after the accession.
ACCESSION_PATTERN_ANY = r"edgar/data/\d+/([\d-]+)(?:/|\.txt$)"

ARCHIVE_HOST = "https://www.sec.gov"
ARCHIVE_BASE = "https://www.sec.gov/Archives"

# --- exhibits --------------------------------------------------------------

JSON_EXHIBIT_MARKS = ["EX-99", "EXHIBIT 99", "PRESS"]
HTML_EXHIBIT_PATTERN = r"EX-99|EXHIBIT\s*99|PRESS\s*RELEASE|EARNINGS"
DOCUMENT_EXTENSIONS = [".htm", ".html", ".txt"]
MARKUP_EXTENSIONS = [".htm", ".html"]
ITEM_PATTERN = r"Item\s+([\d.]+)"

GATE_CHARS = 5000
GATE_TERMS = [
    "EARNINGS", "RESULTS", "REVENUE", "GUIDANCE", "OUTLOOK", "EXPECTS", "FORECAST",
    "QUARTER", "FISCAL", "NET INCOME", "EPS", "PER SHARE", "DILUTED",
]

# --- guidance sentences ----------------------------------------------------

MIN_TEXT_CHARS = 100
SENTENCE_CHARS = 500

# A guidance verb is one of these with white space behind it.
GUIDANCE_VERBS = [
    r"expect(?:s|ing)?", r"anticipate(?:s|d|ing)?", r"project(?:s|ed|ing)?",
    r"forecast(?:s|ed|ing)?", r"guid(?:e[sd]?|ance|ing)", r"target(?:s|ed|ing)?",
    r"estimat(?:e[sd]?|ing)", r"see(?:s|ing)?", r"call(?:s|ed|ing)?\s+for",
    r"rais(?:e[sd]?|ing)", r"lower(?:s|ed|ing)?", r"narrow(?:s|ed|ing)?",
    r"reaffirm(?:s|ed|ing)?", r"reiterat(?:e[sd]?|ing)", r"confirm(?:s|ed|ing)?",
    r"maintain(?:s|ed|ing)?", r"introduc(?:e[sd]?|ing)", r"initiat(?:e[sd]?|ing)",
    r"provid(?:e[sd]?|ing)", r"issu(?:e[sd]?|ing)", r"updat(?:e[sd]?|ing)",
    r"revis(?:e[sd]?|ing)",
]

# Alternatives per metric. Order matters: records of one sentence follow it.
METRICS = {
    "EPS": [
        r"earnings?\s+per\s+(?:diluted\s+|common\s+)?share",
        r"diluted\s+(?:earnings?\s+per\s+share|EPS)", r"EPS",
        r"net\s+(?:income|earnings?)\s+per\s+(?:common\s+)?share",
        r"income\s+per\s+(?:common\s+)?share",
    ],
    "Revenue": [
        r"total\s+(?:revenue|sales)", r"net\s+(?:revenue|sales)", r"revenue", r"sales",
        r"top(?:\s|-)line",
    ],
    "Net_Income": [r"net\s+(?:income|earning)", r"bottom(?:\s|-)line"],
    "EBITDA": [r"adjusted\s+EBIT", r"EBIT"],
    "Operating_Income": [
        r"operating\s+(?:income|profit|earning)", r"income\s+from\s+operations",
        r"profit\s+from\s+operations",
    ],
    "FFO": [r"adjusted\s+(?:funds?\s+from\s+operation|FFO)", r"funds?\s+from\s+operation", r"FFO"],
    "Cash_Flow": [
        r"free\s+cash\s+flow", r"operating\s+cash\s+flow", r"cash\s+flow", r"FCF",
    ],
    "Capex": [r"capital\s+expenditure", r"capex", r"cap(?:\s|-)ex"],
    "Gross_Margin": [r"gross\s+(?:margin|profit)"],
    "Tax_Rate": [r"effective\s+tax\s+rate", r"tax\s+rate"],
}

# Windows in characters: before and after the point of interest.
VALUE_WINDOW = (50, 200)
PERIOD_WINDOW = (300, 300)
ACTION_WINDOW = (150, 150)

# --- amounts ---------------------------------------------------------------

SCALE_WORDS = ["billion", "million", "thousand", "bil", "mil", "mm", "bn", "m", "k", "b"]
SCALE_FACTORS = {
    "billion": 1e9, "bil": 1e9, "bn": 1e9, "b": 1e9,
    "million": 1e6, "mil": 1e6, "mm": 1e6, "m": 1e6,
    "thousand": 1e3, "k": 1e3,
}
AMOUNT_PATTERN = (
    r"\$\s*([0-9]{1,3}(?:,[0-9]{3})*(?:\.[0-9]{1,4})?)"
    r"\s*(billion|million|thousand|bil|mil|mm|bn|m|k|b)?"
)
RANGE_LINK_PATTERN = r"\)?\s*(?:to|through|and|-|–|—)\s*\(?"

# --- labels (first match in this order wins) -------------------------------

PERIODS = {
    "Q1": [r"first(?:\s|-)quarter", r"Q1", r"1st\s+quarter"],
    "Q2": [r"second(?:\s|-)quarter", r"Q2", r"2nd\s+quarter"],
    "Q3": [r"third(?:\s|-)quarter", r"Q3", r"3rd\s+quarter"],
    "Q4": [r"fourth(?:\s|-)quarter", r"Q4", r"4th\s+quarter"],
    "FY": [
        r"full(?:\s|-)year", r"fiscal(?:\s|-)year", r"annual", r"FY\s*[0-9]{2}",
        r"year\s+(?:ending|ended)", r"for\s+the\s+year", r"twelve(?:\s|-)month",
    ],
    "H1": [r"first(?:\s|-)half", r"1st\s+half", r"H1"],
    "H2": [r"second(?:\s|-)half", r"2nd\s+half", r"H2"],
}
PERIOD_DEFAULT = "Unknown"
FISCAL_YEAR_PATTERN = r"20[0-9]{2}"

# Whole words.
ACTIONS = {
    "raises": [r"rais(?:e[sd]?|ing)", r"increas(?:e[sd]?|ing)", r"upward"],
    "lowers": [
        r"lower(?:s|ed|ing)?", r"reduc(?:e[sd]?|ing)", r"decreas(?:e[sd]?|ing)", r"downward", r"cut",
    ],
    "narrows": [r"narrow(?:s|ed|ing)?", r"tighten(?:s|ed|ing)?"],
    "reaffirms": [
        r"reaffirm(?:s|ed|ing)?", r"reiterat(?:e[sd]?|ing)", r"confirm(?:s|ed|ing)?",
        r"maintain(?:s|ed|ing)?",
    ],
    "initiates": [
        r"initiat(?:e[sd]?|ing)", r"introduc(?:e[sd]?|ing)",
        r"provid(?:e[sd]?|ing)\s+(?:initial|new|first)",
    ],
    "withdraws": [
        r"withdraw(?:s|n|ing)?", r"suspend(?:s|ed|ing)?", r"eliminat(?:e[sd]?|ing)",
        r"discontinu(?:e[sd]?|ing)",
    ],
}
ACTION_DEFAULT = "issues"

# --- panel -----------------------------------------------------------------

PER_SHARE_METRICS = ["EPS", "FFO"]
PER_SHARE_LIMIT = 200.0
SAMPLE_ROWS = 500

# --- model-assisted extraction --------------------------------------------

MODEL_METRICS = {
    "EPS": "EPS",
    "Revenue": "Revenue",
    "NetIncome": "Net_Income",
    "EBITDA": "EBITDA",
    "EBIT": "EBITDA",
    "OperatingIncome": "Operating_Income",
    "GrossMargin": "Gross_Margin",
    "GrossProfit": "Gross_Margin",
    "FreeCashFlow": "Cash_Flow",
    "OperatingCashFlow": "Cash_Flow",
    "Capex": "Capex",
    "TaxRate": "Tax_Rate",
    "FFO": "FFO",
    "SubscriptionRevenue": "Revenue",
    "GrossBookings": "Revenue",
    "AdjustedEBITDA": "EBITDA",
    "Other": "Other",
}
HORIZONS = ["Q1", "Q2", "Q3", "Q4", "H1", "H2", "FY"]
ESTIMATE_TYPES = ["point", "range"]
UNITS = ["per_share", "dollars", "millions", "billions", "percent", "basis_points"]
DIRECTIONS = ["initiates", "raises", "lowers", "narrows", "reaffirms", "withdraws", "issues"]

PREFILTER_MAX_WORDS = 3000
PREFILTER_HEAD_WORDS = 1500
PREFILTER_STEMS = [
    "expect", "anticipat", "project", "forecast", "guidanc", "outlook", "target", "estimat",
    "see", "call for", "rais", "lower", "narrow", "reaffirm", "reiterat", "confirm", "maintain",
    "introduc", "initiat", "provid", "issu", "updat", "revis", "full-year", "full year",
    "fiscal year", "quarter",
]

# USD per million tokens: input, output. An unknown model is billed as the default.
MODEL_PRICES = {
    "gpt-4o-mini": (0.15, 0.60),
    "gpt-4o": (2.50, 10.00),
    "gpt-4.1-mini": (0.40, 1.60),
    "gpt-4.1": (2.00, 8.00),
    "gpt-4.1-nano": (0.10, 0.40),
}
DEFAULT_MODEL = "gpt-4o-mini"
EXHIBIT_BATCH_ROWS = 5000
MODEL_BATCH_ROWS = 1000
MODEL_CONCURRENCY = 10
MODEL_ATTEMPTS = 3
