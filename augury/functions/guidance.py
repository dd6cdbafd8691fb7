"""Guidance wording as column expressions: verbs, metrics, amounts, period, action."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from augury.functions import fixed_values as fixed
from augury.functions.text import (
    any_of, fold, folded_pattern, let, match_offset, may_match, pattern, slice_text,
)

# All but the last two are for folded text.
VERB = folded_pattern(any_of(fixed.GUIDANCE_VERBS) + r"\s")
METRICS = {name: folded_pattern(any_of(forms)) for name, forms in fixed.METRICS.items()}
PERIODS = {name: folded_pattern(any_of(forms)) for name, forms in fixed.PERIODS.items()}
ACTIONS = {
    name: folded_pattern(any_of(forms, whole_words=True)) for name, forms in fixed.ACTIONS.items()
}
AMOUNT = folded_pattern(fixed.AMOUNT_PATTERN)
RANGE = folded_pattern(fixed.AMOUNT_PATTERN + fixed.RANGE_LINK_PATTERN + fixed.AMOUNT_PATTERN)
ANY_AMOUNT = pattern(r"\$\s*[0-9]")
FISCAL_YEAR = pattern(fixed.FISCAL_YEAR_PATTERN)


def has_guidance_verb(sentence: Column) -> Column:
    return fold(sentence).rlike(VERB)


def has_amount(text: Column) -> Column:
    """True exactly when :func:`read_amounts` finds a value."""
    return text.rlike(ANY_AMOUNT)


def _mentions(folded: Column) -> Column:
    looked_for = [
        F.struct(
            F.lit(i).alias("metric_ord"),
            F.lit(name).alias("metric"),
            F.when(may_match(folded, fixed.METRICS[name]), match_offset(folded, regex))
            .otherwise(-1).alias("metric_offset"),
        )
        for i, (name, regex) in enumerate(METRICS.items())
    ]
    return F.filter(F.array(*looked_for), lambda m: m["metric_offset"] >= 0)


def metric_mentions(sentence: Column) -> Column:
    """Array of (metric_ord, metric, metric_offset): first mention of each metric found."""
    return let(fold(sentence), _mentions)


def scale_amount(number: Column, word: Column) -> Column:
    """``1,234.5`` and a lower-case scale word to a full amount."""
    value = F.replace(number, F.lit(","), F.lit("")).try_cast("double")
    factor = F.lit(1.0)
    for size in sorted(set(fixed.SCALE_FACTORS.values())):
        words = [w for w, f in fixed.SCALE_FACTORS.items() if f == size]
        factor = F.when(word.isin(words), F.lit(size)).otherwise(factor)
    return value * factor


def _amount_struct(low: Column, high: Column, is_range: bool) -> Column:
    return F.struct(
        low.alias("val1"), high.alias("val2"), F.lit(is_range).alias("is_range")
    )


def _range_amounts(found: Column) -> Column:
    # Rewritten to "number|scale|number|scale"; a missing scale comes from the other side.
    parts = F.split(F.regexp_replace(found, RANGE, r"$1|$2|$3|$4"), r"\|", -1)

    def build(p: Column) -> Column:
        left = scale_amount(p[0], F.coalesce(F.nullif(p[1], F.lit("")), p[3]))
        right = scale_amount(p[2], F.coalesce(F.nullif(p[3], F.lit("")), p[1]))
        return _amount_struct(F.least(left, right), F.greatest(left, right), True)

    return let(parts, build)


def _single_amount(snippet: Column) -> Column:
    parts = F.split(
        F.regexp_replace(F.regexp_extract(snippet, AMOUNT, 0), AMOUNT, r"$1|$2"), r"\|", -1
    )

    def build(p: Column) -> Column:
        value = scale_amount(F.get(p, F.lit(0)), F.get(p, F.lit(1)))
        return _amount_struct(value, value, False)

    return let(parts, build)


def _amounts(folded: Column) -> Column:
    return let(
        F.regexp_extract(folded, RANGE, 0),
        lambda found: F.when(found != "", _range_amounts(found)).otherwise(
            F.when(has_amount(folded), _single_amount(folded))
        ),
    )


def read_amounts(snippet: Column) -> Column:
    """Struct (val1, val2, is_range): the first range, else the first single amount."""
    return let(fold(snippet), _amounts)


def _first_label(
    folded: Column, patterns: dict[str, str], words: dict[str, list[str]], default: str
) -> Column:
    label = F.lit(default)
    for name, regex in reversed(patterns.items()):
        found = may_match(folded, words[name]) & folded.rlike(regex)
        label = F.when(found, F.lit(name)).otherwise(label)
    return label


def folded_period(folded: Column) -> Column:
    return _first_label(folded, PERIODS, fixed.PERIODS, fixed.PERIOD_DEFAULT)


def detect_period(around: Column) -> Column:
    return let(fold(around), folded_period)


def detect_fiscal_year(around: Column) -> Column:
    return F.nullif(F.regexp_extract(around, FISCAL_YEAR, 0), F.lit("")).cast("int")


def folded_action(folded: Column) -> Column:
    return _first_label(folded, ACTIONS, fixed.ACTIONS, fixed.ACTION_DEFAULT)


def detect_action(around: Column) -> Column:
    return let(fold(around), folded_action)


# --- windows ----------------------------------------------------------------
# Every later window lies inside one bounded context per sentence, so the whole
# text never travels with its sentences.


def _window(context: Column, context_start: Column, at: Column, size: tuple[int, int]) -> Column:
    first = F.greatest(at - size[0], F.lit(0)) - context_start
    return slice_text(context, first, at + size[1] - context_start)


def value_window(context: Column, context_start: Column, at: Column) -> Column:
    return _window(context, context_start, at, fixed.VALUE_WINDOW)


def period_window(context: Column, context_start: Column, at: Column) -> Column:
    return _window(context, context_start, at, fixed.PERIOD_WINDOW)


def action_window(context: Column, context_start: Column, at: Column) -> Column:
    return _window(context, context_start, at, fixed.ACTION_WINDOW)
