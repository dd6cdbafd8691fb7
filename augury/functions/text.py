"""Text helpers as column expressions: white space, patterns, offsets."""

from __future__ import annotations

import operator
import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as Unicode has it; Java's own \s knows ASCII only.
WHITE = (
    r"[\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)


def pattern(text: str) -> str:
    """A fixed pattern made ready for Spark: white space of every kind."""
    return text.replace(r"\s", WHITE)


def folded_pattern(text: str) -> str:
    """The same for text that went through :func:`fold`."""
    return pattern(text.lower())


WORD_BREAK = pattern(r"\s+")
WHITE_CHARACTERS = "".join(
    chr(c) for c in (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                     0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times, also inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def elements(values: Column) -> Column:
    """The same array, for a generator over a column that is costly to make.

    From a plain column Spark infers "not empty" filters, pushes them below the column's making
    and makes it again for each of them.
    """
    return F.flatten(F.array(values))


def strip(text: Column) -> Column:
    """Remove white space at both ends, of every kind."""
    return F.btrim(text, F.lit(WHITE_CHARACTERS))


def any_of(alternatives: list[str], whole_words: bool = False) -> str:
    """Alternatives behind a look at their first letters.

    Most positions fail the look, which is several times cheaper than trying every
    alternative there. All alternatives begin with two literal letters at least.
    """
    starts = [re.match(r"\w*", a.lower()).group() for a in alternatives]
    letters = min(3, min(len(start) for start in starts))
    look = "".join("[" + "".join(sorted({s[i] for s in starts})) + "]" for i in range(letters))
    group = f"(?:{'|'.join(alternatives)})"
    return rf"(?={look})\b{group}\b" if whole_words else f"(?={look}){group}"


def openings(alternatives: list[str]) -> list[str]:
    """The letters that the alternatives begin with, in lower case, each match at one of them."""
    found = {re.match(r"(?:\w(?![?*]))+", a.lower()).group() for a in alternatives}
    return sorted(o for o in found if not any(x != o and o.startswith(x) for x in found))


def may_match(folded: Column, alternatives: list[str]) -> Column:
    """False only where no alternative can match: none of their opening letters is there.

    A search for a few letters costs a small part of what a pattern does.
    """
    return reduce(operator.or_, [F.contains(folded, F.lit(o)) for o in openings(alternatives)])


# Letters that equal an ASCII letter when case is ignored, and how to spell them.
ODD_LETTERS = ("\u0130\u0131\u017f\u212a", "iisk")
_ASTRAL = r"[\x{10000}-\x{10FFFF}]"
_ODD = rf"[\x{{130}}\x{{131}}\x{{17F}}\x{{212A}}\x{{10000}}-\x{{10FFFF}}]"


def fold(text: Column) -> Column:
    """Lower case for matching, code point by code point.

    Plain patterns on folded text run several times faster than case-blind ones.
    Characters beyond the basic plane become one unit, so that ``regexp_instr``, which
    counts UTF-16 units, counts code points here.
    """
    ascii_only = F.octet_length(text) == F.length(text)
    odd = F.translate(F.regexp_replace(text, _ASTRAL, "\ufffd"), *ODD_LETTERS)
    return F.lower(F.when(ascii_only | ~text.rlike(_ODD), text).otherwise(odd))


def match_offset(folded: Column, regex: str) -> Column:
    """Code points before the first match in folded text; -1 without one."""
    return F.regexp_instr(folded, F.lit(regex)) - 1


def slice_text(text: Column, start: Column, end: Column) -> Column:
    """``text[start:end]`` in code points, ``start`` not negative."""
    return F.substring(text, start + 1, end - start)


def truncate_sentence(sentence: Column, chars: int) -> Column:
    return F.substring(strip(sentence), 1, chars)
