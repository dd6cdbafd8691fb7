"""Running sums along an array, as column expressions, in time that follows its length.

An array that grows by one at each step of an ``aggregate`` is copied each time. Here that
happens inside blocks of 64 and between the blocks' totals only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from augury.functions.text import let

BLOCK = 64


def _sums(values: Column, floor: bool) -> Column:
    """Sums up to each element, behind a leading 0; with ``floor`` none falls below 0."""

    def add(done: Column, value: Column) -> Column:
        total = F.element_at(done, -1) + value
        return F.array_append(done, F.greatest(total, F.lit(0).cast("long")) if floor else total)

    return F.aggregate(values, F.array(F.lit(0).cast("long")), add)


def _inner(sums: Column) -> Column:
    return F.slice(sums, 2, F.size(sums))


def running_sums(values: Column, floor: bool = False) -> Column:
    """For each element of an array of longs the sum up to and with it.

    With ``floor`` a sum that would fall below 0 is 0, and the next goes on from there. Null
    arrays stay null; elements are not null.
    """

    def entries(parts: Column) -> Column:
        """The sum in front of each block."""

        def add(done: Column, part: Column) -> Column:
            total = F.element_at(done, -1) + F.element_at(part["plain"], -1)
            if floor:
                total = F.greatest(total, F.element_at(part["floored"], -1))
            return F.array_append(done, total)

        return F.aggregate(parts, F.array(F.lit(0).cast("long")), add)

    def joined(parts: Column) -> Column:
        def build(before: Column) -> Column:
            def shifted(part: Column, b: Column) -> Column:
                start = F.get(before, b)
                if not floor:
                    return F.transform(_inner(part["plain"]), lambda x: x + start)
                return F.zip_with(_inner(part["plain"]), _inner(part["floored"]), lambda x, y: F.greatest(x + start, y))

            return F.flatten(F.transform(parts, shifted))

        return let(entries(parts), build)

    def of(v: Column) -> Column:
        blocks = F.when(
            F.size(v) > 0,
            F.transform(
                F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int")),
                lambda b: let(
                    F.slice(v, b * BLOCK + 1, F.lit(BLOCK)),
                    lambda part: F.struct(
                        _sums(part, False).alias("plain"),
                        (_sums(part, True) if floor else F.lit(None).cast("array<bigint>")).alias("floored"),
                    ),
                ),
            ),
        ).otherwise(F.array().cast("array<struct<plain:array<bigint>,floored:array<bigint>>>"))
        return F.when(v.isNotNull(), let(blocks, joined))

    return let(values, of)
