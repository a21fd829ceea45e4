"""Places of pattern matches in a text, as column expressions.

``regexp_extract_all`` gives the matched strings and ``split`` by the same
pattern gives the gaps between them, so running sums of their lengths are the
places. Nothing leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Sums run over blocks of this many numbers, then over the blocks' totals.
BLOCK = 128


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), body)[0]


def total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def sums_before(numbers: Column) -> Column:
    """For each place of an int array the sum of all numbers before it."""

    def scan(part: Column, start: Column) -> Column:
        return F.aggregate(
            part,
            F.array(start),
            lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)),
            lambda a: F.slice(a, 1, F.size(a) - 1),
        )

    def in_blocks(blocks: Column) -> Column:
        starts = scan(F.transform(blocks, total), F.lit(0))
        return let(starts, lambda s: F.flatten(F.transform(blocks, lambda b, k: scan(b, s[k]))))

    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / BLOCK).cast("int")),
        lambda k: F.slice(numbers, k * BLOCK + 1, BLOCK),
    )
    return F.when(F.size(numbers) <= BLOCK, scan(numbers, F.lit(0))).otherwise(let(blocks, in_blocks))


def places(text: Column, pattern: Column, measure: Callable[[Column], Column] = F.length) -> Column:
    """Array of (start, end, found) of the leftmost non-overlapping matches of ``pattern``.

    ``measure`` turns a stretch of text into its length: code points by
    default. Empty where nothing matches.
    """
    nothing = F.array().cast("array<struct<start:int,end:int,found:string>>")

    def located(found: Column) -> Column:
        def joined(gaps: Column) -> Column:
            steps = F.transform(found, lambda m, k: measure(gaps[k]) + measure(m))
            return let(
                sums_before(steps),
                lambda before: F.transform(
                    found,
                    lambda m, k: F.struct(
                        (before[k] + measure(gaps[k])).alias("start"),
                        (before[k] + measure(gaps[k]) + measure(m)).alias("end"),
                        m.alias("found"),
                    ),
                ),
            )

        return F.when(F.size(found) == 0, nothing).otherwise(let(F.split(text, pattern, -1), joined))

    return let(F.regexp_extract_all(text, pattern, F.lit(0)), located)
