"""Column expressions for the text form of posting lists.

A list is ``df;posting;posting;...;``, with the term's document count, and a posting is ``id-tf-p1,p2,...`` (or
``id-tf`` without positions). Positions are written as they are or as differences
to the one before.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from termloom.functions.tokens import once

# Running sums go over blocks of this many numbers, then over the sums of blocks.
SUM_BLOCK = 64


def position_deltas(positions: Column) -> Column:
    """First position, then the step from each position to the next."""
    return F.transform(
        positions,
        lambda p, i: p - F.when(i == 0, F.lit(0)).otherwise(F.get(positions, i - 1)),
    )


def join_positions(positions: Column) -> Column:
    return F.array_join(positions.cast("array<string>"), ",")


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("bigint"), lambda a, x: a + x)


def running_sums(numbers: Column) -> Column:
    """Sums of a not empty BIGINT array up to each of its elements."""
    last = F.floor((F.size(numbers) - 1) / SUM_BLOCK).cast("int")
    blocks = F.transform(
        F.sequence(F.lit(0), last), lambda b: F.slice(numbers, b * SUM_BLOCK + 1, F.lit(SUM_BLOCK))
    )

    def with_blocks(cut: Column) -> Column:
        def with_sums(sums: Column) -> Column:
            def along(block: Column, b: Column) -> Column:
                return once(
                    _total(F.slice(sums, F.lit(1), b)),
                    lambda base: F.transform(block, lambda _, i: base + _total(F.slice(block, F.lit(1), i + 1))),
                )

            return F.flatten(F.transform(cut, along))

        return once(F.transform(cut, _total), with_sums)

    return once(blocks, with_blocks)
