"""Ranking inside groups that may be very large, and ranges that stay small."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType

from termloom.session import staged


def top_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    rank: str,
    spread_on: str | None = None,
    splits: int = 32,
) -> DataFrame:
    """The first ``n`` rows of each group, with their 1-based rank.

    With ``spread_on``, each group is first cut into ``splits`` parts by a hash of
    that column and ranked there, so that no task sorts a whole hot group. Any row
    among the first ``n`` of its group is among the first ``n`` of its part, so the
    result is exact.
    """
    if spread_on is not None:
        part = F.pmod(F.xxhash64(spread_on), F.lit(splits)).alias("_part")
        inner = Window.partitionBy(*keys, "_part").orderBy(*order)
        df = (
            df.select("*", part)
            .withColumn(rank, F.row_number().over(inner))
            .filter(F.col(rank) <= n)
            .drop(rank, "_part")
        )
    whole = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(whole)).filter(F.col(rank) <= n)


#: Bytes of rows, as a task holds them for sorting, that make a range.
RANGE_BYTES = 128 << 20


def row_bytes(df: DataFrame) -> Column:
    """About what a row takes while it is sorted: its values, and 96 bytes beside them."""
    sizes = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (StringType, BinaryType)):
            sizes.append(F.coalesce(F.octet_length(value), F.lit(0)))
        elif isinstance(field.dataType, ArrayType):
            sizes.append(F.greatest(F.size(value), F.lit(0)) * 8)
        else:
            sizes.append(F.lit(16))
    return functools.reduce(operator.add, sizes, F.lit(96)).cast("bigint")


def range_count(df: DataFrame, partitions: int | None = None) -> list[int]:
    """How many ranges ``df`` is sorted in, as leading arguments of ``repartitionByRange``.

    At least ``partitions``, and so many that a range has about ``RANGE_BYTES``, whatever the
    size of the table. None given, and no more needed than Spark makes by itself: no argument.
    """
    total = df.agg(F.sum(row_bytes(df)).alias("n")).first()["n"] or 0
    needed = -(-total // RANGE_BYTES)
    if partitions is None and needed <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return []
    return [max(needed, partitions or 1)]


#: Bits of a number that tell the cells of one histogram apart.
CELL_BITS = 16


def rows_from_rank(df: DataFrame, order: Sequence[tuple[str, bool]], start: int) -> tuple[DataFrame, int]:
    """The rows from rank ``start`` (from 0) on, and how many rows before it are still among them.

    ``order`` names BIGINT columns, each with whether it falls. Nothing is sorted: rows are
    counted by the first bits of a column, the cell in which the rank lies is found from
    running sums over at most 2**16 cells, and only that cell is counted by the next bits.
    Rows that agree in all columns stay together. ``df`` is read once for each 16 bits.
    """
    beyond, inside = F.lit(False), F.lit(True)
    for name, falls in order:
        value = -F.col(name) if falls else F.col(name)
        for shift in range(64 - CELL_BITS, -1, -CELL_BITS):
            cell = F.shiftright(value, shift)
            counts = df.filter(inside).groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"))
            upto = F.sum("n").over(Window.orderBy("cell")).alias("upto")
            found = counts.select("cell", "n", upto).filter(F.col("upto") > start).orderBy("cell").first()
            if found is None:
                return df.limit(0), 0
            start -= found["upto"] - found["n"]
            beyond |= inside & (cell > found["cell"])
            inside &= cell == found["cell"]
    return df.filter(beyond | inside), start


def rows_from_ranks(
    df: DataFrame, keys: Sequence[str], order: Sequence[tuple[str, bool]], start: int, amount: int | None = None
) -> DataFrame:
    """Of each group the rows from rank ``start`` (from 0) on: ``amount`` at least, if it has them, or all.

    As :func:`rows_from_rank`, in all groups at once: the cells in which the ranks lie are a
    table of one row per group, staged for each 16 bits. Only bits in which values differ are
    counted, from the highest on, and after the first of them only the rows of the cells found.
    ``order`` tells all rows of a group apart. Groups of at most ``start`` rows, and rows with a
    null key, have none.
    """
    values = [-F.col(name) if falls else F.col(name) for name, falls in order]
    ends = [f(v).alias(f"_{f.__name__}{i}") for i, v in enumerate(values) for f in (F.min, F.max)]
    groups = staged(df.groupBy(*keys).agg(*ends), "rank-groups")
    seen = groups.agg(*[f(f"_{f.__name__}{i}") for i in range(len(values)) for f in (F.min, F.max)]).first()
    cells: list[Column] = []
    whole: list[int] = []
    for i, value in enumerate(values):
        low, high = (0 if x is None else x for x in seen[2 * i : 2 * i + 2])
        bits = (high - low).bit_length()
        if bits > 63:  # the difference is no BIGINT
            low, bits = 0, 64
        if not bits and (cells or i + 1 < len(values)):
            continue
        shifts = [*range(bits - CELL_BITS, 0, -CELL_BITS), 0]
        cells += [F.shiftright(value - F.lit(low).cast("bigint"), shift) for shift in shifts]
        whole.append(len(cells) - 1)
    names = [f"_cell{i}" for i in range(len(cells))]
    rest = df.select(*keys, *[c.alias(n) for c, n in zip(cells, names, strict=True)])
    edge = groups.select(*keys, F.lit(start).cast("bigint").alias("_left"))
    for i, name in enumerate(names):
        known = [*keys, *names[:i]]
        if i:
            rest = staged(rest.join(edge.select(*known), known), "rank-rows")
        counts = rest.join(edge, known).groupBy(*known, name).agg(F.count(F.lit(1)).alias("_n"), F.first("_left").alias("_left"))
        upto = F.sum("_n").over(Window.partitionBy(*keys).orderBy(name))
        ends = counts.withColumn("_upto", upto).filter((F.col("_upto") > F.col("_left")) & (F.col("_upto") - F.col("_n") <= F.col("_left")))
        left = F.col("_left") - F.col("_upto") + F.col("_n")
        edge = staged(ends.select(*known, name, left.alias("_left")), "rank-edge")
        if not i and amount is not None:
            enough = counts.withColumn("_upto", upto).filter(F.col("_upto") >= start + amount)
            last = staged(enough.groupBy(*keys).agg(F.min(name).alias("_last")), "rank-last")
    # The last bits of each column are in its finest cell, which is the value itself.
    at = edge.select(*keys, F.struct(*[F.col(names[i]).alias(f"c{i}") for i in whole]).alias("_edge"))
    place = F.struct(*[cells[i].alias(f"c{i}") for i in whole])
    found = df.join(at, list(keys)).filter(place >= F.col("_edge"))
    if amount is not None:
        found = found.join(last, list(keys), "left").filter(F.col("_last").isNull() | (cells[0] <= F.col("_last")))
    return found.select(*df.columns)
