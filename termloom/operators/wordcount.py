"""Counts of whitespace-separated words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from termloom.functions.tokens import clean_line, whitespace_words


Patterns = Sequence[str] | DataFrame


def pattern_array(patterns: Patterns) -> Column | None:
    """The distinct patterns in their order, as one array. None without any.

    Patterns of a table ``(pattern)`` stay in the cluster: they are a subquery of one row, and
    the plan has the same size for any number of them.
    """
    if isinstance(patterns, DataFrame):
        listed = F.array_sort(F.collect_set(F.col("pattern").cast("string")))
        return patterns.agg(listed.alias("patterns")).scalar()
    return F.array(*[F.lit(p) for p in sorted(set(patterns))]) if patterns else None


def words(
    lines: DataFrame,
    case_sensitive: bool = True,
    skip_patterns: Patterns = (),
    column: str = "value",
) -> DataFrame:
    """One row per word."""
    patterns = pattern_array(skip_patterns)
    if patterns is not None:  # a subquery can't stand within a fold
        lines = lines.select(F.col(column).alias(column), patterns.alias("__patterns"))
        patterns = F.col("__patterns")
    cleaned = clean_line(F.col(column), case_sensitive, patterns)
    return lines.select(F.explode(whitespace_words(cleaned)).alias("word"))


def word_count(
    lines: DataFrame,
    case_sensitive: bool = True,
    skip_patterns: Patterns = (),
    column: str = "value",
    counter: Observation | None = None,
) -> DataFrame:
    """``(word, n)``. ``counter`` receives ``input_words`` when the result is computed."""
    found = words(lines, case_sensitive, skip_patterns, column)
    if counter is not None:
        found = found.observe(counter, F.count(F.lit(1)).alias("input_words"))
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
