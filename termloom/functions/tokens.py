"""Column expressions that break text into terms and words."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a term is, and what separates whitespace words.
TERM_PATTERN = "[a-z]+"
WORD_SEPARATORS = r"[ \t\n\r\f]+"

# Characters looked at together when positions are found.
PIECE_LENGTH = 4096


def letter_runs(text: Column) -> Column:
    """All maximal runs of letters in the lower-cased text, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(TERM_PATTERN), F.lit(0))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed a single time per row, however often it is read."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def whole_term_pieces(text: Column) -> Column:
    """The lower-cased text in pieces of about ``PIECE_LENGTH`` characters that divide no letter run."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"(?s).{{1,{PIECE_LENGTH}}}[a-z]*"), F.lit(0))


def cutter(text: Column, use: Callable[[Callable[[Column, int], Column]], Column]) -> Column:
    """``use(cut)``, where ``cut(position, width)`` takes characters from a position on.

    The text is divided into pieces once; a cut looks at its piece and the next only.
    """
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE_LENGTH}}}"), F.lit(0))

    def with_pieces(parts: Column) -> Column:
        def cut(position: Column, width: int) -> Column:
            number = F.floor(position / PIECE_LENGTH).cast("int")
            around = F.array_join(F.slice(parts, number + 1, F.lit(width // PIECE_LENGTH + 2)), "")
            return F.substring(around, position % PIECE_LENGTH + 1, F.lit(width))

        return use(cut)

    return once(pieces, with_pieces)


def _indexes(items: Column) -> Column:
    return F.when(F.size(items) > 0, F.sequence(F.lit(0), F.size(items) - 1)).otherwise(
        F.array().cast("array<int>")
    )


def term_starts(text: Column) -> Column:
    """0-based code-point index of the first letter of each letter run.

    The first letter of each run becomes a capital, which no other character of a
    lower-cased text is; the marks' places among the characters are the answer. The
    text is looked through in pieces of one length, so that only the characters of
    a piece are held apart.
    """
    marked = F.regexp_replace(F.lower(text), "[a-z]([a-z]*)", "S$1")
    pieces = F.regexp_extract_all(marked, F.lit(f"(?s).{{1,{PIECE_LENGTH}}}"), F.lit(0))

    def places(piece: Column, n: Column) -> Column:
        chars = F.split(piece, "")
        return F.array_compact(
            F.transform(chars, lambda char, i: F.when(char == "S", n * PIECE_LENGTH + i))
        )

    return F.flatten(F.transform(pieces, places))


def term_positions(text: Column) -> Column:
    """Array of ``struct(term, position)`` in text order."""
    return F.arrays_zip(letter_runs(text).alias("term"), term_starts(text).alias("position"))


def per_run(terms: Column, build: Callable[[Column, Column], Column]) -> Column:
    """``build(first, length)`` for each stretch of equal values in a sorted array."""
    firsts = F.filter(
        _indexes(terms), lambda i: (i == 0) | (F.get(terms, i) != F.get(terms, i - 1))
    )

    def runs(starts: Column) -> Column:
        return F.transform(
            starts,
            lambda first, n: build(first, F.coalesce(F.get(starts, n + 1), F.size(terms)) - first),
        )

    return once(firsts, runs)


def counted_terms(text: Column, wanted: Iterable[str] | None = None) -> Column:
    """Array of ``struct(term, tf)``, one for each distinct term of the text, or each wanted one."""
    found = letter_runs(text)
    if wanted is not None:
        listed = sorted(set(wanted))
        found = F.filter(found, lambda term: term.isin(listed) if listed else F.lit(False))

    def counts(words: Column) -> Column:
        return per_run(
            words,
            lambda first, length: F.struct(
                F.get(words, first).alias("term"), length.cast("bigint").alias("tf")
            ),
        )

    return once(F.sort_array(found), counts)


def distinct_terms(query: Column) -> Column:
    """The set of terms of a query string."""
    return F.array_distinct(letter_runs(query))


def clean_line(line: Column, case_sensitive: bool = True, skip_patterns: Column | None = None) -> Column:
    """Optional lower-casing, then deletion of every match of each pattern of an array, in its order."""
    cleaned = line if case_sensitive else F.lower(line)
    if skip_patterns is None:
        return cleaned
    return F.aggregate(skip_patterns, cleaned, lambda text, pattern: F.regexp_replace(text, pattern, F.lit("")))


def whitespace_words(line: Column) -> Column:
    """Words between blanks, tabs, line feeds, returns and form feeds."""
    return F.filter(F.split(line, WORD_SEPARATORS), lambda word: word != "")
