"""Documents to token rows. Nothing here is shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.functions.codec import running_sums
from termloom.functions.tokens import letter_runs, once, term_positions, whole_term_pieces


def tokenize(documents: DataFrame) -> DataFrame:
    """``(doc_id, term)``, one row per letter run."""
    return documents.select("doc_id", F.explode(letter_runs(F.col("text"))).alias("term"))


def tokenize_positions(documents: DataFrame) -> DataFrame:
    """``(doc_id, term, position)`` with 0-based code-point positions."""
    return documents.select("doc_id", F.inline(term_positions(F.col("text"))))


def tokenize_positions_in_pieces(documents: DataFrame) -> DataFrame:
    """The same rows for very long texts: each piece of a text becomes a row with its own start.

    Pieces divide no term, and what a task holds besides the text is bounded by a piece.
    """

    def with_starts(pieces):
        lengths = F.transform(pieces, lambda piece: F.length(piece).cast("bigint"))
        ends = F.when(F.size(pieces) > 0, running_sums(lengths))
        return F.arrays_zip(ends.alias("end"), pieces.alias("piece"))

    rows = documents.select("doc_id", F.inline(once(whole_term_pieces(F.col("text")), with_starts)))
    rows = rows.select("doc_id", (F.col("end") - F.length("piece")).alias("start"), "piece")
    found = rows.select("doc_id", "start", F.inline(term_positions(F.col("piece"))))
    return found.select("doc_id", "term", (F.col("start") + F.col("position")).cast("int").alias("position"))
