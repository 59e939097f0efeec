"""Extension: postings without very common terms."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.functions.tokens import letter_runs
from termloom.operators.search import corpus_size
from termloom.session import staged


def drop_listed_terms(postings: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Postings whose term is not in the list."""
    listed = sorted({t.lower() for t in terms})
    return postings.filter(~F.col("term").isin(listed)) if listed else postings


#: Documents that a task looks through at a time.
SUMMED_DOCUMENTS = 4096


def _often_in_a_part(max_ratio: float):
    """The terms in more than ``max_ratio`` of a part's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SUMMED_DOCUMENTS):
                part = batch.column("terms").slice(at, SUMMED_DOCUMENTS)
                counts = pc.value_counts(pc.list_flatten(part))
                often = pc.greater(counts.field("counts"), max_ratio * len(part))
                yield pa.RecordBatch.from_arrays([counts.field("values").filter(often)], names=["term"])

    return run


def common_terms(documents: DataFrame, max_ratio: float) -> DataFrame:
    """``(term, df)`` of terms in more than ``max_ratio`` of all documents.

    A term that is so frequent in all is so in one part of the documents at least. Each part
    names its own, and no more than (terms per document) / ``max_ratio`` of them; only these
    are counted, so that there is never a count of every term.
    """
    terms = documents.select(F.array_distinct(letter_runs(F.col("text"))).alias("terms"))
    # Stored, so that its size is known, and no term of a text is shuffled to meet it.
    named = staged(terms.mapInArrow(_often_in_a_part(max_ratio), "term string").distinct(), "named-terms")
    found = terms.select(F.explode("terms").alias("term")).join(named, "term", "left_semi")
    counts = found.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    total = corpus_size(documents).scalar()
    return counts.filter(F.col("df") > total * F.lit(max_ratio))


def drop_common_terms(postings: DataFrame, documents: DataFrame, max_ratio: float) -> DataFrame:
    """Postings whose term is in at most ``max_ratio`` of all documents."""
    # No more of them than (terms per document) / max_ratio: stored, so that no posting is shuffled.
    common = staged(common_terms(documents, max_ratio).select("term"), "common-terms")
    return postings.join(common, "term", "left_anti")
