"""The postings table ``(term, doc_id, tf[, positions])`` and what follows from it."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from termloom.functions.tokens import counted_terms
from termloom.operators.groups import range_count, top_per_group
from termloom.operators.tokens import tokenize_positions_in_pieces
from termloom.session import staged

# The caps of the pruned index.
MAX_TERM_LENGTH = 50
MAX_POSTINGS = 900

# Bytes of text in which a task finds terms at a time, one text at least.
PLACED_BYTES = 1 << 20


def _placed(doc_ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    """The distinct terms of each lower-cased text with their ascending positions."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data or b"", np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    # Letters are bytes of their own in UTF-8. Runs end with their text.
    letter = (data - np.uint8(ord("a"))) < 26
    before, after = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
    before[1:], after[:-1] = letter, letter
    before[bounds] = after[bounds] = False
    start, end = np.flatnonzero(letter & ~before[:-1]), np.flatnonzero(letter & ~after[1:]) + 1
    row = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(start, bounds)))
    # Code points are counted by the bytes that begin one.
    points = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    places = (points[start] - points[bounds[row]]).astype(np.int32)
    ends = np.append(0, np.cumsum(end - start))
    buffers = [None, pa.py_buffer(ends), pa.py_buffer(data[letter])]
    words = pa.Array.from_buffers(pa.large_string(), len(start), buffers).dictionary_encode()
    key = row * max(1, len(words.dictionary)) + words.indices.to_numpy()
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.append(True, np.diff(key[order]) != 0)[: len(key)])
    chosen = pa.array(order[first])
    lists = pa.array(np.append(first, len(key)).astype(np.int32))
    arrays = [
        doc_ids.take(pa.array(row[order[first]])),
        words.dictionary.take(words.indices.take(chosen)).cast(pa.string()),
        pa.ListArray.from_arrays(lists, pa.array(places[order])),
    ]
    return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "term", "positions"])


def _find_placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pc.fill_null(batch.column("text"), "")
        upto = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)
        at = 0
        while at < len(texts):
            stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PLACED_BYTES, "right")))
            yield _placed(batch.column("doc_id").slice(at, stop - at), texts.slice(at, stop - at))
            at = stop


def placed_terms(documents: DataFrame) -> DataFrame:
    """``(doc_id, term, positions)``, a row for each text and distinct term.

    Spark lower-cases the texts; terms are found and grouped in Arrow batches, by arrays.
    """
    schema = StructType([*documents.select("doc_id").schema, *StructType.fromDDL("term string, positions array<int>")])
    return documents.select("doc_id", F.lower("text").alias("text")).mapInArrow(_find_placed, schema)


def build_postings(
    documents: DataFrame, positions: bool = True, long_texts: bool = False
) -> DataFrame:
    """One row per (term, document) with its frequency and, if wanted, sorted positions.

    A document's terms are sorted and grouped inside its own row, so nothing is
    shuffled and no term, however frequent, gathers in one task. With positions, a task
    holds an Arrow batch of documents and what it finds in ``PLACED_BYTES`` or one text of
    them, at about a hundred bytes per character; ``long_texts`` sorts token rows by
    document instead, which can spill.
    """
    if not positions and not long_texts:
        counted = documents.select("doc_id", F.inline(counted_terms(F.col("text"))))
        return counted.select("term", "doc_id", "tf")
    if long_texts:
        placed = (
            tokenize_positions_in_pieces(documents)
            .groupBy("term", "doc_id")
            .agg(F.sort_array(F.collect_list("position")).alias("positions"))
        )
    else:
        placed = placed_terms(documents)
    return placed.select(
        "term",
        "doc_id",
        F.size("positions").cast("bigint").alias("tf"),
        *(["positions"] if positions else []),
    )


def scan_postings(documents: DataFrame, terms: Sequence[str] | None = None) -> DataFrame:
    """``(term, doc_id, tf)`` for searching documents that have no stored index.

    Terms are counted inside the document's row, and with ``terms`` only those, so that
    no more than the wanted counts is ever moved.
    """
    counted = documents.select("doc_id", F.inline(counted_terms(F.col("text"), terms)))
    return counted.select("term", "doc_id", "tf")


def term_stats(postings: DataFrame) -> DataFrame:
    """``(term, df, total_tf, max_tf)`` for every term."""
    return postings.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"),
        F.sum("tf").alias("total_tf"),
        F.max("tf").alias("max_tf"),
    )


def prune_postings(
    postings: DataFrame,
    max_term_length: int = MAX_TERM_LENGTH,
    max_postings: int = MAX_POSTINGS,
    splits: int = 32,
) -> DataFrame:
    """Drop over-long terms; keep each term's postings of highest frequency, then lowest id.

    How many postings a term has of each frequency tells the frequency at which its last
    place falls. Postings above it stay, those below go, and only those that have just it are
    ranked by id. Terms within the cap are not ranked at all. Postings are staged, so that
    they are computed once.
    """
    short = staged(postings.filter(F.length("term") <= max_term_length), "short-terms")
    by_tf = Window.partitionBy("term").orderBy(F.desc("tf"))  # a row for each frequency
    found = short.groupBy("term", "tf").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(by_tf.rowsBetween(Window.unboundedPreceding, 0))
    last = found.withColumn("_upto", upto).filter((F.col("_upto") > max_postings) & (F.col("_upto") - F.col("n") <= max_postings))
    last = last.select("term", F.col("tf").alias("_last"), (F.lit(max_postings) - F.col("_upto") + F.col("n")).alias("_places"))
    # Where the cap falls between two frequencies, the lower one has no place.
    last = last.groupBy("term").agg(F.max_by("_places", "_last").alias("_places"), F.max("_last").alias("_last"))
    # One row for each term beyond the cap: stored, so that its size is known and no posting is shuffled for it.
    last = staged(last, "last-places")
    marked = short.join(last, "term", "left")
    kept = marked.filter(F.col("_last").isNull() | (F.col("tf") > F.col("_last")))
    edge = marked.filter((F.col("tf") == F.col("_last")) & (F.col("_places") > 0))
    ranked = top_per_group(
        edge, ["term"], [F.asc("doc_id")], max_postings, rank="_rank", spread_on="doc_id", splits=splits
    ).filter(F.col("_rank") <= F.col("_places"))
    return kept.select(*short.columns).unionByName(ranked.select(*short.columns))


def sorted_by_term(postings: DataFrame, partitions: int | None = None) -> DataFrame:
    """Range-partitioned and sorted by (term, doc_id).

    The document id takes part in the ranges, so a hot term spreads over several
    partitions; written as Parquet, a filter on ``term`` skips row groups. ``partitions``
    is the least number of ranges; there are more where a range would be large, which is told
    from all rows: they should be stored.
    """
    return postings.repartitionByRange(*range_count(postings, partitions), "term", "doc_id").sortWithinPartitions("term", "doc_id")
