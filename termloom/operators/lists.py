"""Posting lists as text lines, and back."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termloom.functions.codec import join_positions, position_deltas
from termloom.session import staged

ORDERS = ("id", "tf", "tf_id")

# Format of the lists, the same for every term and every size of data. A new line of a
# list begins at the first block of ids before which SEGMENT_ROWS postings stand.
SEGMENT_ROWS = 100_000
BLOCK_BITS = 16
# Bytes of text that a task decodes at a time.
DECODED_BYTES = 1 << 20


def _segments(rows: DataFrame, lead: list[str], segment_rows: int) -> DataFrame:
    """``rows`` with ``segment`` and ``df``: their line, and the postings of the term in all.

    Rows are sorted by ranges of the list order, a block in one range. Within a range, a row's
    place is its number there less that of the term's first; before that stand the term's
    counts in the ranges before, of which there is one row for each range and term. So no task
    sums along a term, and nothing is counted by block, whether ids are dense or hashed.
    """
    order = [*lead, "block"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = ordered.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.spark_partition_id())
    # Blocks are whole in their ranges: this needs no shuffle.
    blocks = numbered.withColumn("first", F.min("at").over(Window.partitionBy(*order)))
    placed = staged(blocks, "placed-rows")
    parts = placed.groupBy("term", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("begin"))
    term = Window.partitionBy("term")
    upto = F.sum("n").over(term.orderBy("part").rowsBetween(Window.unboundedPreceding, 0))
    parts = parts.select("term", "part", (upto - F.col("n") - F.col("begin")).alias("base"), F.sum("n").over(term).alias("df"))
    # One row for each long list and range: stored, so that its size is known.
    joined = placed.filter(F.col("block").isNotNull()).join(staged(parts, "term-parts"), ["term", "part"])
    segment = F.expr(f"(base + first) div {int(segment_rows)}")
    return joined.withColumn("segment", segment).drop("part", "at", "first", "base", "block")


def _lines(delta: str | None, positions: bool):
    """Lines of the postings of a partition, which is sorted by line and in list order within.

    Without a ``segment``, a term is one line, and its own count. Ids are written as differences along
    a line (``delta`` is ``"list"``), along its postings of equal frequency (``"run"``) or as they are.
    """

    def same_as_before(column: pa.Array) -> np.ndarray:
        """Of all rows but the first; nulls are equal."""
        codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy()
        return codes[1:] == codes[:-1]

    def begins(rows: pa.RecordBatch, names: list[str]) -> np.ndarray:
        same = [same_as_before(rows.column(c)) for c in names]
        return np.flatnonzero(np.append(True, ~np.logical_and.reduce(same)))

    def texts(rows: pa.RecordBatch, names: list[str]) -> pa.RecordBatch:
        starts = begins(rows, names)
        counts = np.diff(np.append(starts, rows.num_rows))
        ids, neg_tf = rows.column("doc_id"), rows.column("neg_tf")
        if delta is not None:
            related = np.ones(rows.num_rows, bool)
            related[starts] = False
            if delta == "run":
                related[1:] &= same_as_before(neg_tf) & neg_tf.is_valid().to_numpy(zero_copy_only=False)[1:]
            earlier = np.where(related, np.arange(rows.num_rows) - 1, 0)
            # What follows an unknown id has no difference.
            ids = pc.subtract(ids, pc.if_else(pa.array(related), ids.take(pa.array(earlier)), 0))
        fields = [ids.cast(pa.string()), pc.negate(neg_tf).cast(pa.string()), *([rows.column("coded")] if positions else [])]
        postings = pc.binary_join_element_wise(*fields, "-", null_handling="skip")
        ends = pa.array(np.append(starts, rows.num_rows).astype(np.int32))
        first = pa.array(starts)
        segment = rows.column("segment").take(first) if "segment" in names else pa.array(np.zeros(len(starts), np.int64))
        df = rows.column("df").take(first) if "segment" in names else pa.array(counts)
        body = pc.binary_join(pa.ListArray.from_arrays(ends, postings), ";")
        text = pc.binary_join_element_wise(df.cast(pa.string()), body, "", ";")
        arrays = [rows.column("term").take(first), segment, df, text]
        return pa.RecordBatch.from_arrays(arrays, names=["term", "segment", "df", "posting_list"])

    def joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        arrays = [pa.concat_arrays(columns) for columns in zip(*(part.columns for part in parts), strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=parts[0].schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The beginning of a line that may go on: a line has a bounded number of postings.
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            names = [c for c in ("term", "segment") if c in batch.schema.names]
            # Lines begin in the batch as they do after the last row before it.
            seen = joined([held[-1].slice(held[-1].num_rows - 1), batch]) if held else batch
            cut = int(begins(seen, names)[-1]) - (seen.num_rows - batch.num_rows)
            if cut < 0:  # all of it goes on with the line before
                held.append(batch)
                continue
            done = [*held, *([batch.slice(0, cut)] if cut else [])]
            if done:
                yield texts(joined(done), names)
            held = [batch.slice(cut)]
        if held:
            yield texts(joined(held), names)

    return run


def posting_lists(
    postings: DataFrame,
    order: str = "id",
    positions: bool = True,
    delta: bool = False,
    segment_rows: int = SEGMENT_ROWS,
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """``(term, segment, df, posting_list)``, text lines in list order.

    ``order`` is ``"id"`` (ascending id), ``"tf_id"`` (descending frequency, ascending
    id) or ``"tf"``, which leaves ties open and is answered in the same way. With
    ``delta``, ids and positions are written as differences. Ids can't be negative.

    A list is cut between blocks of ids into lines of at most ``segment_rows`` postings
    plus one block, numbered from 0; in each, differences start anew. ``df`` and the
    number in front of each line count the term's documents over all of its lines.

    Postings are staged, so that ``postings`` is computed once. A list of at most
    ``segment_rows`` is one line by this rule and is gathered by its term. Only the others,
    of which there is one for each ``segment_rows`` postings at most, are sorted by ranges.
    """
    if order not in ORDERS:
        raise ValueError(f"order must be one of {ORDERS}")
    by_tf = order != "id"
    if positions:
        coded = join_positions(position_deltas(F.col("positions")) if delta else F.col("positions"))
    else:
        coded = F.lit("")
    checked = F.when(
        F.col("doc_id") < 0, F.raise_error(F.lit("posting lists can't hold a negative doc_id")).cast("bigint")
    ).otherwise(F.col("doc_id"))
    rows = postings.select("term", checked.alias("doc_id"), (-F.col("tf")).alias("neg_tf"), coded.alias("coded"))
    # Texts are looked through once; the counts read two columns of this.
    rows = staged(rows, "list-rows")
    counts = rows.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    several = staged(counts.filter(F.col("df") > int(segment_rows)).select("term"), "long-lists")
    sort_key = ["neg_tf", "doc_id"] if by_tf else ["doc_id", "neg_tf"]
    scheme = None if not delta else ("run" if by_tf else "list")

    def lines(of: DataFrame) -> DataFrame:
        # Sorted rows, put together by batches: no array of a line's postings is shuffled or sorted.
        line = [c for c in ("term", "segment") if c in of.columns]
        placed = of.repartition(*line).sortWithinPartitions(*line, *sort_key, "coded")
        return placed.mapInArrow(_lines(scheme, positions), "term string, segment bigint, df bigint, posting_list string")

    if several.isEmpty():
        return lines(rows)
    lead = ["term", "neg_tf"] if by_tf else ["term"]
    long = rows.join(several, "term", "left_semi").withColumn("block", F.shiftright("doc_id", block_bits))
    placed = _segments(long, lead, segment_rows)
    return lines(rows.join(several, "term", "left_anti")).unionByName(lines(placed))


def encode_lists(postings: DataFrame, order: str = "id", **options) -> DataFrame:
    """Posting lists with ids and positions written as differences."""
    return posting_lists(postings, order, positions=True, delta=True, **options)


def _cuts(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Stretches of about ``DECODED_BYTES``, of one text at least."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(ends):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + DECODED_BYTES, "right")))
        yield at, stop
        at = stop


def _decode(with_sums_by_tf: bool, positions: bool, ids: tuple[int, int] | None):
    """Lines of Arrow batches to postings, column by column, some bytes of lines or a part of a long one at a time."""

    def sums(steps: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Running sums that start anew at ``starts``."""
        upto = np.cumsum(steps)
        before = (upto - steps)[starts]
        return upto - np.repeat(before, np.diff(np.append(starts, len(steps))))

    def postings_of(terms: pa.Array, line: np.ndarray, items: pa.Array, last: tuple[int, int, int] | None):
        """The postings of some items, and the last one's line, id and frequency, with which the next go on."""
        fields = pc.split_pattern(items, "-", max_splits=2)
        steps, tfs = (pc.list_element(fields, i).cast(pa.int64()).to_numpy() for i in (0, 1))
        begins = np.append(True, np.diff(line) != 0)
        if with_sums_by_tf:  # sums start anew with each frequency
            begins[1:] |= np.diff(tfs) != 0
        if last is not None and last[0] == line[0] and not (with_sums_by_tf and last[2] != tfs[0]):
            steps = np.append(steps[0] + last[1], steps[1:])
        doc_ids = sums(steps, np.flatnonzero(begins))
        last = int(line[-1]), int(doc_ids[-1]), int(tfs[-1])
        if ids is not None:
            inside = (doc_ids >= ids[0]) & (doc_ids <= ids[1])
            line, doc_ids, tfs = line[inside], doc_ids[inside], tfs[inside]
            fields = fields.filter(pa.array(inside))
        columns = [terms.take(pa.array(line)), pa.array(doc_ids), pa.array(tfs)]
        if positions:
            places = pc.split_pattern(pc.list_element(fields, 2), ",") if len(line) else pa.array([], pa.list_(pa.string()))
            counts = pc.list_value_length(places).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = pc.list_flatten(places).cast(pa.int64()).to_numpy()
            flat = sums(flat, np.cumsum(counts) - counts) if len(flat) else flat
            offsets = np.append(0, np.cumsum(counts))
            columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32())))
        return pa.RecordBatch.from_arrays(columns, names=["term", "doc_id", "tf", "positions"][: len(columns)]), last

    def some_lines(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lines = pc.utf8_rtrim(batch.column("posting_list").fill_null(""), ";")
        items = pc.split_pattern(lines, ";")
        # The first item of a line is its count.
        sizes = np.maximum(pc.list_value_length(items).to_numpy(zero_copy_only=False) - 1, 0)
        items = pc.list_flatten(pc.list_slice(items, 1))
        line, last = np.repeat(np.arange(len(sizes)), sizes), None
        for at, stop in _cuts(items):
            found, last = postings_of(batch.column("term"), line[at:stop], items.slice(at, stop - at), last)
            yield found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, stop in _cuts(batch.column("posting_list")):
                yield from some_lines(batch.slice(at, stop - at))

    return run


def decode_lists(
    lists: DataFrame, order: str = "id", positions: bool = True, ids: tuple[int, int] | None = None
) -> DataFrame:
    """Postings from lines written by :func:`encode_lists`: ``(term, doc_id, tf[, positions])``.

    Every line is decoded by itself: nothing is shuffled, and no row is made for a position.
    Beside its lines, a task holds what it makes of ``DECODED_BYTES`` of them; a longer line goes on
    from the last posting of the part before.
    With ``ids``, only postings from the first to the last of both; of the others no positions
    are read.
    """
    if order not in ORDERS:
        raise ValueError(f"order must be one of {ORDERS}")
    schema = "term string, doc_id bigint, tf bigint" + (", positions array<int>" if positions else "")
    return lists.select("term", "posting_list").mapInArrow(_decode(order != "id", positions, ids), schema)
