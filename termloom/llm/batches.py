"""Python work over a table, one bounded slice of rows at a time.

Spark hands a task its rows in Arrow batches that are bounded by rows, not by bytes.
The helpers here cut them again by the bytes of one column, so that what numpy holds
beside a batch is bounded by ``SLICE_BYTES`` or by one text, whichever is larger.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

SLICE_BYTES = 1 << 20


def filled(column: pa.Array) -> pa.Array:
    """The column with empty values in place of nulls."""
    empty = b"" if pa.types.is_binary(column.type) else ""
    return pc.fill_null(column, empty) if column.null_count else column


def byte_slices(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``max_bytes`` of the column, at least a row each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start, rows = 0, batch.num_rows
    while start < rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + max_bytes, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def add_columns(
    df: DataFrame,
    make: Callable[[pa.RecordBatch], dict[str, pa.Array]],
    ddl: str,
    column: str = "text",
    keep: list[str] | None = None,
    reads: tuple[str, ...] = (),
) -> DataFrame:
    """The rows of ``df`` with the columns that ``make`` derives from each slice of them.

    ``keep`` names the columns that stay (default: all). Where a kept column has the name
    of a new one, in any case, the new one takes its place. ``reads`` names further
    columns that ``make`` needs.
    """
    new = StructType.fromDDL(ddl)
    names = {name.lower() for name in new.names}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in names]
    schema = StructType([df.schema[c] for c in kept] + new.fields)
    read = list(dict.fromkeys([*kept, column, *reads]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, column):
                made = make(part)
                arrays = [part.column(c) for c in kept] + [made[name] for name in new.names]
                yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *new.names])

    return df.select(*[f"`{c}`" for c in read]).mapInArrow(run, schema)
