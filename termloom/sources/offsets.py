"""Byte offsets of records in split text files, without leaving DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def source_columns() -> list[Column]:
    """Where a record of a file scan came from, and its order inside its input split.

    The scan reads each split in file order, so the ids grow with the offset.
    """
    return [
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("record"),
    ]


def with_byte_offsets(records: DataFrame) -> DataFrame:
    """Add ``byte_offset``: where each record starts in its file, decompressed.

    Needs ``file_path, block_start, record, n_bytes`` and every record of the file;
    select what else is needed as narrowly as possible first. Bytes are summed along
    each input split, and the totals of the splits along each file, so no task
    handles more than one split. The rows are read twice; after a costly scan, store
    them first (:func:`termloom.session.staged`).
    """
    inside = (
        Window.partitionBy("file_path", "block_start")
        .orderBy("record")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    earlier = (
        Window.partitionBy("file_path")
        .orderBy("block_start")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        records.groupBy("file_path", "block_start")
        .agg(F.sum("n_bytes").alias("_total"))
        .select(
            "file_path",
            "block_start",
            F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_split_offset"),
        )
    )
    local = records.withColumn("_inside", F.coalesce(F.sum("n_bytes").over(inside), F.lit(0)))
    joined = local.join(starts, ["file_path", "block_start"])
    return joined.withColumn("byte_offset", F.col("_split_offset") + F.col("_inside")).drop(
        "_split_offset", "_inside"
    )
