"""Pages of an XML dump as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.sources.offsets import source_columns, with_byte_offsets

# The element that makes one record.
START_TAG = "<page>"
END_TAG = "</page>"


def read_chunks(
    spark: SparkSession, path: str, start_tag: str = START_TAG, end_tag: str = END_TAG
) -> DataFrame:
    """Every stretch of the files up to an end tag, with its size and source.

    ``page`` starts at the first start tag and ends with the end tag, ``prefix`` is
    what comes before it; chunks without a start tag have a null ``page``. The text
    reader splits large files and keeps a record in the split where it starts.
    """
    raw = spark.read.option("lineSep", end_tag).text(path)
    opened = F.locate(start_tag, F.col("value"))
    chunks = raw.select(*source_columns(), "value", opened.alias("opened"))
    has_page = F.col("opened") > 0
    return chunks.select(
        "file_name",
        "file_path",
        "block_start",
        "record",
        (F.octet_length("value") + F.lit(len(end_tag.encode()))).alias("n_bytes"),
        F.when(has_page, F.substring("value", F.lit(1), F.col("opened") - 1)).alias("prefix"),
        F.when(
            has_page, F.concat(F.expr("substring(value, opened)"), F.lit(end_tag))
        ).alias("page"),
    )


def read_pages(
    spark: SparkSession, path: str, start_tag: str = START_TAG, end_tag: str = END_TAG
) -> DataFrame:
    """``(file_name, page)``, one row per element. Narrow: no shuffle.

    A last page whose end tag is missing keeps its row only as far as the file goes;
    it has a document only if its text is closed.
    """
    chunks = read_chunks(spark, path, start_tag, end_tag)
    return chunks.filter(F.col("page").isNotNull()).select("file_name", "page")


def read_page_offsets(
    spark: SparkSession, path: str, start_tag: str = START_TAG, end_tag: str = END_TAG
) -> DataFrame:
    """``(file_name, byte_offset, page_bytes)`` of every start tag."""
    chunks = read_chunks(spark, path, start_tag, end_tag).select(
        "file_name",
        "file_path",
        "block_start",
        "record",
        "n_bytes",
        F.octet_length("prefix").alias("skipped"),
        F.octet_length("page").alias("page_bytes"),
    )
    placed = with_byte_offsets(chunks).filter(F.col("page_bytes").isNotNull())
    return placed.select(
        "file_name",
        (F.col("byte_offset") + F.col("skipped")).alias("byte_offset"),
        F.col("page_bytes").cast("bigint").alias("page_bytes"),
    )
