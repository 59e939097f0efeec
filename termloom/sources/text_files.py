"""Tab-separated text in and out: lines, lists, metadata, patterns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(value)``, one row per line."""
    return spark.read.text(path)


def read_skip_patterns(spark: SparkSession, path: str) -> DataFrame:
    """``(pattern)``, the distinct patterns of a file, one regular expression per line."""
    return spark.read.text(path).select(F.col("value").alias("pattern")).distinct()


def write_pairs(df: DataFrame, key: Column | str, value: Column | str, path: str) -> None:
    """Write ``key <tab> value`` lines."""
    key = F.col(key) if isinstance(key, str) else key
    value = F.col(value) if isinstance(value, str) else value
    df.select(F.concat(key.cast("string"), F.lit("\t"), value.cast("string")).alias("value")).write.text(path)


def write_lists(lists: DataFrame, path: str) -> None:
    """Write posting lists as ``term <tab> df;...;``.

    The key of a later line of a long list is ``term:segment``, which no term is.
    """
    first = F.col("segment") == 0
    key = F.when(first, F.col("term")).otherwise(F.concat_ws(":", "term", F.col("segment").cast("string")))
    write_pairs(lists, key, "posting_list", path)


def read_lists(spark: SparkSession, path: str) -> DataFrame:
    """``(term, segment, posting_list)`` from an exported index."""
    line = F.split(F.col("value"), "\t", 2)
    key = F.split(F.get(line, F.lit(0)), ":", 2)
    return spark.read.text(path).select(
        F.get(key, F.lit(0)).alias("term"),
        F.coalesce(F.get(key, F.lit(1)).cast("bigint"), F.lit(0).cast("bigint")).alias("segment"),
        F.get(line, F.lit(1)).alias("posting_list"),
    )


def metadata_line(metadata: DataFrame) -> Column:
    """``title,name,contributor_id,time,text_start,text_len``."""
    return F.concat_ws(
        ",",
        "title",
        "contributor_name",
        "contributor_id",
        "ts",
        F.col("text_start").cast("string"),
        F.col("text_len").cast("string"),
    )


def write_metadata(metadata: DataFrame, path: str) -> None:
    """Write metadata rows as text lines, sorted by id."""
    ordered = metadata.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    write_pairs(ordered, "doc_id", metadata_line(metadata), path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Metadata rows from text lines, and ``rejected``, the line where it has too few fields or a bad number.

    Fields are taken from the right, so commas inside a title are lost and a comma
    in a contributor's name shifts the fields before it, as in files of this format.
    A rejected line has nulls in all other columns.
    """
    line = F.split(F.col("value"), "\t", 2)
    fields = F.split(F.trim(F.get(line, F.lit(1))), ",")
    rows = spark.read.text(path).select("value", F.get(line, F.lit(0)).try_cast("bigint").alias("id"), fields.alias("f"))

    def field(n: int) -> Column:
        return F.try_element_at("f", F.lit(n))

    start, length = field(-2).try_cast("bigint"), field(-1).try_cast("bigint")
    good = (F.size("f") >= 6) & F.col("id").isNotNull() & start.isNotNull() & length.isNotNull()
    sound = F.coalesce(good, F.lit(False))
    title = F.array_join(F.slice("f", F.lit(1), F.greatest(F.size("f") - 5, F.lit(0))), "")
    columns = {
        "doc_id": F.col("id"),
        "title": title,
        "contributor_name": field(-5),
        "contributor_id": field(-4),
        "ts": field(-3),
        "text_start": start,
        "text_len": length,
    }
    return rows.select(
        *[F.when(sound, value).alias(name) for name, value in columns.items()],
        F.when(~sound, F.col("value")).alias("rejected"),
    )
