"""Document fingerprints: the k smallest hashes of a text's word shingles.

Everything is built of Spark's own column functions. A sketch is a sorted array of at most
``SKETCH_SIZE`` distinct hashes. Sketches of parts merge into the sketch of the whole, and
two sketches estimate how alike their texts are, how much of one the other contains, and
how many distinct shingles there are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.session import staged

SHINGLE_WORDS = 5
SKETCH_SIZE = 128

#: Stands for a null id while documents are ordered and joined.
NO_ID = -(1 << 63)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once per row, however often it is named."""
    return F.element_at(F.transform(F.array(value), use), 1)


def shingle_hashes(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """Hashes of all runs of words; of a text with fewer words, the hash of them all."""

    def hashes(found: Column) -> Column:
        n = F.size(found)
        every = F.transform(F.sequence(F.lit(1), F.greatest(n - words + 1, F.lit(1))), lambda i: F.xxhash64(F.slice(found, i, words)))
        return F.when(n == 0, F.array().cast("array<bigint>")).otherwise(every)

    split = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    return _let(F.array_remove(split, ""), hashes)


def sketch(text: Column, size: int = SKETCH_SIZE, words: int = SHINGLE_WORDS) -> Column:
    """A null text has the sketch of an empty one, which is empty."""
    return F.slice(F.sort_array(F.array_distinct(shingle_hashes(text, words))), 1, size)


def merge(a: Column, b: Column, size: int = SKETCH_SIZE) -> Column:
    """The sketch of both parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, size)


def merge_groups(df: DataFrame, keys: list[str], column: str, size: int = SKETCH_SIZE) -> DataFrame:
    """One sketch per group. Hashes are made distinct before they are ranked, so that no group is gathered."""
    hashes = df.select(*keys, F.explode(column).alias("__hash")).distinct()
    ranked = hashes.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy("__hash")))
    kept = ranked.filter(F.col("__rank") <= size)
    return kept.groupBy(*keys).agg(F.sort_array(F.collect_list("__hash")).alias(column))


def resemblance(a: Column, b: Column, size: int = SKETCH_SIZE) -> Column:
    """Estimated share of common shingles in all shingles of both. Two empty texts are alike."""

    def share(both: Column) -> Column:
        common = F.size(F.array_intersect(both, F.array_intersect(a, b)))
        return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(common / F.size(both))

    return _let(merge(a, b, size), share)


def distinct_shingles(a: Column, size: int = SKETCH_SIZE) -> Column:
    """Estimated number of distinct shingles; exact below ``size``."""
    reach = (F.element_at(a, size).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < size, F.size(a).cast("double")).otherwise(F.lit(float(size - 1)) / reach)


def containment(a: Column, b: Column, size: int = SKETCH_SIZE) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has. An empty text is contained in any."""

    def share(alike: Column) -> Column:
        common = alike / (1 + alike) * (distinct_shingles(a, size) + distinct_shingles(b, size))
        return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), common / distinct_shingles(a, size)))

    return _let(resemblance(a, b, size), share)


def as_text(a: Column) -> Column:
    """16 hex digits per hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def next_ids(ids: DataFrame, key: str) -> DataFrame:
    """``ids`` with ``next``: the next smaller key, of the smallest key the largest. Keys are distinct.

    Keys are dealt out by ranges. Neighbours within a range are found in its own task; one
    row per range is all that is ordered as a whole.
    """
    ranged = ids.repartitionByRange(F.col(key).desc()).withColumn("part", F.spark_partition_id())
    ranged = staged(ranged, "ranges")
    within = Window.partitionBy("part").orderBy(F.col(key).desc())
    ranged = ranged.withColumn("next", F.lead(key).over(within))
    edges = ranged.groupBy("part").agg(F.max(key).alias("top"))
    across = Window.orderBy("part")
    ring = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edges = edges.select("part", F.coalesce(F.lead("top").over(across), F.first("top").over(ring)).alias("edge"))
    return ranged.join(edges, "part").withColumn("next", F.coalesce("next", "edge")).drop("part", "edge")


def edited_neighbours(docs: DataFrame, doc_id: str = "doc_id", column: str = "text") -> DataFrame:
    """``(doc_id, text, edited, next_sketch)``, one row per id.

    ``edited``: the last half of the code points, rounded down, gives way to as many from
    the beginning of the next document's text, or all that it has. Next is the next
    smaller id; after the smallest (or the null id, which comes last) the largest follows.
    Rows that share an id are one document with its greatest text; a null text is empty.
    Texts are shuffled once, by id, and then the beginnings that the neighbours need.
    """
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID))
    text = F.coalesce(F.col(column), F.lit(""))
    rows = docs.select(key.alias("key"), text.alias("text"))
    lengths = rows.groupBy("key").agg(F.max(F.length("text")).alias("most"))
    chain = next_ids(lengths, "key").select("next", F.col("key").alias("to"), "most")
    texts = rows.groupBy("key").agg(F.max("text").alias("text"))
    heads = texts.join(chain, F.col("key") == F.col("next")).select(
        F.col("to").alias("key"),
        F.expr("substring(text, 1, most div 2)").alias("head"),
        sketch(F.col("text")).alias("next_sketch"),
    )
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.length("text") - half), F.substring(F.col("head"), F.lit(1), half)
    )
    back = F.when(F.col("key") != NO_ID, F.col("key"))
    return texts.join(heads, "key").select(back.alias("doc_id"), "text", edited.alias("edited"), "next_sketch")
