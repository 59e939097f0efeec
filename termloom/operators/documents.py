"""Raw pages to the documents table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.functions import pages
from termloom.operators.groups import range_count
from termloom.session import staged
from termloom.sources.offsets import with_byte_offsets


def build_documents(
    raw_pages: DataFrame, text_mode: str = "index", dedupe: bool = False
) -> DataFrame:
    """One row per page that has a numeric id and a text.

    ``title``, ``contributor`` and ``ts`` are lower-cased; ``title_raw`` and the
    text keep their case. ``contributor`` is null without a contributor block.
    ``text_mode="regex"`` also drops pages whose opening text tag spans lines.
    Ids are taken as unique; ``dedupe`` keeps the newest page of each id.
    """
    if text_mode not in ("index", "regex"):
        raise ValueError("text_mode must be 'index' or 'regex'")
    page, plain = F.col("page"), F.col("plain")
    body = pages.body_by_index(page, plain=plain) if text_mode == "index" else pages.body_by_regex(page)
    block = pages.contributor(page, plain)
    # A generated column is a value and no expression: it is computed once, for the filter and all fields.
    both = F.inline(F.array(F.struct(page.alias("page"), pages.plain_case(page).alias("plain"))))
    parsed = raw_pages.filter(F.length("page") > 0).select(both).select(
        pages.page_id(page).alias("doc_id"),
        F.lower(pages.page_title(page)).alias("title"),
        pages.page_title(page).alias("title_raw"),
        block.alias("contributor"),
        F.lower(pages.page_timestamp(page)).alias("ts"),
        body.alias("text"),
    )
    kept = parsed.filter(F.col("doc_id").isNotNull() & (F.length("text") > 0))
    if dedupe:
        columns = kept.columns
        marked = kept.withColumn("mark", F.struct("ts", F.xxhash64("title_raw", "text").alias("hash")))
        # Narrow rows decide; of equal pages any one is kept.
        newest = marked.groupBy("doc_id").agg(F.max("mark").alias("newest"))
        won = marked.join(newest, "doc_id").filter("mark = newest")
        kept = won.dropDuplicates(["doc_id"]).select(columns)
    return kept.withColumn("edited_at", F.try_to_timestamp(F.upper("ts")))


def document_metadata(chunks: DataFrame, store: bool = False, keep_file: bool = False) -> DataFrame:
    """``(doc_id, title, contributor_name, contributor_id, ts, text_start, text_len)``.

    ``chunks`` come from :func:`termloom.sources.xml_pages.read_chunks`.
    ``text_start`` is the byte offset of the text in its file, ``text_len`` counts
    code points. Pages without a contributor block have no row. Only these narrow
    columns are shuffled to number the bytes, never the page text; with ``store``
    they are written to the shared folder, so that the dump itself is read once.
    ``keep_file`` adds ``file_name`` and ``text_bytes``.
    """
    page = F.col("page")
    block = pages.contributor(page)
    skipped = F.octet_length("prefix")
    before_text = F.octet_length(F.substring(page, F.lit(1), pages.body_start(page) - 1))
    narrow = chunks.select(
        "file_name",
        "file_path",
        "block_start",
        "record",
        "n_bytes",
        pages.page_id(page).alias("doc_id"),
        F.lower(pages.page_title(page)).alias("title"),
        block.alias("contributor"),
        F.lower(pages.page_timestamp(page)).alias("ts"),
        (skipped + before_text).alias("into"),
        pages.body_length(page).alias("text_len"),
        F.octet_length(pages.body_by_index(page)).cast("bigint").alias("text_bytes"),
    )
    placed = with_byte_offsets(staged(narrow, "pages") if store else narrow)
    kept = placed.filter(
        F.col("doc_id").isNotNull()
        & F.col("contributor").isNotNull()
        & F.col("text_len").isNotNull()
    )
    return kept.select(
        "doc_id",
        "title",
        F.col("contributor.name").alias("contributor_name"),
        F.col("contributor.id").alias("contributor_id"),
        "ts",
        (F.col("byte_offset") + F.col("into")).alias("text_start"),
        F.col("text_len").cast("bigint").alias("text_len"),
        *(["file_name", "text_bytes"] if keep_file else []),
    )


def sorted_by_id(documents: DataFrame, partitions: int | None = None) -> DataFrame:
    """Range-partitioned and sorted by id, so that id filters skip row groups.

    ``partitions`` is the least number of ranges; there are more where a range would be large.
    """
    return documents.repartitionByRange(*range_count(documents, partitions), "doc_id").sortWithinPartitions("doc_id")
