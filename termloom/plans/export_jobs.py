"""Jobs that read a page dump and write one text index, as ``key <tab> value`` lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from termloom.operators.documents import build_documents, document_metadata
from termloom.operators.lists import encode_lists, posting_lists
from termloom.operators.postings import (
    MAX_POSTINGS,
    MAX_TERM_LENGTH,
    build_postings,
    prune_postings,
)
from termloom.operators.wordcount import word_count
from termloom.sources.text_files import (
    read_lines,
    read_skip_patterns,
    write_lists,
    write_metadata,
    write_pairs,
)
from termloom.sources.xml_pages import read_chunks, read_pages


def _documents(spark: SparkSession, source: str, text_mode: str) -> DataFrame:
    return build_documents(read_pages(spark, source), text_mode=text_mode)


def _postings(
    spark: SparkSession, source: str, text_mode: str = "index", positions: bool = True
) -> DataFrame:
    return build_postings(_documents(spark, source, text_mode), positions=positions)


def inverted_index(spark: SparkSession, source: str, target: str, text_mode: str = "index") -> None:
    """``term  df;id-tf;...;``"""
    postings = _postings(spark, source, text_mode, positions=False)
    write_lists(posting_lists(postings, "id", positions=False), target)


def positional_index(
    spark: SparkSession, source: str, target: str, order: str = "id", text_mode: str = "index"
) -> None:
    """``term  df;id-tf-p1,p2;...;`` in id, tf or tf_id order."""
    write_lists(posting_lists(_postings(spark, source, text_mode), order), target)


def lossless_index(spark: SparkSession, source: str, target: str, order: str = "tf_id") -> None:
    """Delta-coded lists of all postings."""
    write_lists(encode_lists(_postings(spark, source), order), target)


def lossy_index(
    spark: SparkSession,
    source: str,
    target: str,
    max_term_length: int = MAX_TERM_LENGTH,
    max_postings: int = MAX_POSTINGS,
) -> None:
    """Delta-coded lists of the pruned postings, in tf_id order."""
    postings = build_postings(_documents(spark, source, "index"))
    kept = prune_postings(postings, max_term_length, max_postings)
    write_lists(encode_lists(kept, "tf_id"), target)


def document_index(spark: SparkSession, source: str, target: str) -> None:
    """``id  title,name,contributor_id,time,text_start,text_len``, sorted by id."""
    write_metadata(document_metadata(read_chunks(spark, source), store=True), target)


def count_words(
    spark: SparkSession,
    source: str,
    target: str,
    case_sensitive: bool = True,
    skip_file: str | None = None,
) -> None:
    """``word  n``."""
    patterns = read_skip_patterns(spark, skip_file) if skip_file else ()
    write_pairs(word_count(read_lines(spark, source), case_sensitive, patterns), "word", "n", target)
