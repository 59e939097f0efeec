
from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from termloom.functions import pages as page_fields
from termloom.functions.codec import join_positions
from termloom.operators.browse import get_documents, snippets, term_documents, text_snippets
from termloom.operators.documents import build_documents, document_metadata, sorted_by_id
from termloom.operators.lists import decode_lists, encode_lists, posting_lists
from termloom.operators.postings import (
    build_postings,
    prune_postings,
    scan_postings,
    sorted_by_term,
    term_stats,
)
from termloom.operators.search import corpus_size, literal_terms, result_page, search, tf_idf_scores
from termloom.operators.redirects import follow_titles, read_redirects, resolve_redirects
from termloom.operators.stopwords import drop_common_terms, drop_listed_terms
from termloom.operators.tokens import tokenize, tokenize_positions, tokenize_positions_in_pieces
from termloom.plans.index_tables import IndexTables, open_index, write_index
from termloom.operators.wordcount import word_count, words
from termloom.session import scratch_path, staged
from termloom.sources.offsets import source_columns, with_byte_offsets
from termloom.sources.text_files import (
    read_lists,
    read_metadata,
    read_skip_patterns,
    write_lists,
    write_metadata,
)
from termloom.sources.xml_pages import read_chunks, read_page_offsets, read_pages

try:  # the subpackage can be left out, and so can the packages that only it needs
    from termloom.llm import queries as corpus_queries
except ModuleNotFoundError:
    corpus_queries = None
try:
    import corpus_pipeline
except ModuleNotFoundError:
    corpus_pipeline = None

QUERY = "the and that"
DOCUMENT_IDS = [3, 17, 42, 150, 999999]
TERM = "the"
ID_RANGE = (40, 120)
SNIPPET_TERMS = ["worthless", "that"]
SKIP_PATTERNS = [r"\.", ",", "!", "to"]
CAPS = {"max_term_length": 8, "max_postings": 50}
STOP_WORDS = ["the", "and", "of", "de", "la", "der", "und", "que"]
COMMON_RATIO = 0.3
# Ids are scattered over 97 blocks of this many, far from each other within each.
SPARSE_BLOCK = 1 << 50
SPARSE_STEP = 7_919
RANGE_BYTES = 1 << 16
INDEX_CAPS = {"max_term_length": 8, "max_postings": 50}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table; its source stands in for a title."""
    docs = _table(spark, sf_dir, "documents")
    return docs.select("doc_id", "text", F.lower("source").alias("title"))


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", "text")


def _postings(spark: SparkSession, sf_dir: str, positions: bool = True) -> DataFrame:
    return build_postings(_texts(spark, sf_dir), positions)


def _scored(results: DataFrame) -> DataFrame:
    return results.withColumn("score", F.round("score", 6))


def _batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark passage as a query."""
    return _table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query")
    )


def page_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.col("html")
    return _table(spark, sf_dir, "pages").select(
        "page_id", F.lower(page_fields.page_title(html)).alias("title")
    )


def page_body_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = page_fields.body_by_index(F.col("html"), "body")
    return _table(spark, sf_dir, "pages").select("page_id", body.alias("body")).filter(
        F.length("body") > 0
    )


def page_body_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = page_fields.body_by_regex(F.col("html"), "body")
    return _table(spark, sf_dir, "pages").select("page_id", body.alias("body")).filter(
        F.length("body") > 0
    )


def query_tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize(_texts(spark, sf_dir))


def query_tokenize_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize_positions(_texts(spark, sf_dir))


def query_tokenize_windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize_positions_in_pieces(_texts(spark, sf_dir))


def term_doc_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _postings(spark, sf_dir, positions=False)


def term_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_stats(_postings(spark, sf_dir, positions=False))


def positional_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _postings(spark, sf_dir).select(
        "term", "doc_id", "tf", join_positions(F.col("positions")).alias("positions")
    )


def inverted_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    postings = _postings(spark, sf_dir, positions=False)
    return posting_lists(postings, "id", positions=False)


def index_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_lists(_postings(spark, sf_dir), "id")


def index_by_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_lists(_postings(spark, sf_dir), "tf")


def index_by_tf_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_lists(_postings(spark, sf_dir), "tf_id")


def lossless_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_lists(_postings(spark, sf_dir), "tf_id")


def lossless_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_lists(_postings(spark, sf_dir), "id")


def lossy_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    postings = prune_postings(_postings(spark, sf_dir), **CAPS)
    return encode_lists(postings, "tf_id")


def pruned_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prune_postings(_postings(spark, sf_dir, positions=False), **CAPS)


def _small_segments(postings: DataFrame, order: str) -> DataFrame:
    """A new line starts past 100 postings, at a block of 64 ids."""
    return posting_lists(postings, order, positions=False, segment_rows=100, block_bits=6)


def segmented_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _small_segments(_postings(spark, sf_dir, positions=False), "id")


def segmented_lists_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _small_segments(_postings(spark, sf_dir, positions=False), "tf_id")


def _sparse(postings: DataFrame) -> DataFrame:
    """The postings under ids that are far from each other."""
    return postings.withColumn("doc_id", F.pmod(F.col("doc_id") * F.lit(SPARSE_STEP), F.lit(97)) * F.lit(SPARSE_BLOCK) + F.col("doc_id") * F.lit(SPARSE_STEP))


def sparse_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _small_segments(_sparse(_postings(spark, sf_dir, positions=False)), "id")


def sparse_lists_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _small_segments(_sparse(_postings(spark, sf_dir, positions=False)), "tf_id")


def _decoded(spark: SparkSession, sf_dir: str, order: str) -> DataFrame:
    lists = encode_lists(_postings(spark, sf_dir), order)
    return decode_lists(lists, order).select(
        "term", "doc_id", "tf", join_positions(F.col("positions")).alias("positions")
    )


def decode_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decoded(spark, sf_dir, "id")


def decode_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decoded(spark, sf_dir, "tf_id")


def _search(
    spark: SparkSession, sf_dir: str, queries, mode: str, start=0, amount=10, caps=None, **options
) -> DataFrame:
    terms = literal_terms([queries]) if isinstance(queries, str) else None
    postings = scan_postings(_texts(spark, sf_dir), terms)
    if caps:
        postings = prune_postings(postings, **caps)
    return _scored(search(postings, queries, mode, start, amount, _docs(spark, sf_dir), **options))


def search_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _search(spark, sf_dir, QUERY, "or")


def search_or_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _search(spark, sf_dir, QUERY, "or", caps=CAPS)


def search_and(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _search(spark, sf_dir, QUERY, "and")


def search_page2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _search(spark, sf_dir, QUERY, "or", start=10)


def search_page_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of each query whose place is found by counting."""
    return _search(spark, sf_dir, _batch(spark, sf_dir), "or", start=10, deep=1)


def search_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _search(spark, sf_dir, _batch(spark, sf_dir), "or")


def search_batch_and(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _search(spark, sf_dir, _batch(spark, sf_dir), "and")


def search_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries without letters and with unknown terms have no rows."""
    postings = scan_postings(_texts(spark, sf_dir))
    return _scored(search(postings, ["", "12 !", "zzzzqqqq"], "or", documents=_docs(spark, sf_dir)))


@functools.cache
def _index_path(application: str, sf_dir: str) -> str:
    """Where the documents' index is written, once for each application and folder."""
    spark = SparkSession.getActiveSession()
    path = scratch_path(spark, "index")
    write_index(spark, _docs(spark, sf_dir), path, **INDEX_CAPS)
    return path


def _stored_index(spark: SparkSession, sf_dir: str) -> IndexTables:
    return open_index(spark, _index_path(spark.sparkContext.applicationId, sf_dir))


def stored_search_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(_stored_index(spark, sf_dir).search(QUERY, "or"))


def stored_search_and(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(_stored_index(spark, sf_dir).search(QUERY, "and"))


def stored_search_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(_stored_index(spark, sf_dir).search(_batch(spark, sf_dir), "or"))


def stored_search_batch_and(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(_stored_index(spark, sf_dir).search(_batch(spark, sf_dir), "and"))


def stored_search_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(_stored_index(spark, sf_dir).search(QUERY, "or", pruned=True))


def stored_tf_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(_stored_index(spark, sf_dir).tf_idf(QUERY))


def stored_top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pruned postings beside the document counts of the whole lists."""
    return _stored_index(spark, sf_dir).top_terms().select("term", "doc_id", "tf", "df")


def stored_term_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_index(spark, sf_dir).term_documents(TERM, "tf", 5, 10)


def stored_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Around every place of the terms in all stored documents."""
    return _stored_index(spark, sf_dir).snippets(SNIPPET_TERMS, width=20)


def decode_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The postings of a range of ids, from the lists of all."""
    lists = encode_lists(_postings(spark, sf_dir), "id")
    return decode_lists(lists, "id", ids=ID_RANGE).select(
        "term", "doc_id", "tf", join_positions(F.col("positions")).alias("positions")
    )


def search_exported_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists written as text, read, decoded and searched."""
    path = scratch_path(spark, "lists")
    write_lists(lossless_id(spark, sf_dir), path)
    wanted = read_lists(spark, path).filter(F.col("term").isin(literal_terms([QUERY])))
    postings = decode_lists(wanted, "id", positions=False)
    return _scored(search(postings, QUERY, "and", documents=_docs(spark, sf_dir)))


def sorted_index_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of both sorted tables: rows, and partitions whose rows are out of order or overlap the next."""
    documents = sorted_by_id(_texts(spark, sf_dir), 5)
    postings = sorted_by_term(staged(_postings(spark, sf_dir, positions=False), "postings"), 5)
    counts = []
    for name, table, key in (
        ("documents", documents, F.struct("doc_id")),
        ("postings", postings, F.struct("term", "doc_id")),
    ):
        placed = table.select(key.alias("key"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
        parts = placed.groupBy("part").agg(
            F.count(F.lit(1)).alias("n"),
            F.min("key").alias("low"),
            F.max("key").alias("high"),
            (F.min_by("key", "at") == F.min("key")).alias("begins"),
            (F.max_by("key", "at") == F.max("key")).alias("ends"),
        )
        after = parts.select((F.col("part") - 1).alias("part"), F.col("low").alias("next_low"))
        joined = parts.join(after, "part", "left")
        wrong = ~F.col("begins") | ~F.col("ends") | F.coalesce(F.col("high") >= F.col("next_low"), F.lit(False))
        counts.append(
            joined.agg(F.sum("n").alias("n_rows"), F.sum(wrong.cast("bigint")).alias("out_of_order")).select(
                F.lit(name).alias("table_name"), "n_rows", "out_of_order"
            )
        )
    return counts[0].unionByName(counts[1])


def document_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return get_documents(_docs(spark, sf_dir), DOCUMENT_IDS)


def term_documents_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    postings = scan_postings(_texts(spark, sf_dir), [TERM])
    return term_documents(postings, _docs(spark, sf_dir).drop("text"), TERM, "tf", 5, 10)


def term_documents_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page whose place is found by counting."""
    postings = scan_postings(_texts(spark, sf_dir), [TERM])
    return term_documents(postings, _docs(spark, sf_dir).drop("text"), TERM, "tf", 5, 10, deep=1)


def term_documents_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    postings = scan_postings(_texts(spark, sf_dir), [TERM])
    return term_documents(postings, _docs(spark, sf_dir).drop("text"), TERM, "id", 5, 10)


def query_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_snippets(_texts(spark, sf_dir), SNIPPET_TERMS, width=20)


def snippets_of_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = _postings(spark, sf_dir).filter(F.col("term").isin(SNIPPET_TERMS))
    return snippets(hits, _docs(spark, sf_dir), width=20)


def query_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_count(_texts(spark, sf_dir), column="text")


def word_count_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "conversations")
    return word_count(lines, False, SKIP_PATTERNS, column="text")


def input_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = words(_table(spark, sf_dir, "conversations"), False, SKIP_PATTERNS, column="text")
    return found.agg(F.count(F.lit(1)).alias("input_words"))


def word_count_skip_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skip patterns from a file, which holds the two-letter words of the benchmark."""
    path = scratch_path(spark, "patterns")
    found = _table(spark, sf_dir, "benchmark").select(F.explode(F.split(F.lower("text"), " ")).alias("value"))
    found.filter(F.col("value").rlike("^[a-z]{2}$")).write.text(path)
    lines = _table(spark, sf_dir, "conversations")
    return word_count(lines, False, read_skip_patterns(spark, path), column="text")


def observed_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counter that a word count fills while it runs."""
    seen = Observation()
    counted = word_count(_table(spark, sf_dir, "conversations"), False, SKIP_PATTERNS, column="text", counter=seen)
    counted.write.format("noop").mode("overwrite").save()
    return spark.range(1).select(F.lit(seen.get["input_words"]).cast("bigint").alias("input_words"))


def _written_dump(spark: SparkSession, sf_dir: str) -> str:
    """The documents table written out as page markup, in the shared folder."""
    text = _escaped(F.col("text"))
    named = F.concat(F.lit("<username>"), F.col("source"), F.lit("</username><id>"), F.col("n_chars"), F.lit("</id>"))
    # Every seventh edit is anonymous, every eleventh page has no contributor.
    who = F.when(F.col("doc_id") % 7 == 0, F.lit("<ip>10.0.0.1</ip>")).otherwise(named)
    block = F.when(F.col("doc_id") % 11 == 0, F.lit("")).otherwise(
        F.concat(F.lit("<contributor>"), who, F.lit("</contributor>"))
    )
    page = F.concat(
        F.lit("  <page>\n    <title>Page "), F.col("lang"), F.lit(" "), F.col("doc_id"),
        F.lit("</title>\n    <id>"), F.col("doc_id"),
        F.lit("</id>\n    <revision><id>1</id><timestamp>2023-06-15T08:30:00Z</timestamp>"),
        block, F.lit('<text xml:space=\n"preserve">'), text, F.lit("</text></revision>\n  </page>"),
    )
    path = scratch_path(spark, "dump")
    _table(spark, sf_dir, "documents").select(page.alias("value")).write.text(path)
    return path


def xml_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_pages(spark, _written_dump(spark, sf_dir))
    return build_documents(pages).select("doc_id", "title", "ts", "text")


def _escaped(text: Column) -> Column:
    for plain, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def xml_without_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose id is missing or not a number have no document; the tags are in capitals."""
    case = F.col("doc_id") % 5
    marked = F.concat(F.lit("<ID>"), F.when(case == 1, "n").otherwise(""), F.col("doc_id"), F.lit("</ID>"))
    page = F.concat(
        F.lit("<page>\n<TITLE>Page "), F.col("doc_id"), F.lit("</TITLE>\n"), F.when(case == 0, "").otherwise(marked),
        F.lit('<TEXT xml:space="preserve">'), _escaped(F.col("text")), F.lit("</TEXT>\n</page>"),
    )
    pages = _table(spark, sf_dir, "documents").select(page.alias("page"))
    return build_documents(pages).select("doc_id", "title", "text")


def _in_ranges(rows: DataFrame, start: str, size: str) -> DataFrame:
    """The rows, once for each range of ``RANGE_BYTES`` bytes of the file that they reach into."""
    first, last = (F.expr(f"({x}) div {RANGE_BYTES}") for x in (start, f"{start} + greatest({size}, 1) - 1"))
    return rows.withColumn("first_range", first).withColumn("range", F.explode(F.sequence(first, last)))


def _bytes_at(spark: SparkSession, path: str, placed: DataFrame, start: str, size: str, kept: list[str], digest: str) -> DataFrame:
    """The kept columns and the digest of the bytes of the file at each place.

    The files are read again line by line. Lines and places meet by ranges of bytes, so that no
    task holds more of a file than a range and the places in it.
    """
    whole = F.encode(F.concat("value", F.lit("\n")), "UTF-8")
    lines = spark.read.option("lineSep", "\n").text(path).select(*source_columns(), whole.alias("line"))
    lines = with_byte_offsets(lines.withColumn("n_bytes", F.octet_length("line")))
    lines = _in_ranges(lines.select("file_name", "byte_offset", "n_bytes", "line"), "byte_offset", "n_bytes")
    places = placed.select(
        "file_name", F.col(start).alias("at"), F.col(size).cast("bigint").alias("bytes"), F.struct(*kept).alias("kept")
    )
    places = _in_ranges(places, "at", "bytes").withColumnRenamed("first_range", "own_first")
    both = places.join(lines, ["file_name", "range"]).filter(
        # Both may reach into several ranges; they meet in the first that they share.
        (F.col("range") == F.greatest("first_range", "own_first"))
        & (F.col("byte_offset") < F.col("at") + F.col("bytes"))
        & (F.col("byte_offset") + F.col("n_bytes") > F.col("at"))
    )
    begin = F.greatest(F.col("at") - F.col("byte_offset"), F.lit(0))
    end = F.least(F.col("at") + F.col("bytes") - F.col("byte_offset"), F.col("n_bytes"))
    part = F.substring("line", (begin + 1).cast("int"), (end - begin).cast("int"))
    whole = both.groupBy("file_name", "at").agg(
        F.first("kept").alias("kept"), F.sort_array(F.collect_list(F.struct("byte_offset", part.alias("part")))).alias("parts")
    )
    there = F.aggregate("parts", F.lit(b""), lambda text, x: F.concat(text, x["part"]))
    return whole.select("kept.*", F.sha2(there, 256).alias(digest))


def xml_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of the written dump, with the digest of the bytes that stand at ``text_start``."""
    path = _written_dump(spark, sf_dir)
    metadata = document_metadata(read_chunks(spark, path), keep_file=True)
    kept = ["doc_id", "title", "contributor_name", "contributor_id", "ts", "text_len"]
    return _bytes_at(spark, path, metadata, "text_start", "text_bytes", kept, "text_sha256")


def metadata_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata written as text lines and read back, bad lines apart."""
    path = scratch_path(spark, "metadata")
    write_metadata(document_metadata(read_chunks(spark, _written_dump(spark, sf_dir))), path)
    bad = _table(spark, sf_dir, "region").select(F.concat(F.col("r_regionkey"), F.lit("\ta,b")).alias("value"))
    bad.coalesce(1).write.mode("append").text(path)
    # A rejected line has no numbers.
    return read_metadata(spark, path).drop("text_start").na.fill(-1, ["doc_id", "text_len"])


def xml_page_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page of the written dump by the bytes that stand at its offset."""
    path = _written_dump(spark, sf_dir)
    offsets = read_page_offsets(spark, path)
    return _bytes_at(spark, path, offsets, "byte_offset", "page_bytes", ["page_bytes"], "page_sha256")


def tf_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    scores = tf_idf_scores(scan_postings(_texts(spark, sf_dir)), docs, QUERY)
    return _scored(result_page(scores, documents=docs))


def query_corpus_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_size(_docs(spark, sf_dir))


def stop_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_listed_terms(_postings(spark, sf_dir, positions=False), STOP_WORDS)


def stop_words_common(spark: SparkSession, sf_dir: str) -> DataFrame:
    postings = _postings(spark, sf_dir, positions=False)
    return drop_common_terms(postings, _docs(spark, sf_dir), COMMON_RATIO)


REDIRECT = "(doc_id * 7 + 3) % 500"


def redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of a written dump that stand for others, by way of chains and cycles."""
    docs = _table(spark, sf_dir, "documents").filter("doc_id % 4 <> 1")
    page = F.concat(
        F.lit("  <page>\n    <title>Page "), F.col("doc_id"), F.lit("</title>\n    <id>"), F.col("doc_id"),
        F.lit('</id>\n    <redirect title="Page '), F.expr(REDIRECT), F.lit('" />\n    <revision><text>'),
        _escaped(F.col("text")), F.lit("</text></revision>\n  </page>"),
    )
    path = scratch_path(spark, "dump")
    docs.select(page.alias("value")).write.text(path)
    return resolve_redirects(read_redirects(read_pages(spark, path)))


def search_redirected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results under the titles that theirs stand for."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("page "), "doc_id").alias("title"))
    page = search(scan_postings(_texts(spark, sf_dir), literal_terms([QUERY])), QUERY, "or", amount=100, documents=docs)
    return _scored(follow_titles(page, redirects(spark, sf_dir)))


def entry(spark: SparkSession) -> DataFrame:
    """Ranked OR search over the smallest data set."""
    return search_or(spark, "/root/testdata/sf0.001")


def _corpus(attribute: str) -> dict:
    """What the optional modules add."""
    found = dict(getattr(corpus_queries, attribute)) if corpus_queries else {}
    if corpus_pipeline:
        added = corpus_pipeline.run if attribute == "QUERIES" else corpus_pipeline.ORACLE_SQL
        found |= {"pipeline": added} if added else {}
    return found


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _corpus("QUERIES") | {
        "page_title": page_title,
        "page_body_index": page_body_index,
        "page_body_regex": page_body_regex,
        "tokenize": query_tokenize,
        "tokenize_positions": query_tokenize_positions,
        "tokenize_windowed": query_tokenize_windowed,
        "term_doc_tf": term_doc_tf,
        "term_df": term_df,
        "positional_postings": positional_postings,
        "inverted_index": inverted_index,
        "index_by_id": index_by_id,
        "index_by_tf": index_by_tf,
        "index_by_tf_id": index_by_tf_id,
        "lossless_tf": lossless_tf,
        "lossless_id": lossless_id,
        "lossy_tf": lossy_tf,
        "pruned_postings": pruned_postings,
        "segmented_lists": segmented_lists,
        "segmented_lists_tf": segmented_lists_tf,
        "sparse_lists": sparse_lists,
        "sparse_lists_tf": sparse_lists_tf,
        "decode_id": decode_id,
        "decode_tf": decode_tf,
        "decode_range": decode_range,
        "search_or": search_or,
        "search_or_pruned": search_or_pruned,
        "search_and": search_and,
        "search_page2": search_page2,
        "search_page_deep": search_page_deep,
        "search_nothing": search_nothing,
        "search_exported_lists": search_exported_lists,
        "stored_search_or": stored_search_or,
        "stored_search_and": stored_search_and,
        "stored_search_batch": stored_search_batch,
        "stored_search_batch_and": stored_search_batch_and,
        "stored_search_pruned": stored_search_pruned,
        "stored_tf_idf": stored_tf_idf,
        "stored_top_terms": stored_top_terms,
        "stored_term_documents": stored_term_documents,
        "stored_snippets": stored_snippets,
        "sorted_index_order": sorted_index_order,
        "search_batch": search_batch,
        "search_batch_and": search_batch_and,
        "document_lookup": document_lookup,
        "term_documents_tf": term_documents_tf,
        "term_documents_deep": term_documents_deep,
        "term_documents_id": term_documents_id,
        "snippets": query_snippets,
        "snippets_of_hits": snippets_of_hits,
        "word_count": query_word_count,
        "word_count_skip": word_count_skip,
        "word_count_skip_file": word_count_skip_file,
        "input_words": input_words,
        "observed_words": observed_words,
        "xml_roundtrip": xml_roundtrip,
        "xml_without_ids": xml_without_ids,
        "xml_metadata": xml_metadata,
        "metadata_lines": metadata_lines,
        "xml_page_offsets": xml_page_offsets,
        "tf_idf": tf_idf,
        "corpus_size": query_corpus_size,
        "stop_words": stop_words,
        "stop_words_common": stop_words_common,
        "redirects": redirects,
        "search_redirected": search_redirected,
    }


# --- SQL twins -------------------------------------------------------------------

_TF = """
tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS term FROM documents),
tf AS (SELECT term, doc_id, count(*)::BIGINT AS tf FROM tok GROUP BY term, doc_id)"""

_POSITIONS = """
cut AS (SELECT doc_id, regexp_extract_all(lower(text), '([^a-z]*)([a-z]+)', 1) AS g,
               regexp_extract_all(lower(text), '([^a-z]*)([a-z]+)', 2) AS w FROM documents),
part AS (SELECT doc_id, unnest(g) AS gap, unnest(w) AS term, generate_subscripts(w, 1) AS i FROM cut),
pos AS (SELECT doc_id, term,
               (sum(length(gap) + length(term)) OVER (PARTITION BY doc_id ORDER BY i)
                - length(term))::INTEGER AS position FROM part)"""

_POSTINGS = f"""{_POSITIONS},
step AS (SELECT *, position - lag(position, 1, 0) OVER (PARTITION BY doc_id, term ORDER BY position) AS gap
         FROM pos),
post AS (SELECT term, doc_id, count(*)::BIGINT AS tf,
                string_agg(position::VARCHAR, ',' ORDER BY position) AS positions,
                string_agg(gap::VARCHAR, ',' ORDER BY position) AS gaps
         FROM step GROUP BY term, doc_id)"""


def _list_sql(source: str, ctes: str, by_tf: bool, fields: str) -> str:
    order = "tf DESC, doc_id" if by_tf else "doc_id"
    return f"""WITH {ctes}
SELECT term, 0::BIGINT AS segment, count(*)::BIGINT AS df,
       count(*) || ';' || string_agg({fields}, ';' ORDER BY {order}) || ';' AS posting_list
FROM {source} GROUP BY term"""


_DELTA_ID = """
coded AS (SELECT *, doc_id - lag(doc_id, 1, 0) OVER (PARTITION BY term ORDER BY doc_id) AS id_gap FROM post)"""

_DELTA_RUN = """
coded AS (SELECT *, doc_id - lag(doc_id, 1, 0) OVER (PARTITION BY term, tf ORDER BY doc_id) AS id_gap FROM {0})"""

_SPARSE_ID = f"(doc_id * {SPARSE_STEP} % 97) * {SPARSE_BLOCK} + doc_id * {SPARSE_STEP}"


def _segment_sql(doc_id: str, by_tf: bool) -> str:
    """Lines begin at the first block of 64 ids before which a hundred postings stand."""
    run, order = (", tf", "tf DESC, ") if by_tf else ("", "")
    return f"""WITH {_TF},
p AS (SELECT term, {doc_id} AS doc_id, tf FROM tf),
blocks AS (SELECT term{run}, doc_id >> 6 AS block, count(*) AS n FROM p GROUP BY ALL),
cuts AS (SELECT term{run}, block, (coalesce(sum(n) OVER (PARTITION BY term ORDER BY {order}block
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 100)::BIGINT AS segment FROM blocks),
all_of AS (SELECT term, count(*)::BIGINT AS df FROM p GROUP BY term)
SELECT term, segment, df, df || ';' || string_agg(doc_id || '-' || tf, ';' ORDER BY {order}doc_id) || ';' AS posting_list
FROM (SELECT *, doc_id >> 6 AS block FROM p) JOIN cuts USING (term{run}, block) JOIN all_of USING (term)
GROUP BY term, segment, df"""


_PLAIN = "doc_id || '-' || tf || '-' || positions"
_CODED = "id_gap || '-' || tf || '-' || gaps"

_PRUNED = """
pruned AS (SELECT * FROM {0} WHERE length(term) <= {max_term_length}
           QUALIFY row_number() OVER (PARTITION BY term ORDER BY tf DESC, doc_id) <= {max_postings})"""

_ONE_QUERY = f"""
q AS (SELECT DISTINCT 0::BIGINT AS query_id, unnest(regexp_extract_all(lower('{QUERY}'), '[a-z]+')) AS term)"""

_BATCH = """
q AS (SELECT DISTINCT item_id AS query_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS term
      FROM benchmark)"""

_OR = """
hit AS (SELECT query_id, doc_id, tf / max(tf) OVER (PARTITION BY query_id, term) AS part
        FROM {0} JOIN q USING (term)),
scored AS (SELECT query_id, doc_id, sum(part) AS score FROM hit GROUP BY query_id, doc_id)"""

_AND = """
need AS (SELECT query_id, count(*) AS n_terms FROM q GROUP BY query_id),
full_match AS (SELECT query_id, term, doc_id, tf FROM (
                 SELECT query_id, term, doc_id, tf, count(*) OVER (PARTITION BY query_id, doc_id) AS n
                 FROM {0} JOIN q USING (term)) JOIN need USING (query_id) WHERE n = n_terms),
hit AS (SELECT query_id, doc_id, tf / max(tf) OVER (PARTITION BY query_id, term) AS part FROM full_match),
scored AS (SELECT query_id, doc_id, sum(part) AS score FROM hit GROUP BY query_id, doc_id)"""

_TF_IDF = """
weight AS (SELECT term, ln((SELECT count(*) FROM documents) / count(*)) AS idf FROM tf GROUP BY term),
scored AS (SELECT query_id, doc_id, sum(tf * idf) AS score
           FROM tf JOIN q USING (term) JOIN weight USING (term) GROUP BY query_id, doc_id)"""


def _page_sql(ctes: str, start: int = 0, amount: int = 10) -> str:
    return f"""WITH {ctes},
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS r
           FROM scored)
SELECT query_id, (r - 1 - {start})::INTEGER AS number, lower(source) AS title, doc_id,
       round(score, 6) AS score, '/document/' || doc_id AS url
FROM ranked LEFT JOIN documents USING (doc_id) WHERE r > {start} AND r <= {start + amount}"""


def _term_page_sql(order: str) -> str:
    return f"""WITH {_TF},
ranked AS (SELECT *, row_number() OVER (ORDER BY {order}) - 1 AS n FROM tf WHERE term = '{TERM}')
SELECT n::INTEGER AS number, doc_id, tf, lower(source) AS title
FROM ranked LEFT JOIN documents USING (doc_id) WHERE n >= 5 AND n < 15"""


_BODY_INDEX = """SELECT page_id, body FROM (
  SELECT page_id, substr(html, start, closed - start) AS body, start, closed FROM (
    SELECT page_id, html, instr(html, '<body') + instr(substr(html, instr(html, '<body')), '>') AS start,
           instr(html, '</body>') AS closed FROM pages
    WHERE instr(html, '<body') > 0 AND instr(substr(html, instr(html, '<body')), '>') > 0))
WHERE closed > start"""

_SKIPPED = "lower(text)"
for _pattern in sorted(SKIP_PATTERNS):
    _SKIPPED = f"regexp_replace({_SKIPPED}, '{_pattern}', '', 'g')"
_SKIP_WORDS = f"""(SELECT word FROM (
    SELECT unnest(regexp_split_to_array({_SKIPPED}, '[ \\t\\n\\r\\f]+')) AS word FROM conversations)
    WHERE word <> '')"""

_ESCAPED = "replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
_PAGE = f"""'<page>' || chr(10) || '    <title>Page ' || lang || ' ' || doc_id || '</title>' || chr(10)
    || '    <id>' || doc_id || '</id>' || chr(10)
    || '    <revision><id>1</id><timestamp>2023-06-15T08:30:00Z</timestamp>'
    || CASE WHEN doc_id % 11 = 0 THEN ''
       ELSE '<contributor>' || CASE WHEN doc_id % 7 = 0 THEN '<ip>10.0.0.1</ip>'
            ELSE '<username>' || source || '</username><id>' || n_chars || '</id>' END || '</contributor>' END
    || '<text xml:space=' || chr(10) || '"preserve">' || {_ESCAPED} || '</text></revision>' || chr(10)
    || '  </page>'"""
_METADATA = f"""doc_id, 'page ' || lower(lang) || ' ' || doc_id AS title,
    CASE WHEN doc_id % 7 = 0 THEN '' ELSE lower(source) END AS contributor_name,
    CASE WHEN doc_id % 7 = 0 THEN '' ELSE n_chars::VARCHAR END AS contributor_id,
    '2023-06-15t08:30:00z' AS ts, length({_ESCAPED})::BIGINT AS text_len"""
_WITH_METADATA = "FROM documents WHERE length(text) > 0 AND doc_id % 11 <> 0"
_LOOKED_UP = ", ".join(str(i) for i in DOCUMENT_IDS)
_SNIPPETS = f"""WITH {_POSITIONS} SELECT doc_id, term, position,
    substr(text, position + 1, 20) AS snippet FROM pos JOIN documents USING (doc_id)
    WHERE term IN ({", ".join(f"'{t}'" for t in SNIPPET_TERMS)})"""
_STOP_LIST = ", ".join(f"'{w}'" for w in STOP_WORDS)


_REDIRECTS = f"""RECURSIVE
links AS (SELECT doc_id, {REDIRECT} AS next_id FROM documents WHERE doc_id % 4 <> 1 AND length(text) >= 0),
walk AS (SELECT doc_id, next_id, 1::BIGINT AS steps FROM links
         UNION ALL SELECT w.doc_id, l.next_id, steps + 1 FROM walk w JOIN links l ON l.doc_id = w.next_id
         WHERE steps <= (SELECT count(*) FROM links)),
ends AS (SELECT * FROM walk WHERE next_id NOT IN (SELECT doc_id FROM links)),
led AS (SELECT 'page ' || links.doc_id AS title, 'page ' || ends.next_id AS target, steps
        FROM links LEFT JOIN ends USING (doc_id))"""


def oracle_sql() -> dict[str, str]:
    lossless_run = _DELTA_RUN.format("post")
    pruned_post = _PRUNED.format("post", **CAPS)
    pruned_tf = _PRUNED.format("tf", **CAPS)
    by_id = _list_sql("post", _POSTINGS, False, _PLAIN)
    by_tf = _list_sql("post", _POSTINGS, True, _PLAIN)
    decoded = f"WITH {_POSTINGS} SELECT term, doc_id, tf, positions FROM post"
    return _corpus("ORACLE_SQL") | {
        "page_title": "SELECT page_id, lower(regexp_extract(html, '<title>(.*?)</title>', 1)) AS title FROM pages",
        "page_body_index": _BODY_INDEX,
        "page_body_regex": r"""SELECT page_id, body FROM (
            SELECT page_id, regexp_extract(html, '<body.*>([\s\S]*)</body>', 1) AS body FROM pages)
            WHERE length(body) > 0""",
        "tokenize": f"WITH {_TF} SELECT doc_id, term FROM tok",
        "tokenize_positions": f"WITH {_POSITIONS} SELECT doc_id, term, position FROM pos",
        "tokenize_windowed": f"WITH {_POSITIONS} SELECT doc_id, term, position FROM pos",
        "term_doc_tf": f"WITH {_TF} SELECT term, doc_id, tf FROM tf",
        "term_df": f"""WITH {_TF} SELECT term, count(*)::BIGINT AS df, sum(tf)::BIGINT AS total_tf,
            max(tf)::BIGINT AS max_tf FROM tf GROUP BY term""",
        "positional_postings": decoded,
        "inverted_index": _list_sql("tf", _TF, False, "doc_id || '-' || tf"),
        "index_by_id": by_id,
        "index_by_tf": by_tf,
        "index_by_tf_id": by_tf,
        "lossless_tf": _list_sql("coded", f"{_POSTINGS},{lossless_run}", True, _CODED),
        "lossless_id": _list_sql("coded", f"{_POSTINGS},{_DELTA_ID}", False, _CODED),
        "lossy_tf": _list_sql(
            "coded", f"{_POSTINGS},{pruned_post},{_DELTA_RUN.format('pruned')}", True, _CODED
        ),
        "pruned_postings": f"WITH {_TF},{pruned_tf} SELECT term, doc_id, tf FROM pruned",
        "segmented_lists": _segment_sql("doc_id", False),
        "segmented_lists_tf": _segment_sql("doc_id", True),
        "sparse_lists": _segment_sql(_SPARSE_ID, False),
        "sparse_lists_tf": _segment_sql(_SPARSE_ID, True),
        "decode_id": decoded,
        "decode_tf": decoded,
        "decode_range": f"{decoded} WHERE doc_id BETWEEN {ID_RANGE[0]} AND {ID_RANGE[1]}",
        "search_or": _page_sql(f"{_TF},{_ONE_QUERY},{_OR.format('tf')}"),
        "search_or_pruned": _page_sql(f"{_TF},{pruned_tf},{_ONE_QUERY},{_OR.format('pruned')}"),
        "search_and": _page_sql(f"{_TF},{_ONE_QUERY},{_AND.format('tf')}"),
        "search_page2": _page_sql(f"{_TF},{_ONE_QUERY},{_OR.format('tf')}", start=10),
        "search_page_deep": _page_sql(f"{_TF},{_BATCH},{_OR.format('tf')}", start=10),
        "search_batch": _page_sql(f"{_TF},{_BATCH},{_OR.format('tf')}"),
        "search_batch_and": _page_sql(f"{_TF},{_BATCH},{_AND.format('tf')}"),
        "document_lookup": f"""SELECT doc_id, text, lower(source) AS title FROM documents
            WHERE doc_id IN ({_LOOKED_UP})""",
        "term_documents_tf": _term_page_sql("tf DESC, doc_id"),
        "term_documents_deep": _term_page_sql("tf DESC, doc_id"),
        "term_documents_id": _term_page_sql("doc_id"),
        "snippets": _SNIPPETS,
        "word_count": r"""SELECT word, count(*)::BIGINT AS n FROM (
            SELECT unnest(regexp_split_to_array(text, '[ \t\n\r\f]+')) AS word FROM documents)
            WHERE word <> '' GROUP BY word""",
        "word_count_skip": f"SELECT word, count(*)::BIGINT AS n FROM {_SKIP_WORDS} GROUP BY word",
        "input_words": f"SELECT count(*)::BIGINT AS input_words FROM {_SKIP_WORDS}",
        "xml_roundtrip": f"""SELECT doc_id, 'page ' || lower(lang) || ' ' || doc_id AS title,
            '2023-06-15t08:30:00z' AS ts, {_ESCAPED} AS text FROM documents WHERE length(text) > 0""",
        "xml_without_ids": f"""SELECT doc_id, 'page ' || doc_id AS title, {_ESCAPED} AS text
            FROM documents WHERE length(text) > 0 AND doc_id % 5 NOT IN (0, 1)""",
        "xml_metadata": f"SELECT {_METADATA}, sha256({_ESCAPED}) AS text_sha256 {_WITH_METADATA}",
        "metadata_lines": f"""SELECT {_METADATA}, NULL::VARCHAR AS rejected {_WITH_METADATA}
            UNION ALL SELECT -1, NULL, NULL, NULL, NULL, -1, r_regionkey || chr(9) || 'a,b' FROM region""",
        "xml_page_offsets": f"""SELECT octet_length(encode(page))::BIGINT AS page_bytes, sha256(page) AS page_sha256
            FROM (SELECT {_PAGE} AS page FROM documents)""",
        "search_nothing": _page_sql(f"{_TF},{_ONE_QUERY},{_OR.format('tf')}") + " AND false",
        "search_exported_lists": _page_sql(f"{_TF},{_ONE_QUERY},{_AND.format('tf')}"),
        "stored_search_or": _page_sql(f"{_TF},{_ONE_QUERY},{_OR.format('tf')}"),
        "stored_search_and": _page_sql(f"{_TF},{_ONE_QUERY},{_AND.format('tf')}"),
        "stored_search_batch": _page_sql(f"{_TF},{_BATCH},{_OR.format('tf')}"),
        "stored_search_batch_and": _page_sql(f"{_TF},{_BATCH},{_AND.format('tf')}"),
        "stored_tf_idf": _page_sql(f"{_TF},{_ONE_QUERY},{_TF_IDF}"),
        "stored_top_terms": f"""WITH {_TF},{_PRUNED.format('tf', **INDEX_CAPS)},
            n AS (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term)
            SELECT term, doc_id, tf, df FROM pruned JOIN n USING (term)""",
        "stored_search_pruned": _page_sql(
            f"{_TF},{_PRUNED.format('tf', **INDEX_CAPS)},{_ONE_QUERY},{_OR.format('pruned')}"
        ),
        "stored_term_documents": _term_page_sql("tf DESC, doc_id"),
        "stored_snippets": _SNIPPETS,
        "sorted_index_order": f"""WITH {_TF}
            SELECT 'documents' AS table_name, count(*)::BIGINT AS n_rows, 0::BIGINT AS out_of_order FROM documents
            UNION ALL SELECT 'postings', count(*)::BIGINT, 0::BIGINT FROM tf""",
        "snippets_of_hits": _SNIPPETS,
        "observed_words": f"SELECT count(*)::BIGINT AS input_words FROM {_SKIP_WORDS}",
        "word_count_skip_file": """WITH RECURSIVE
            found AS (SELECT DISTINCT p FROM (SELECT unnest(string_split(lower(text), ' ')) AS p FROM benchmark)
                      WHERE regexp_full_match(p, '[a-z]{2}')),
            listed AS (SELECT p, row_number() OVER (ORDER BY p) AS i FROM found),
            cleaned AS (SELECT lower(text) AS line, 0::BIGINT AS i FROM conversations
                        UNION ALL SELECT replace(line, p, ''), c.i + 1 FROM cleaned c JOIN listed l ON l.i = c.i + 1)
            SELECT word, count(*)::BIGINT AS n FROM (
                SELECT unnest(regexp_split_to_array(line, '[ \\t\\n\\r\\f]+')) AS word FROM cleaned
                WHERE i = (SELECT count(*) FROM listed)) WHERE word <> '' GROUP BY word""",
        "tf_idf": _page_sql(f"{_TF},{_ONE_QUERY},{_TF_IDF}"),
        "redirects": f"WITH {_REDIRECTS} SELECT * FROM led",
        "search_redirected": f"""WITH {_REDIRECTS}, page AS ({_page_sql(f"{_TF},{_ONE_QUERY},{_OR.format('tf')}", amount=100)})
            SELECT query_id, number, 'page ' || doc_id AS title, doc_id, score, url,
                   CASE WHEN l.title IS NULL THEN 'page ' || doc_id ELSE l.target END AS resolved_title
            FROM page LEFT JOIN led l ON l.title = 'page ' || doc_id""",
        "corpus_size": "SELECT count(*)::BIGINT AS n_documents FROM documents",
        "stop_words": f"WITH {_TF} SELECT term, doc_id, tf FROM tf WHERE term NOT IN ({_STOP_LIST})",
        "stop_words_common": f"""WITH {_TF} SELECT term, doc_id, tf FROM tf WHERE term NOT IN (
            SELECT term FROM tf GROUP BY term
            HAVING count(*) > {COMMON_RATIO} * (SELECT count(*) FROM documents))""",
    }
