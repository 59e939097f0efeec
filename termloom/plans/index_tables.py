"""The stored index: Parquet tables that searches read."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.operators.browse import get_documents, snippets, term_documents
from termloom.operators.documents import build_documents, sorted_by_id
from termloom.operators.postings import build_postings, prune_postings, sorted_by_term, term_stats
from termloom.operators.search import Queries, block_maxima, result_page, search, tf_idf_scores
from termloom.session import staged
from termloom.sources.xml_pages import read_pages


@dataclass(frozen=True)
class IndexTables:
    """``postings`` and ``documents`` are whole; ``top_postings`` holds each term's best.

    ``terms`` is the dictionary: document count, highest and total frequency of every term, also
    of those whose postings are pruned. ``blocks`` has the highest frequency of a term within
    each block of documents.
    """

    documents: DataFrame
    postings: DataFrame
    top_postings: DataFrame
    terms: DataFrame
    blocks: DataFrame

    def search(
        self, queries: Queries, mode: str = "and", start: int = 0, amount: int = 10, pruned: bool = False
    ) -> DataFrame:
        """A page of results. ``pruned`` reads the best postings of each term only."""
        if pruned:
            return search(self.top_postings, queries, mode, start, amount, self.documents)
        tables = {"terms": self.terms, "blocks": self.blocks}
        return search(self.postings, queries, mode, start, amount, self.documents, **tables)

    def tf_idf(self, queries: Queries, start: int = 0, amount: int = 10) -> DataFrame:
        """A page of results by tf-idf, with document counts from the dictionary."""
        scores = tf_idf_scores(self.postings, self.documents, queries, self.terms)
        return result_page(scores, start, amount, self.documents)

    def top_terms(self) -> DataFrame:
        """The pruned postings with the true document count of each term beside them."""
        return self.top_postings.join(self.terms.select("term", "df"), "term")

    def get(self, ids: Sequence[int]) -> DataFrame:
        """The documents with these ids."""
        return get_documents(self.documents, ids)

    def term_documents(self, term: str, order: str = "tf", start: int = 0, amount: int = 10) -> DataFrame:
        """A page of the documents that hold a term."""
        return term_documents(self.postings, self.documents.drop("text"), term, order, start, amount)

    def snippets(
        self, terms: Sequence[str], ids: Sequence[int] | DataFrame | None = None, width: int = 10
    ) -> DataFrame:
        """Text around every place of the terms: in all documents, in those with these ids, or in
        those of a table with a ``doc_id``, such as a page of results. Only these texts are read."""
        hits = self.postings.filter(F.col("term").isin([term.lower() for term in terms]))
        if isinstance(ids, DataFrame):
            hits = hits.join(ids.select("doc_id").distinct(), "doc_id", "left_semi")
        elif ids is not None:
            hits = hits.filter(F.col("doc_id").isin([int(i) for i in ids]))
        return snippets(hits, self.documents, width)


def write_index(
    spark: SparkSession, documents: DataFrame, path: str, partitions: int | None = None, **caps
) -> IndexTables:
    """Write documents, postings, pruned postings, the dictionary and block maxima below ``path`` and open them.

    Each table is read back before the next is derived from it, so no stage depends on a
    long lineage and a lost executor costs only its own tasks. Documents are parsed once:
    they are staged in the shared folder before their ranges are found. ``partitions`` is
    the least number of ranges of the sorted tables (default: as many as Spark makes); there are
    more where a task would have much to sort. Maxima are taken within such ranges, too.
    """
    sorted_by_id(staged(documents, "documents"), partitions).write.parquet(f"{path}/documents")
    stored = spark.read.parquet(f"{path}/documents")
    postings = staged(build_postings(stored), "postings")
    sorted_by_term(postings, partitions).write.parquet(f"{path}/postings")
    top = staged(prune_postings(postings.drop("positions"), **caps), "top-postings")
    sorted_by_term(top, partitions).write.parquet(f"{path}/top_postings")
    block_maxima(postings, partitions).write.parquet(f"{path}/blocks")
    dictionary = term_stats(postings)
    dictionary.repartitionByRange(*([partitions] if partitions else []), "term").sortWithinPartitions("term").write.parquet(
        f"{path}/terms"
    )
    return open_index(spark, path)


def open_index(spark: SparkSession, path: str) -> IndexTables:
    return IndexTables(
        documents=spark.read.parquet(f"{path}/documents"),
        postings=spark.read.parquet(f"{path}/postings"),
        top_postings=spark.read.parquet(f"{path}/top_postings"),
        terms=spark.read.parquet(f"{path}/terms"),
        blocks=spark.read.parquet(f"{path}/blocks"),
    )


def index_dump(spark: SparkSession, source: str, path: str, dedupe: bool = False, **caps) -> IndexTables:
    """Index a page dump."""
    documents = build_documents(read_pages(spark, source), dedupe=dedupe)
    return write_index(spark, documents, path, **caps)
