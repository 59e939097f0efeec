"""Lookups by document or term, and text around term positions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.functions.tokens import cutter, term_positions
from termloom.operators.groups import rows_from_rank
from termloom.operators.search import DEEP_START, rows_of
from termloom.session import staged


def get_documents(documents: DataFrame, ids: Sequence[int]) -> DataFrame:
    """The documents with these ids; unknown ids have no row. The filter reaches the scan."""
    return documents.filter(F.col("doc_id").isin([int(i) for i in ids]))


def term_documents(
    postings: DataFrame,
    documents: DataFrame,
    term: str,
    order: str = "tf",
    start: int = 0,
    amount: int = 10,
    deep: int = DEEP_START,
) -> DataFrame:
    """One page of a term's documents, by falling frequency or by id.

    ``(number, doc_id, tf, <other document columns>)``, ``number`` counting from 0
    over the whole list. Each task keeps its first ``start + amount`` rows only; for pages
    from ``deep`` on, the place of the page is found by counting first, and a task keeps
    ``amount`` rows. A document without a row in ``documents`` keeps its place, with nulls.
    """
    by = [F.asc("doc_id")] if order == "id" else [F.desc("tf"), F.asc("doc_id")]
    hits, before = postings.filter(F.col("term") == term.lower()).select("doc_id", "tf"), start
    if start >= deep:
        keys = [("doc_id", False)] if order == "id" else [("tf", True), ("doc_id", False)]
        hits, before = rows_from_rank(staged(hits, "hits"), keys, start)
    page = hits.orderBy(*by).offset(before).limit(amount)
    # At most ``amount`` rows are left: they are found once, and ordering them in one group is cheap.
    page = staged(page, "page")
    numbered = page.withColumn(
        "number", (F.row_number().over(Window.orderBy(*by)) - 1 + start).cast("int")
    )
    columns = [c for c in documents.columns if c != "doc_id"]
    return numbered.join(rows_of(documents, page), "doc_id", "left").select("number", "doc_id", "tf", *columns).orderBy("number")


def snippets(hits: DataFrame, documents: DataFrame, width: int = 10) -> DataFrame:
    """``(doc_id, term, position, snippet)``: ``width`` characters from each position on.

    ``hits`` are postings with positions, usually of a result page. The text is cut
    inside its own row, so no row repeats it.
    """
    per_document = hits.groupBy("doc_id").agg(
        F.collect_list(F.struct("term", "positions")).alias("found")
    )
    joined = per_document.join(documents.select("doc_id", "text"), "doc_id")

    def cut_all(cut: Callable[[Column, int], Column]) -> Column:
        def around(hit: Column) -> Column:
            return F.transform(
                hit["positions"],
                lambda position: F.struct(
                    hit["term"].alias("term"), position.alias("position"), cut(position, width).alias("snippet")
                ),
            )

        return F.flatten(F.transform("found", around))

    return joined.select("doc_id", F.inline(cutter(F.col("text"), cut_all)))


def text_snippets(documents: DataFrame, terms: Sequence[str], width: int = 10) -> DataFrame:
    """The same rows for terms of documents without an index, cut in the row that holds the text."""
    wanted = sorted({term.lower() for term in terms})

    def cut_all(cut: Callable[[Column, int], Column]) -> Column:
        hits = F.filter(term_positions(F.col("text")), lambda hit: hit["term"].isin(wanted))
        return F.transform(
            hits,
            lambda hit: F.struct(
                hit["term"].alias("term"),
                hit["position"].alias("position"),
                cut(hit["position"], width).alias("snippet"),
            ),
        )

    return documents.select("doc_id", F.inline(cutter(F.col("text"), cut_all)))
