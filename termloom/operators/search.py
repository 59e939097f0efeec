"""Ranked AND / OR keyword search over the postings table.

A document's score is the sum over the query's terms of its frequency divided by a
scale: the term's highest frequency, taken over all its documents (OR) or over the
documents that hold every term (AND).
"""

from __future__ import annotations

import functools
import operator
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions.tokens import distinct_terms
from termloom.operators.groups import range_count, rows_from_ranks, top_per_group
from termloom.session import staged

Queries = str | Sequence[str] | DataFrame

def query_frame(spark: SparkSession, queries: Sequence[str]) -> DataFrame:
    """``(query_id, query)`` from strings, numbered from 0."""
    rows = [
        F.struct(F.lit(i).cast("bigint").alias("query_id"), F.lit(q).alias("query"))
        for i, q in enumerate(queries)
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def query_terms(queries: DataFrame) -> DataFrame:
    """``(query_id, term, n_terms)``: the distinct terms of each query. No shuffle."""
    sets = queries.select("query_id", distinct_terms(F.col("query")).alias("terms"))
    return sets.select(
        "query_id", F.explode("terms").alias("term"), F.size("terms").alias("n_terms")
    )


def literal_terms(queries: Sequence[str]) -> list[str]:
    return sorted({term for q in queries for term in re.findall("[a-z]+", q.lower())})


def _wanted(postings: DataFrame, queries: Queries, *tables: DataFrame) -> tuple[DataFrame, ...]:
    """The query terms, and of each table ``(term, ...)`` the rows of these terms.

    Terms of queries that are given as strings are a literal list, which reaches the
    Parquet scan and skips row groups.
    """
    if isinstance(queries, DataFrame):
        wanted = query_terms(queries)
        terms = wanted.select("term").distinct()
        return wanted, *(table.join(terms, "term", "left_semi") for table in tables)
    texts = [queries] if isinstance(queries, str) else list(queries) or [""]
    literals = literal_terms(texts)
    wanted = query_terms(query_frame(postings.sparkSession, texts))
    known = F.col("term").isin(literals) if literals else F.lit(False)
    return wanted, *(table.filter(known) for table in tables)


def _matches(postings: DataFrame, queries: Queries) -> tuple[DataFrame, DataFrame]:
    """Postings of the queries' terms, dealt out by document, and the query terms."""
    wanted, found = _wanted(postings, queries, postings.select("term", "doc_id", "tf"))
    # Both the scales and the scores read this one exchange.
    return found.repartition("doc_id"), wanted


def or_scores(postings: DataFrame, queries: Queries, terms: DataFrame | None = None) -> DataFrame:
    """``(query_id, doc_id, score)`` of every document that holds any term.

    ``terms (term, max_tf)`` of a stored index saves the look through the postings for scales.
    """
    if terms is None:
        found, wanted = _matches(postings, queries)
        scale = found.groupBy("term").agg(F.max("tf").alias("scale"))
    else:
        columns = postings.select("term", "doc_id", "tf"), terms.select("term", F.col("max_tf").alias("scale"))
        wanted, found, scale = _wanted(postings, queries, *columns)
    scaled = found.join(scale, "term").select("term", "doc_id", (F.col("tf") / F.col("scale")).alias("part"))
    return scaled.join(wanted, "term").groupBy("query_id", "doc_id").agg(F.sum("part").alias("score"))


#: Documents of a block have ids that agree but for so many bits.
BLOCK_BITS = 7
#: Bounds and scores are sums of the same parts in any order.
SLACK = 1e-6


def block_maxima(postings: DataFrame, partitions: int | None = None) -> DataFrame:
    """``(term, block, top)``: the highest frequency of a term within each block of documents.

    Range-partitioned and sorted by (term, block). All of a block's rows of a term are in one range, so
    that no more is shuffled and a task holds the maxima of its range only.
    """
    rows = postings.select("term", F.shiftright("doc_id", BLOCK_BITS).alias("block"), "tf")
    placed = rows.repartitionByRange(*range_count(rows, partitions), "term", "block")
    return placed.groupBy("term", "block").agg(F.max("tf").alias("top")).sortWithinPartitions("term", "block")


def best_or_scores(
    postings: DataFrame,
    queries: Queries,
    best: int,
    terms: DataFrame | None = None,
    blocks: DataFrame | None = None,
) -> DataFrame:
    """Of :func:`or_scores`, the ``best`` of each query at least, ties with the last included.

    A block's highest frequencies bound the score of every document in it. Each query first
    scores the blocks with the highest bounds. The score of its ``best``-th document there
    is a floor, and only blocks whose bound reaches it are opened. Queries meet postings by
    term and block, so that a frequent term is dealt out by its blocks. ``terms`` and
    ``blocks`` are those of a stored index; else they come from the postings, which are
    staged for it.
    """
    columns = postings.select("term", "doc_id", "tf")
    if terms is None or blocks is None:
        wanted, found = _wanted(postings, queries, columns)
        found = staged(found, "wanted-postings")
        scale = found.groupBy("term").agg(F.max("tf").alias("scale"))
        maxima = block_maxima(found)
    else:
        scale = terms.select("term", F.col("max_tf").alias("scale"))
        wanted, found, scale, maxima = _wanted(postings, queries, columns, scale, blocks)
    found = found.withColumn("block", F.shiftright("doc_id", BLOCK_BITS))
    asked = wanted.select("query_id", "term").join(scale, "term")
    bounds = asked.join(maxima, "term").groupBy("query_id", "block").agg(F.sum(F.col("top") / F.col("scale")).alias("bound"))
    bounds = staged(bounds, "block-bounds")

    def scored(opened: DataFrame) -> DataFrame:
        pairs = opened.select("query_id", "block").join(asked, "query_id").join(found, ["term", "block"])
        return pairs.groupBy("query_id", "doc_id").agg(F.sum(F.col("tf") / F.col("scale")).alias("score"))

    # The best documents lie in the best blocks, but a block has often one of them only.
    seeds = top_per_group(
        bounds, ["query_id"], [F.desc("bound"), F.asc("block")], best + 2, rank="_rank", spread_on="block", splits=8
    )
    ranked = top_per_group(
        scored(seeds), ["query_id"], [F.desc("score"), F.asc("doc_id")], best, rank="_rank", spread_on="doc_id", splits=8
    )
    floors = ranked.filter(F.col("_rank") == best).select("query_id", F.col("score").alias("floor"))
    opened = bounds.join(floors, "query_id", "left").filter(F.col("bound") + SLACK >= F.coalesce("floor", F.lit(0.0)))
    return scored(opened)


def and_scores(
    postings: DataFrame, queries: Queries, terms: DataFrame | None = None, blocks: DataFrame | None = None
) -> DataFrame:
    """``(query_id, doc_id, score)`` of every document that holds all terms.

    One query, given as a string, has a column for each of its terms, so that a document's
    frequencies meet in one aggregation. Of several queries, or a table of them, only
    documents with a query's rarest term can hold all: those are its candidates, and the
    other terms are looked up for them. ``terms (term, df)`` of a stored index tells the
    rarest without a look through the postings, ``blocks (term, block)`` which blocks of
    documents hold all terms of one query.
    """
    if isinstance(queries, str):
        return _and_scores_of_one(postings, queries, blocks)
    wanted, found = _wanted(postings, queries, postings.select("term", "doc_id", "tf"))
    if terms is None:
        # The counts, the candidates and the look-up read this.
        found = staged(found, "wanted-postings")
        counts = found.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    else:
        counts = terms.select("term", "df")
    known = wanted.join(counts, "term", "left")
    asked = known.groupBy("query_id").agg(
        F.min_by("term", F.struct(F.coalesce("df", F.lit(0)).alias("df"), "term")).alias("rarest"),
        F.collect_list("term").alias("terms"),
    )
    # A row for each query: stored, so that its size is known, and it is the side that is sent around.
    rare = staged(asked.select("query_id", "terms", F.col("rarest").alias("term")), "rarest-terms")
    candidates = found.join(rare, "term").select("query_id", "doc_id", F.size("terms").alias("n"), F.explode("terms").alias("term"))
    # Stored postings are many times larger in memory than their files say, and are never broadcast.
    matched = candidates.join(found.hint("merge"), ["doc_id", "term"])
    hits = matched.groupBy("query_id", "doc_id").agg(F.collect_list(F.struct("term", "tf")).alias("hits"), F.first("n").alias("n"))
    # A document has as many hits of a query as the query has terms, or it goes.
    whole = hits.filter(F.size("hits") == F.col("n")).select("query_id", "doc_id", F.inline("hits"))
    scale = whole.groupBy("query_id", "term").agg(F.max("tf").alias("scale"))
    return (
        whole.join(scale, ["query_id", "term"])
        .groupBy("query_id", "doc_id")
        .agg(F.sum(F.col("tf") / F.col("scale")).alias("score"))
    )


def _and_scores_of_one(postings: DataFrame, query: str, blocks: DataFrame | None) -> DataFrame:
    literals = literal_terms([query])
    known = F.col("term").isin(literals) if literals else F.lit(False)
    found = postings.select("term", "doc_id", "tf").filter(known)
    if blocks is not None:
        # Where a term is rare, few blocks hold all terms, and only their postings are shuffled.
        held = blocks.filter(known).groupBy("block").agg(F.count(F.lit(1)).alias("n"))
        held = held.filter(F.col("n") == len(literals)).select("block")
        found = found.withColumn("block", F.shiftright("doc_id", BLOCK_BITS)).join(held, "block", "left_semi")
    names = [f"tf_{i}" for i in range(len(literals))]
    by_term = [F.max(F.when(F.col("term") == t, F.col("tf"))).alias(n) for t, n in zip(literals, names, strict=True)]
    whole = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), *by_term).filter(F.col("n") == len(literals))
    scale = whole.agg(F.array(*[F.max(n) for n in names]).alias("scale")).scalar()
    parts = [F.col(n) / F.element_at(scale, i + 1) for i, n in enumerate(names)]
    score = functools.reduce(operator.add, parts, F.lit(0.0))
    return whole.select(F.lit(0).cast("bigint").alias("query_id"), "doc_id", score.alias("score"))


def tf_idf_scores(
    postings: DataFrame, documents: DataFrame, queries: Queries, terms: DataFrame | None = None
) -> DataFrame:
    """Extension: ``sum(tf * ln(N / df))`` over the query's terms, N counting all documents.

    ``terms (term, df)`` of a stored index saves the look through the postings for counts.
    """
    if terms is None:
        found, wanted = _matches(postings, queries)
        counts = found.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    else:
        columns = postings.select("term", "doc_id", "tf"), terms.select("term", "df")
        wanted, found, counts = _wanted(postings, queries, *columns)
    total = corpus_size(documents).scalar()
    weight = counts.select("term", F.log(total / F.col("df")).alias("idf"))
    weighted = found.join(weight, "term").select(
        "term", "doc_id", (F.col("tf") * F.col("idf")).alias("part")
    )
    return (
        weighted.join(wanted, "term")
        .groupBy("query_id", "doc_id")
        .agg(F.sum("part").alias("score"))
    )


def corpus_size(documents: DataFrame) -> DataFrame:
    """Extension: one row, the number of documents."""
    return documents.agg(F.count(F.lit(1)).alias("n_documents"))


#: Pages that begin there, or later, are found by counting.
DEEP_START = 10_000


def result_page(
    scores: DataFrame,
    start: int = 0,
    amount: int = 10,
    documents: DataFrame | None = None,
    title: str = "title",
    deep: int = DEEP_START,
) -> DataFrame:
    """Rows ``[start, start + amount)`` of each query by falling score, ties by id.

    ``(query_id, number, title, doc_id, score, url)``; ``number`` counts from 0 on
    the page, and rows come in its order. A document without metadata keeps its row
    with a null title. A task ranks its first ``start + amount`` rows of a query; for pages
    from ``deep`` on, the first row of the page is found by counting, and a task ranks ``amount``.
    """
    if start >= deep:
        points = F.round(F.round("score", 9) * 1e9).cast("bigint")
        counted = staged(scores.withColumn("_points", points), "scores")
        scores = rows_from_ranks(counted, ["query_id"], [("_points", True), ("doc_id", False)], start, amount).drop("_points")
        start = 0
    last = start + amount
    ranked = top_per_group(
        scores,
        ["query_id"],
        [F.desc(F.round("score", 9)), F.asc("doc_id")],
        last,
        rank="_rank",
        spread_on="doc_id",
    )
    page = ranked.filter(F.col("_rank") > start).select(
        "query_id",
        (F.col("_rank") - F.lit(1 + start)).cast("int").alias("number"),
        "doc_id",
        "score",
        F.concat(F.lit("/document/"), F.col("doc_id").cast("string")).alias("url"),
    )
    if documents is None:
        titled = page.withColumn("title", F.lit(None).cast("string"))
    else:
        page = staged(page, "page")
        titled = page.join(rows_of(documents.select("doc_id", F.col(title).alias("title")), page), "doc_id", "left")
    return titled.select("query_id", "number", "title", "doc_id", "score", "url").orderBy("query_id", "number")


#: Ids of a page that are looked up as a list.
LISTED_IDS = 1000


def rows_of(documents: DataFrame, page: DataFrame) -> DataFrame:
    """The documents of a stored page.

    The ids of a page of usual size are a literal list, which reaches the Parquet scan: of
    documents that are sorted by id, only row groups that can hold one are read.
    """
    ids = [row.doc_id for row in page.select("doc_id").distinct().limit(LISTED_IDS + 1).collect()]
    if len(ids) <= LISTED_IDS:
        return documents.filter(F.col("doc_id").isin(ids) if ids else F.lit(False))
    return documents.join(page.select("doc_id"), "doc_id", "left_semi")


def search(
    postings: DataFrame,
    queries: Queries,
    mode: str = "and",
    start: int = 0,
    amount: int = 10,
    documents: DataFrame | None = None,
    title: str = "title",
    terms: DataFrame | None = None,
    blocks: DataFrame | None = None,
    deep: int = DEEP_START,
) -> DataFrame:
    """Answer one query, several, or a table ``(query_id, query)``.

    ``mode="or"`` ranks documents with any term, everything else means "and".
    Unknown terms match nothing; a query without letters has no rows. ``terms`` and ``blocks``
    are the dictionary and the maxima of a stored index. With both, a table of queries is
    answered in "or" by way of block maxima, so that a pair of a query and a document is
    scored only where the document's block can reach the page.
    """
    if mode.strip().lower() not in ("or", "tf"):
        scores = and_scores(postings, queries, terms, blocks)
    elif isinstance(queries, DataFrame) and terms is not None and blocks is not None and start < deep:
        scores = best_or_scores(postings, queries, start + amount, terms, blocks)
    else:
        scores = or_scores(postings, queries, terms)
    return result_page(scores, start, amount, documents, title, deep)
