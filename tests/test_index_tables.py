"""The stored index answers as the unstored postings do, from few row groups."""

import pytest
from pyspark.sql import functions as F

from termloom.operators.postings import build_postings, prune_postings
from termloom.operators.search import search
from termloom.plans.index_tables import index_dump, open_index, write_index
from tests.dumps import small_dump


@pytest.fixture(scope="module")
def documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return docs.select("doc_id", "text", F.col("source").alias("title"))


@pytest.fixture(scope="module")
def index(spark, documents, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / "tables")
    write_index(spark, documents, path, max_term_length=8, max_postings=50)
    return open_index(spark, path)


@pytest.mark.parametrize("pruned", [False, True])
@pytest.mark.parametrize("mode", ["or", "and"])
def test_same_answers(documents, index, mode, pruned):
    postings = build_postings(documents, positions=False)
    if pruned:
        postings = prune_postings(postings, max_term_length=8, max_postings=50)
    want = search(postings, "the and that", mode, documents=documents).collect()
    got = index.search("the and that", mode, pruned=pruned).collect()
    assert [r.number for r in got] == list(range(10))
    assert [(r.doc_id, r.title, round(r.score, 9)) for r in got] == [
        (r.doc_id, r.title, round(r.score, 9)) for r in want
    ]


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_terms_and_ids_reach_the_scans(index):
    assert "PushedFilters: [In(term, [and,the])" in plan_of(search(index.postings, "the and", "and"))
    assert "PushedFilters: [In(doc_id, [" in plan_of(index.get([1, 2]))


def test_browsing_the_stored_index(documents, index):
    rows = index.term_documents("the", "id", 0, 3).collect()
    assert [r.number for r in rows] == [0, 1, 2] and all(r.title for r in rows)
    texts = {r.doc_id: r.text for r in documents.collect()}
    found = index.snippets(["the"], [r.doc_id for r in rows], width=7).collect()
    assert found and all(texts[r.doc_id][r.position : r.position + 7] == r.snippet for r in found)


def test_long_pages_and_query_tables_are_joined(spark, index):
    want = [(r.doc_id, r.title) for r in index.search("the", "or").orderBy("number").collect()]
    long = index.search("the", "or", amount=2000).orderBy("number").limit(10).collect()
    table = spark.createDataFrame([(5, "the")], "query_id bigint, query string")
    rows = index.search(table, "or").orderBy("number").collect()
    assert [(r.doc_id, r.title) for r in long] == [(r.doc_id, r.title) for r in rows] == want


def test_no_matches_at_all(index):
    assert index.search("zzzzqqq", "and").count() == 0 and index.search(["", "1"], "or").count() == 0


def test_dump_to_answers(spark, tmp_path):
    (tmp_path / "dump.xml").write_text(small_dump())
    index = index_dump(spark, str(tmp_path / "dump.xml"), str(tmp_path / "index"))
    rows = index.search("quartz glass", "and").orderBy("number").collect()
    assert [(r.doc_id, r.title, r.score) for r in rows] == [(7, "note 7", 2.0), (1003, "note 1003", 2.0)]


def test_a_page_reads_the_row_groups_of_its_documents_only(index):
    plan = index.search("the", "or", amount=3)._jdf.queryExecution().executedPlan().toString()
    assert "In(doc_id" in plan or "EqualTo(doc_id" in plan


def test_dictionary_and_block_maxima(index):
    postings = index.postings.select("term", "doc_id", "tf").collect()
    counts, best = {}, {}
    for r in postings:
        df, high, total = counts.get(r.term, (0, 0, 0))
        counts[r.term] = df + 1, max(high, r.tf), total + r.tf
        key = r.term, r.doc_id >> 7
        best[key] = max(best.get(key, 0), r.tf)
    assert {r.term: (r.df, r.max_tf, r.total_tf) for r in index.terms.collect()} == counts
    assert {(r.term, r.block): r.top for r in index.blocks.collect()} == best
    assert all(r.df == counts[r.term][0] for r in index.top_terms().collect())


def test_snippets_of_a_table_of_ids(spark, index):
    page = index.search("the", "or", amount=2).select("doc_id")
    ids = [r.doc_id for r in page.collect()]
    of_page = {tuple(r) for r in index.snippets(["the"], page).collect()}
    assert of_page == {tuple(r) for r in index.snippets(["THE"], ids).collect()} and of_page
    assert of_page < {tuple(r) for r in index.snippets(["the"]).collect()}


def test_ranges_grow_with_the_rows(spark, monkeypatch):
    from termloom.operators import groups
    from termloom.operators.documents import sorted_by_id
    from termloom.operators.postings import sorted_by_term
    from termloom.operators.search import block_maxima

    monkeypatch.setattr(groups, "RANGE_BYTES", 1 << 13)
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.range(4000).selectExpr("concat('t', id % 3) as term", "4000 - id as doc_id", "id % 7 as tf", "'some text' as text")
    for sort, key in ((sorted_by_id, ("doc_id",)), (sorted_by_term, ("term", "doc_id")), (block_maxima, ("term", "block"))):
        for asked in (None, 2):
            parts = [[tuple(r[k] for k in key) for r in part] for part in sort(rows, asked).rdd.glom().collect()]
            assert max(map(len, parts)) < 1000 and len(parts) > max(most, 20)
            assert [k for part in parts for k in part] == sorted(k for part in parts for k in part)
    assert {tuple(r) for r in block_maxima(rows).collect()} == {
        tuple(r) for r in rows.selectExpr("term", "doc_id div 128 as block", "tf").groupBy("term", "block").max("tf").collect()
    }
    assert len(sorted_by_id(rows.limit(0), 2).collect()) == 0


def test_common_terms_move_no_posting(spark):
    from termloom.operators.postings import build_postings
    from termloom.operators.stopwords import drop_common_terms

    docs = spark.range(20000).selectExpr("id as doc_id", "concat('all ', if(id % 2 = 0, 'half ', ''), 'x') as text")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        kept = drop_common_terms(build_postings(docs, positions=False), docs, 0.6)
        assert "SortMergeJoin" not in kept._jdf.queryExecution().executedPlan().toString()
        assert {tuple(r) for r in kept.groupBy("term").count().collect()} == {("half", 10000)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
