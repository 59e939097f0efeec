"""A small dump, with every list and every ranking worked out by plain arithmetic."""

import pytest

from termloom.operators.documents import build_documents
from termloom.operators.lists import decode_lists, encode_lists, posting_lists
from termloom.operators.postings import build_postings, prune_postings, scan_postings, term_stats
from termloom.operators.search import search
from termloom.sources.xml_pages import read_pages
from tests.dumps import SMALL_TEXTS, small_dump

ID_ORDER = {
    "and": "6;7-2-7,10;54-2-0,4;34-1-12;155-1-24;150-1-0;603-1-11;",
    "dim": "2;95-1-22;908-1-0;",
    "frogs": "1;250-1-32;",
    "glass": "3;7-1-11;54-1-8;942-1-4;",
    "glow": "2;95-1-6;908-1-22;",
    "lamps": "2;95-3-0,16,11;155-1-18;",
    "nobody": "2;250-1-0;150-1-9;",
    "paints": "1;250-1-7;",
    "quartz": "2;7-1-0;996-1-15;",
    "rest": "1;95-1-33;",
    "spoke": "1;400-1-16;",
    "then": "1;400-1-4;",
    "tin": "2;7-1-21;243-2-14,14;",
}
TF_ORDER = ID_ORDER | {
    "and": "6;7-2-7,10;54-2-0,4;95-1-12;155-1-24;150-1-0;603-1-11;",
    "lamps": "2;95-3-0,16,11;250-1-18;",
    "tin": "2;250-2-14,14;7-1-21;",
}


@pytest.fixture(scope="module")
def documents(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("small") / "dump.xml"
    path.write_text(small_dump())
    return build_documents(read_pages(spark, str(path))).cache()


@pytest.fixture(scope="module")
def postings(documents):
    return build_postings(documents).cache()


def as_lines(lists):
    return {r.term: r.posting_list for r in lists.collect()}


def test_documents(documents):
    rows = {r.doc_id: r for r in documents.collect()}
    assert {k: r.text for k, r in rows.items()} == SMALL_TEXTS
    assert rows[7].title == "note 7" and rows[7].title_raw == "Note 7"
    assert rows[7].contributor.name == "ann" and rows[7].contributor.id == "7"
    assert rows[7].ts == "2021-03-05t09:08:07z" and rows[7].edited_at.year == 2021


def test_regex_extraction_drops_the_page_with_a_tag_over_several_lines(spark, tmp_path):
    path = tmp_path / "dump.xml"
    path.write_text(small_dump())
    documents = build_documents(read_pages(spark, str(path)), text_mode="regex")
    lists = as_lines(posting_lists(build_postings(documents), "id", positions=False))
    assert lists["and"].startswith("5;") and lists["glass"] == "2;7-1;1003-1;"


@pytest.mark.parametrize("long_texts", [False, True])
def test_lists_in_id_order(documents, long_texts):
    assert as_lines(encode_lists(build_postings(documents, long_texts=long_texts), "id")) == ID_ORDER


def test_lists_in_tf_order(postings):
    assert as_lines(encode_lists(postings, "tf_id")) == TF_ORDER
    assert as_lines(encode_lists(prune_postings(postings), "tf_id")) == TF_ORDER


def test_plain_lists(postings):
    assert as_lines(posting_lists(postings, "tf"))["tin"] == "2;250-2-14,28;7-1-21;"
    assert as_lines(posting_lists(postings, "id"))["and"] == "6;7-2-7,17;61-2-0,4;95-1-12;250-1-24;400-1-0;1003-1-11;"
    assert as_lines(posting_lists(postings, "id", positions=False))["lamps"] == "2;95-3;250-1;"


def test_frequency_only_builds_agree(documents, postings):
    want = {(r.term, r.doc_id, r.tf) for r in postings.collect()}
    for other in (build_postings(documents, positions=False), scan_postings(documents)):
        assert {(r.term, r.doc_id, r.tf) for r in other.collect()} == want


def test_term_stats(postings):
    stats = {r.term: (r.df, r.total_tf, r.max_tf) for r in term_stats(postings).collect()}
    assert stats["and"] == (6, 8, 2) and stats["lamps"] == (2, 4, 3) and stats["rest"] == (1, 1, 1)


@pytest.mark.parametrize("order", ["id", "tf", "tf_id"])
def test_decoding_gives_the_postings_back(postings, order):
    got = {(r.term, r.doc_id, r.tf, tuple(r.positions)) for r in decode_lists(encode_lists(postings, order), order).collect()}
    assert got == {(r.term, r.doc_id, r.tf, tuple(r.positions)) for r in postings.collect()}


LAMPS = [(95, 1.0), (250, 1 / 3)]
RANKINGS = [
    ("lamps", LAMPS, LAMPS),
    ("lamps tin", [(250, 4 / 3), (95, 1.0), (7, 0.5)], [(250, 2.0)]),
    ("tin glass", [(7, 1.5), (61, 1.0), (250, 1.0), (1003, 1.0)], [(7, 2.0)]),
    ("quartz", [(7, 1.0), (1003, 1.0)], [(7, 1.0), (1003, 1.0)]),
    ("nobody rest", [(95, 1.0), (250, 1.0), (400, 1.0)], []),
    ("TIN: tin", [(250, 1.0), (7, 0.5)], [(250, 1.0), (7, 0.5)]),
    ("and lamps dim", [(95, 2.5), (1003, 1.5), (7, 1.0), (61, 1.0), (250, 5 / 6), (400, 0.5)], [(95, 3.0)]),
    ("77 !", [], []),
    ("lamps zzz", LAMPS, []),
    ("", [], []),
]


def pairs(rows):
    return [(r.doc_id, pytest.approx(r.score)) for r in rows]


@pytest.mark.parametrize("query,either,both", RANKINGS)
def test_rankings(postings, documents, query, either, both):
    for mode, want in (("or", either), ("and", both)):
        rows = search(postings, query, mode, documents=documents).collect()
        assert pairs(rows) == want
        assert [r.number for r in rows] == list(range(len(want)))
        assert all(r.url == f"/document/{r.doc_id}" and r.title == f"note {r.doc_id}" for r in rows)


@pytest.mark.parametrize("as_table", [False, True])
def test_many_queries_in_one_job(spark, postings, as_table):
    texts = [q for q, _, _ in RANKINGS]
    queries = texts
    if as_table:
        queries = spark.createDataFrame(list(enumerate(texts)), "query_id bigint, query string")
    for mode, column in (("or", 1), ("and", 2)):
        got = {}
        for r in search(postings, queries, mode).collect():
            got.setdefault(r.query_id, []).append((r.doc_id, pytest.approx(r.score)))
        assert got == {i: case[column] for i, case in enumerate(RANKINGS) if case[column]}


def test_pages_of_results(postings):
    rows = search(postings, "and lamps dim", "or", start=1, amount=2).collect()
    assert [(r.number, r.doc_id) for r in rows] == [(0, 1003), (1, 7)]
    deep = search(postings, "and lamps dim", "or", start=0, amount=5000).collect()
    assert [r.doc_id for r in deep] == [95, 1003, 7, 61, 250, 400]


def test_result_without_metadata_keeps_its_row(postings, documents):
    rows = search(postings, "quartz", "and", documents=documents.filter("doc_id = 7")).collect()
    assert [(r.doc_id, r.title) for r in rows] == [(7, "note 7"), (1003, None)]
