"""Page markup, byte offsets and text files."""

import bz2

import pytest
from pyspark.sql import functions as F

from termloom.operators.documents import build_documents, document_metadata
from termloom.operators.lists import decode_lists, encode_lists
from termloom.operators.postings import build_postings, prune_postings
from termloom.plans import export_jobs
from termloom.operators.wordcount import word_count
from termloom.sources import text_files
from termloom.sources.xml_pages import read_chunks, read_page_offsets, read_pages
from tests.dumps import LONG_WORD, SMALL_TEXTS, edge_dump, small_dump
from tests.dumps import page as page_markup


@pytest.fixture
def tiny_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.fixture
def edge_path(tmp_path):
    path = tmp_path / "edge.xml"
    path.write_text(edge_dump(), encoding="utf-8")
    return path


def assert_offsets(rows, files):
    for r in rows:
        raw = files[r.file_name]
        assert raw[r.byte_offset : r.byte_offset + 6] == b"<page>"
        assert raw[: r.byte_offset + r.page_bytes].endswith(b"</page>")


def test_pages_and_offsets_across_splits(spark, tmp_path, tiny_splits):
    dumps = {"a.xml": small_dump() * 3, "b.xml": edge_dump()}
    for name, text in dumps.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    files = {name: text.encode() for name, text in dumps.items()}
    chunks = read_chunks(spark, str(tmp_path))
    assert chunks.rdd.getNumPartitions() > 8
    rows = read_page_offsets(spark, str(tmp_path)).filter(F.col("file_name") == "a.xml").collect()
    assert len(rows) == 18
    assert_offsets(rows, files)
    pages = read_pages(spark, str(tmp_path)).filter(F.col("file_name") == "a.xml").collect()
    assert len(pages) == 18 and all(p.page.startswith("<page>") and p.page.endswith("</page>") for p in pages)


def test_offsets_in_compressed_dump_are_those_of_the_plain_file(spark, tmp_path):
    plain = small_dump().encode()
    (tmp_path / "dump.xml.bz2").write_bytes(bz2.compress(plain))
    rows = read_page_offsets(spark, str(tmp_path)).collect()
    assert len(rows) == 6
    assert_offsets(rows, {"dump.xml.bz2": plain})


def test_edge_pages(spark, edge_path):
    documents = build_documents(read_pages(spark, str(edge_path)))
    rows = {r.doc_id: r for r in documents.collect()}
    assert set(rows) == {5, 6, 7, 8, 9, 13, 14}
    assert rows[5].contributor is None
    assert (rows[6].contributor.name, rows[6].contributor.id) == ("", "")
    assert rows[7].title == "one, two, three"
    assert rows[8].title == "entités été"
    postings = build_postings(documents).collect()
    terms = {}
    for p in postings:
        terms.setdefault(p.doc_id, {})[p.term] = p.positions
        for position in p.positions:
            text = rows[p.doc_id].text
            assert text[position : position + len(p.term)].lower() == p.term
    assert 13 not in terms
    assert {"lt", "ref", "gt"} <= set(terms[8])
    assert terms[14] == {"word": [4, 16], "clair": [10]}
    assert LONG_WORD in terms[9]
    kept = {r.term for r in prune_postings(build_postings(documents)).collect()}
    assert LONG_WORD not in kept and "short" in kept


def test_metadata_places_every_text(spark, edge_path, tiny_splits):
    raw = edge_path.read_bytes()
    metadata = document_metadata(read_chunks(spark, str(edge_path))).collect()
    texts = {r.doc_id: r.text for r in build_documents(read_pages(spark, str(edge_path))).collect()}
    assert {m.doc_id for m in metadata} == set(texts) - {5}
    for m in metadata:
        assert raw[m.text_start :].decode()[: m.text_len] == texts[m.doc_id]


def test_metadata_lines_there_and_back(spark, edge_path, tmp_path):
    target = str(tmp_path / "meta")
    export_jobs.document_index(spark, str(edge_path), target)
    rows = {r.doc_id: r for r in text_files.read_metadata(spark, target).collect()}
    assert rows[6].contributor_name == "" and rows[6].contributor_id == ""
    # Commas of a title are lost; one in a name shifts the fields before it.
    assert rows[7].title == "one two threea" and rows[7].contributor_name == " b"
    assert rows[8].title == "entités été"
    raw = edge_path.read_bytes()
    assert raw[rows[9].text_start :].decode()[: rows[9].text_len].startswith("short")


@pytest.mark.parametrize("segment_rows", [100_000, 1])
def test_exported_lists_are_read_and_decoded(spark, tmp_path, tiny_splits, segment_rows):
    dump = tmp_path / "dump.xml"
    dump.write_text(small_dump())
    postings = build_postings(build_documents(read_pages(spark, str(dump))))
    lists = encode_lists(postings, "id", segment_rows=segment_rows, block_bits=1)
    text_files.write_lists(lists, str(tmp_path / "lists"))
    back = text_files.read_lists(spark, str(tmp_path / "lists"))
    want = {(r.term, r.segment, r.posting_list) for r in lists.collect()}
    assert {tuple(r) for r in back.collect()} == want
    decoded = decode_lists(back, "id")
    assert {(r.term, r.doc_id, r.tf) for r in decoded.collect()} == {(r.term, r.doc_id, r.tf) for r in postings.collect()}


def test_bad_metadata_lines_are_kept_apart(spark, tmp_path):
    lines = ["1\tt,n,i,ts,5,6", "2", "x\tt,n,i,ts,5,6", "3\ta,b", "", "4\tt,n,i,ts,five,6"]
    (tmp_path / "meta.txt").write_text("\n".join(lines))
    rows = text_files.read_metadata(spark, str(tmp_path / "meta.txt")).collect()
    assert [r.doc_id for r in rows if r.rejected is None] == [1]
    assert sorted(r.rejected for r in rows if r.rejected is not None) == sorted(lines[1:])


def test_tags_in_any_case(spark):
    page = page_markup("21", "İstanbul Text", title="A Title")
    for tag in ("id", "title", "text", "contributor", "username", "timestamp"):
        page = page.replace(f"<{tag}", f"<{tag.upper()}").replace(f"</{tag}", f"</{tag.upper()}")
    for mode in ("index", "regex"):
        (row,) = build_documents(spark.createDataFrame([(page,)], "page string"), text_mode=mode).collect()
        assert (row.doc_id, row.title, row.contributor.name, row.text) == (21, "a title", "ann", "İstanbul Text")


def test_export_jobs_write_the_expected_lines(spark, tmp_path):
    dump = tmp_path / "dump.xml"
    dump.write_text(small_dump())

    def lines(name):
        return {r.value for r in spark.read.text(str(tmp_path / name)).collect()}

    export_jobs.inverted_index(spark, str(dump), str(tmp_path / "tf"))
    assert "lamps\t2;95-3;250-1;" in lines("tf")
    export_jobs.positional_index(spark, str(dump), str(tmp_path / "pos"), order="tf_id")
    assert "tin\t2;250-2-14,28;7-1-21;" in lines("pos")
    export_jobs.lossy_index(spark, str(dump), str(tmp_path / "lossy"), max_postings=2)
    assert "and\t2;7-2-7,10;54-2-0,4;" in lines("lossy")
    export_jobs.document_index(spark, str(dump), str(tmp_path / "meta"))
    assert len(lines("meta")) == 6
    export_jobs.count_words(spark, str(dump), str(tmp_path / "words"))
    assert "<page>\t6" in lines("words")


def test_duplicate_ids_keep_the_newest(spark):
    old, new = small_dump(), small_dump().replace("2021-03", "2022-03").replace("spoke", "sang")
    chunk = [(p + "</page>",) for p in (old + new).split("</page>") if "<page>" in p]
    raw = spark.createDataFrame(chunk, "page string")
    rows = {r.doc_id: r.text for r in build_documents(raw, dedupe=True).collect()}
    assert rows == SMALL_TEXTS | {400: "And then nobody sang."}


def test_skip_patterns_are_distinct_and_sorted(spark, tmp_path):
    (tmp_path / "skip.txt").write_text("to\n,\nto\n\\.\n")
    rows = text_files.read_skip_patterns(spark, str(tmp_path / "skip.txt"))
    assert sorted(r.pattern for r in rows.collect()) == [",", "\\.", "to"]


def test_many_patterns_are_no_part_of_the_plan(spark, tmp_path):
    patterns = [f"q{i}z" for i in range(20_000)] + ["b+", "b"]
    (tmp_path / "skip.txt").write_text("\n".join(patterns))
    lines = spark.createDataFrame([("abbc q7z xq19999zy q20000z",)], "value string")
    counted = word_count(lines, True, text_files.read_skip_patterns(spark, str(tmp_path / "skip.txt")))
    assert "q77z" not in counted._jdf.queryExecution().toString()
    assert {r.word: r.n for r in counted.collect()} == {"ac": 1, "xy": 1, "q20000z": 1}


def test_a_page_is_put_in_plain_case_once(spark):
    """Not again for the filter and for each field."""
    pages = spark.createDataFrame([("<page><ID>3</ID><Title>A</Title><TEXT x='y'>Some <b>T</b></TEXT></page>",), (None,), ("",)], "page string")
    docs = build_documents(pages)
    assert docs._jdf.queryExecution().optimizedPlan().toString().count("translate(") == 1
    assert [(r.doc_id, r.title, r.contributor, r.text) for r in docs.collect()] == [(3, "a", None, "Some <b>T</b>")]
