"""Chains and cycles of titles."""

import random

from pyspark.sql import functions as F

from termloom.operators.redirects import follow_titles, read_redirects, resolve_redirects
from termloom.sources.xml_pages import read_pages


def plain_ends(links):
    first = {}
    for title, target in links:
        if title is not None and target is not None:
            first[title] = min(target, first.get(title, target))
    out = {}
    for title in first:
        at, steps = title, 0
        while at in first and steps <= len(first):
            at, steps = first[at], steps + 1
        out[title] = (None, None) if at in first else (at, steps)
    return out


def found(spark, links):
    rows = resolve_redirects(spark.createDataFrame(links, "title string, target string")).collect()
    assert len({r.title for r in rows}) == len(rows)
    return {r.title: (r.target, r.steps) for r in rows}


def test_chains_cycles_and_odd_links(spark):
    links = [(f"c{i}", f"c{i + 1}") for i in range(37)]
    links += [("a", "b"), ("b", "a"), ("into", "a"), ("self", "self"), ("two", "z"), ("two", "c36"), (None, "x"), ("x", None)]
    links += [(f"hot{i}", "c0") for i in range(50)]
    assert found(spark, links) == plain_ends(links)
    r = random.Random(3)
    links = [(f"t{r.randrange(80)}", f"t{r.randrange(120)}") for _ in range(90)]
    assert found(spark, links) == plain_ends(links)
    assert found(spark, []) == {}


def test_titles_of_rows_follow(spark):
    resolved = resolve_redirects(spark.createDataFrame([("a", "b"), ("b", "c"), ("o", "o")], "title string, target string"))
    rows = spark.createDataFrame([(1, "a"), (2, "c"), (3, "o"), (4, None)], "doc_id int, title string")
    got = {r.doc_id: r.resolved_title for r in follow_titles(rows, resolved).collect()}
    assert got == {1: "c", 2: "c", 3: None, 4: None}


def test_redirects_of_a_dump(spark, tmp_path):
    page = '<page>\n<title>{}</title>\n<id>1</id>\n{}<revision><text>x</text></revision>\n</page>\n'
    text = page.format("Old Name", '<redirect title="New &amp; Name" />\n') + page.format("New", "")
    (tmp_path / "d.xml").write_text(text)
    rows = read_redirects(read_pages(spark, str(tmp_path / "d.xml"))).select(F.struct("title", "target")).collect()
    assert [tuple(r[0]) for r in rows] == [("old name", "new &amp; name")]
