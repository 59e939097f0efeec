"""Each stage of the pipeline against what it must keep."""

from collections import Counter

import pytest

import corpus_pipeline as pipeline
from termloom.llm import bpe, ngram_jaccard, pii, queries, quality_classifier
from termloom.session import staged
from tests.llm.test_joins import plain_components
from tests.llm.test_mixing_models import PATH, plain_targets

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def outputs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = [docs]
    for _, stage in pipeline.STAGES:
        found.append(staged(stage(spark, found[-1], SF), "stage"))
    return found


def test_columns_and_order(outputs):
    assert [frame.columns for frame in outputs[:-1]] == [outputs[0].columns] * 5
    assert len(pipeline.STAGES) == 5 and pipeline.ORACLE_SQL is None


def test_rejected_documents_go(spark, outputs):
    model = queries.quality_model(spark, SF, outputs[0])
    good = quality_classifier.score(outputs[0], model, keep=["doc_id"]).filter(f"score >= {queries.KEEP_FROM}")
    assert {r[0] for r in outputs[1].select("doc_id").collect()} == {r["doc_id"] for r in good.collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1")
    lost = labels.join(outputs[0], "doc_id").join(outputs[1], "doc_id", "left_anti").count()
    assert lost <= 0.02 * labels.count()


def test_one_of_each_group_stays(outputs):
    rows = [tuple(r) for r in outputs[1].select("doc_id", "text").collect()]
    want = sorted(d for d, (_, first) in plain_components(rows, 5, 80).items() if d == first)
    assert sorted(r[0] for r in outputs[2].select("doc_id").collect()) == want


def test_personal_data_is_masked(outputs):
    before = {r["doc_id"]: r["text"] for r in outputs[2].collect()}
    after = outputs[3].collect()
    assert len(after) == len(before)
    for row in after:
        assert row["text"] == pii.redact(before[row["doc_id"]], pii.find_spans(before[row["doc_id"]]))
        assert row["n_chars"] == len(row["text"])


def test_sources_come_near_their_targets(outputs):
    def sizes(frame):
        out = Counter()
        for row in frame.collect():
            out[row["source"]] += len(row["text"].split())
        return out

    want, got = plain_targets(sizes(outputs[3])), sizes(outputs[4])
    largest = max(len(r["text"].split()) for r in outputs[3].collect())
    assert all(abs(got[source] - goal) <= largest for source, goal in want.items())


def test_every_row_is_encoded(outputs):
    own = bpe.Encoder(PATH)
    want = Counter((r["doc_id"], own.words([r["text"].encode()])[0]) for r in outputs[4].collect())
    assert Counter((r["doc_id"], bytes(r["ids"])) for r in outputs[5].collect()) == want


ODD = [(1, None), (2, ""), (3, "\n"), (4, "one two"), (4, "one two"), (None, "one two"), (None, None), (5, "w " * 30_000)]


@pytest.mark.parametrize("number", range(5))
@pytest.mark.parametrize("rows", [ODD, []], ids=["odd", "empty"])
def test_odd_tables(spark, table, tables, number, rows):
    docs = table(rows)
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 0), (None, None, None)], "doc_id bigint, quality int, toxic int")
    path = tables(documents=docs, labels=labels)
    out = pipeline.STAGES[number][1](spark, docs, path)
    kept = Counter(r["doc_id"] for r in out.collect())
    if number < 4:
        assert out.columns == docs.columns
    if number == 1 and rows:  # repeated rows are one, rows without words or id stay
        assert kept == Counter({1: 1, 2: 1, 3: 1, 4: 1, None: 2, 5: 1})
    if number in (2, 4):
        assert kept == Counter(r[0] for r in rows)


def test_run_is_registered(spark):
    import __spark_entry__ as registry

    assert registry.queries()["pipeline"] is pipeline.run
    assert pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
    assert ngram_jaccard.Rule(5, 80).percent == 80


def test_columns_with_the_names_of_a_stage_keep_their_values(spark, tables):
    schema = (
        "doc_id bigint, text string, lang string, source string, n_chars bigint, passes int, threshold string, "
        "place double, score string, Copies int, target boolean, source_size string, copy int"
    )
    own = (5, "t", 0.5, "s", 3, True, "big", 8)
    rows = [(i, f"text number {i} of some words", "en", "ab"[i % 2], 7, *own) for i in range(40)]
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id bigint, quality int, toxic int")
    sf_dir = tables(documents=docs, labels=labels)
    for _, stage in pipeline.STAGES[:-1]:
        found = stage(spark, docs, sf_dir)
        assert found.columns == docs.columns
        assert {tuple(r[5:]) for r in found.collect()} <= {own}
        assert found.count() or stage is pipeline.keep_quality
