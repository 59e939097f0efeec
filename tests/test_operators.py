"""Tokens, lists, groups, browsing and word counts against plain Python."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation
from pyspark.sql import functions as F

from termloom.functions.codec import running_sums
from termloom.operators import lists
from termloom.operators import postings as postings_module
from termloom.operators.browse import get_documents, snippets, term_documents, text_snippets
from termloom.operators.groups import rows_from_rank, rows_from_ranks, top_per_group
from termloom.operators.lists import decode_lists, encode_lists, posting_lists
from termloom.operators.postings import build_postings, prune_postings, scan_postings, term_stats
from termloom.operators.search import and_scores, best_or_scores, block_maxima, or_scores, result_page, search, tf_idf_scores
from termloom.operators.stopwords import common_terms, drop_common_terms, drop_listed_terms
from termloom.operators.tokens import tokenize_positions, tokenize_positions_in_pieces
from termloom.operators.wordcount import word_count

ALPHABET = "abZ \n\t.,-<&é中\U0001f600" + "0"


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(alphabet=ALPHABET, max_size=60), min_size=1, max_size=30))
def test_positions_match_a_regular_expression(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    want = sorted((i, m.group(), m.start()) for i, t in enumerate(texts) for m in re.finditer("[a-z]+", t.lower()))
    for operator in (tokenize_positions, tokenize_positions_in_pieces):
        assert sorted(tuple(r) for r in operator(docs).collect()) == want


def hot_documents(spark, n=3000):
    """Every document holds ``hot``; a third of them often."""
    word = F.expr("case when id % 3 = 0 then repeat('hot ', 1 + cast(id % 5 as int)) else 'hot ' end")
    rare = F.concat(F.lit("w"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij"))
    return spark.range(n).select(F.col("id").alias("doc_id"), F.concat(word, rare).alias("text"))


@pytest.fixture(scope="module")
def hot(spark):
    return build_postings(hot_documents(spark)).cache()


@pytest.mark.parametrize("order", ["id", "tf_id"])
def test_long_lists_are_cut_into_bounded_lines(hot, order):
    lists = encode_lists(hot, order, segment_rows=500, block_bits=6).cache()
    lines = lists.filter("term = 'hot'").orderBy("segment").collect()
    sizes = [r.posting_list.count(";") - 1 for r in lines]
    assert len(lines) > 3 and max(sizes) <= 500 + 64 and sum(sizes) == 3000
    assert all(r.df == 3000 and r.posting_list.startswith("3000;") for r in lines)
    assert lists.filter("term <> 'hot' and segment > 0").count() == 0
    back = decode_lists(lists, order)
    same = back.intersect(hot.select(*back.columns)).count()
    assert same == hot.count() == back.count()
    # Read line after line, the lists keep their order.
    plain = posting_lists(hot, order, positions=False, segment_rows=500, block_bits=6)
    found = []
    for line in plain.filter("term = 'hot'").orderBy("segment").collect():
        found += [tuple(map(int, p.split("-"))) for p in line.posting_list.rstrip(";").split(";")[1:]]
    want = [(r.doc_id, r.tf) for r in hot.filter("term = 'hot'").collect()]
    key = (lambda p: p[0]) if order == "id" else (lambda p: (-p[1], p[0]))
    assert found == sorted(want, key=key)


@pytest.mark.parametrize("order", ["id", "tf_id"])
def test_lines_are_the_same_for_hashed_ids(hot, order):
    """Ids far apart make blocks of one posting each; lines then hold exactly ``segment_rows``."""
    sparse = hot.withColumn("doc_id", F.shiftleft(F.col("doc_id") * 524287 % 262147, 44))
    lines = encode_lists(sparse, order, segment_rows=500).cache()
    assert [r.posting_list.count(";") - 1 for r in lines.filter("term = 'hot'").collect()] == [500] * 6
    back = decode_lists(lines, order)
    assert back.intersect(sparse.select(*back.columns)).count() == sparse.count() == back.count()


def test_negative_ids_are_refused(hot):
    with pytest.raises(Exception, match="negative doc_id"):
        encode_lists(hot.withColumn("doc_id", -F.col("doc_id") - 1)).collect()


def test_decoding_shuffles_nothing(spark, hot):
    lists = spark.createDataFrame([("a", "2;3-2-1,4;5-1-0;")], "term string, posting_list string")
    for order in ("id", "tf_id"):
        assert "Exchange" not in decode_lists(lists, order)._jdf.queryExecution().executedPlan().toString()


def test_running_sums(spark):
    for n in (1, 63, 64, 65, 200):
        df = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda x: x.cast("bigint")).alias("a"))
        assert df.select(running_sums(F.col("a"))).first()[0] == [k * (k + 1) // 2 for k in range(1, n + 1)]


def test_texts_of_many_pieces(spark):
    text = ("\U0001f600 word é " + "x" * 5000 + " ") * 9
    docs = spark.createDataFrame([(1, text), (2, ""), (3, None)], "doc_id bigint, text string")
    want = sorted((1, m.group(), m.start()) for m in re.finditer("[a-z]+", text))
    assert sorted(tuple(r) for r in tokenize_positions_in_pieces(docs).collect()) == want
    rows = text_snippets(docs, ["Word"], width=6000).collect()
    assert [(r.position, r.snippet) for r in rows] == [(p, text[p : p + 6000]) for _, t, p in want if t == "word"]
    hits = build_postings(docs).filter("term = 'word'")
    assert sorted(rows) == sorted(snippets(hits, docs, 6000).collect())


@pytest.mark.parametrize("n", [1, 7, 900, 1500])
def test_pruning_is_exact_on_a_hot_term(hot, n):
    kept = prune_postings(hot, max_term_length=3, max_postings=n, splits=5)
    assert kept.filter("length(term) > 3").count() == 0
    kept = kept.filter("term = 'hot'")
    got = sorted(((-r.tf, r.doc_id) for r in kept.collect()))
    want = sorted((-r.tf, r.doc_id) for r in hot.filter("term = 'hot'").collect())[:n]
    assert got == want


def test_top_per_group_with_and_without_spreading(spark):
    df = spark.range(2000).select((F.col("id") % 2).alias("g"), (F.col("id") * 7919 % 1009).alias("v"), "id")
    order = [F.desc("v"), F.asc("id")]
    a = top_per_group(df, ["g"], order, 20, "r").collect()
    b = top_per_group(df, ["g"], order, 20, "r", spread_on="id", splits=4).collect()
    assert sorted(a) == sorted(b) and len(a) == 40


def test_postings_add_up(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = build_postings(docs).collect()
    assert sum(r.tf for r in rows) == sum(len(re.findall("[a-z]+", t.lower())) for t in texts.values())
    assert len({(r.term, r.doc_id) for r in rows}) == len(rows)
    for r in rows:
        assert r.tf == len(r.positions)
        assert all(a < b for a, b in zip(r.positions, r.positions[1:]))
        assert all(texts[r.doc_id][p : p + len(r.term)].lower() == r.term for p in r.positions)


def test_browsing(spark, hot):
    docs = hot_documents(spark)
    by_id = term_documents(hot, docs, "HOT", "id", 5, 3).orderBy("number").collect()
    assert [(r.number, r.doc_id) for r in by_id] == [(5, 5), (6, 6), (7, 7)]
    by_tf = term_documents(hot, docs, "hot", "tf", 0, 2).orderBy("number").collect()
    assert [(r.doc_id, r.tf) for r in by_tf] == [(9, 5), (24, 5)]
    assert [r.doc_id for r in get_documents(docs, [4, 99999]).collect()] == [4]


def test_snippets_reach_the_end_of_the_text(spark):
    docs = spark.createDataFrame([(1, "\U0001f600 Alpha beta"), (2, "beta")], "doc_id bigint, text string")
    hits = build_postings(docs).filter("term in ('alpha', 'beta')")
    rows = sorted((r.doc_id, r.term, r.snippet) for r in snippets(hits, docs, 7).collect())
    assert rows == [(1, "alpha", "Alpha b"), (1, "beta", "beta"), (2, "beta", "beta")]


LINES = ["Hello World, Bye World!", "Hello Hadoop, Goodbye to hadoop.", "", " \t "]


@pytest.mark.parametrize("case_sensitive", [True, False])
@pytest.mark.parametrize("skip", [(), (r"\.", ",", "!", "to")])
def test_word_count_and_its_counter(spark, case_sensitive, skip):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    seen = Observation()
    got = {r.word: r.n for r in word_count(lines, case_sensitive, skip, counter=seen).collect()}
    want = Counter()
    for line in LINES:
        line = line if case_sensitive else line.lower()
        for pattern in sorted(skip):
            line = re.sub(pattern, "", line)
        want.update(line.split())
    assert got == dict(want)
    assert seen.get["input_words"] == sum(want.values())


def test_stop_words_and_weights(spark):
    docs = spark.createDataFrame([(1, "the cat the"), (2, "the dog"), (3, "the cat")], "doc_id bigint, text string")
    postings = scan_postings(docs)
    assert {r.term for r in drop_listed_terms(postings, ["The"]).collect()} == {"cat", "dog"}
    assert {r.term for r in drop_common_terms(postings, docs, 0.7).collect()} == {"cat", "dog"}
    scores = {r.doc_id: r.score for r in tf_idf_scores(postings, docs, "the cat dog").collect()}
    assert scores[1] == pytest.approx(0.4054651081) and scores[2] == pytest.approx(1.0986122887)


def test_scans_shuffle_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    whole, wanted = scan_postings(docs).filter("term = 'the'"), scan_postings(docs, ["the"])
    assert sorted(whole.collect()) == sorted(wanted.collect())
    assert "Exchange" not in wanted._jdf.queryExecution().executedPlan().toString()


def test_browsing_keeps_documents_without_metadata(spark, hot):
    docs = hot_documents(spark).filter("doc_id <> 6").withColumn("title", F.lit("t"))
    rows = term_documents(hot, docs.drop("text"), "hot", "id", 5, 3).collect()
    assert [(r.number, r.doc_id, r.title) for r in rows] == [(5, 5, "t"), (6, 6, None), (7, 7, "t")]


def random_postings(spark, documents, seed):
    r = random.Random(seed)
    rows = []
    for term in range(60):
        for doc_id in r.sample(range(documents), max(1, documents // (term + 1))):
            # A few long documents hold the highest frequencies of nearly every term.
            rows.append((f"t{chr(97 + term // 26)}{chr(97 + term % 26)}", doc_id, r.randrange(1, 4) + (60 if doc_id % 997 == 5 else 0)))
    return spark.createDataFrame(rows, "term string, doc_id bigint, tf bigint").repartition(4)


@pytest.mark.parametrize("start,amount", [(0, 10), (7, 4), (0, 300)])
def test_block_maxima_find_the_same_pages(spark, start, amount):
    postings = random_postings(spark, 6000, amount).cache()
    texts = ["taa", "taa tab tac tad", "tbz tca tcb tch taa", "tch", "zzz taa", "zzz", "", "tab tbb tbc"]
    queries = spark.createDataFrame(list(enumerate(texts)), "query_id bigint, query string")
    want = result_page(or_scores(postings, queries), start, amount).select("query_id", "number", "doc_id").collect()
    got = search(postings, queries, "or", start, amount).select("query_id", "number", "doc_id").collect()
    assert got == want
    stored = search(postings, queries, "or", start, amount, terms=term_stats(postings), blocks=block_maxima(postings))
    assert stored.select("query_id", "number", "doc_id").collect() == want


def test_most_pairs_of_query_and_document_are_never_scored(spark):
    postings = random_postings(spark, 20_000, 1).cache()
    queries = spark.createDataFrame([(i, f"taa tab tac ta{chr(100 + i)} tb{chr(97 + i)}") for i in range(20)], "query_id bigint, query string")
    pairs = or_scores(postings, queries).count()
    assert best_or_scores(postings, queries, 10).count() * 4 < pairs


@pytest.mark.parametrize("cap", [1, 3, 20, 500])
def test_pruning_against_plain_python(spark, cap):
    postings = random_postings(spark, 900, cap)
    lists = {}
    for r in postings.collect():
        lists.setdefault(r.term, []).append((-r.tf, r.doc_id))
    want = {(t, d, -f) for t, rows in lists.items() for f, d in sorted(rows)[:cap]}
    assert {(r.term, r.doc_id, r.tf) for r in prune_postings(postings, max_postings=cap, splits=3).collect()} == want


@pytest.mark.parametrize("parts", [1, 5])
def test_common_terms_against_counts(spark, parts):
    r = random.Random(parts)
    texts = [" ".join(w for i, w in enumerate("abcdefghij") if r.random() * 10 < i) for _ in range(300)] + [None, "", "!"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(parts)
    counts = Counter(w for t in texts for w in set((t or "").split()))
    got = {r.term: r.df for r in common_terms(docs, 0.4).collect()}
    assert got == {w: n for w, n in counts.items() if n > 0.4 * len(texts)}
    assert common_terms(docs.limit(0), 0.4).count() == 0


def test_a_range_of_ids_is_decoded_alone(spark):
    rows = [(t, d, 1 + d % 3, [d + 7 * k for k in range(1 + d % 3)]) for t in ("a", "b") for d in range(0, 900, 1 + len(t))]
    postings = spark.createDataFrame(rows, "term string, doc_id bigint, tf bigint, positions array<int>")
    for order in ("id", "tf_id"):
        lists = encode_lists(postings, order, segment_rows=100, block_bits=4)
        got = {(r.term, r.doc_id, r.tf, tuple(r.positions)) for r in decode_lists(lists, order, ids=(100, 250)).collect()}
        assert got == {(t, d, n, tuple(p)) for t, d, n, p in rows if 100 <= d <= 250}


@pytest.mark.parametrize("start", [0, 1, 250, 898, 899, 5000])
def test_rows_from_a_rank_on(spark, start):
    r = random.Random(start)
    rows = [(d * r.choice([1, 1 << 20, 1 << 45, -7]), r.randrange(1, 5) << r.choice([0, 30])) for d in range(900)]
    df = spark.createDataFrame(rows, "doc_id bigint, tf bigint").repartition(3)
    ranked = sorted(rows, key=lambda x: (-x[1], x[0]))
    found, before = rows_from_rank(df, [("tf", True), ("doc_id", False)], start)
    got = sorted((tuple(x) for x in found.collect()), key=lambda x: (-x[1], x[0]))
    assert got[before:] == ranked[start:] and before < 900
    assert start >= 900 or before == start - ranked.index(ranked[start])


@pytest.mark.parametrize("query", ["taa tab", "tad tbz taa", "tch", "taa zzz", "", "12 !", "taa TAA taa"])
def test_and_of_one_query_against_plain_python(spark, query):
    postings = random_postings(spark, 700, 3).cache()
    rows = {(r.term, r.doc_id): r.tf for r in postings.collect()}
    asked = sorted(set(re.findall("[a-z]+", query.lower())))
    docs = {d for t, d in rows if asked} & {d for _, d in rows if all((t, d) in rows for t in asked)}
    scale = {t: max((rows[t, d] for d in docs), default=1) for t in asked}
    want = {d: pytest.approx(sum(rows[t, d] / scale[t] for t in asked)) for d in docs}
    for blocks in (None, block_maxima(postings)):
        assert {r.doc_id: r.score for r in and_scores(postings, query, blocks=blocks).collect()} == want
    assert {r.doc_id: r.score for r in and_scores(postings, [query]).collect()} == want


@pytest.mark.parametrize("start,amount", [(1, 5), (37, 10), (699, 3), (100_000, 3)])
def test_deep_pages_are_the_same_rows(spark, start, amount):
    r = random.Random(start)
    rows = [(q, d, r.choice([0.5, 1.0, r.random() * 4])) for q, n in ((1, 700), (5, 40), (9, 1)) for d in r.sample(range(5000), n)]
    scores = spark.createDataFrame(rows, "query_id bigint, doc_id bigint, score double").repartition(3)
    pages = [result_page(scores, start, amount, deep=deep).collect() for deep in (1, start + 1)]
    assert pages[0] == pages[1] and len(pages[0]) == sum(max(0, min(amount, n - start)) for n in (700, 40, 1))


def test_a_deep_page_ranks_few_rows(spark):
    rows = [(d % 2, (d * 48271) % 65521, 1.0 + d % 3) for d in range(4000)]
    scores = spark.createDataFrame(rows, "query_id bigint, doc_id bigint, score double")
    plan = result_page(scores, 1900, 5, deep=1)._jdf.queryExecution().optimizedPlan().toString()
    assert "<= 5" in plan and "1905" not in plan


def test_looking_up_the_terms_of_queries_broadcasts_no_postings(spark):
    """A few megabytes of stored postings take many times that in a broadcast table."""
    postings = random_postings(spark, 2000, 5).cache()
    queries = spark.createDataFrame([(0, "taa tab"), (1, "tac tad taa"), (2, "zzz taa")], "query_id bigint, query string")
    plan = and_scores(postings, queries)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=merge" in plan
    texts = {0: ["taa", "tab"], 1: ["tac", "tad", "taa"]}
    held = {}
    for r in postings.collect():
        held.setdefault(r.doc_id, {})[r.term] = r.tf
    want = {(q, d) for q, terms in texts.items() for d, found in held.items() if all(t in found for t in terms)}
    assert {(r.query_id, r.doc_id) for r in and_scores(postings, queries).collect()} == want


@pytest.mark.parametrize("order", ["id", "tf_id"])
def test_long_lists_are_placed_without_counting_blocks(spark, hot, order):
    """Ids far apart make as many blocks as postings; one shuffle gathers each kind of lists."""
    sparse = hot.withColumn("doc_id", F.shiftleft(F.col("doc_id") * 524287 % 262147, 44))
    lists = posting_lists(sparse, order, positions=False, segment_rows=700, block_bits=6)
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2
    lines = lists.filter("term = 'hot'").orderBy("segment").collect()
    assert [r.posting_list.count(";") - 1 for r in lines] == [700, 700, 700, 700, 200]
    ranked = sorted((-r.tf if order == "tf_id" else 0, r.doc_id) for r in sparse.filter("term = 'hot'").collect())
    assert [int(x.split("-")[0]) for r in lines for x in r.posting_list.split(";")[1:-1]] == [d for _, d in ranked]


@pytest.mark.parametrize("order", ["id", "tf_id"])
def test_long_lines_are_decoded_in_parts(spark, monkeypatch, order):
    rows = [(t, d, 1 + d % 3, [d + 7 * k for k in range(1 + d % 3)]) for t in ("a", "b") for d in range(0, 900, 1 + ord(t) % 3)]
    postings = spark.createDataFrame(rows, "term string, doc_id bigint, tf bigint, positions array<int>")
    batch = pa.RecordBatch.from_pandas(encode_lists(postings, order).select("term", "posting_list").toPandas())
    monkeypatch.setattr(lists, "DECODED_BYTES", 200)
    for ids in (None, (100, 250)):
        parts = list(lists._decode(order != "id", True, ids)([batch]))
        assert len(parts) > 20 and max(p.num_rows for p in parts) <= 100
        got = sorted((r["term"], r["doc_id"], r["tf"], r["positions"]) for p in parts for r in p.to_pylist())
        assert got == sorted(r for r in rows if ids is None or ids[0] <= r[1] <= ids[1])


def test_postings_within_the_cap_are_not_shuffled(spark):
    postings = random_postings(spark, 2000, 3).cache()
    kept = prune_postings(postings, max_postings=100)
    # Only those at a term's last frequency are ranked: by parts, then in all.
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2 and "SortMergeJoin" not in plan
    lists = {}
    for r in postings.collect():
        lists.setdefault(r.term, []).append((-r.tf, r.doc_id))
    want = {(t, d) for t, found in lists.items() for _, d in sorted(found)[:100]}
    assert {(r.term, r.doc_id) for r in kept.collect()} == want and kept.count() == len(want)


@pytest.mark.parametrize("amount", [None, 3])
def test_ranks_in_groups_of_any_values(spark, amount):
    """Values over all 64 bits, equal ones, ties beyond a page, small groups and null keys."""
    far = 2**63 - 1
    points = {0: [5, 5, 5, 5, 5, 5], 1: [-far, far, 0, 7, 7, 1 << 40], 2: [1, 2], None: [1, 2, 3, 4]}
    rows = [(g, p, i * 70000) for g, found in points.items() for i, p in enumerate(found)]
    df = spark.createDataFrame(rows, "g int, p bigint, id bigint")
    for chosen in (df, df.filter("g = 0"), df.filter("p between -1 and 10")):
        got = [tuple(r) for r in rows_from_ranks(chosen, ["g"], [("p", True), ("id", False)], 2, amount).collect()]
        left = [tuple(r) for r in chosen.collect()]
        for g in (0, 1, 2):
            want = sorted((r for r in left if r[0] == g), key=lambda r: (-r[1], r[2]))[2:]
            have = sorted((r for r in got if r[0] == g), key=lambda r: (-r[1], r[2]))
            assert have == want if amount is None else have[:amount] == want[:amount]
        assert all(r[0] is not None for r in got)
    if amount:
        many = spark.range(3000).selectExpr("0 as g", "id as p", "id")
        assert rows_from_ranks(many, ["g"], [("p", True), ("id", False)], 10, amount).count() < 100


@pytest.mark.parametrize("size", [1, 90, 1 << 20])
def test_placed_terms_of_slices(monkeypatch, size):
    monkeypatch.setattr(postings_module, "PLACED_BYTES", size)
    texts = ["ab cd ab", None, "", "cd", "\U0001f600 é ab-cd", "", "zz" * 60 + " ab", "é", "ab", None]
    ids = [5, 6, None, 8, 9, 10, 11, 12, 5, 14]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string())})
    want = []
    for number, text in zip(ids, texts, strict=True):
        places = {}
        for m in re.finditer("[a-z]+", text or ""):
            places.setdefault(m.group(), []).append(m.start())
        want += [(number, term, at) for term, at in places.items()]
    got = [tuple(r.values()) for b in postings_module._find_placed(iter([batch.slice(0, 4), batch.slice(4)])) for r in b.to_pylist()]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("delta", [None, "list", "run"])
@pytest.mark.parametrize("size", [1, 3, 100])
def test_lines_over_batches(delta, size):
    r = random.Random(size)
    rows, want = [], []
    for term, segment, n in [("a", 0, 7), ("a", 2, 1), ("b", 2, 1), ("c", 0, 6), (None, 0, 2)]:
        key = (lambda p: p) if delta != "run" else (lambda p: (p[1], p[0]))
        found = sorted(((r.randrange(50), -r.randrange(1, 3), f"{i}") for i in range(n)), key=key)
        rows += [(term, segment, *p, 90 + n) for p in found]
        told = []
        for i, (number, neg_tf, coded) in enumerate(found):
            related = i > 0 and (delta == "list" or delta == "run" and found[i - 1][1] == neg_tf)
            told.append(f"{number - found[i - 1][0] if related else number}-{-neg_tf}-{coded}")
        want.append((term, segment, 90 + n, f"{90 + n};{';'.join(told)};"))
    names = ["term", "segment", "doc_id", "neg_tf", "coded", "df"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    whole = pa.RecordBatch.from_arrays(columns, names=names)
    parts = [whole.slice(at, size) for at in range(0, len(rows), size)]
    got = [tuple(line.values()) for b in lists._lines(delta, True)(iter(parts)) for line in b.to_pylist()]
    assert got == want


def test_lines_need_no_array_of_postings(spark, hot):
    plan = encode_lists(hot)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan
