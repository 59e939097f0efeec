"""Mixing, language models and token ids."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from termloom.llm import bpe, lm_scoring, mixing, queries

SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(queries.TOKENIZER)

# --- mixing ------------------------------------------------------------------------


def plain_targets(sizes, weights=(5, 2, 1), cap=3):
    """Share by weight; what is over the cap is shared among the others until nothing is."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped = {}
    while True:
        left = sum(sizes.values()) - sum(capped.values())
        open_ = [s for s in names if s not in capped]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > cap * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: cap * sizes[s] for s in over}


def test_targets_against_repeated_sharing(spark):
    r = random.Random(0)
    for _ in range(4):
        sizes = {s: r.choice([0, 1, 7, 100, 5000]) for s in ["a", "B", "é", "z", None][: r.randrange(1, 6)]}
        rows = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")).collect()
        want = plain_targets(sizes)
        assert {x["source"]: pytest.approx(x["target"], abs=1e-6) for x in rows} == want


def test_mix_of_odd_rows(spark, table, tables):
    r = random.Random(1)
    rows = [(i, "w " * r.randrange(200), r.choice(["a", "a", "a", "b", "c", None])) for i in range(400)]
    rows += [(None, None, "a"), (None, "x y", None), (7, "t " * 9, "d"), (7, "t " * 9, "d"), (8, "", "e")]
    path = tables(documents=table(rows))
    out = queries.op5_mixing(spark, path).collect()
    again = queries.op5_mixing(spark, path).collect()
    assert sorted(map(str, out)) == sorted(map(str, again)) and len(out) == len(rows)
    sizes = Counter()
    for row in rows:
        sizes[row[2]] += len((row[1] or "").split())
    want = plain_targets({row[2]: sizes[row[2]] for row in rows})
    taken = Counter()
    for row in out:
        assert row["taken"] <= 3 * row["size"]
    for source, n in spark.read.parquet(f"{path}/documents.parquet").groupBy("source").count().collect():
        total = sum(x["taken"] for x in out if x["source_size"] == sizes[source] and abs(x["target"] - want[source]) < 1e-6)
        taken[source] = total
        assert abs(total - want[source]) <= 200


def test_mix_of_nothing(table):
    docs = table([]).select("doc_id", "source", mixing.word_count().alias("size"), mixing.place().alias("place"))
    assert mixing.mix(docs, mixing.plan_mix(docs)).count() == 0


def test_larger_budgets_take_all_of_smaller_ones(spark):
    docs = spark.range(500).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"), F.lit(10).cast("long").alias("size"),
        F.pmod(F.xxhash64("id"), F.lit(1 << 48)).alias("place"), "id",
    )
    kept = []
    for weights in ((1, 9), (3, 7), (6, 4)):
        rows = mixing.mix(docs, mixing.plan_mix(docs, weights)).filter("source = 'a'").collect()
        kept.append({x["id"]: x["copies"] for x in rows})
    assert all(kept[0][i] <= kept[1][i] <= kept[2][i] for i in kept[0])


# --- language models ---------------------------------------------------------------


def plain_whole_scores(target, background, texts):
    def tokens(text):
        return re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())

    models = []
    for corpus in (target, background):
        singles = Counter(w for t in corpus for w in tokens(t))
        doubles = Counter(p for t in corpus for p in itertools.pairwise(tokens(t)))
        models.append((singles, doubles, sum(singles.values())))
    words = len(models[0][0].keys() | models[1][0].keys())
    out = []
    for text in texts:
        own, losses = tokens(text), []
        for singles, doubles, total in models:
            sum_ = 0.0
            for i, w in enumerate(own):
                chance = (singles[w] + 1) / (total + words + 1)
                if i:
                    held = doubles[own[i - 1], w] / max(singles[own[i - 1]], 1)
                    chance = lm_scoring.MIX * held + (1 - lm_scoring.MIX) * chance
                sum_ -= math.log(chance)
            losses.append(sum_ / max(len(own), 1))
        out.append((len(own), *losses, losses[0] - losses[1]))
    return out


@pytest.mark.parametrize("same", [True, False])
def test_scores_know_every_word_and_pair(table, monkeypatch, same):
    monkeypatch.setattr(lm_scoring, "GATHER_BYTES", 20_000)
    r = random.Random(5)
    # More words than any fixed limit kept, most of them once; some are only in the target.
    texts = [" ".join(r.choice([f"rare{i}x{k}", "The", "of", f"w{r.randrange(300)}"]) for k in range(150)) for i in range(900)]
    texts += [None, "", " ", "alone", "The of " * 9000]
    assert len({w for t in texts for w in (t or "").lower().split()}) > 32_768
    target = [texts[3], "only here only there", texts[5] + " new", None]
    docs = table(list(enumerate(texts)))
    scored = texts if same else ["only here alone", "unseen of the", texts[7], None]
    rows = docs if same else table(list(enumerate(scored)))
    model = lm_scoring.fit(table(list(enumerate(target))), docs)
    found = sorted(lm_scoring.score(rows, model, keep=["doc_id"]).collect(), key=lambda x: x["doc_id"])
    got = [(x["n_tokens"], x["target_loss"], x["background_loss"], x["score"]) for x in found]
    assert np.allclose(got, plain_whole_scores(target, texts, scored), atol=1e-9)


def test_scores_prefer_the_target(spark, table):
    docs = table([(i, "red green blue " * 9 if i % 2 else "one two three " * 9) for i in range(40)])
    scorer = lm_scoring.fit(table([(0, "red green blue " * 20)]), docs)
    rows = lm_scoring.score(docs, scorer).collect()
    assert max(x["score"] for x in rows if x["doc_id"] % 2) < min(x["score"] for x in rows if not x["doc_id"] % 2)


def test_scores_of_empty_corpora(table):
    docs = table([(1, None), (2, "a b"), (None, "a")])
    flat = lm_scoring.fit(table([]), table([]))
    assert {x["score"] for x in lm_scoring.score(docs, flat).collect()} == {0.0}
    assert lm_scoring.score(table([]), flat).count() == 0


def test_lm_query_covers_every_document(spark):
    n = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert queries.op8_lm_scoring(spark, SMALL).select("doc_id").distinct().count() == n


# --- BPE ---------------------------------------------------------------------------

PARTS = ["a", "=====", "lower", "ßüé", "日本語日本", "b", "the", "ing", "é", "日本", "İ", "1", "23", "!", "'s", "'", "<|startoftext|>", "<|endoftext|>", "A", "ti", "🎉", "́", "\x1c", " ", " ", "aaaa", "abab"]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def test_halves_join_to_the_whole(library, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE_CHARS", 7)
    monkeypatch.setattr(bpe, "CACHED_WORDS", 50)
    own, r = bpe.Encoder(PATH), random.Random(1)
    open_cuts = 0
    for _ in range(3000):
        some = r.sample(PARTS, r.randrange(1, len(PARTS)))
        text = "".join(r.choice(some) if r.random() > 0.02 else r.choice(" \n\t") for _ in range(r.randrange(1, 120)))
        pieces = own.pieces(text)
        assert "".join(piece for piece, _ in pieces) == text
        open_cuts += sum(unfinished for _, unfinished in pieces)
        parts = [np.frombuffer(own.piece(*piece), "<u4").tolist() for piece in pieces]
        want = library.encode(text, add_special_tokens=False).ids
        assert own.tree(parts) == want, text
        assert own.words([text.encode()]) == [bpe.pack(want)], text
    assert open_cuts > 5000


def test_long_texts_of_the_given_table_go_through_the_tree(spark):
    lengths = [len(r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    assert max(lengths) >= bpe.LONG_CHARS


def test_encoding_query_against_the_library(spark, table, tables, library):
    long = "ab" * 50_000
    rows = [(1, None), (2, ""), (3, " \n"), (4, "Hello  WORLD é"), (4, "Hello  WORLD é"), (None, "x"), (5, f"start {long}é9 end"), (6, f"start {long}é9 end"), (7, "<|endoftext|>" + "!" * 70_000), (8, "word " * 30_000), (9, "unsplit" * 9000), (10, "éà" * 30_000), (11, "7" * 50_000), (12, "漢字" * 20_000)]
    out = queries.op9_bpe(spark, tables(documents=table(rows))).collect()
    got = sorted((str(x["doc_id"]), x["n_tokens"], x["ids_sha256"], x["decoded_sha256"]) for x in out)
    want = []
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((str(doc), len(ids), hashlib.sha256(bpe.pack(ids)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert got == sorted(want)


def test_small_data_against_the_library(spark, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for row in bpe.encode(spark.read.parquet(f"{SMALL}/documents.parquet"), PATH).collect():
        assert bytes(row["ids"]) == bpe.pack(library.encode(texts[row["doc_id"]], add_special_tokens=False).ids)


def test_tokenizers_that_keep_white_space_are_refused():
    with pytest.raises(ValueError, match="white space"):
        bpe.Encoder(public_tokenizers.path("byte_bpe_50k.json"))


def test_empty_table(table):
    assert bpe.decode(bpe.encode(table([]), PATH), PATH).count() == 0
