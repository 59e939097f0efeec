"""Operators that judge each text by itself."""

import hashlib
import re
import time
import zlib
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pytest

from termloom.llm import pii, queries, quality_classifier, quality_rules

SMALL = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (None, "two words"), (5, "word " * 40_000), (6, "é" * 50_000)]

# --- personal data -----------------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = pii.digits_of(m[0])
            good = {
                "email": True,
                "ip": all(int(part) <= 255 for part in m[0].split(".")) if kind == "ip" else None,
                "card": 12 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                yield m.start(), pii.KINDS.index(kind), m.end()


PIECES = ["a", "b.c", "@", "@x.y", "1.2", "3.4", ".", "+1", "(555)", " ", "-", "4111 1111 1111 1111", "255", "256.", "é", "\n", "+49 30 1234567", "0"]


def test_base_spans_against_plain_patterns():
    random = np.random.default_rng(0)
    for _ in range(3000):
        text = "".join(random.choice(PIECES, random.integers(1, 14)))
        want = sorted(plain_spans(text))
        got = [(s, pii.KINDS.index(k), e) for k, s, e, _ in pii.find_spans(text) if k in BASE]
        assert got == want, text


def test_checks_and_context():
    assert pii.mod97("GB82WEST12345698765432") and not pii.mod97("GB82WEST12345698765431")
    assert [k for k, *_ in pii.find_spans("pay to GB82 WEST 1234 5698 7654 32 NOW")] == ["iban"]
    assert not pii.find_spans("model 219-09-9999") and [k for k, *_ in pii.find_spans("SSN 219-09-9999")] == ["ssn"]
    assert pii.score("call +1 555 555 5555", "phone", 5, 20) > pii.score("+1 555 555 5555", "phone", 0, 15)


def test_redaction_of_spans_that_overlap():
    assert pii.redact("abcdefgh", [("email", 1, 4, 1), ("ip", 3, 5, 1), ("card", 6, 7, 1)]) == "a<EMAIL>f<CARD>h"


def test_hostile_texts_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "a@" * 100_000, "+1" + " " * 300_000, "AA11" + " A1" * 99_999):
        pii.find_spans(text)


def test_pii_query(spark, table, tables):
    rows = [*ODD, (7, "mail a.b@c.de or 10.0.0.1"), (8, "日本 a@b.c"), (9, "1" * 6000 + ".1.1.1")]
    out = {(r["doc_id"], r["spans"], r["n_email"], r["base_sha256"]) for r in queries.op3_pii(spark, tables(documents=table(rows))).collect()}
    none = hashlib.sha256(b"").hexdigest()
    assert (1, "", 0, none) in out and (None, "", 0, none) in out
    spans = "email:5:13,ip:17:25"
    assert (7, spans, 1, hashlib.sha256(spans.encode()).hexdigest()) in out
    assert (8, "email:3:8", 1, hashlib.sha256(b"email:3:8").hexdigest()) in out


def test_redact_keeps_rows_and_columns(table):
    docs = table([*ODD, (7, "mail a.b@c.de")])
    out = pii.redact_pii(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[7] == "mail <EMAIL>" and texts[1] is None


# --- quality rules -----------------------------------------------------------------


def plain_stats(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    again = {i + j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again)


def test_statistics_against_plain_python():
    random = np.random.default_rng(1)
    parts = ["a", "b", "é|", "#", " ", "  ", "\n", "\t", "日本", "\x0b", "\x0c\r", " ", "word", "\n\n"]
    texts = ["".join(random.choice(parts, random.integers(0, 60))) for _ in range(400)]
    stats = quality_rules.text_stats(pa.array([*texts, None]))
    got = list(zip(*(stats[n].tolist() for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), strict=True))
    assert got == [plain_stats(t) for t in [*texts, ""]]


def test_cascade_is_the_same_in_any_order(spark, table):
    docs = table([*ODD, (8, "A | B | " * 60), (9, "LOUD WORDS " * 60), (10, " ".join(f"plain{i}" for i in range(99)))])
    verdicts = []
    for rules in (quality_rules.RULES, quality_rules.RULES[::-1], quality_rules.order_rules(docs)):
        out = quality_rules.apply_rules(docs, rules)
        verdicts.append(sorted((str(r["doc_id"]), r["kept"]) for r in out.collect()))
        assert {r["kept"]: r["rejected_by"] is None for r in out.collect()} == {True: True, False: False}
    assert verdicts[0] == verdicts[1] == verdicts[2] and ("10", True) in verdicts[0]


def test_order_is_by_rejections_per_second(table):
    def rule(name, pause, rejects):
        return quality_rules.Rule(name, lambda texts: time.sleep(pause) or np.full(len(texts), rejects))

    rules = [rule("slow", 0.2, True), rule("useless", 0, False), rule("fast", 0.01, True)]
    docs = table([(i, f"text {i}") for i in range(60)])
    assert [r.name for r in quality_rules.order_rules(docs, rules)] == ["fast", "slow", "useless"]
    assert quality_rules.order_rules(docs.limit(0)) == quality_rules.RULES


def test_rules_skip_what_is_rejected():
    seen = []
    first = quality_rules.Rule("first", lambda texts: np.array([t.as_py() == "x" for t in texts]))
    second = quality_rules.Rule("second", lambda texts: seen.extend(texts.to_pylist()) or np.zeros(len(texts), bool))
    assert quality_rules.cascade(pa.array(["x", "y", None]), [first, second]).tolist() == [0, -1, -1]
    assert seen == ["y", ""]


# --- quality classifier ------------------------------------------------------------


def test_held_out_accuracy(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = queries.op4_quality(spark, "/root/testdata/sf0.1").join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.98


def test_fold_is_by_checksum(spark):
    for r in queries.op4_quality(spark, SMALL).collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)


def _labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_odd_tables(spark, table, tables):
    rows = [*ODD, *((i, f"fine words of text {i}" if i % 2 else f"junk$$$ {i}$$$") for i in range(100, 160))]
    labels = [(i, i % 2, 0) for i in range(100, 160)] + [(1, None, None), (None, 1, 0), (101, 1, 0), (9999, 1, 0)]
    out = queries.op4_quality(spark, tables(documents=table(rows), labels=_labels(spark, labels))).collect()
    assert len(out) == len(rows)
    assert len({r["score"] for r in out if r["doc_id"] in (1, 2)}) == 1  # null is empty
    assert not any(r["held_out"] for r in out if r["doc_id"] is None)


def test_no_labels_and_no_documents(spark, table, tables):
    path = tables(documents=table([(1, "a")]), labels=_labels(spark, []))
    assert [r["score"] for r in queries.op4_quality(spark, path).collect()] == [0.5]
    assert quality_classifier.score(table([]), quality_classifier.fit_model([], np.zeros(0))).count() == 0


def test_descent_finds_the_widest_margin():
    rows = [(np.array([0]), np.array([1.0])), (np.array([1]), np.array([1.0]))]
    weight, bias = quality_classifier.dual_coordinate_descent(rows, np.array([1.0, -1.0]), 2, cost=100.0, epochs=500)
    assert np.allclose(weight, [1, -1], atol=1e-2) and abs(bias) < 1e-2


def test_features_are_of_whole_texts():
    one, two = quality_classifier._places(pa.array(["a b " * 5000, "a b " * 5000 + "zzz"]))
    assert len(two) > len(one) and all(x < y for x, y in pairwise(one.tolist()))


@pytest.mark.parametrize("text", ["x x", "x x x y", "a b"])
def test_runs_of_equal_words(text):
    (places,) = quality_classifier._places(pa.array([text]))
    assert (quality_classifier._FIRST_RUN in places) == (text != "a b")
