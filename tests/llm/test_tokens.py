"""Token counts and the alignment of two tokenizers, against the libraries."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from termloom.llm import alignment, packing, queries, token_counts, units

SMALL = "/root/testdata/sf0.001"
A, B = (public_tokenizers.path(name) for name in (queries.BYTE_LEVEL, queries.PIECES))
ODD = [
    (1, None),
    (2, ""),
    (3, " "),
    (4, "  \n\t  "),
    (5, "one"),
    (5, "one"),
    (None, "no id  two   spaces "),
    (6, "word " * 30_000),
    (7, "é" * 20_000),
    (8, "mark▁in ▁text ▁"),
    (9, "<s> </s> <unk> <0x0A> <|endoftext|> it's"),
    (10, "a  b　 c  d \u0085 e\x00 f\x1c g​ h ﬁ 漢字 仮名 𝔘 ok"),
    (11, "x\r\n y\n z"),
    (12, "▁"),
]


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=B)


@pytest.fixture(scope="module")
def byte_level():
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    return tokenizer


def random_texts(n, seed=0):
    random = np.random.default_rng(seed)
    parts = [" ", "  ", "\n", "the", "The", "é", "▁", "ing", "123", ".", "'s", "　", " ", "漢", "xyzzy", "\t", "🙂", "\u0085", "\r"]
    return ["".join(random.choice(parts, random.integers(0, 30))) for _ in range(n)]


def test_packing():
    for values in ([], [0], [1, 255, 256, 70_000], [0, 1 << 40]):
        assert packing.unpack(packing.pack(np.array(values, np.int64))).tolist() == values
    assert packing.unpack_text(packing.pack_text(b"")) == b""


def test_units_cover_the_texts_and_encode_like_them(pieces, byte_level):
    texts = random_texts(2000)
    found = units.cut(units.spaced(pa.array(texts)))
    values = found.texts.to_pylist()
    for i, text in enumerate(texts):
        own = [values[k] for k in found.index[found.first[i] : found.first[i + 1]]]
        assert b"".join(own) == ((" " + text).encode() if text else b"")
        assert [k for u in own for k in byte_level.encode(u.decode(), add_special_tokens=False).ids] == (
            byte_level.encode(" " + text, add_special_tokens=False).ids if text else []
        )
    for path, library in ((A, lambda u: byte_level.encode(u, add_special_tokens=False).ids), (B, lambda u: pieces.encode(u[1:]))):
        ids, first, exact = units.vocabulary(path).encode(found.texts)
        assert not exact.all() or path == A
        for k, unit in enumerate(values):
            if unit != b" ":
                assert ids[first[k] : first[k + 1]].tolist() == library(unit.decode()), unit


def test_no_units():
    assert [len(x) for x in units.vocabulary(A).encode(pa.array([], pa.large_binary()))] == [0, 1, 0]


def test_counts(spark, table, pieces, monkeypatch):
    monkeypatch.setattr(token_counts, "NEW_BYTES", 50)
    rows = ODD + [(100 + i, text) for i, text in enumerate(random_texts(300, 1))]
    got = token_counts.count_tokens(table(rows), B, keep=["doc_id", "text", "score", "N_Words"]).collect()
    want = Counter((i, text, len((text or "").encode()), len(pieces.encode(text or ""))) for i, text in rows)
    assert Counter((r.doc_id, r.text, r.n_bytes, r.n_tokens) for r in got) == want
    assert {r.score for r in got} == {1.5} and {r.N_Words for r in got} == {"x"}


def test_counts_of_other_slices(spark, table, monkeypatch):
    rows = [(i, text) for i, text in enumerate(random_texts(200, 2))]
    whole = token_counts.count_tokens(table(rows, 1), B, keep=["doc_id"]).collect()
    parts = token_counts.count_tokens(table(rows, 7), B, keep=["doc_id"]).collect()
    assert sorted(whole) == sorted(parts) and len(whole) == 200


def test_a_column_with_the_name_of_a_count_gives_way(spark, table):
    docs = table([(1, "one two")]).withColumnRenamed("score", "N_Tokens")
    found = token_counts.count_tokens(docs, B)
    assert sorted(c for c in found.columns if c.lower() == "n_tokens") == ["n_tokens"] and found.first()["n_tokens"] == 2


def test_registered_counts(spark, tables, table):
    row = queries.op13_token_counts(spark, tables(documents=table([(1, "a " * 5000), (2, "a " * 4000)]))).orderBy("doc_id").collect()
    assert [r.over_limit for r in row] == [True, False]


def plain_groups(text, byte_level, pieces):
    """``(a ids, b ids, groups, links)`` by all common ends, or None."""
    if not text:
        return None
    want, names = (" " + text).encode(), units._byte_letters()
    code = byte_level.encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(names[c] for c in t)) for i, t in zip(code.ids, code.tokens, strict=True)]
    b = []
    for i in pieces.encode(text):
        name = pieces.id_to_piece(i)
        b.append((i, bytes([int(name[3:5], 16)]) if pieces.is_byte(i) else name.replace("▁", " ").encode()))
    if any(b"".join(t for _, t in side) != want for side in (a, b)):
        return None
    ends = [np.cumsum([len(t) for _, t in side]) for side in (a, b)]
    common = np.intersect1d(*ends)
    groups, links, at = [], [], (0, 0)
    for stop in zip(*(np.searchsorted(e, common) + 1 for e in ends), strict=True):
        part = [[i for i, _ in side[s:e]] for side, s, e in zip((a, b), at, stop, strict=True)]
        groups.append("|".join(",".join(map(str, ids)) for ids in part))
        links.append((part[0][-1], part[1][-1]))
        at = stop
    return len(a), len(b), groups, links


def plain_alignments(rows, byte_level, pieces):
    found = [(i, plain_groups(text, byte_level, pieces)) for i, text in rows]
    counts = Counter(link for _, f in found if f for link in f[3])
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for i, f in found:
        if f is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        high = sum(counts[link] == best[link[1]] for link in f[3])
        digest = hashlib.sha256(";".join(f[2]).encode()).hexdigest()
        out.append((i, f[0], f[1], len(f[2]), len(f[3]), high, sum(counts[link] for link in f[3]), digest))
    return Counter(out)


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_alignments(spark, table, byte_level, pieces):
    rows = ODD + [(100 + i, text) for i, text in enumerate(random_texts(300, 3))]
    got = alignment.alignments(table(rows), A, B, keep=["doc_id", "score"]).collect()
    assert Counter(tuple(r[c] for c in COLUMNS) for r in got) == plain_alignments(rows, byte_level, pieces)
    assert {r.score for r in got} == {1.5}


def test_registered_alignment_of_the_small_table(spark, byte_level, pieces):
    got = queries.op12_token_alignment(spark, SMALL).collect()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert Counter(tuple(r[c] for c in COLUMNS) for r in got) == plain_alignments(rows, byte_level, pieces)


def test_division_finds_all_shared_ends():
    random = np.random.default_rng(4)
    for _ in range(500):
        ends, first, base = [[], []], [[0], [0]], 0
        for _ in range(random.integers(0, 4)):
            top = int(random.integers(1, 60))
            for side in (0, 1):
                inner = random.choice(top, random.integers(0, top + 1) // 2, replace=False)
                own = np.union1d(inner[inner > 0], [top]) + base
                ends[side].extend(own.tolist())
                first[side].append(len(ends[side]))
            base += top
        a, b = (np.array(e, np.int64) for e in ends)
        at_a, at_b = alignment.shared_ends(a, b, np.array(first[0]), np.array(first[1]))
        common = np.intersect1d(a, b)
        assert np.array_equal(a[at_a], common) and np.array_equal(b[at_b], common)


def test_linkable_pairs_are_bounded_by_the_vocabularies():
    codes = alignment.linkable(A, B)
    bytes_of_all = sum(int(units.vocabulary(p).lengths.sum()) for p in (A, B))
    assert len(codes) <= 2 * bytes_of_all


def test_empty_tables(spark, table):
    empty = table([(1, "x")]).limit(0)
    assert token_counts.count_tokens(empty, B).count() == 0
    assert alignment.alignments(empty, A, B).count() == 0


def test_only_models_that_put_a_space_before_texts_are_counted(table):
    with pytest.raises(ValueError, match="space"):
        token_counts.count_tokens(table([(1, "x")]), A)
