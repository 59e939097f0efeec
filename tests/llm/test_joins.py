"""Operators that compare texts with each other, against brute force."""

import hashlib
import random
import re
import uuid

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from termloom import session
from termloom.llm import fingerprints, ngram_jaccard, queries, substring_dedup
from termloom.llm.components import components
from termloom.llm.fm_index import FMIndex, WaveletTree
from termloom.llm.words import find_words, mix, word_hashes

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n, lower=True):
    words = WORD.findall((text or "").translate(LOWER) if lower else text or "")
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def near_copies(seed, groups):
    """Groups of edited copies; a license line stands in many of them."""
    r = random.Random(seed)
    rows, license_line = [], [f"L{k}" for k in range(15)]
    for size in groups:
        base = [f"w{r.randrange(3000)}" for _ in range(r.choice([3, 5, 8, 20, 60, 200]))]
        for _ in range(size):
            words = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3, 5])):
                k = r.randrange(len(words))
                words[k : k + r.randrange(2)] = [f"e{r.randrange(99999)}"]
            if r.random() < 0.4:
                k = r.randrange(len(words) + 1)
                words[k:k] = license_line
            rows.append((len(rows) * 7, r.choice([" ", "  ", "\n"]).join(words)))
    r.shuffle(rows)
    return rows


# --- n-gram Jaccard join -----------------------------------------------------------


def plain_components(rows, words, percent):
    sets = {}
    for doc, text in rows:
        sets[doc] = shingles(text, words)
    found = {d: d for d in sets}

    def root(d):
        while found[d] != d:
            d = found[d]
        return d

    docs = sorted(sets)
    for i, a in enumerate(docs):
        for b in docs[:i]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                found[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in sets}


@pytest.mark.parametrize(("rare", "gather", "words", "percent"), [(8, 4 << 20, 4, 85), (2, 5000, 5, 80)])
def test_join_against_all_pairs(table, monkeypatch, rare, gather, words, percent):
    monkeypatch.setattr(ngram_jaccard, "RARE", rare)
    monkeypatch.setattr(ngram_jaccard, "GATHER_BYTES", gather)
    rows = near_copies(rare, [1] * 20 + [2] * 15 + [5] * 8 + [40] * 2)
    rows += [(-5, None), (-6, ""), (-7, " \n "), (-8, "one"), (-9, "ONE"), (-10, "É"), (-11, "é"), (-12, "a b " * 30_000)]
    got = {r[0]: tuple(r)[1:] for r in ngram_jaccard.join_similar(table(rows), words, percent).collect()}
    assert got == plain_components(rows, words, percent)


def test_join_odd_rows(table):
    rows = [(3, "a b c d e"), (3, "a b c d e"), (1, "A B c d e"), (None, "a b c d e"), (None, None)]
    got = sorted(map(str, (tuple(r) for r in ngram_jaccard.join_similar(table(rows), 4, 85).collect())))
    assert got == sorted(map(str, [(3, 2, 1), (3, 2, 1), (1, 2, 1), (None, 2, None), (None, 0, None)]))
    assert ngram_jaccard.join_similar(table([]), 4, 85).count() == 0


def reordered(df, marks, copies, turn):
    """The rows in one task, by groups of copies in every second reading, else with the copies of a group far apart."""

    def run(batches):
        table = pa.Table.from_batches(list(batches))
        (marks / uuid.uuid4().hex).touch()
        number = table.column("doc_id").to_numpy()
        together = len(list(marks.iterdir())) % 2 == turn
        yield from table.take(np.argsort(number if together else number % copies, kind="stable")).to_batches()

    return df.coalesce(1).mapInArrow(run, df.schema)


def copies_with_edits(groups, copies):
    rows = []
    for g in range(groups):
        base = [f"g{g}w{k}" for k in range(40)]
        rows += [(g * copies + c, " ".join([*base, f"own{g}x{c}"])) for c in range(copies)]
    return rows


@pytest.mark.parametrize("turn", [0, 1])
def test_join_when_slices_differ_between_readings(table, monkeypatch, tmp_path, turn):
    monkeypatch.setattr(ngram_jaccard, "GATHER_BYTES", 5000)
    rows = copies_with_edits(6, 24)
    docs = reordered(table(rows), tmp_path, 24, turn)
    got = {r[0]: tuple(r)[1:] for r in ngram_jaccard.join_similar(docs, 4, 85).collect()}
    assert got == plain_components(rows, 4, 85)


@pytest.mark.parametrize("turn", [0, 1])
def test_removal_when_slices_differ_between_readings(table, monkeypatch, tmp_path, turn):
    monkeypatch.setattr(substring_dedup, "GATHER_BYTES", 2500)
    rows = copies_with_edits(8, 8)
    docs = reordered(table(rows), tmp_path, 8, turn)
    found = substring_dedup.remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256))
    assert sorted(map(tuple, found.collect())) == sorted(plain_removal(rows))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_files_of_a_join_follow_from_its_rows(spark, table, monkeypatch):
    rows = copies_with_edits(6, 24)
    paths = {}

    def noted(of, name, make=session.scratch_path):
        path = make(of, name)
        paths.setdefault(name, []).append(path)
        return path

    monkeypatch.setattr(session, "scratch_path", noted)
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        monkeypatch.setattr(session.Staging, "drop", lambda self, *names: None)
        got = {r[0]: tuple(r)[1:] for r in ngram_jaccard.join_similar(table(rows), 4, 85).collect()}
        made = set(paths) - {"sets", "tokens"}  # those have a file of each task that reads texts
        files = {name: [len(spark.read.parquet(path).inputFiles()) for path in paths[name]] for name in made}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert got == plain_components(rows, 4, 85)
    assert set(files) == {"members", "classed", "combinations", "pairs", "candidates", "similar", "links", "labels", "blocks"}
    assert {n for counts in files.values() for n in counts} == {1}


# --- substring dedup ---------------------------------------------------------------


def plain_removal(rows, length=13):
    first = {}
    words = [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in words:
        for i in range(len(w) - length + 1):
            key = tuple(w[i : i + length])
            if d is not None:
                first[key] = min(first.get(key, d), d)
    out = []
    for d, w in words:
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if d is not None and first[tuple(w[i : i + length])] < d:
                gone[i : i + length] = [True] * length
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("crowded", "symbols", "gather"), [(64, 1 << 18, 4 << 20), (2, 500, 4000)])
def test_removal_against_plain_python(spark, table, tables, monkeypatch, crowded, symbols, gather):
    monkeypatch.setattr(substring_dedup, "CROWDED", crowded)
    monkeypatch.setattr(substring_dedup, "INDEX_SYMBOLS", symbols)
    monkeypatch.setattr(substring_dedup, "GATHER_BYTES", gather)
    rows = near_copies(1, [1] * 20 + [2] * 10 + [30] * 2)
    phrase = " ".join(f"p{i}" for i in range(9))
    rows += [(5000 + i, f"x{i} y{i} {phrase} z{i} q{i} " * 2) for i in range(60)]
    rows += [(9001, None), (9002, ""), (9003, "a " * 12), (9004, "a " * 40_000), (9005, "a " * 14), (None, "a " * 20), (None, None)]
    rows += [rows[0], rows[0]]
    out = queries.op10_substring_dedup(spark, tables(documents=table(rows)))
    assert sorted((tuple(r) for r in out.collect()), key=str) == plain_removal(rows)


def test_removal_of_an_empty_table(table):
    assert substring_dedup.remove_repeats(table([])).count() == 0


def test_intervals_and_texts(table):
    text = " ".join(f"w{i}" for i in range(20))
    rows = {r["doc_id"]: r for r in substring_dedup.remove_repeats(table([(1, text), (2, f"new {text}  end")])).collect()}
    assert rows[1]["n_removed"] == 0 and rows[1]["intervals"] == []
    assert [tuple(i) for i in rows[2]["intervals"]] == [(1, 21)] and rows[2]["kept_text"] == "new end"


def test_equal_windows_are_searched_once_and_told_to_every_piece(monkeypatch):
    searched, search = [], FMIndex.search

    def counted(self, ends, source, length):
        searched.append(len(ends))
        return search(self, ends, source, length)

    monkeypatch.setattr(FMIndex, "search", counted)
    pieces = [" ".join([f"c{i}", *(f"w{k}" for k in range(30))]).encode() for i in range(50)]
    least = substring_dedup.index_pieces(pieces, np.arange(100, 50, -1), 13)
    assert [m.tolist() for m in least] == [[100 - i] + [51] * 18 for i in range(50)]
    assert searched == [50 + 18]


@pytest.mark.parametrize("largest", [1, 15, 16, 3000])
def test_tree_has_a_level_for_four_bits_and_counts(largest):
    r = np.random.default_rng(largest)
    symbols = np.append(r.integers(0, largest + 1, 700), largest)
    tree = WaveletTree(symbols, largest)
    assert len(tree.levels) == -(-largest.bit_length() // 4)
    wanted, low, high = symbols[r.integers(0, 701, 300)], r.integers(0, 350, 300), r.integers(350, 702, 300)
    lower, upper = tree.rank(wanted, low, high)
    plain = [(symbols[a:b] == s).sum() for s, a, b in zip(wanted, low, high, strict=True)]
    assert (upper - lower).tolist() == plain


def test_word_hashes_are_sums_of_powers():
    step, odd, every = 0xD6E8FEB86659FD93, 0x9E3779B97F4A7C15, (1 << 64) - 1
    texts = ["ab " * 1500 + "x" * 9000 + " é", None, "", "b", "x" * 9000, " ab\tab"]
    words = find_words(pa.array(texts))
    plain = []
    for word in (w for t in texts for w in (t or "").encode().split()):
        value = sum((b + 1) * pow(odd, i, 1 << 64) for i, b in enumerate(word)) + len(word) * step
        plain.append(value & every)
    assert word_hashes(words).tolist() == mix(np.array(plain, np.uint64)).tolist()


def test_index_counts_and_lengths():
    r = np.random.default_rng(0)
    text = r.integers(1, 5, 1500)
    text[r.integers(0, 1500, 60)] = 0
    text[-1] = 0
    ends = np.arange(1, len(text) + 1)
    pattern = r.integers(0, 7, len(text))
    matched, low, high = FMIndex(text, 13).search(ends, pattern, 6)
    whole, flat = pattern.tolist(), text.tolist()

    def count(p):
        return sum(flat[j : j + len(p)] == p for j in range(len(flat) - len(p) + 1))

    for e in range(1, len(text), 41):
        k = matched[e - 1]
        p = whole[e - k : e]
        assert not k or count(p) == high[e - 1] - low[e - 1] > 0
        longer = whole[e - k - 1 : e]
        assert k == 6 or e - k - 1 < 0 or 0 in longer or count(longer) == 0


# --- fingerprints ------------------------------------------------------------------


def test_fingerprints_against_exact_sets(spark, table, tables):
    rows = near_copies(3, [1] * 15 + [2] * 10)
    rows += [(-1, None), (-2, ""), (-3, "one"), (-4, "é日" * 999), (None, "tail of the ring")]
    out = {r["doc_id"]: r for r in queries.op7_fingerprints(spark, tables(documents=table(rows))).collect()}
    ring = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    prints = {}
    for i, (doc, text) in enumerate(ring):
        text, after = text or "", ring[(i + 1) % len(ring)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row = out[doc]
        assert row["n_chars"] == len(text) and row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        for other, near in ((edited, row["near_edited"]), (after, row["near_next"])):
            a, b = shingles(text, 5, lower=False), shingles(other, 5, lower=False)
            exact = len(a & b) / len(a | b) if a | b else 1.0
            small = len(a | b) <= fingerprints.SKETCH_SIZE
            assert near == pytest.approx(exact, abs=1e-9 if small else 0.2)
        assert prints.setdefault(text, row["fingerprint"]) == row["fingerprint"]


def test_fingerprints_of_repeated_rows_and_one_row(spark, table):
    rows = [(1, "b"), (1, "a"), (1, "b")]
    (row,) = fingerprints.edited_neighbours(table(rows)).collect()
    assert (row["doc_id"], row["text"], row["edited"]) == (1, "b", "b")
    assert fingerprints.edited_neighbours(table([])).count() == 0


def test_no_python_on_the_main_path(spark):
    plan = queries.op7_fingerprints(spark, SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_merging_and_estimates(spark):
    def numbered(a, b):
        return " ".join(f"w{i}" for i in range(a, b))

    rows = [(numbered(0, 3000), numbered(1000, 3000)), (numbered(0, 50), numbered(0, 50)), ("", "a"), ("", "")]
    df = spark.createDataFrame(rows, "x string, y string").withColumns({"a": fingerprints.sketch(F.col("x")), "b": fingerprints.sketch(F.col("y"))})
    a, b = F.col("a"), F.col("b")
    got = df.select(
        fingerprints.resemblance(a, b).alias("r"), fingerprints.containment(b, a).alias("c"), fingerprints.distinct_shingles(a).alias("n")
    ).collect()
    assert got[0]["r"] == pytest.approx(2 / 3, abs=0.15) and got[0]["c"] > 0.8 and got[0]["n"] == pytest.approx(2996, rel=0.3)
    assert tuple(got[1]) == (1.0, 1.0, 46.0) and got[2]["r"] == 0 and tuple(got[3]) == (1.0, 1.0, 0.0)
    # Two parts that share the words at their border make the sketch of the whole.
    parts = spark.createDataFrame([(numbered(0, 1504),), (numbered(1500, 3000),)], "t string").select(
        F.lit(1).alias("g"), fingerprints.sketch(F.col("t")).alias("s")
    )
    (merged,) = fingerprints.merge_groups(parts, ["g"], "s").collect()
    assert merged["s"] == df.select("a").first()["a"]
    two = [r["s"] for r in parts.collect()]
    both = spark.createDataFrame([tuple(two)], "a array<bigint>, b array<bigint>").select(fingerprints.merge(a, b).alias("m"))
    assert both.first()["m"] == merged["s"]
