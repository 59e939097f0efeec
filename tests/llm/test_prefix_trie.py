"""The tree of common beginnings, against plain Python."""

import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest

from termloom.llm import prefix_trie as trie
from termloom.llm import queries

SCHEMA = "conv_id bigint, turn bigint, role string, text string, Shard int, path string, n double"


def plain_nodes(rows):
    told = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            code = sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            told[conv].append((turn is not None, turn or 0, code, role, text))
    told = {c: [t[3:] for t in sorted(turns)] for c, turns in told.items()}
    paths = {}
    for c, own in told.items():
        h = zlib.crc32(str(c).encode()) % 9
        first = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        paths[c] = (*told.get(first, [])[:h], *own[h:])
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = Counter(path[:-1] for path in members if path)
    leaves, saved = Counter(), Counter()
    for path, convs in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(convs) - 1) * len(path[-1][1].encode()) if path else 0
    out = []
    for path, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(paths[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out.append(
            (min(convs), len(path), parent, len(convs), children[path], leaves[path], saved[path], sha256(ends.encode()).hexdigest())
        )
    return Counter(out)


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def found(nodes):
    assert nodes.columns == list(COLUMNS)
    return Counter(tuple(r) for r in nodes.collect())


@pytest.fixture
def told(spark):
    def make(rows, parts=4):
        full = [(*r, 7, "p", 0.5) for r in rows]
        return trie.rebuilt(trie.sequences(spark.createDataFrame(full, SCHEMA).repartition(parts)))

    return make


def talk(random, conv, words=3, length=6):
    return [(conv, t, ["user", "bot"][t % 2], f"é{random.integers(words)}") for t in range(random.integers(0, length + 1))]


@pytest.mark.parametrize("shard_turns", [1, 7, 40, 1 << 14])
def test_against_plain_python(told, shard_turns):
    random = np.random.default_rng(shard_turns)
    rows = [row for conv in range(-20, 160) for row in talk(random, conv)]
    rows += [(500, 0, "user", "é1"), (501, 0, None, None), (502, 0, "", ""), (503, 0, "user", None)]
    assert found(trie.prefix_nodes(told(rows), shard_turns)) == plain_nodes(rows)


def test_odd_rows(told):
    rows = [
        (None, 0, "user", "nobody"),
        (0, None, "user", "null turn"),
        (0, 0, "user", "a"),
        (0, 0, "user", "a"),
        (0, 0, "bot", "tie"),
        (0, 0, "user", "bot tie"),
        (7, -3, "user", "x" * 300_000),
        (7, 2, "us", "erx"),
        (8, 2, "user", "x"),
        (9, 9, "user", "\x00, 中"),
        ((1 << 62) + 1, 0, "user", "large id"),
        (-6, 0, "user", "a"),
    ]
    for shard_turns in (1, 3, 100):
        assert found(trie.prefix_nodes(told(rows), shard_turns)) == plain_nodes(rows)


def test_a_third_are_copies_and_a_long_one(told):
    rows = [(c, t, "user", f"same {t}") for c in range(0, 6000, 20) for t in range(3)]
    rows += [(c, t, "user", ["first turn of all", f"own {c}"][t]) for c in range(1, 3000, 10) for t in range(2)]
    rows += [(7000, t, "bot", f"{t}") for t in range(1500)] + [(7005, t, "bot", f"{t}") for t in range(700)]
    assert found(trie.prefix_nodes(told(rows), 200)) == plain_nodes(rows)


def test_ids_in_several_ranges(told, monkeypatch):
    monkeypatch.setattr(trie, "RANGE_BITS", 2)
    rows = [(c * 5, 0, "user", "same") for c in range(-40, 40)]
    assert found(trie.prefix_nodes(told(rows))) == plain_nodes(rows)


def test_siblings_are_balanced():
    tree = trie.Tree()
    tree.insert_sorted([[i, 0] for i in range(1 << 10)])
    depth, stack = 0, [(tree.equal[0], 1)]
    while stack:
        node, below = stack.pop()
        if node >= 0:
            depth = max(depth, below)
            stack += [(tree.less[node], below + 1), (tree.more[node], below + 1)]
    assert depth == 11 and len(tree.key) == 1 + 2 * (1 << 10)


def test_empty_table(told, spark, tables):
    assert trie.prefix_nodes(told([(1, 0, "a", "b")]).limit(0)).count() == 0
    none = spark.createDataFrame([], SCHEMA)
    assert queries.op11_prefix_trie(spark, tables(conversations=none)).count() == 0
