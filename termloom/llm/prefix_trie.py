"""The tree of common beginnings of conversations.

A turn is known by a code of its role and text (128 bits of SHA-256), a conversation by the
codes of its turns, one after another. Equal conversations become one row first, with their
number, their smallest id and the digest of their ids, which are hashed as a stream. The
rows are dealt out to shards by range, so that a beginning lies in one shard or in
neighbours.

Within a shard, codes become small numbers by a dictionary, and a ternary search tree takes
the sequences: a node's ``less`` and ``more`` lead to other turns at the same place, its
``equal`` to the next turn. The median of the sorted rows goes in first, then the medians of
both halves, so that siblings are balanced. Members, leaves and savings are added up from
the youngest node to the oldest, without recursion.

Beginnings that a shard shares with the one before it or behind it lie on the path of its
first or last row. The length that two neighbours have in common tells which: such nodes
are counted as somebody's child, and their one saved copy is kept back, only in the first of
the shards that have them. All else adds up, so that they are merged by a sum over shards.

Rows without a ``conv_id`` belong to no conversation. A null role or text is an empty one.
Rows of one conversation with the same turn go by their code, and rows that repeat others
are turns of their own. A conversation is held in one row, as a text is. An empty table has
no nodes.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termloom.session import staged

CODE_BYTES = 16
#: Turns and conversations that a shard holds, about.
SHARD_TURNS = 1 << 14
#: Of equal conversations, the ids of a range of this many (a power of two) are one row.
RANGE_BITS = 12
NO_ENDS = sha256(b"").hexdigest()


def sequences(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turns)``: code and bytes of the text of each turn, in order, null turns first."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # The length in front keeps role and text apart.
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.substring(F.sha2(said, 256), 1, 2 * CODE_BYTES).alias("code"),
        F.octet_length(text).cast("long").alias("size"),
    )
    turns = F.sort_array(F.collect_list(F.struct("turn", "code", "size")))
    turns = F.transform(turns, lambda t: F.struct(t["code"].alias("code"), t["size"].alias("size")))
    return rows.groupBy("conv_id").agg(turns.alias("turns"))


def rebuilt(told: DataFrame, family: int = 5, most: int = 8) -> DataFrame:
    """Each conversation with its first h turns replaced by those of the first of its family.

    Families are runs of ``family`` ids; h is the id's CRC-32 modulo ``most + 1``. Without a
    first member the conversation begins with its own turns after the first h.
    """
    first = F.col("conv_id") - F.col("conv_id") % family
    heads = told.filter(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("first"), F.slice("turns", 1, most).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    own = told.select("conv_id", first.alias("first"), h.alias("h"), "turns")
    head = F.when(F.col("head").isNotNull(), F.slice("head", F.lit(1), F.col("h")))
    rest = F.slice("turns", F.col("h") + 1, F.size("turns"))
    turns = F.when(head.isNull(), rest).otherwise(F.concat(head, rest))
    return own.join(heads, "first", "left").select("conv_id", turns.alias("turns"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of ranges of ids sorted by path, a row per path, with the SHA-256 of all its ids as a list."""
    path, digest, sizes, n, conv = None, None, None, 0, 0
    done: list[tuple] = []

    def rows() -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) or [[]] * 5
        kinds = (pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.string())
        arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
        done.clear()
        return pa.RecordBatch.from_arrays(arrays, names=["path", "sizes", "n", "conv", "ends"])

    for batch in batches:
        for row in zip(*(batch.column(c) for c in ("path", "sizes", "ids")), strict=True):
            name, own_sizes, ids = (x.as_py() for x in row)
            if name != path:
                if path is not None:
                    done.append((path, sizes, n, conv, digest.hexdigest()))
                path, sizes, n, conv, digest = name, own_sizes, 0, ids[0], sha256()
            digest.update((("," if n else "") + ",".join(map(str, ids))).encode())
            n += len(ids)
        yield rows()
    if path is not None:
        done.append((path, sizes, n, conv, digest.hexdigest()))
        yield rows()


def distinct_paths(told: DataFrame) -> DataFrame:
    """``(path, sizes, n, conv, ends)``: each sequence of turns once, with the number of conversations
    that are it, the smallest of them and the digest of all. No task holds more than a range of ids."""
    codes = F.array_join(F.transform("turns", lambda t: t["code"]), "")
    rows = told.select(
        "conv_id", F.unhex(codes).alias("path"), F.transform("turns", lambda t: t["size"]).alias("sizes")
    )
    ranges = rows.groupBy("path", F.shiftright("conv_id", RANGE_BITS).alias("range")).agg(
        F.first("sizes").alias("sizes"), F.sort_array(F.collect_list("conv_id")).alias("ids")
    )
    together = ranges.repartition("path").sortWithinPartitions("path", "range").select("path", "sizes", "ids")
    return together.mapInArrow(_digests, "path binary, sizes array<bigint>, n bigint, conv bigint, ends string")


def _common(one: bytes | None, other: bytes | None) -> int:
    """The number of turns with which both begin; -1 without one of them."""
    if one is None or other is None:
        return -1
    a, b = (np.frombuffer(x, np.uint8) for x in (one, other))
    n = min(len(a), len(b))
    apart = np.flatnonzero(a[:n] != b[:n])
    return int(apart[0] if len(apart) else n) // CODE_BYTES


def _common_lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        first, last, before, after = (batch.column(c).to_pylist() for c in ("first", "last", "before", "after"))
        arrays = [
            batch.column("shard"),
            pa.array(map(_common, before, first), pa.int64()),
            pa.array(map(_common, last, after), pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=["shard", "with_previous", "with_next"])


class Tree:
    """A ternary search tree of sequences of numbers. Node 0 is the empty beginning."""

    def __init__(self) -> None:
        self.key, self.up, self.depth, self.row = [-1], [-1], [0], [-1]
        self.less, self.equal, self.more = [-1], [-1], [-1]

    def _new(self, key: int, up: int) -> int:
        self.key.append(key)
        self.up.append(up)
        self.depth.append(self.depth[up] + 1)
        self.row.append(-1)
        for link in (self.less, self.equal, self.more):
            link.append(-1)
        return len(self.key) - 1

    def insert(self, sequence: list[int], row: int) -> None:
        at = 0
        for key in sequence:
            node, links, last = self.equal[at], self.equal, at
            while node >= 0 and self.key[node] != key:
                links, last = (self.less if key < self.key[node] else self.more), node
                node = links[node]
            if node < 0:
                node = links[last] = self._new(key, at)
            at = node
        self.row[at] = row

    def insert_sorted(self, sequences: list[list[int]]) -> None:
        """Medians first."""
        spans = [(0, len(sequences))]
        while spans:
            start, stop = spans.pop()
            if start < stop:
                middle = (start + stop) // 2
                self.insert(sequences[middle], middle)
                spans += [(middle + 1, stop), (start, middle)]

    def path(self, sequence: list[int]) -> list[int]:
        """The nodes of a sequence in the tree, node 0 first."""
        nodes = [0]
        for key in sequence:
            node = self.equal[nodes[-1]]
            while self.key[node] != key:
                node = (self.less if key < self.key[node] else self.more)[node]
            nodes.append(node)
        return nodes


_NODES = (
    "shard int, key binary, parent_key binary, parent_conv bigint, depth bigint, conv bigint, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved bigint, ends string"
)


def _shard_nodes(table: pa.Table) -> pa.Table:
    """The nodes of one shard. Those that other shards may have too carry a key, as their children do for them."""
    paths, sizes, counts, convs, ends = (table.column(c).to_pylist() for c in ("path", "sizes", "n", "conv", "ends"))
    order = sorted(range(len(paths)), key=paths.__getitem__)
    codes = np.frombuffer(b"".join(paths[i] for i in order), f"S{CODE_BYTES}")
    names, numbers = np.unique(codes, return_inverse=True)
    text_bytes = np.zeros(len(names), np.int64)
    text_bytes[numbers] = np.fromiter((s for i in order for s in sizes[i]), np.int64, len(numbers))
    text_bytes = text_bytes.tolist()
    lengths = [len(paths[i]) // CODE_BYTES for i in order]
    tops = np.cumsum([0, *lengths]).tolist()
    numbers = numbers.tolist()
    sequences = [numbers[a:b] for a, b in zip(tops, tops[1:], strict=False)]
    tree = Tree()
    tree.insert_sorted(sequences)

    size = len(tree.key)
    with_previous, with_next = (table.column(c)[0].as_py() for c in ("with_previous", "with_next"))
    owned, goes_on, keys = [True] * size, [False] * size, [None] * size
    for row, common, flags, value in ((0, with_previous, owned, False), (-1, with_next, goes_on, True)):
        path = paths[order[row]]
        for node in tree.path(sequences[row])[: common + 1]:
            flags[node] = value
            keys[node] = blake2b(path[: tree.depth[node] * CODE_BYTES], digest_size=16).digest()

    members, least, children = [0] * size, [None] * size, [0] * size
    leaves, saved, last = [0] * size, [0] * size, [None] * size
    for node in range(size - 1, -1, -1):  # a node is older than those below it
        if tree.row[node] >= 0:
            row = order[tree.row[node]]
            members[node] += counts[row]
            last[node] = ends[row]
            least[node] = convs[row] if least[node] is None else min(least[node], convs[row])
        if tree.equal[node] < 0 and not goes_on[node]:
            leaves[node] = 1
        if not node:
            break
        saved[node] += text_bytes[tree.key[node]] * (members[node] - owned[node])
        up = tree.up[node]
        members[up] += members[node]
        least[up] = least[node] if least[up] is None else min(least[up], least[node])
        children[up] += owned[node]
        leaves[up] += leaves[node]
        saved[up] += saved[node]

    up = tree.up
    parents = [None if p < 0 or keys[p] is not None else least[p] for p in up]
    parent_keys = [None if p < 0 else keys[p] for p in up]
    shard = [table.column("shard")[0].as_py()] * size
    columns = [shard, keys, parent_keys, parents, tree.depth, least, members, children, leaves, saved, last]
    kinds = [pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 7, pa.string()]
    names = [field.split()[0] for field in _NODES.split(", ")]
    return pa.table([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=names)


def prefix_nodes(told: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of the tree of ``told (conv_id, turns)``: every beginning of a conversation once.

    ``conv_id`` is its smallest member, ``parent_conv_id`` that of the beginning one turn
    shorter; ``saved_tokens`` the bytes of text that its subtree holds more than once.
    """
    paths = staged(distinct_paths(told), "paths")
    total = paths.agg(F.sum(F.octet_length("path") / CODE_BYTES + 1)).first()[0] or 0
    shards = max(1, -(-int(total) // shard_turns))
    dealt = paths.repartitionByRange(shards, "path").withColumn("shard", F.spark_partition_id())
    dealt = staged(dealt, "shards")

    # A row per shard: so many as there are partitions, whatever the input.
    by_shard = Window.orderBy("shard")
    edges = dealt.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("last"))
    edges = edges.withColumns({"before": F.lag("last").over(by_shard), "after": F.lead("first").over(by_shard)})
    common = edges.mapInArrow(_common_lengths, "shard int, with_previous bigint, with_next bigint")
    nodes = dealt.join(common, "shard").groupBy("shard").applyInArrow(_shard_nodes, _NODES)
    nodes = staged(nodes, "trie-nodes")

    alone = nodes.filter("key IS NULL")
    shared = nodes.filter("key IS NOT NULL")
    merged = shared.groupBy("key").agg(
        F.first("parent_key").alias("parent_key"),
        F.first("depth").alias("depth"),
        F.min("conv").alias("conv"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
        F.max("ends").alias("ends"),
    )
    merged = staged(merged, "merged-nodes")
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv").alias("shared_conv"))
    # Children look for their parent within their shard, so that the first turns of all do not meet in one task.
    in_shard = shared.select("shard", F.col("key").alias("parent_key")).join(parents, "parent_key")
    inner = alone.filter("parent_key IS NULL").withColumn("shared_conv", F.lit(None).cast("long"))
    outer = alone.filter("parent_key IS NOT NULL").join(in_shard, ["shard", "parent_key"])
    top = merged.join(parents, "parent_key", "left").withColumn("parent_conv", F.lit(None).cast("long"))

    def result(rows: DataFrame) -> DataFrame:
        return rows.select(
            F.col("conv").alias("conv_id"),
            "depth",
            F.coalesce("parent_conv", "shared_conv").alias("parent_conv_id"),
            "n_convs",
            "n_children",
            "n_leaves",
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
        )

    return result(inner).unionByName(result(outer)).unionByName(result(top))
