"""Similarity join of texts by the Jaccard similarity of their sets of word n-grams.

All sets are ordered alike, by the hashes of their n-grams (tokens). Two sets A and B are
similar when ``|A & B| >= t |A | B|``; then at most ``(1 - t) |A|`` tokens of A are not in B.

- A token is *rare* when at most ``RARE`` prefixes hold it, else *frequent*. Rare tokens
  are indexed one by one, frequent ones as combinations of two that follow each other
  among the frequent tokens of a prefix.
- A prefix is as long as that takes. Of two similar sets take the one whose prefix ends
  first. Let m of its prefix tokens be missing in the other set, and e tokens of the other
  stand between them. Without a common rare token all rare ones are missing; without a
  common combination, each missing frequent token breaks two of them and each extra one
  breaks one, so ``rare + (frequent - 1) / 2 <= m + e / 2``. Similarity bounds the right
  side by ``extent(n)``, so prefixes of ``2 * extent(n) + 2`` tokens lose no pair.
- A set with more rare tokens than can be missing always shares one of them. Pairs that
  meet in a combination are therefore only compared when one of the two has fewer.

Candidates are first held against bitmaps: a set's bitmap has, for each of ``BITS`` classes
of tokens, whether the set holds an odd number of them. Two bitmaps differ in at most as
many places as the sets do in tokens, so pairs with too many differences are no links.
The others are verified on both texts. Equal sets are one node from the start.
Combinations of a large group of near copies are met by all of its members: those are first
compared with one member. Members of a combination that are still in different components
are then compared by their bitmaps, block against block inside of tasks, which return none
but the pairs that can be links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.batches import byte_slices
from termloom.llm.components import components
from termloom.llm.words import find_words, gram_hashes, gram_starts, mix, word_hashes
from termloom.session import Staging, staged

#: A token in more prefixes is frequent.
RARE = 8
BITS = 512
#: A combination with more members is compared in blocks of about so many.
BLOCK = 2048
GATHER_BYTES = 4 << 20
#: Tokens of all sets for each task that writes, at least; smaller partitions share a file.
TASK_TOKENS = 250_000
#: Places over which the rows of equal sets are spread.
PARTS = 16


def _sets(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of each text, in their order, and where each text's begin (and the end)."""
    found = find_words(column, lower=True)
    hashes = word_hashes(found)
    inside = gram_starts(found, words)
    grams, owner = gram_hashes(hashes, words)[inside], found.doc[: len(inside)][inside]
    short = np.flatnonzero((found.counts > 0) & (found.counts < words))
    whole = np.array(
        [mix(gram_hashes(hashes[found.first[d] : found.first[d + 1]], int(found.counts[d])) + np.uint64(found.counts[d]))[0] for d in short],
        np.uint64,
    )
    grams = np.concatenate([grams, whole]) >> np.uint64(1)  # as positive signed numbers
    owner = np.concatenate([owner, short.astype(np.int32)])
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    grams, owner = grams[new], owner[new]
    return grams.astype(np.int64), np.searchsorted(owner, np.arange(len(column) + 1))


class Rule:
    """When two sets are similar: ``100 * common >= percent * all``."""

    def __init__(self, words: int, percent: int) -> None:
        if not 70 <= percent <= 100:  # lower, prefixes of short sets would not be long enough
            raise ValueError("percent must be from 70 to 100")
        self.words, self.percent = words, percent

    def missing(self, n: np.ndarray) -> np.ndarray:
        """Tokens of a set of n that a similar set can lack: (1 - t) n."""
        return (100 - self.percent) * n // 100

    def extent(self, n: np.ndarray) -> np.ndarray:
        """The most that m + e / 2 comes to, rounded up.

        m + e <= (1 - t) |A | B| with |A | B| = n + e: m <= (1 - t) n - t e, so that
        m + e / 2 <= (1 - t) n as t is over a half.
        """
        return -((self.percent - 100) * n // 100)

    def prefix(self, n: np.ndarray) -> np.ndarray:
        return np.minimum(n, 2 * self.extent(n) + 2)

    def possible(self, n_a: np.ndarray, n_b: np.ndarray, different: np.ndarray) -> np.ndarray:
        """Whether sets of these sizes can be similar when so many tokens at least are in one of them only."""
        least = np.maximum(np.abs(n_a - n_b), different)
        return least * (100 + self.percent) <= (n_a + n_b) * (100 - self.percent)

    def similar(self, a: np.ndarray, b: np.ndarray) -> bool:
        common = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * common >= self.percent * (len(a) + len(b) - common)


def _describe(rule: Rule) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Size, two hashes and bitmap of each text's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", GATHER_BYTES):
                grams, first = _sets(part.column("text"), rule.words)
                values = grams.astype(np.uint64)
                sums = []
                for value in (mix(values), mix(values ^ np.uint64(0x5851F42D4C957F2D))):
                    total = np.zeros(len(grams) + 1, np.uint64)
                    np.cumsum(value, out=total[1:])
                    sums.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
                sizes = np.diff(first)
                cells = np.repeat(np.arange(len(sizes)), sizes) * BITS + grams % BITS
                odd = (np.bincount(cells, minlength=len(sizes) * BITS) & 1).astype(np.uint8)
                bits = [row.tobytes() for row in np.packbits(odd.reshape(len(sizes), BITS), axis=1)]
                arrays = [part.column("doc_id"), pa.array(sizes), pa.array(sums[0]), pa.array(sums[1]), pa.array(bits, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n", "key_a", "key_b", "bits"])

    return run


def _tokens(rule: Rule) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Prefix tokens with their documents; of a token in more than ``RARE`` of a slice's sets, a row with their number.

    The documents of those tokens follow, with a count of 0. Equal sets of a slice count once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", GATHER_BYTES):
                grams, first = _sets(part.column("text"), rule.words)
                sizes = np.diff(first)
                docs = part.column("doc_id").to_numpy()
                once: dict[bytes, int] = {}
                for d in np.argsort(docs, kind="stable").tolist():
                    once.setdefault(grams[first[d] : first[d + 1]].tobytes(), d)
                own = np.zeros(len(docs), bool)
                own[list(once.values())] = True
                lengths = np.where(own, rule.prefix(sizes), 0)
                owner = np.repeat(np.arange(len(docs)), lengths)
                at = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + first[owner]
                tokens, holders = grams[at], docs[owner]
                order = np.argsort(tokens, kind="stable")
                tokens, holders = tokens[order], holders[order]
                starts = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1])) if len(tokens) else order
                counts = np.diff(np.append(starts, len(tokens)))
                crowded = np.repeat(counts > RARE, counts)
                many = starts[counts > RARE]
                of = [pa.array(holders[~crowded], pa.int64()), pa.nulls(len(many), pa.int64()), pa.array(holders[crowded], pa.int64())]
                number = [np.ones(int((~crowded).sum())), counts[counts > RARE], np.zeros(int(crowded.sum()))]
                arrays = [
                    pa.array(np.concatenate([tokens[~crowded], tokens[many], tokens[crowded]])),
                    pa.concat_arrays(of),
                    pa.array(np.concatenate(number).astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["token", "doc_id", "count"])

    return run


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by token: the pairs of documents of each rare token, the documents of each frequent one.

    A token has at most ``RARE`` rows of each slice, however many documents hold it.
    """
    names = ["a", "b", "token"]

    def made(token: np.ndarray, doc: np.ndarray, empty: np.ndarray, count: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(token):
            return
        starts = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
        rows = np.diff(np.append(starts, len(token)))
        total = np.add.reduceat(count, starts)
        firsts, seconds = [], []
        for size in range(2, RARE + 1):
            group = starts[(rows == size) & (total <= RARE)]
            for i in range(size):
                for j in range(i + 1, size):
                    firsts.append(doc[group + i])
                    seconds.append(doc[group + j])
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (firsts, seconds))
        pairs = np.unique(np.column_stack([np.minimum(a, b), np.maximum(a, b)])[a != b], axis=0)
        frequent = np.repeat(total > RARE, rows) & ~empty
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([pairs[:, 0], doc[frequent]])),
                pa.concat_arrays([pa.array(pairs[:, 1], pa.int64()), pa.nulls(int(frequent.sum()), pa.int64())]),
                pa.concat_arrays([pa.nulls(len(pairs), pa.int64()), pa.array(token[frequent], pa.int64())]),
            ],
            names=names,
        )

    held: list[np.ndarray] | None = None
    for batch in batches:
        doc = batch.column("doc_id")
        new = [
            batch.column("token").to_numpy(),
            doc.fill_null(0).to_numpy(),
            doc.is_null().to_numpy(zero_copy_only=False),
            batch.column("count").to_numpy().astype(np.int64),
        ]
        held = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
        # The last token may go on in the next batch.
        cut = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
        yield from made(*(x[:cut] for x in held))
        held = [x[cut:] for x in held]
    if held is not None:
        yield from made(*held)


def _by_bitmaps(rule: Rule) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(batch.num_rows, BITS // 64)
                for c in ("bits_a", "bits_b")
            ]
            different = np.bitwise_count(bits[0] ^ bits[1]).sum(axis=1, dtype=np.int64)
            good = rule.possible(batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy(), different)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return run


def possible_pairs(pairs: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """Those of ``pairs (a, b)`` that sizes and bitmaps of ``nodes (node, n, bits)`` leave."""
    joined = pairs
    for end in ("a", "b"):
        of = nodes.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}"), F.col("bits").alias(f"bits_{end}"))
        joined = joined.join(of, end)
    joined = joined.select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
    return joined.mapInArrow(_by_bitmaps(rule), "a bigint, b bigint")


def _verify(rule: Rule) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Which of the pairs ``(a, b, text_a, text_b)`` are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text_a"):
                for half in byte_slices(part, "text_b"):
                    # A pair's texts often repeat from row to row; each distinct one is cut once.
                    both = pa.chunked_array([half.column("text_a"), half.column("text_b")]).dictionary_encode()
                    both = both.unify_dictionaries()
                    codes = np.concatenate([c.indices.to_numpy() for c in both.chunks])
                    grams, first = _sets(both.chunk(0).dictionary, rule.words)
                    sets = [grams[s:e] for s, e in zip(first[:-1], first[1:], strict=True)]
                    n = half.num_rows
                    good = np.array([rule.similar(sets[codes[i]], sets[codes[n + i]]) for i in range(n)], bool)
                    yield half.select(["a", "b"]).filter(pa.array(good))

    return run


def similar_pairs(pairs: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """Those of ``pairs (a, b)`` whose ``texts (doc_id, text)`` are similar."""
    first = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(_verify(rule), "a bigint, b bigint")


def _combinations(frequent: DataFrame, members: DataFrame, rule: Rule) -> DataFrame:
    """``(node, few, combination, before)`` of each set with two frequent tokens: neighbours in their order.

    ``few``: the prefix doesn't have more rare tokens than can be missing. ``before`` is the
    set's combination before this one. Sizes of similar sets differ by a band at most, so a
    set is in its own band and the next.
    """
    sets = frequent.groupBy("doc_id").agg(F.sort_array(F.collect_set("token")).alias("tokens"))
    sets = sets.join(members.filter("doc_id = node").select("doc_id", "n"), "doc_id")
    n, count = F.col("n"), F.size("tokens")
    missing = F.floor(n * (100 - rule.percent) / 100)
    extent = F.ceil(n * (100 - rule.percent) / 100)
    rare = F.least(n, 2 * extent + 2) - count
    band = F.floor(F.log(n.cast("double")) / float(-np.log(rule.percent / 100 - 1e-9))) if rule.percent < 100 else n
    rows = sets.filter(count > 1).select(
        F.col("doc_id").alias("node"), (rare <= missing).alias("few"), "tokens", F.explode(F.array(band, band + 1)).alias("band")
    )
    keys = F.transform(
        F.sequence(F.lit(1), F.size("tokens") - 1),
        lambda i: F.xxhash64(F.element_at("tokens", i), F.element_at("tokens", i + 1), "band"),
    )
    rows = rows.select("node", "few", keys.alias("keys"))
    before = F.xxhash64(F.lit("none"), "node")
    each = F.transform(
        "keys", lambda key, i: F.struct(key.alias("combination"), F.coalesce(F.get("keys", i - 1), before).alias("before"))
    )
    return rows.select("node", "few", F.inline(each))


def _apart(combinations: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of combinations that meet in more than one component, one of them with few rare tokens."""
    found = combinations.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    kept = found.groupBy("combination").agg(
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.max("few").alias("some"),
        F.count(F.lit(1)).alias("size"),
    )
    kept = kept.filter("low < high AND some").select("combination", "size")
    return found.join(kept, "combination")


def _stars(rows: DataFrame) -> DataFrame:
    """Pairs of one member of each combination and all of its other members."""
    of = F.when(F.col("few"), F.col("node"))
    heads = rows.groupBy("combination").agg(F.min(of).alias("head"))
    pairs = rows.join(heads, "combination").filter("node <> head")
    return pairs.select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct()


def _in_blocks(rows: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """Pairs within combinations that their components, sizes and bitmaps leave.

    A combination of many members is cut into blocks by their hashes, and each two blocks
    meet in a group of their own.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.hash("node"), F.col("blocks"))
    rows = rows.withColumn("blocks", blocks).withColumn("block", own)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    of = nodes.select("node", "n", "bits")
    rows = rows.join(of, "node").select("combination", "low", "high", "block", "node", "few", "component", "before", "n", "bits")
    groups = rows.repartition("combination", "low", "high").sortWithinPartitions("combination", "low", "high")
    return groups.mapInArrow(_compare(rule), "a bigint, b bigint").distinct()


def _compare(rule: Rule) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = ["block", "node", "few", "component", "before", "n"]

    def group(low: int, high: int, rows: dict[str, np.ndarray], bits: np.ndarray) -> Iterator[np.ndarray]:
        left = np.flatnonzero(rows["block"] == low)
        right = np.flatnonzero(rows["block"] == high)
        for i in left.tolist():
            others = right[right > i] if low == high else right
            # A pair with one combination before this has met there.
            apart = rows["component"][others] != rows["component"][i]
            apart &= (rows["before"][others] != rows["before"][i]) & (rows["few"][others] | rows["few"][i])
            others = others[apart]
            if len(others):
                different = np.bitwise_count(bits[others] ^ bits[i]).sum(axis=1, dtype=np.int64)
                others = others[rule.possible(rows["n"][others], rows["n"][i], different)]
                node, theirs = rows["node"][i], rows["node"][others]
                yield np.column_stack([np.minimum(theirs, node), np.maximum(theirs, node)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def made(table: pa.Table) -> Iterator[pa.RecordBatch]:
            if not table.num_rows:
                return
            keys = [table.column(c).to_numpy() for c in ("combination", "low", "high")]
            rows = {c: table.column(c).to_numpy() for c in names}
            bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint64).reshape(table.num_rows, BITS // 64)
            new = np.ones(table.num_rows, bool)
            new[1:] = np.any([key[1:] != key[:-1] for key in keys], axis=0)
            starts = np.flatnonzero(new)
            found = []
            for s, e in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows], strict=True):
                if e - s > 1:
                    found += group(int(keys[1][s]), int(keys[2][s]), {c: v[s:e] for c, v in rows.items()}, bits[s:e])
            if found:
                pairs = np.unique(np.concatenate(found), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            keys = [held.column(c).to_numpy() for c in ("combination", "low", "high")]
            # The last group may go on in the next batch.
            same = np.all([key == key[-1] for key in keys], axis=0) if held.num_rows else np.zeros(0, bool)
            cut = int(held.num_rows - same.sum())
            yield from made(held.slice(0, cut))
            held = held.slice(cut)
        if held is not None:
            yield from made(held)

    return run


def join_similar(docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id", column: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per row of ``docs``.

    ``component_id`` is the smallest id that links of similar texts reach. A-Z are taken as
    a-z; a text of fewer words than ``words`` is one n-gram; a text without words, or a
    null one, has none and is linked with nothing. Rows with equal texts are similar, also
    when they share their id. A row without an id is linked with nothing, and its
    component is null. Ids are taken to name one text each: rows that share an id with
    different texts are one node of the graph.
    """
    rule = Rule(words, percent)
    staging = Staging(docs.sparkSession)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(column).alias("text"))
    described = texts.mapInArrow(_describe(rule), "doc_id bigint, n bigint, key_a bigint, key_b bigint, bits binary")
    described = staged(described, "sets")
    size, grams = described.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    tasks = max(1, -(-grams // TASK_TOKENS))
    members = staged(_equal_sets(described.filter("n > 0 AND doc_id IS NOT NULL")), "members", size)
    nodes = members.filter("doc_id = node").select("node", "n", "bits").dropDuplicates(["node", "n"])
    members = members.select("doc_id", "n", "node")

    usable = texts.filter("doc_id IS NOT NULL AND text IS NOT NULL")
    # Slices may fall differently whenever the texts are read, so one reading makes both kinds of rows.
    found = staging.keep("tokens", usable.mapInArrow(_tokens(rule), "token bigint, doc_id bigint, count int"))
    tokens = found.filter("count > 0").repartition("token").sortWithinPartitions("token")
    classed = staging.keep("classed", tokens.mapInArrow(_classes, "a bigint, b bigint, token bigint").coalesce(tasks))
    crowded = found.filter("count = 0").select("doc_id", "token")
    frequent = classed.filter("b IS NULL").select(F.col("a").alias("doc_id"), "token").unionByName(crowded)
    # Sets that several slices hold have one node.
    node_of = members.select("doc_id", "node").distinct()
    frequent = frequent.join(node_of, "doc_id").select(F.col("node").alias("doc_id"), "token").distinct()
    combinations = staging.keep("combinations", _combinations(frequent, members, rule).coalesce(tasks))
    staging.drop("tokens")
    pairs = classed.filter("b IS NOT NULL").select("a", "b").distinct()
    for end in ("a", "b"):
        of = node_of.select(F.col("doc_id").alias(end), F.col("node").alias(f"node_{end}"))
        pairs = pairs.join(of, end)
    pairs = pairs.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).filter("a < b")
    rows = _apart(combinations, docs.sparkSession.createDataFrame([], "node bigint, component bigint"))
    pairs = pairs.unionByName(_stars(rows)).distinct()
    pairs = staging.keep("pairs", possible_pairs(pairs, nodes, rule), size)
    staging.drop("classed")

    # From here on only texts of nodes with a candidate matter.
    wanted = [pairs.select("a"), pairs.select("b"), rows.select("node")]
    wanted = reduce(DataFrame.union, wanted).distinct().toDF("doc_id")
    chosen = staging.keep("candidates", usable.join(wanted, "doc_id").coalesce(tasks))
    links = [staged(similar_pairs(pairs, chosen, rule), "similar", size)]
    staging.drop("pairs")
    same = named_links(members)
    labels = components(links[0].union(same), size)
    apart = _apart(combinations, labels)
    pairs = staging.keep("blocks", _in_blocks(apart, nodes, rule), size)
    staging.drop("combinations")
    links.append(staged(similar_pairs(pairs, chosen, rule), "similar", size))
    staging.drop("blocks", "candidates")
    labels = components(reduce(DataFrame.union, links).union(same), size)
    found = labels.withColumnRenamed("node", "__node")
    return described.join(found, F.col("doc_id") == F.col("__node"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )


def _equal_sets(named: DataFrame) -> DataFrame:
    """``(doc_id, n, node, bits)``: of equal sets the smallest id is the node.

    Only sets that occur again look for it, in one of ``PARTS`` places each, so that the
    copies of one text do not meet in one task.
    """
    keys = ["key_a", "key_b", "n"]
    again = named.groupBy(*keys).agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    again = again.select(*keys, "first", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"))
    part = F.pmod(F.hash("doc_id", "bits"), F.lit(PARTS))
    found = named.withColumn("part", part).join(again, [*keys, "part"], "left")
    return found.select("doc_id", "n", F.coalesce("first", "doc_id").alias("node"), "bits")


def named_links(members: DataFrame) -> DataFrame:
    """Links between each document and the first one with an equal set."""
    return members.filter("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b")).distinct()
