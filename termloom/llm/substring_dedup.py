"""Passages that repeat across documents, found with a compressed index per shard.

A passage counts from ``length`` words on. Comparing every document with every shard
would grow with the square of the corpus, so documents are cut by their content, and
pieces meet in a shard only where they can match:

1. The anchor of a window of ``length`` words is the smallest hash of the short runs of
   words in it. Windows with the same words have the same anchor; neighbouring windows
   with one anchor make a piece. Anchors are gathered slice by slice, one row for each
   slice and anchor, and those that occur in one document only are left out.
2. The remaining pieces go, each distinct one once per slice, to the shard of their
   anchor. The shard builds an FM-index of its pieces and searches all their windows
   backwards. Of each window it finds the smallest document in which it stands.
3. A piece's answer goes back to every document that has the piece, by an ordinary join
   that Spark can split where one piece is in a large part of all documents.

An anchor that stands in many different pieces (a phrase shorter than ``length`` in many
contexts) would fill a shard. Its windows go to shards one by one, by all of their words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termloom.llm.batches import add_columns, byte_slices
from termloom.llm.fm_index import FMIndex
from termloom.llm.words import Words, find_words, gram_hashes, gram_starts, text_bytes, word_hashes
from termloom.session import staged

LENGTH = 13
ANCHOR_WORDS = 5
#: Bytes of text of which one slice gathers its anchors.
GATHER_BYTES = 4 << 20
#: An anchor with so many pieces, those of all slices together, is split by whole windows. So a
#: shard never holds more different pieces of one anchor, and equal windows are one piece again.
CROWDED = 1 << 11
#: Symbols of one index; a shard's anchors are packed into indexes of about this size.
INDEX_SYMBOLS = 1 << 18


def _windows(words: Words, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each window: whether one text holds it, its anchor, and a hash of all its words."""
    hashes = word_hashes(words)
    inside = gram_starts(words, length)
    short = gram_hashes(hashes, ANCHOR_WORDS)
    anchor = short[: len(inside)].copy()
    for i in range(1, length - ANCHOR_WORDS + 1):
        np.minimum(anchor, short[i : i + len(inside)], out=anchor)
    return inside, anchor.view(np.int64), gram_hashes(hashes, length).view(np.int64)


def _pieces(inside: np.ndarray, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First window and number of windows of each piece."""
    new = inside.copy()
    new[1:] &= ~inside[:-1] | (anchor[1:] != anchor[:-1])
    first = np.flatnonzero(new)
    ends = np.append(first[1:], len(inside))
    # A piece ends with its text: the windows that reach over two texts follow it.
    total = np.zeros(len(inside) + 1, np.int64)
    np.cumsum(inside, out=total[1:])
    return first, total[ends] - total[first]


def _piece_hashes(whole: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A second hash of a piece, from its first and last window and its length."""
    ends = whole[first + count - 1].astype(np.uint64)
    with np.errstate(over="ignore"):
        value = whole[first].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        value += ends * np.uint64(0xC2B2AE3D27D4EB4F) + count.astype(np.uint64)
    total = np.zeros(len(whole) + 1, np.uint64)
    np.cumsum(whole.view(np.uint64), out=total[1:])
    return (value ^ (total[first + count] - total[first])).view(np.int64)


def _runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that sorts by the keys, and where equal rows begin in it."""
    order = np.argsort(keys[0])
    # Few rows share their first key: only those are sorted by the others.
    new = np.append(True, keys[0][order][1:] != keys[0][order][:-1])[: len(order)]
    several = np.flatnonzero(~new | ~np.append(new[1:], True)[: len(order)])
    rest = np.sort(order[several])
    order[several] = rest[np.lexsort([key[rest] for key in keys[::-1]])]
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = False
        for key in keys:
            new[1:] |= key[order][1:] != key[order][:-1]
    return order, np.flatnonzero(new)


def _anchors(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of each slice, its anchors with smallest and largest document, all documents but the smallest, and how many pieces they have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", GATHER_BYTES):
                words = find_words(part.column("text"))
                inside, anchor, whole = _windows(words, length)
                first, count = _pieces(inside, anchor)
                docs = part.column("doc_id").to_numpy()[words.doc[first]]
                anchors, seconds = anchor[first], _piece_hashes(whole, first, count)
                order, runs = _runs(anchors, docs)
                anchors, docs = anchors[order][runs], docs[order][runs]
                starts = np.flatnonzero(np.append(True, anchors[1:] != anchors[:-1])) if len(anchors) else runs
                sizes = np.diff(np.append(starts, len(anchors)))
                all_anchors = anchor[first]
                order, runs = _runs(all_anchors, seconds)
                of = all_anchors[order][runs]
                many = np.diff(np.append(np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else runs, len(of)))
                others = np.ones(len(docs), bool)
                others[starts] = False
                ends = np.append(0, np.cumsum(sizes - 1)).astype(np.int32)
                arrays = [
                    pa.array(anchors[starts]),
                    pa.array(docs[starts]),
                    pa.array(docs[starts + sizes - 1] if len(starts) else docs),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(docs[others]), mask=pa.array(sizes == 1)),
                    pa.array(many.astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["anchor", "low", "high", "others", "pieces"])

    return run


def _shared_anchors(texts: DataFrame, length: int) -> DataFrame:
    """``(doc_id, anchors, crowded)``: of each document the anchors that others have too.

    Slices may fall differently whenever the texts are read, so one reading tells both
    which anchors are shared and which documents have them.
    """
    gathered = texts.mapInArrow(
        _anchors(length), "anchor bigint, low bigint, high bigint, others array<bigint>, pieces int"
    )
    # A group has one row per slice at most, however many documents share the anchor.
    same = Window.partitionBy("anchor")
    gathered = gathered.withColumns(
        {
            "least": F.min("low").over(same),
            "most": F.max("high").over(same),
            "crowded": F.sum("pieces").over(same) >= CROWDED,
        }
    ).filter("least < most")
    docs = F.concat(F.array("low"), F.coalesce("others", F.array().cast("array<bigint>")))
    both = gathered.select(F.explode(docs).alias("doc_id"), "anchor", "crowded")
    return both.groupBy("doc_id").agg(
        F.collect_set(F.when(~F.col("crowded"), F.col("anchor"))).alias("anchors"),
        F.collect_set(F.when(F.col("crowded"), F.col("anchor"))).alias("crowded"),
    )


def _text_key(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def _listed(lists: pa.Array, doc: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Which anchors are in the list of their text."""
    values = lists.flatten().to_numpy(zero_copy_only=False)
    if not len(values):
        return np.zeros(len(anchors), bool)
    owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    # An anchor by its number among all values, so that it has one number together with its text.
    known = np.unique(values)
    at = np.minimum(np.searchsorted(known, anchors), len(known) - 1)
    listed = np.searchsorted(known, values) + owner * len(known)
    return (known[at] == anchors) & np.isin(at + doc.astype(np.int64) * len(known), listed)


def _located(part: pa.RecordBatch, length: int) -> tuple[Words, dict[str, np.ndarray]]:
    """The pieces that shared anchors make of each text: shard, second hash, text, first word, windows."""
    words = find_words(part.column("text"))
    inside, anchor, whole = _windows(words, length)
    first, count = _pieces(inside, anchor)
    anchors, doc = anchor[first], words.doc[first]
    chosen, crowded = (_listed(part.column(name), doc, anchors) for name in ("anchors", "crowded"))
    single = np.repeat(first[crowded], count[crowded])
    steps = np.arange(len(single)) - np.repeat(np.cumsum(count[crowded]) - count[crowded], count[crowded])
    single = single + steps
    at = np.concatenate([first[chosen], single])
    windows = np.concatenate([count[chosen], np.ones(len(single), np.int64)])
    shard = np.concatenate([anchors[chosen], whole[single]])
    return words, {"shard": shard, "second": _piece_hashes(whole, at, windows), "first": at, "windows": windows}


def _to_shards(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Distinct pieces of each slice, with the smallest and largest document that has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", GATHER_BYTES):
                words, found = _located(part, length)
                docs = part.column("doc_id").to_numpy()[words.doc[found["first"]]]
                order, runs = _runs(found["shard"], found["second"], docs)
                order = order[runs]
                shard, second = found["shard"][order], found["second"][order]
                new = np.ones(len(order), bool)
                new[1:] = (shard[1:] != shard[:-1]) | (second[1:] != second[:-1])
                starts = np.flatnonzero(new)
                lasts = np.append(starts[1:], len(order)) - 1 if len(starts) else starts
                one = order[starts]
                first, windows = found["first"][one], found["windows"][one]
                raw = words.data.tobytes()
                starts_at, ends_at = words.start[first].tolist(), words.end[first + windows + length - 2].tolist()
                texts = [raw[a:b] for a, b in zip(starts_at, ends_at, strict=True)]
                arrays = [
                    pa.array(found["shard"][one]),
                    pa.array(found["second"][one]),
                    pa.array(docs[order[starts]]),
                    pa.array(docs[order[lasts]]),
                    pa.array(texts, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["shard", "second", "low", "high", "piece"])

    return run


def _in_documents(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Where each document has which piece: its first word, counted from the text's first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", GATHER_BYTES):
                words, found = _located(part, length)
                doc = words.doc[found["first"]]
                keys = np.array([_text_key(text) for text in part.column("text").to_pylist()], np.int64)
                arrays = [
                    pa.array(found["shard"]),
                    pa.array(found["second"]),
                    pa.array(part.column("doc_id").to_numpy()[doc]),
                    pa.array(keys[doc] if len(keys) else keys),
                    pa.array((found["first"] - words.first[doc]).astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["shard", "second", "doc_id", "text_key", "first"])

    return run


def index_pieces(pieces: list[bytes] | pa.Array, docs: np.ndarray, length: int) -> list[np.ndarray]:
    """Of each window of each piece, the smallest document of the pieces in which it stands."""
    least, counts = _least_documents(pa.array(pieces, pa.binary()), docs, length)
    return np.split(least, np.cumsum(counts)[:-1])


def _least_documents(pieces: pa.Array, docs: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """What :func:`index_pieces` tells, all pieces in one array, and the windows of each piece."""
    words = find_words(pieces)
    hashes = word_hashes(words)
    _, symbols = np.unique(hashes, return_inverse=True)
    # A separator follows every piece.
    text = np.zeros(len(symbols) + len(pieces), np.int64)
    at = np.arange(len(symbols)) + words.doc
    text[at] = symbols + 1
    index = FMIndex(text, length)
    windows = np.flatnonzero(gram_starts(words, length))
    # A window that stands in several pieces is searched once.
    _, one, same = np.unique(gram_hashes(hashes, length)[windows], return_index=True, return_inverse=True)
    matched, low, high = index.search(at[windows[one]] + length, text, length)
    assert (matched == length).all()  # every window is in the index
    owner = np.repeat(np.arange(len(pieces)), words.counts + 1)
    of_suffix = np.append(docs[owner][index.suffixes], np.iinfo(np.int64).max)
    order = np.argsort(low)
    bounds = np.column_stack([low[order], high[order]]).ravel()
    least = np.empty(len(one), np.int64)
    least[order] = np.minimum.reduceat(of_suffix, bounds)[::2] if len(bounds) else bounds
    return least[same], np.bincount(words.doc[windows], minlength=len(pieces))


def _search_shards(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Index and search the pieces of a partition that is sorted by shard and piece."""

    def merged(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        """The rows, those of a piece that several slices sent as one."""
        columns = [pa.concat_arrays(arrays) for arrays in zip(*(part.columns for part in parts), strict=True)]
        shard, second, low, high = (column.to_numpy() for column in columns[:4])
        starts = np.flatnonzero(np.append(True, (shard[1:] != shard[:-1]) | (second[1:] != second[:-1])))
        ends = pa.array(np.minimum.reduceat(low, starts)), pa.array(np.maximum.reduceat(high, starts))
        arrays = [pa.array(shard[starts]), pa.array(second[starts]), *ends, columns[4].take(pa.array(starts))]
        return pa.RecordBatch.from_arrays(arrays, names=["shard", "second", "low", "high", "piece"])

    def flush(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        pieces = merged(parts)
        shard, second, low, high = (column.to_numpy() for column in pieces.columns[:4])
        least, counts = _least_documents(pieces.column("piece"), low, length)
        ends = np.append(0, np.cumsum(counts))
        told = np.add.reduceat(least < np.repeat(high, counts), ends[:-1]) > 0
        kept = pa.py_buffer(least[np.repeat(told, counts)].astype("<i8"))
        offsets = pa.py_buffer(np.append(0, np.cumsum(8 * counts[told])).astype(np.int32))
        arrays = [
            pa.array(shard[told]),
            pa.array(second[told]),
            pa.Array.from_buffers(pa.binary(), int(told.sum()), [None, offsets, kept]),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=["shard", "second", "least"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, before = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = merged([batch])
            shard = batch.column("shard").to_numpy()
            words = np.cumsum(pc.count_substring(batch.column("piece"), " ").to_numpy() + 1, dtype=np.int64)
            # Where another anchor begins, and the words that stand before it here.
            new = np.flatnonzero(np.append(shard[0] != before, shard[1:] != shard[:-1]))
            upto = np.append(0, words)[new]
            at = told = 0
            while (cut := int(np.searchsorted(upto, INDEX_SYMBOLS - size + told))) < len(new):
                if new[cut] > at:
                    held.append(batch.slice(at, new[cut] - at))
                yield flush(held)
                held, size, at, told = [], 0, int(new[cut]), int(upto[cut])
            held.append(batch.slice(at))
            size, before = size + int(words[-1]) - told, shard[-1]
        if held:
            yield flush(held)

    return run


def find_repeats(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", column: str = "text") -> DataFrame:
    """``(doc_id, repeats)`` of the documents that repeat a passage of a document with a smaller id.

    ``repeats`` lists ``(text_key, first, least)``: pieces by their first word, with the
    smallest document of each of their windows, packed as 8-byte integers. Documents
    without an id or a text take no part.
    """
    texts = _texts(docs, doc_id, column)
    shared = staged(_shared_anchors(texts, length), "shared-anchors")
    found = texts.join(shared, "doc_id")
    pieces = found.mapInArrow(_to_shards(length), "shard bigint, second bigint, low bigint, high bigint, piece binary")
    pieces = pieces.repartition("shard").sortWithinPartitions("shard", "second")
    answers = pieces.mapInArrow(_search_shards(length), "shard bigint, second bigint, least binary")
    placed = found.mapInArrow(
        _in_documents(length), "shard bigint, second bigint, doc_id bigint, text_key bigint, first int"
    )
    hits = placed.join(answers, ["shard", "second"])
    return hits.groupBy("doc_id").agg(F.collect_list(F.struct("text_key", "first", "least")).alias("repeats"))


def _texts(docs: DataFrame, doc_id: str, column: str) -> DataFrame:
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(column).alias("text"))
    return texts.filter("doc_id IS NOT NULL AND text IS NOT NULL")


def _repeated(part: pa.RecordBatch, words: Words, length: int) -> np.ndarray:
    """Which words of each text are covered by windows that a smaller document has."""
    lists = part.column("repeats")
    owner = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).fill_null(0).to_numpy())
    if not len(owner):
        return np.zeros(len(words.start), bool)
    repeats = pa.table(lists.flatten().flatten(), names=["text_key", "first", "least"])
    keys = np.zeros(len(lists), np.int64)
    some = np.unique(owner)
    keys[some] = [_text_key(text) for text in part.column("text").take(pa.array(some)).to_pylist()]
    of_text = repeats["text_key"].to_numpy() == keys[owner]
    repeats, owner = repeats.filter(pa.array(of_text)).combine_chunks(), owner[of_text]
    raw, ends = text_bytes(repeats["least"].combine_chunks())
    least, ends = raw.view("<i8"), ends // 8
    sizes = np.diff(ends)
    # By the texts' words one after another, where each window begins.
    shift = words.first[owner] + repeats["first"].to_numpy() - ends[:-1]
    at = np.arange(len(least)) + np.repeat(shift, sizes)
    at = at[least < np.repeat(part.column("doc_id").to_numpy()[owner], sizes)]
    total = len(words.start) + 1
    edge = np.bincount(at, minlength=total) - np.bincount(at + length, minlength=total)
    return np.cumsum(edge[:-1]) > 0


def _kept_texts(words: Words, gone: np.ndarray) -> pa.Array:
    """The words that stay of each text, with one space between them."""
    bytes_kept = np.zeros(len(words.data), bool)
    bytes_kept[words.solid] = np.repeat(~gone, words.end - words.start)
    stays = np.flatnonzero(~gone)
    # A word that another one of its text follows has white space behind it.
    behind = words.end[stays[:-1][words.doc[stays[1:]] == words.doc[stays[:-1]]]]
    bytes_kept[behind] = True
    data = words.data.copy()
    data[behind] = 0x20
    ends = np.append(0, np.cumsum(bytes_kept))[words.texts]
    buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data[bytes_kept])]
    return pa.Array.from_buffers(pa.string(), len(ends) - 1, buffers)


def remove_repeats(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", column: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_removed, intervals, kept_text)``, a row per row of ``docs``.

    Every word goes that a window of ``length`` words covers whose words stand, in this
    order, in a document with a smaller id; ``intervals`` are the word ranges that went,
    ``kept_text`` the words that stay with one space between them. Windows are judged on
    the input. A row without an id, or without words, stays as it is; so does the first
    of equal documents. Rows that share an id are texts of one document: they are not
    compared with each other.
    """

    def make(part: pa.RecordBatch) -> dict[str, pa.Array]:
        words = find_words(part.column("text"))
        gone = _repeated(part, words, length)
        same = words.doc[1:] == words.doc[:-1]
        starts = np.flatnonzero(gone & ~np.append(False, gone[:-1] & same)[: len(gone)])
        ends = np.flatnonzero(gone & ~np.append(gone[1:] & same, False)[: len(gone)]) + 1
        before = words.first[words.doc[starts]]
        intervals = pa.StructArray.from_arrays([pa.array(starts - before), pa.array(ends - before)], names=["start", "end"])
        offsets = pa.array(np.searchsorted(starts, words.first).astype(np.int32))
        removed = np.append(0, np.cumsum(gone))[words.first]
        return {
            "n_words": pa.array(words.counts),
            "n_removed": pa.array(np.diff(removed)),
            "intervals": pa.ListArray.from_arrays(offsets, intervals),
            "kept_text": _kept_texts(words, gone),
        }

    ddl = "n_words bigint, n_removed bigint, intervals array<struct<start: bigint, end: bigint>>, kept_text string"
    repeats = find_repeats(docs, length, doc_id, column)
    # The same shuffled texts as in the search; Spark reads them again.
    joined = _texts(docs, doc_id, column).join(repeats, "doc_id", "left")
    rest = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(column).alias("text"))
    rest = rest.filter("doc_id IS NULL OR text IS NULL").withColumn("repeats", F.lit(None).cast(joined.schema["repeats"].dataType))
    made = [add_columns(df, make, ddl, "text", ["doc_id"], ("repeats",)) for df in (joined, rest)]
    return made[0].unionByName(made[1])
