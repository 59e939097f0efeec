"""Cross-entropy difference of two n-gram language models.

A target and a background model of the same form score every token of a text. Both know
all words and all word pairs of both corpora, counted over all of their texts.

    P(w | v) = MIX * count(v, w) / count(v) + (1 - MIX) * (count(w) + 1) / (tokens + words)

A text's score is the mean of its tokens' losses (negative logarithms) by the target model
less that by the background model: the lower, the more it is like the target.

The counts grow with the corpora, so no task holds them. Texts are stored in slices. Each
slice sends its distinct words and pairs once, in buckets by their hashes, so that a
frequent one makes no more rows than a rare one. A bucket adds up the counts and answers
each slice with them, and the answers meet the slice's texts again. The number of buckets
follows that of the slices, so that a bucket has about the same size in any corpus.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from termloom.llm.batches import byte_slices
from termloom.llm.words import Words, find_words, gram_hashes, gram_starts, word_hashes
from termloom.session import staged

MIX = 0.6
#: Fewest buckets, as a power of two; with more slices there is one for each four of them.
BUCKET_BITS = 10
GATHER_BYTES = 4 << 20


@dataclass
class Whole:
    """Models of all words and pairs of two corpora; they are counted when texts are scored."""

    target: DataFrame
    background: DataFrame
    column: str


def fit(target: DataFrame, background: DataFrame, column: str = "text") -> Whole:
    """Models of both corpora, all words and pairs of whole texts. Null texts have no tokens; an empty
    corpus makes a flat model."""
    return Whole(target, background, column)


def _pack(*counts: np.ndarray) -> bytes:
    """Arrays of one length, each in the narrowest type that holds it, after a byte for each type's width."""
    narrow = [c.astype(np.min_scalar_type(int(c.max(initial=0)))) for c in counts]
    return bytes([c.itemsize for c in narrow]) + b"".join(c.tobytes() for c in narrow)


def _unpack(data: bytes, arrays: int) -> list[np.ndarray]:
    widths = list(data[:arrays])
    n, at, out = (len(data) - arrays) // sum(widths), arrays, []
    for width in widths:
        out.append(np.frombuffer(data, f"<u{width}", n, at).astype(np.int64))
        at += n * width
    return out


def _grams(column: pa.Array) -> tuple[Words, np.ndarray, np.ndarray]:
    """The words of the texts, a value of each word, and of each but a text's first one with the word before.

    Values of words are even, those of pairs odd.
    """
    words = find_words(column, lower=True)
    hashes = word_hashes(words)
    pairs = gram_hashes(hashes, 2)[gram_starts(words, 2)]
    return words, hashes & ~np.uint64(1), pairs | np.uint64(1)


_GRAMS = "bucket int, target boolean, background boolean, slice bigint, items binary, counts binary"


def _counted(column: pa.Array, bits: int, target: bool, background: bool, number: int | None) -> pa.RecordBatch:
    """Distinct words and pairs of a slice with their counts, a row for each bucket."""
    _, singles, pairs = _grams(column)
    items, counts = np.unique(np.concatenate([singles, pairs]), return_counts=True)
    buckets = (items >> np.uint64(64 - bits)).astype(np.int32)
    starts = np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1])) if len(items) else np.zeros(0, np.int64)
    ends = [*starts[1:].tolist(), len(items)]
    spans = list(zip(starts.tolist(), ends, strict=False))
    arrays = [
        pa.array(buckets[starts]),
        pa.array([target] * len(spans), pa.bool_()),
        pa.array([background] * len(spans), pa.bool_()),
        pa.array([number] * len(spans), pa.int64()),
        pa.array([items[a:b].tobytes() for a, b in spans], pa.binary()),
        pa.array([_pack(counts[a:b]) for a, b in spans], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(arrays, names=["bucket", "target", "background", "slice", "items", "counts"])


def _count_corpus(bits: int, target: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", GATHER_BYTES):
                yield _counted(part.column("text"), bits, target, not target, None)

    return run


def _to_slices(column: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each slice of rows as one row, under a number of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            for part in byte_slices(batch, column, GATHER_BYTES):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema, options=options) as writer:
                    writer.write_batch(part)
                arrays = [pa.array([uuid.uuid4().int >> 65], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["slice", "packed"])

    return run


def _from_slice(packed: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(packed).read_next_batch()


def _count_slices(column: str, bits: int, background: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, packed in zip(*(batch.column(c) for c in ("slice", "packed")), strict=True):
                texts = _from_slice(packed.as_py()).column(column)
                yield _counted(texts, bits, False, background, number.as_py())

    return run


_ANSWERS = "slice bigint, bucket int, packed binary, target_tokens bigint, background_tokens bigint, words bigint"


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by bucket: both corpora's counts of each slice's items, and a row of totals for each bucket."""

    def made(rows: list[tuple]) -> pa.RecordBatch:
        bucket, target, background, slices, items, counts = zip(*rows, strict=True)
        lengths = [len(x) // 8 for x in items]
        values, at = np.unique(np.frombuffer(b"".join(items), np.uint64), return_inverse=True)
        counted = np.concatenate([_unpack(x, 1)[0] for x in counts])
        sums = [
            np.bincount(at, counted * np.repeat(np.array(flags, bool), lengths), len(values)).astype(np.int64)
            for flags in (target, background)
        ]
        ends = np.cumsum(lengths).tolist()
        spans = [(n, at[e - k : e]) for n, e, k in zip(slices, ends, lengths, strict=True) if n is not None]
        single = (values & np.uint64(1)) == 0
        known = int((single & (sums[0] + sums[1] > 0)).sum())
        none, n = [None], len(spans)
        columns = [
            [number for number, _ in spans] + none,
            [bucket[0]] * (n + 1),
            [_pack(*(total[where] for total in sums)) for _, where in spans] + none,
            *(none * n + [int(total[single].sum())] for total in sums),
            none * n + [known],
        ]
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
        names = ["slice", "bucket", "packed", "target_tokens", "background_tokens", "words"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    rows: list[tuple] = []
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if rows and rows[-1][0] != row[0]:
                yield made(rows)
                rows = []
            rows.append(row)
    if rows:
        yield made(rows)


def _slice_losses(
    column: pa.Array, answers: list[bytes], tokens: tuple[int, int], words: int
) -> tuple[np.ndarray, list[np.ndarray]]:
    """Where each text's tokens begin, and the losses of all tokens by both models."""
    found, singles, pairs = _grams(column)
    _, at = np.unique(np.concatenate([singles, pairs]), return_inverse=True)
    follows = np.ones(len(singles), bool)
    follows[found.first[:-1][found.counts > 0]] = False
    before = np.flatnonzero(follows) - 1
    parts = [_unpack(answer, 2) for answer in answers]
    out = []
    for model in (0, 1):
        counts = np.concatenate([part[model] for part in parts]) if parts else np.zeros(0, np.int64)
        of_word, of_pair = counts[at[: len(singles)]], counts[at[len(singles) :]]
        chance = (of_word + 1) / (tokens[model] + words + 1)  # one for the words that no corpus has
        chance[follows] = MIX * of_pair / np.maximum(of_word[before], 1) + (1 - MIX) * chance[follows]
        out.append(-np.log(chance))
    return found.first, out


def _means(first: np.ndarray, losses: list[np.ndarray]) -> dict[str, pa.Array]:
    n = np.diff(first)
    means = []
    for of_tokens in losses:
        total = np.zeros(len(of_tokens) + 1)
        np.cumsum(of_tokens, out=total[1:])
        means.append((total[first[1:]] - total[first[:-1]]) / np.maximum(n, 1))
    return {
        "n_tokens": pa.array(n, pa.int64()),
        "target_loss": pa.array(means[0]),
        "background_loss": pa.array(means[1]),
        "score": pa.array(means[0] - means[1]),
    }


_SCORES = "n_tokens bigint, target_loss double, background_loss double, score double"


def score(docs: DataFrame, models: Whole, column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns, ``n_tokens``, ``target_loss``, ``background_loss`` and ``score``.

    Losses are means over the tokens of the whole text. A text without words, or a null
    one, has losses and a score of 0.
    """
    new = StructType.fromDDL(_SCORES)
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in {name.lower() for name in new.names}]
    schema = StructType([docs.schema[c] for c in kept] + new.fields)
    read = docs.select(*[f"`{c}`" for c in dict.fromkeys([*kept, column])])
    slices = staged(read.mapInArrow(_to_slices(column), "slice bigint, packed binary"), "slices")
    bits = max(BUCKET_BITS, (slices.count() // 4).bit_length())
    # Where the scored texts are the background, they are counted and asked for at once.
    same = docs is models.background and column == models.column
    grams = slices.mapInArrow(_count_slices(column, bits, same), _GRAMS)
    for corpus, target in [(models.target, True)] + [(models.background, False)] * (not same):
        texts = corpus.select(F.col(models.column).alias("text"))
        grams = grams.unionByName(texts.mapInArrow(_count_corpus(bits, target), _GRAMS))
    grams = grams.repartition("bucket").sortWithinPartitions("bucket")
    answers = staged(grams.mapInArrow(_answer, _ANSWERS), "answers")
    sums = answers.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("target_tokens", "background_tokens", "words")]).first()
    tokens, words = (sums[0], sums[1]), sums[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(packed: bytes, told: list[bytes]) -> pa.RecordBatch:
            part = _from_slice(packed)
            means = _means(*_slice_losses(part.column(column), told, tokens, words))
            arrays = [part.column(c) for c in kept] + [means[name] for name in new.names]
            return pa.RecordBatch.from_arrays(arrays, names=[*kept, *new.names])

        held: bytes | None = None
        told: list[bytes] = []
        for batch in batches:
            for bucket, packed in zip(*(batch.column(c) for c in ("bucket", "packed")), strict=True):
                if bucket.as_py() < 0:
                    if held is not None:
                        yield made(held, told)
                    held, told = packed.as_py(), []
                else:
                    told.append(packed.as_py())
        if held is not None:
            yield made(held, told)

    # A slice's texts come before the answers to it.
    rows = slices.select("slice", F.lit(-1).alias("bucket"), "packed")
    rows = rows.unionByName(answers.filter("slice IS NOT NULL").select("slice", "bucket", "packed"))
    return rows.repartition("slice").sortWithinPartitions("slice", "bucket").mapInArrow(run, schema)
