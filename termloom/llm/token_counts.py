"""How many tokens a public tokenizer makes of each text, without the tokens themselves.

Pre-tokens (the units of ``units.py``) are counted once. A slice of texts sends its
distinct pre-tokens to buckets by their hash. A bucket encodes each pre-token the first
time that it sees it, remembers the number of pieces, and answers every slice with a
number per pre-token. Meanwhile the slice's texts are a row of small numbers: the
pre-tokens of each text and how often it has them. That row meets the answers, and a
text's count is the sum of frequency times pieces.

What moves are distinct pre-tokens of slices and packed numbers, never texts. A frequent
pre-token is one entry per slice, so that no bucket gathers its occurrences. A task holds
the pre-tokens of one bucket, or one slice.

Rows: every row of the table gives one, with null texts as empty ones, which have no
tokens. Rows that repeat others are counted like them; an empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from termloom.llm.batches import byte_slices, filled
from termloom.llm.packing import pack, pack_rows, pack_text, unpack, unpack_rows, unpack_text
from termloom.llm.units import SPACE_MARK, cut, spaced, unit_hashes, vocabulary
from termloom.llm.words import text_bytes

#: Texts of a slice. Larger ones repeat fewer pre-tokens and take more memory.
COUNT_BYTES = 4 << 20
#: New pre-tokens that a bucket encodes at a time.
NEW_BYTES = 1 << 18

#: ``part`` -1: a slice's texts; else the pre-tokens, or the answers, of one bucket.
_SENT = "bucket int, slice binary, part int, lengths binary, packed binary"
_ANSWERED = "slice binary, part int, lengths binary, packed binary"


def _offsets(lengths: np.ndarray) -> np.ndarray:
    return np.r_[0, np.cumsum(lengths)].astype(np.int64)


def _binaries(lengths: np.ndarray, data: bytes) -> pa.Array:
    buffers = [None, pa.py_buffer(_offsets(lengths)), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), buffers)


def _slice_rows(part: pa.RecordBatch, column: str, kept: list[str], buckets: int, name: bytes) -> pa.RecordBatch:
    """What a slice sends: a row for each bucket, and one with its texts' frequencies."""
    texts = filled(part.column(column)).cast(pa.large_string())
    sizes = pc.binary_length(texts)
    # Both are a space to the library.
    units = cut(spaced(pc.replace_substring(texts, SPACE_MARK, " ")))
    n = len(units.texts)
    bucket = ((unit_hashes(units.texts) >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    order = pc.sort_indices(
        pa.table({"bucket": bucket, "unit": units.texts}), [("bucket", "ascending"), ("unit", "ascending")]
    )
    data, at = text_bytes(units.texts.take(order))
    raw, lengths = data.tobytes(), np.diff(at)
    order = order.to_numpy()
    number = np.empty(n, np.int64)
    number[order] = np.arange(n)
    bucket = bucket[order]
    pairs, times = np.unique(units.doc * max(n, 1) + number[units.index], return_counts=True)
    doc, item = pairs // max(n, 1), pairs % max(n, 1)
    steps = np.diff(item, prepend=0)
    new = np.flatnonzero(np.diff(doc, prepend=-1))
    steps[new] = item[new]
    per_text = np.bincount(doc, minlength=part.num_rows)
    columns = [part.column(c) for c in kept] + [sizes]
    held = pa.RecordBatch.from_arrays(columns, names=[*kept, "n_bytes"])
    numbers = [pack(x) for x in (per_text, steps, times)]
    lead = pack(np.array([len(x) for x in numbers[:2]]))
    texts_row = len(lead).to_bytes(8, "little") + lead + b"".join(numbers)
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if n else np.zeros(0, np.int64)
    bounds = [*starts.tolist(), n]
    words = [
        (int(bucket[a]), int(bucket[a]), pack(lengths[a:b]), pack_text(raw[at[a] : at[b]]))
        for a, b in zip(bounds, bounds[1:], strict=False)
    ]
    rows_row = pack_rows(held)
    # A slice that is computed again after a loss has the same name only if it is the same.
    key = name + blake2b(raw + texts_row + rows_row, digest_size=16).digest()
    rows = [(int.from_bytes(key[-4:], "little") % buckets, -1, texts_row, rows_row), *words]
    where, parts, first, second = zip(*rows, strict=True)
    arrays = [
        pa.array(where, pa.int32()),
        pa.array([key] * len(rows), pa.binary()),
        pa.array(parts, pa.int32()),
        pa.array(first, pa.binary()),
        pa.array(second, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(arrays, names=["bucket", "slice", "part", "lengths", "packed"])


class _Bucket:
    """The pieces of each pre-token of one bucket."""

    def __init__(self, path: str) -> None:
        self.vocabulary = vocabulary(path)
        self.known: dict[bytes, int] = {}

    def counts(self, lengths: np.ndarray, raw: bytes) -> np.ndarray:
        at = _offsets(lengths).tolist()
        units = [raw[a:b] for a, b in zip(at, at[1:], strict=False)]
        known = self.known
        new = [u for u in units if u not in known]
        start = 0
        while start < len(new):
            stop, size = start, 0
            while stop < len(new) and (stop == start or size + len(new[stop]) <= NEW_BYTES):
                size += len(new[stop])
                stop += 1
            _, first, _ = self.vocabulary.encode(pa.array(new[start:stop], pa.large_binary()))
            known.update(zip(new[start:stop], np.diff(first).tolist(), strict=True))
            start = stop
        return np.fromiter(map(known.__getitem__, units), np.int64, len(units))


def count_tokens(docs: DataFrame, path: str, column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns (default: all), ``n_bytes`` and ``n_tokens`` of each whole text.

    ``path`` is a sentencepiece model. A kept column with the name of a new one gives way to it.
    """
    if not path.endswith(".model"):
        raise ValueError(f"{path}: units of texts without a space before them are not independent")
    made = ("n_bytes", "n_tokens")
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in made]
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = StructType([docs.schema[c] for c in kept]).add("n_bytes", "long").add("n_tokens", "long")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in byte_slices(batch, column, COUNT_BYTES):
                yield _slice_rows(part, column, kept, buckets, task.to_bytes(4, "big") + number.to_bytes(4, "big"))
                number += 1

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = None
        for batch in batches:
            lengths, packed = [], []
            for part, sizes, sent in zip(*(batch.column(c) for c in ("part", "lengths", "packed")), strict=True):
                part, sizes, sent = part.as_py(), sizes.as_py(), sent.as_py()
                if part >= 0:
                    if part != bucket:
                        bucket, held = part, _Bucket(path)
                    sizes, sent = None, pack(held.counts(unpack(sizes), unpack_text(sent)))
                lengths.append(sizes)
                packed.append(sent)
            arrays = [batch.column("slice"), batch.column("part"), pa.array(lengths, pa.binary()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["slice", "part", "lengths", "packed"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, texts, answers = None, None, []
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("slice", "part", "lengths", "packed")), strict=True):
                name, part, lengths, packed = (x.as_py() for x in row)
                if name != key:
                    if key is not None:
                        yield summed(texts, answers)
                    key, texts, answers = name, None, []
                if part < 0:
                    texts = (lengths, packed)
                else:
                    answers.append(unpack(packed))
        if key is not None:
            yield summed(texts, answers)

    def summed(texts: tuple[bytes, bytes] | None, answers: list[np.ndarray]) -> pa.RecordBatch:
        if texts is None:
            raise ValueError("answers for a slice that was made anew with other rows")
        numbers, rows = texts[0], unpack_rows(texts[1])
        top = 8 + int.from_bytes(numbers[:8], "little")
        a, b = np.cumsum(unpack(numbers[8:top])).tolist()
        per_text, steps, times = (unpack(x) for x in (numbers[top : top + a], numbers[top + a : top + b], numbers[top + b :]))
        pieces = np.concatenate([np.zeros(0, np.int64), *answers])
        before = _offsets(per_text)
        upto = np.cumsum(steps)
        base = np.r_[0, upto][before[:-1]]
        item = upto - np.repeat(base, per_text)
        if len(item) and item.max() != len(pieces) - 1:
            raise ValueError("a slice got other answers than it asked for")
        counted = _offsets(times * pieces[item])
        arrays = [*rows.columns, pa.array(counted[before[1:]] - counted[before[:-1]])]
        return pa.RecordBatch.from_arrays(arrays, names=[*rows.schema.names, "n_tokens"])

    read = docs.select(*[f"`{c}`" for c in dict.fromkeys([*kept, column])])
    sent = read.mapInArrow(send, _SENT).repartitionById(buckets, "bucket").sortWithinPartitions("part")
    answered = sent.mapInArrow(answer, _ANSWERED)
    together = answered.repartition("slice").sortWithinPartitions("slice", "part")
    return together.mapInArrow(total, schema)
