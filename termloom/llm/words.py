"""Words ``[^\\x20\\x09-\\x0D]+`` of many texts at once, as numpy arrays over their UTF-8 bytes.

The white space that separates words is ASCII, so bytes and code points agree on it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from termloom.llm.batches import filled

#: The same words for Spark's own functions.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_BLOCK = 1 << 12
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
_ODD_POWERS, _INVERSE_POWERS = _powers(_BLOCK, _ODD), _powers(_BLOCK, _INVERSE)
# From block to block.
_ODD_BLOCK, _INVERSE_BLOCK = (np.uint64(pow(int(x), _BLOCK, 1 << 64)) for x in (_ODD, _INVERSE))


@dataclass
class Words:
    """``data``: bytes of all texts; word i is ``data[start[i]:end[i]]`` of text ``doc[i]``.

    The words of text d are ``first[d]`` to ``first[d + 1]``; its bytes are ``texts[d]``
    to ``texts[d + 1]``. ``solid`` marks the bytes that belong to words.
    """

    data: np.ndarray
    texts: np.ndarray
    solid: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each row begins, with the end at last."""
    column = filled(column)
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def find_words(column: pa.Array, lower: bool = False) -> Words:
    """The words of every text; nulls have none. ``lower`` turns A-Z into a-z."""
    data, texts = text_bytes(column)
    if lower:
        data = data + ((data - np.uint8(65)) < 26).astype(np.uint8) * np.uint8(32)
    solid = ~_SPACE[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = solid
    before[texts] = False  # words end with their text
    start = np.flatnonzero(solid & ~before[:-1])
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = solid
    after[texts] = False
    end = np.flatnonzero(solid & ~after[1:]) + 1
    first = np.searchsorted(start, texts)
    doc = np.repeat(np.arange(len(texts) - 1, dtype=np.int32), np.diff(first))
    return Words(data, texts, solid, start, end, doc, first)


def word_hashes(words: Words) -> np.ndarray:
    """A 64-bit value of each word's bytes."""
    if not len(words.start):
        return np.zeros(0, np.uint64)
    # Of all bytes, each times a power by its place: sums up to a place tell the sum along a
    # word, and the inverse power (odd numbers have one) makes it as if the word came first.
    blocks = -(-len(words.data) // _BLOCK)
    total = np.zeros(1 + blocks * _BLOCK, np.uint64)
    values = total[1:]
    values[: len(words.data)] = words.data
    values += np.uint64(1)
    values = values.reshape(blocks, _BLOCK)
    values *= _ODD_POWERS
    values *= _powers(blocks, _ODD_BLOCK)[:, None]
    np.cumsum(total, out=total)
    back = _INVERSE_POWERS[words.start % _BLOCK] * _powers(blocks, _INVERSE_BLOCK)[words.start // _BLOCK]
    lengths = (words.end - words.start).astype(np.uint64)
    return mix((total[words.end] - total[words.start]) * back + lengths * _STEP)


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit value of each run of n words, by its first word; the last n - 1 have none."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    stop = len(hashes) - n + 1
    total = hashes[:stop].copy()
    for i in range(1, n):
        total = total * _STEP + hashes[i : stop + i]
    return mix(total)


def gram_starts(words: Words, n: int) -> np.ndarray:
    """Which words begin a run of n words of one text (aligned with ``gram_hashes``)."""
    if len(words.doc) < n:
        return np.zeros(0, bool)
    return words.doc[: len(words.doc) - n + 1] == words.doc[n - 1 :]


def sums_by_text(words: Words, flags: np.ndarray) -> np.ndarray:
    """Of a value per byte, the sum over each text."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[words.texts[1:]] - total[words.texts[:-1]]
