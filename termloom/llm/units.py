"""Texts cut into units that public tokenizers encode independently of each other.

A text is cut before each space that follows a character which is no white space. There a
byte-level tokenizer begins a new pre-token, and no piece of a vocabulary goes on from
another character to the mark of a space (``Vocabulary`` looks through its pieces). Hence
the tokens of a text are those of its units, one after another. A character in doubt is
taken for white space: a larger unit has the same tokens.

Each distinct unit of a slice of texts is encoded once. Units are encoded many at a time,
as one text, for they don't depend on what stands before them.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from tokenizers import Tokenizer

from termloom.llm.batches import filled
from termloom.llm.words import Words, text_bytes, word_hashes

#: What sentencepiece writes for a space.
SPACE_MARK = "▁"
#: Bytes of units that a library encodes at a time.
CHUNK_BYTES = 1 << 14


def _solid_before(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before a place is surely none of white space (three bytes at least precede).

    Not sure of: the two-byte U+0085 and U+00A0, and all of three bytes from E1, E2 and E3 on,
    which hold every other kind of white space, and the mark of a space.
    """
    one, two, three = (data[at - k] for k in (1, 2, 3))
    plain = (one > 0x20) & (one < 0x7F)
    odd = ((two == 0xC2) & ((one == 0x85) | (one == 0xA0))) | ((two >= 0x80) & (three >= 0xE1) & (three <= 0xE3))
    return plain | ((one >= 0x80) & ~odd)


@dataclass
class Units:
    """``texts[i]``: distinct units as binary values; ``index``: the unit at each place of each
    text; the places of text d are ``first[d]`` to ``first[d + 1]``."""

    texts: pa.Array
    index: np.ndarray
    first: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def spaced(column: pa.Array) -> pa.Array:
    """Each text after a space; null and empty texts stay empty."""
    column = filled(column).cast(pa.large_string())
    some = pc.greater(pc.binary_length(column), 0)
    space = pa.scalar(" ", pa.large_string())
    return pc.if_else(some, pc.binary_join_element_wise(space, column, pa.scalar("", pa.large_string())), column)


def cut(column: pa.Array) -> Units:
    """The units of each text of ``spaced`` texts."""
    data, texts = text_bytes(column)
    at = np.flatnonzero(data == 0x20)
    begins = np.zeros(len(data) + 1, bool)
    # A space near the beginning of a text may see bytes of the one before: it is not cut there.
    at = at[at >= texts[np.searchsorted(texts, at, "right") - 1] + 3] if len(at) else at
    begins[at[_solid_before(data, at)]] = True
    begins[texts[:-1]] = True
    begins[len(data)] = False
    starts = np.flatnonzero(begins)
    offsets = np.append(starts, len(data)).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    coded = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
    return Units(coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), np.searchsorted(starts, texts))


def unit_hashes(units: pa.Array) -> np.ndarray:
    """A 64-bit value of each unit's bytes."""
    data, at = text_bytes(units)
    none = np.zeros(0, np.int64)
    return word_hashes(Words(data, at[[0, -1]], np.ones(len(data), bool), at[:-1], at[1:], none, none))


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies name bytes: printable ones stand for
    themselves, the others for those from U+0100 on, in their order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """A public tokenizer and the bytes of its tokens.

    ``.model``: sentencepiece, which puts a space before each text. ``.json``: a byte-level
    tokenizer; strings of special tokens are ordinary text.
    """

    def __init__(self, path: str) -> None:
        self.path = path
        if path.endswith(".model"):
            self.library = sentencepiece.SentencePieceProcessor(model_file=path)
            self.tokens = self._pieces()
            self._encode = self._encode_pieces
        else:
            self.library = Tokenizer.from_file(path)
            self.library.no_truncation()
            self.library.no_padding()
            self.library.encode_special_tokens = True
            self.tokens = self._byte_level()
            self._encode = self._encode_bytes
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.blob = np.frombuffer(b"".join(self.tokens), np.uint8)

    def _pieces(self) -> list[bytes]:
        model, tokens = self.library, []
        if model.encode("a b", out_type=str) != [SPACE_MARK + "a", SPACE_MARK + "b"]:
            raise ValueError(f"{self.path}: no space is put before texts")
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                tokens.append(bytes([int(piece[3:5], 16)]))
                continue
            if SPACE_MARK in piece.lstrip(SPACE_MARK):
                raise ValueError(f"{self.path}: piece {i} goes on beyond a space")
            tokens.append(piece.replace(SPACE_MARK, " ").encode())
        return tokens

    def _byte_level(self) -> list[bytes]:
        with open(self.path, encoding="utf-8") as file:
            spec = json.load(file)
        steps = spec.get("pre_tokenizer") or {}
        if steps.get("type") != "ByteLevel" or steps.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError(f"{self.path}: not a plain byte-level tokenizer")
        letters, named = _byte_letters(), self.library.get_vocab(with_added_tokens=True)
        added = {t["content"] for t in spec["added_tokens"]}
        tokens = [b""] * (max(named.values()) + 1)
        for name, i in named.items():
            tokens[i] = name.encode() if name in added else bytes(letters[c] for c in name)
        return tokens

    def _encode_pieces(self, texts: list[str]) -> list[list[int]]:
        # The library puts the first space back. A text of nothing else would be an empty one to it.
        out = self.library.encode([t[1:] for t in texts], num_threads=1)
        alone = self.library.piece_to_id(SPACE_MARK)
        return [[alone] if text == " " else ids for text, ids in zip(texts, out, strict=True)]

    def _encode_bytes(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all tokens, one after another."""
        lengths = self.lengths[ids]
        total = np.cumsum(lengths)
        place = np.arange(int(total[-1]) if len(ids) else 0) - np.repeat(total - lengths, lengths)
        return self.blob[np.repeat(self.begins[ids], lengths) + place]

    def encode(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(ids, first, exact)`` of units that each begin with a space: the tokens of unit i are
        ``ids[first[i]:first[i + 1]]``; whether their bytes are those of the unit."""
        data, at = text_bytes(units)
        n = len(at) - 1
        if not n:
            return np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, bool)
        # A unit that ends with white space, as a text may, is the last of its chunk.
        last = np.maximum(at[1:] - 1, 0)
        joins = np.zeros(n, bool)
        long = np.diff(at) >= 3
        joins[long] = _solid_before(data, last[long] + 1)
        joins |= ~long & (data[last] > 0x20) & (data[last] < 0x7F)
        chunk = at[:-1] // CHUNK_BYTES
        starts = np.flatnonzero(np.r_[True, ~joins[:-1] | (chunk[1:] != chunk[:-1])])
        raw = data.tobytes()
        bounds = [*starts.tolist(), n]
        parts = self._encode([raw[at[a] : at[b]].decode() for a, b in zip(bounds, bounds[1:], strict=False)])
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        ids = np.fromiter((i for part in parts for i in part), np.int64, int(counts.sum()))
        ends = np.cumsum(self.lengths[ids])
        tops = np.cumsum(counts)
        reached = np.r_[0, ends][tops]
        if (reached == at[bounds[1:]]).all() and np.array_equal(self.bytes_of(ids), data):
            stop = np.searchsorted(ends, at[1:])
            if (ends[stop] != at[1:]).any():
                raise ValueError(f"{self.path}: a token goes on beyond a cut")
            return ids, np.r_[0, stop + 1], np.ones(n, bool)
        return self._one_by_one(raw, at)

    def _one_by_one(self, raw: bytes, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same where some tokens have other bytes than the text, as for the mark of a space in it."""
        bounds = at.tolist()
        units = [raw[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
        parts = self._encode([u.decode() for u in units])
        exact = [b"".join([self.tokens[i] for i in part]) == u for part, u in zip(parts, units, strict=True)]
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        ids = np.fromiter((i for part in parts for i in part), np.int64, int(counts.sum()))
        return ids, np.r_[0, np.cumsum(counts)], np.array(exact, bool)


@cache
def vocabulary(path: str) -> Vocabulary:
    """One per worker process."""
    return Vocabulary(path)
