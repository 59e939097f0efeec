"""BPE encoding and decoding by the vocabulary file of a public tokenizer.

For tokenizers that drop white space (their file says so), so that words between white
space are encoded apart. Each distinct word of a slice of texts is encoded once, many words
at a time, and remembered for the slices that follow.

A text of ``LONG_CHARS`` and more is not encoded as a whole. It is halved, in the middle of
a word where it can be, until pieces are short; the pieces are encoded in parallel, as rows
of their own, and the halves are joined again, pair by pair. A piece that stops within a word
ends with tokens of an unfinished word. Around such a join a window of tokens is encoded
anew, and doubled until its first token is the one that the left half had there and its
last token the one that the right half had. A sequence of tokens is the encoding of its text
when each two neighbours encode to themselves; the window's outer neighbours did so before,
hence the joined sequence is exactly that of the whole.

Token ids are packed, 4 bytes each, unsigned and little-endian.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache, cached_property
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.models import BPE

from termloom.llm.batches import add_columns, byte_slices, filled
from termloom.llm.words import find_words

if TYPE_CHECKING:
    import pandas as pd

LONG_CHARS = 1 << 15
PIECE_CHARS = 1 << 12
#: Words of a generation. A worker remembers the words of two, and forgets the older one.
CACHED_WORDS = 100_000
#: Bytes of words that the library encodes at a time.
CHUNK_BYTES = 1 << 14
WINDOW = 4
#: What separates words; Python calls more than that white space.
SPACE = " \t\n\r\x0b\x0c"
#: Characters alike before a cut within a word; more than the longest contraction that the patterns know.
ALIKE = 4


def pack(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def _kind(char: str) -> str:
    """``letter`` and ``sign`` stand for characters that neither join with their neighbours in a
    composed form nor change by them in lower case; a sign goes on with itself only."""
    if char.isascii():
        if char.isalpha():
            return "letter"
        return char if char.isprintable() and not char.isdigit() and char not in " '" else ""
    plain = unicodedata.category(char) in ("Ll", "Lo") and char < "\ua000" and not "\u1100" <= char <= "\u11ff"
    return "letter" if plain and unicodedata.normalize("NFC", char) == char and char.lower() == char else ""


class Encoder:
    """The tokenizer of a file, with a memory of words."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if not any(s["type"] == "Split" and s["behavior"] == "Removed" and s["invert"] for s in steps):
            raise ValueError(f"{path}: the tokenizer does not drop white space")
        self.path = path
        self.suffix = spec["model"].get("end_of_word_suffix") or ""
        if not self.suffix:
            raise ValueError(f"{path}: tokens do not show where a word ends")
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.special = [t["content"] for t in spec["added_tokens"]]
        added = sorted(self.special, key=len, reverse=True)
        self.added = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        self.names = names(path)
        self.closed = {i for i, name in self.names.items() if name.endswith(self.suffix) or name in self.special}
        self.young: dict[bytes, tuple[bytes, str]] = {}
        self.old: dict[bytes, tuple[bytes, str]] = {}

    @cached_property
    def open_model(self) -> BPE:
        """The same merges without a mark at the end, for pieces that do not end a word."""
        with open(self.path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        return BPE(vocab=model["vocab"], merges=merges)

    def look_up(self, words: list[bytes]) -> list[tuple[bytes, str]]:
        """Packed ids and names of each of distinct words."""
        new = []
        for word in words:
            if word not in self.young:
                known = self.old.get(word)
                if known is None:
                    new.append(word)
                else:
                    self.young[word] = known
        at = 0
        while at < len(new):
            stop, size = at, 0
            while stop < len(new) and (stop == at or size + len(new[stop]) < CHUNK_BYTES):
                size += len(new[stop]) + 1
                stop += 1
            self._learn(new[at:stop])
            at = stop
        young = self.young
        out = [young[word] for word in words]
        if len(young) > CACHED_WORDS:
            self.old, self.young = young, {}
        return out

    def _learn(self, words: list[bytes]) -> None:
        """Encode words as one text; where its tokens begin tells them apart."""
        text = " ".join([word.decode() for word in words])
        code = self.whole.encode(text, add_special_tokens=False)
        lengths = np.array([len(word.decode()) + 1 for word in words])
        begins = np.cumsum(lengths) - lengths
        ids = np.array(code.ids, "<u4")
        at = np.fromiter((start for start, _ in code.offsets), np.int64, len(ids))
        first = np.searchsorted(at, np.append(begins, len(text) + 1)).tolist()
        raw, known = ids.tobytes(), [self.names[i] for i in code.ids]
        for i, word in enumerate(words):
            a, b = first[i], first[i + 1]
            self.young[word] = raw[4 * a : 4 * b], " ".join(known[a:b])

    def texts(self, column: pa.Array, decoded: bool) -> tuple[pa.Array, pa.Array | None]:
        """Packed ids of each text and, if asked for, the names of its tokens with spaces between them."""
        words = find_words(column)
        data = np.ascontiguousarray(words.data[words.solid])
        lengths = words.end - words.start
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data)]
        coded = pa.Array.from_buffers(pa.large_binary(), len(lengths), buffers).dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False)
        known = self.look_up(coded.dictionary.to_pylist())
        parts = [ids for ids, _ in known]
        counts = np.array([len(ids) // 4 for ids in parts], np.int64)
        begins = np.cumsum(counts) - counts
        own = counts[index]
        upto = np.concatenate([[0], np.cumsum(own)])
        place = np.arange(upto[-1]) + np.repeat(begins[index] - upto[:-1], own)
        ids = np.frombuffer(b"".join(parts), "<u4")[place]
        tops = 4 * upto[words.first]
        kind, width = (pa.binary(), np.int32) if tops[-1] < 1 << 31 else (pa.large_binary(), np.int64)
        ids = pa.Array.from_buffers(kind, len(column), [None, pa.py_buffer(tops.astype(width)), pa.py_buffer(ids)])
        if not decoded:
            return ids, None
        some = own > 0  # a word of no tokens has no name
        kept = np.concatenate([[0], np.cumsum(some)])[words.first]
        spoken = pa.array([name for _, name in known], pa.string()).take(pa.array(index[some]))
        return ids, pc.binary_join(pa.ListArray.from_arrays(pa.array(kept, pa.int32()), spoken), " ")

    def words(self, texts: list[bytes]) -> list[bytes]:
        """Packed ids of each text."""
        return self.texts(pa.array(texts, pa.large_binary()), False)[0].to_pylist()

    def pieces(self, text: str) -> list[tuple[str, bool]]:
        """``(piece, unfinished)``: the halves of the halves of a text. An unfinished piece stops within a word."""
        out, spans = [], [(0, len(text))]
        while spans:
            start, stop = spans.pop()
            at = self._cut(text, start, stop) if stop - start > PIECE_CHARS else None
            if at is None:
                out.append((text[start:stop], stop < len(text) and not self._closed_at(text, stop)))
            else:
                spans += [(at, stop), (start, at)]
        return out

    def _cut(self, text: str, start: int, stop: int) -> int | None:
        """A place near the middle where a piece can end: next to white space, within letters or equal
        signs, or between digits. None if there is none at all."""
        middle = (start + stop) // 2
        for at in (*range(middle, stop), *range(middle - 1, start, -1)):
            if at - start > ALIKE and (self._closed_at(text, at) or self._open_at(text, at)):
                return at
        return None

    def _closed_at(self, text: str, at: int) -> bool:
        return text[at] in SPACE or text[at - 1] in SPACE

    def _open_at(self, text: str, at: int) -> bool:
        kind = _kind(text[at])
        if not kind or any(_kind(c) != kind for c in text[at - ALIKE : at]):
            return False
        if self.added is None:
            return True
        reach = max(map(len, self.special))
        near = max(0, at - reach)
        return not any(m.start() < at - near < m.end() for m in self.added.finditer(text[near : at + reach]))

    def piece(self, text: str, unfinished: bool) -> bytes:
        if not unfinished:
            return self.words([text.encode()])[0]
        begin = max(text.rfind(c) for c in SPACE) + 1
        parts = self.added.split(text[begin:]) if self.added else [text[begin:]]
        last = parts[-1]
        before = self.words([(text[:begin] + "".join(parts[:-1])).encode()])[0]
        normal = self.whole.normalizer.normalize_str(last) if self.whole.normalizer else last
        *done, rest = [word for word, _ in self.whole.pre_tokenizer.pre_tokenize_str(normal)]
        ids = [t.id for word in done for t in self.whole.model.tokenize(word)]
        return before + pack(ids + [t.id for t in self.open_model.tokenize(rest)])

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbours of which the left one may stop within a word."""
        start = len(left)
        while start and left[start - 1] not in self.closed:
            start -= 1
        if start == len(left):
            return left + right
        stop = next((i + 1 for i, token in enumerate(right) if token in self.closed), len(right))
        ends = stop > 0 and right[stop - 1] in self.closed
        return left[:start] + self._join_word(left[start:], right[:stop], ends) + right[stop:]

    def _join_word(self, left: list[int], right: list[int], ends: bool) -> list[int]:
        """The same for two parts of one word; ``ends``: the right one is its end."""
        size = WINDOW
        while True:
            a, b = max(0, len(left) - size), min(len(right), size)
            closed = ends and b == len(right)
            text = "".join(self.names[i] for i in left[a:] + right[:b])
            if closed:
                text = text.removesuffix(self.suffix)
            model = self.whole.model if closed else self.open_model
            new = [t.id for t in model.tokenize(text)]
            if (a == 0 or new[0] == left[a]) and (b == len(right) or new[-1] == right[b - 1]):
                return left[:a] + new + right[b:]
            size *= 2

    def tree(self, parts: list[list[int]]) -> list[int]:
        """Neighbouring pieces joined pair by pair, then pairs of pairs."""
        while len(parts) > 1:
            last = len(parts) - 1
            parts = [self.join(parts[i], parts[i + 1]) if i < last else parts[i] for i in range(0, len(parts), 2)]
        return parts[0] if parts else []


@cache
def names(path: str) -> dict[int, str]:
    """Tokens by id, added ones included."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    return {i: name for name, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}


@cache
def decoding_tokenizer(path: str) -> Tokenizer | None:
    """None where decoding is no more than names with spaces between them."""
    with open(path, encoding="utf-8") as file:
        if json.load(file).get("decoder") is None:
            return None
    return Tokenizer.from_file(path)


@cache
def encoder(path: str) -> Encoder:
    """One per worker process."""
    return Encoder(path)


def _decoded(path: str, packed: list[bytes]) -> list[str]:
    tokenizer, known = decoding_tokenizer(path), names(path)
    rows = (np.frombuffer(ids, "<u4").tolist() for ids in packed)
    if tokenizer is None:
        return [" ".join([known[i] for i in ids if i in known]) for ids in rows]
    return tokenizer.decode_batch(list(rows), skip_special_tokens=False)


def _encode_plain(docs: DataFrame, path: str, column: str, keep: list[str], decoded: bool) -> DataFrame:
    def make(part: pa.RecordBatch) -> dict[str, pa.Array]:
        spoken = decoded and decoding_tokenizer(path) is None
        ids, text = encoder(path).texts(part.column(column), spoken)
        out = {"ids": ids.cast(pa.binary())}
        if decoded:
            out["decoded"] = text.cast(pa.string()) if spoken else pa.array(_decoded(path, ids.to_pylist()), pa.string())
        return out

    return add_columns(docs, make, "ids binary, decoded string" if decoded else "ids binary", column, keep)


def _encode_long(texts: DataFrame, path: str) -> DataFrame:
    """``(text_key, ids)`` of each distinct text of ``(text_key, text)``, piece by piece."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text"):
                for key, text in zip(*(part.column(c).to_pylist() for c in ("text_key", "text")), strict=True):
                    found = encoder(path).pieces(text)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([key] * len(found), pa.string()),
                            pa.array(range(len(found)), pa.int64()),
                            pa.array([unfinished for _, unfinished in found], pa.bool_()),
                            pa.array([piece for piece, _ in found], pa.string()),
                        ],
                        names=["text_key", "number", "unfinished", "text"],
                    )

    def encode(part: pa.RecordBatch) -> dict[str, pa.Array]:
        rows = zip(part.column("text").to_pylist(), part.column("unfinished").to_pylist(), strict=True)
        return {"ids": pa.array([encoder(path).piece(*row) for row in rows], pa.binary())}

    def joined(group: pd.DataFrame) -> pd.DataFrame:
        import pandas as pd  # workers that only encode words do without it

        parts = [np.frombuffer(ids, "<u4").tolist() for ids in group.sort_values("number")["ids"]]
        return pd.DataFrame({"text_key": [group["text_key"].iloc[0]], "ids": [pack(encoder(path).tree(parts))]})

    pieces = texts.mapInArrow(cut, "text_key string, number bigint, unfinished boolean, text string")
    # Equal texts have equal pieces; what a task has twice it sends once.
    pieces = pieces.dropDuplicates(["text_key", "number"])
    coded = add_columns(pieces, encode, "ids binary", "text", ["text_key", "number"], ("unfinished",))
    # One group is one text.
    return coded.groupBy("text_key").applyInPandas(joined, "text_key string, ids binary")


def encode(
    docs: DataFrame, path: str, column: str = "text", keep: list[str] | None = None, decoded: bool = False
) -> DataFrame:
    """The kept columns and ``ids``, the packed token ids of each whole text, without added tokens.

    ``decoded`` adds what ``decode`` makes of the ids, by the same worker.

    A null or empty text has no ids. Texts of ``LONG_CHARS`` and more go piece by piece, each
    distinct text once; the others are encoded in their own rows and move nowhere.
    """
    made = ("ids", "decoded") if decoded else ("ids",)
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in made]
    text = F.col(column)
    is_long = F.coalesce(F.length(text) >= LONG_CHARS, F.lit(False))
    plain = _encode_plain(docs.filter(~is_long), path, column, kept, decoded)
    long = docs.filter(is_long)
    keyed = long.select(*kept, F.sha2(text, 256).alias("__key"))
    coded = _encode_long(long.select(F.sha2(text, 256).alias("text_key"), text.alias("text")), path)
    found = keyed.join(coded.withColumnRenamed("text_key", "__key"), "__key", "left")
    found = found.select(*kept, F.coalesce("ids", F.lit(b"")).alias("ids"))
    return plain.unionByName(decode(found, path) if decoded else found)


def decode(coded: DataFrame, path: str, keep: list[str] | None = None) -> DataFrame:
    """The kept columns and ``decoded``, the text of the packed ``ids``, special tokens included.

    Ids that the vocabulary doesn't have are left out, as the library does.
    """

    def make(part: pa.RecordBatch) -> dict[str, pa.Array]:
        return {"decoded": pa.array(_decoded(path, filled(part.column("ids")).to_pylist()), pa.string())}

    return add_columns(coded, make, "decoded string", "ids", keep)
