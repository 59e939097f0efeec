"""Tokens of two public tokenizers over the same text, aligned where both end.

``A`` is a byte-level vocabulary, given each text after a space; ``B`` a sentencepiece
model, which puts that space itself. The bytes of both sequences are the same, and an end
that both share cuts them into groups.

Cuts are found by dividing: of an interval that ends with a shared end, the end of the
middle A token is looked for among B's ends by bisection. If B has none there, its next
one is looked for among A's, and so on, each time the other side's next end, until both
agree. Where that reaches the end of the interval, the same goes backwards from the
middle. A shared end halves the interval and both halves are divided in turn; an interval
without one is a group. All intervals of a slice of texts take each step at once.

Each group has one link, that of its last A token and last B token. Two tokens that end
together, in the same bytes, are such that one's bytes are the end of the other's. So the
pairs that can be linked are known from the vocabularies alone (``linkable``), and what is
counted over all documents, and sent to the tasks again, has that size whatever the corpus.

Rows: each row of the table gives one. Null and empty texts, and texts whose tokens have
other bytes than the text (those with U+2581, which B takes for a space), have no tokens:
their numbers are 0 and their digest is the empty string. Rows that repeat others count as
often as they occur. An empty table has no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from termloom.llm.batches import add_columns
from termloom.llm.units import Units, Vocabulary, cut, spaced, vocabulary
from termloom.session import staged

_COMMA, _SEMICOLON, _BAR = b",;|"


@cache
def linkable(path_a: str, path_b: str) -> np.ndarray:
    """Sorted codes ``a * size of B + b`` of all pairs of which one's bytes end with the other's."""
    a, b = vocabulary(path_a).tokens, vocabulary(path_b).tokens
    codes = []
    for near, far, code in ((a, b, lambda x, y: x * len(b) + y), (b, a, lambda x, y: y * len(b) + x)):
        ends = defaultdict(list)
        for i, token in enumerate(far):
            if token:
                ends[token].append(i)
        for i, token in enumerate(near):
            for at in range(len(token)):
                codes += [code(i, j) for j in ends.get(token[at:], ())]
    return np.unique(np.array(codes, np.int64))


def shared_ends(
    ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The places of A and B tokens that end together, in order.

    ``ends_a`` and ``ends_b`` grow over all texts; text i has the tokens from ``first[i]`` to
    ``first[i + 1]`` of each, at least one, and its last ones end together.
    """
    lo_a, hi_a, lo_b, hi_b = first_a[:-1], first_a[1:], first_b[:-1], first_b[1:]
    found_a, found_b = [hi_a - 1], [hi_b - 1]
    while True:
        inner = (hi_a - lo_a > 1) & (hi_b - lo_b > 1)
        lo_a, hi_a, lo_b, hi_b = lo_a[inner], hi_a[inner], lo_b[inner], hi_b[inner]
        if not len(lo_a):
            break
        middle = (lo_a + hi_a) // 2 - 1
        at_a, at_b = _meet_after(ends_a, ends_b, middle)
        reached = at_a >= hi_a - 1
        back_a, back_b = _meet_before(ends_a, ends_b, middle[reached], lo_a[reached], lo_b[reached])
        at_a[reached], at_b[reached] = back_a, back_b
        split = at_a >= 0
        at_a, at_b = at_a[split], at_b[split]
        found_a.append(at_a)
        found_b.append(at_b)
        # What lies between a cut found backwards and the end has no other.
        right = ~reached[split]
        lo_a, hi_a, lo_b, hi_b = lo_a[split], hi_a[split], lo_b[split], hi_b[split]
        lo_a, hi_a = np.r_[lo_a, at_a[right] + 1], np.r_[at_a + 1, hi_a[right]]
        lo_b, hi_b = np.r_[lo_b, at_b[right] + 1], np.r_[at_b + 1, hi_b[right]]
    return np.sort(np.concatenate(found_a)), np.sort(np.concatenate(found_b))


def _meet_after(ends_a: np.ndarray, ends_b: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first places from A's ``start`` on at which both end. A text's end is one."""
    at_a, at_b = start.copy(), np.zeros_like(start)
    open_ = np.arange(len(start))
    while len(open_):
        at_b[open_] = np.searchsorted(ends_b, ends_a[at_a[open_]])
        open_ = open_[ends_b[at_b[open_]] != ends_a[at_a[open_]]]
        at_a[open_] = np.searchsorted(ends_a, ends_b[at_b[open_]])
        open_ = open_[ends_b[at_b[open_]] != ends_a[at_a[open_]]]
    return at_a, at_b


def _meet_before(
    ends_a: np.ndarray, ends_b: np.ndarray, start: np.ndarray, lo_a: np.ndarray, lo_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The last places before A's ``start`` at which both end; -1 where that is before the interval."""
    at_a, at_b = start.copy(), np.zeros_like(start)
    open_ = np.arange(len(start))
    while len(open_):
        at_b[open_] = np.searchsorted(ends_b, ends_a[at_a[open_]], "right") - 1
        open_ = _unmet(ends_a, ends_b, at_a, at_b, open_, lo_a, lo_b)
        at_a[open_] = np.searchsorted(ends_a, ends_b[at_b[open_]], "right") - 1
        open_ = _unmet(ends_a, ends_b, at_a, at_b, open_, lo_a, lo_b)
    return at_a, at_b


def _unmet(ends_a, ends_b, at_a, at_b, open_, lo_a, lo_b) -> np.ndarray:
    """The places still open; those that left their interval get -1."""
    out = (at_a[open_] < lo_a[open_]) | (at_b[open_] < lo_b[open_])
    at_a[open_[out]] = at_b[open_[out]] = -1
    open_ = open_[~out]
    return open_[ends_b[at_b[open_]] != ends_a[at_a[open_]]]


@dataclass
class Aligned:
    """Tokens of a slice's texts. ``texts``: which rows have any; text i of those has the A tokens
    from ``first_a[i]`` and the B tokens from ``first_b[i]`` on. ``cuts_a``, ``cuts_b``: the last
    tokens of each group; ``first`` says where each text's groups begin."""

    texts: np.ndarray
    a: np.ndarray
    b: np.ndarray
    first_a: np.ndarray
    first_b: np.ndarray
    cuts_a: np.ndarray
    cuts_b: np.ndarray
    first: np.ndarray


def _tokens(which: Vocabulary, ids: np.ndarray, first: np.ndarray, index: np.ndarray, places: np.ndarray):
    """The tokens of units at their places, their ends, and where each text's begin."""
    counts = np.diff(first)[index]
    upto = np.r_[0, np.cumsum(counts)]
    tokens = ids[np.arange(upto[-1]) + np.repeat(first[index] - upto[:-1], counts)]
    return tokens, np.cumsum(which.lengths[tokens]), upto[places]


def align(column: pa.Array, path_a: str, path_b: str) -> Aligned:
    """Encode and align whole texts."""
    a, b = vocabulary(path_a), vocabulary(path_b)
    units: Units = cut(spaced(column))
    ids_a, units_a, exact_a = a.encode(units.texts)
    ids_b, units_b, exact_b = b.encode(units.texts)
    doc = units.doc
    bad = np.bincount(doc, ~(exact_a & exact_b)[units.index], len(units.first) - 1) > 0
    good = ~bad & (np.diff(units.first) > 0)
    index = units.index[good[doc]]
    places = np.r_[0, np.cumsum(np.diff(units.first)[good])]
    tokens_a, ends_a, first_a = _tokens(a, ids_a, units_a, index, places)
    tokens_b, ends_b, first_b = _tokens(b, ids_b, units_b, index, places)
    cuts_a, cuts_b = shared_ends(ends_a, ends_b, first_a, first_b)
    first = np.searchsorted(cuts_a, first_a)
    return Aligned(np.flatnonzero(good), tokens_a, tokens_b, first_a, first_b, cuts_a, cuts_b, first)


def written_groups(found: Aligned) -> list[memoryview]:
    """Of each text, its groups as ``a1,a2|b1;a3|b2,b3``."""
    groups_a = np.diff(found.cuts_a, prepend=-1)
    groups_b = np.diff(found.cuts_b, prepend=-1)
    n = len(found.a) + len(found.b)
    # Before an A token stand the B tokens of all earlier groups, before a B token the A tokens of its own too.
    at_a = np.arange(len(found.a)) + np.repeat(np.cumsum(groups_b) - groups_b, groups_a)
    at_b = np.arange(len(found.b)) + np.repeat(np.cumsum(groups_a), groups_b)
    ids = np.empty(n, np.int64)
    ids[at_a], ids[at_b] = found.a, found.b
    after = np.full(n, _COMMA, np.uint8)
    after[at_a[found.cuts_a]] = _BAR
    after[at_b[found.cuts_b]] = _SEMICOLON
    digits = np.ones(n, np.int64)
    power = 10
    while n and power <= ids.max():
        digits += ids >= power
        power *= 10
    ends = np.cumsum(digits + 1)
    out = np.empty(int(ends[-1]) if n else 0, np.uint8)
    out[ends - 1] = after
    place, rest, left = ends - 2, ids, digits
    while len(rest):
        out[place] = rest % 10 + 48
        more = left > 1
        place, rest, left = place[more] - 1, rest[more] // 10, left[more] - 1
    tops = np.r_[0, ends][found.first_a + found.first_b].tolist()
    view = memoryview(out)
    return [view[x : y - 1] for x, y in zip(tops, tops[1:], strict=False)]


def link_counts(links: DataFrame, pairs: int) -> np.ndarray:
    """How often each of so many linkable pairs is held, over all rows of ``(pairs, times)``.

    A task sends each pair once, and the driver gets no more numbers than there are pairs.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(pairs, np.int64)
        for batch in batches:
            which, times = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("pairs", "times"))
            np.add.at(total, which, times)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["pair", "n"])

    rows = links.select("pairs", "times").mapInArrow(count, "pair bigint, n bigint")
    table = rows.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(pairs, np.int64)
    out[table.column("pair").to_numpy()] = table.column("n").to_numpy()
    return out


def alignments(
    docs: DataFrame, path_a: str, path_b: str, column: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """The kept columns (default: all), numbers of A and B tokens, groups and links of each whole text,
    the links that are their B token's most frequent of the corpus (``n_best``), the sum of their
    counts over the corpus (``count_sum``), and the groups' digest.

    A kept column with the name of a new one gives way to it.
    """
    names = "n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string"
    made = [*StructType.fromDDL(names).names, "n_links", "n_best", "count_sum"]
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in made]
    size_b = len(vocabulary(path_b).tokens)
    pairs = len(linkable(path_a, path_b))

    def make(part: pa.RecordBatch) -> dict[str, pa.Array]:
        found = align(part.column(column), path_a, path_b)
        rows = part.num_rows

        def spread(values: np.ndarray) -> np.ndarray:
            out = np.zeros(rows, np.int64)
            out[found.texts] = values
            return out

        digests = [""] * rows
        for i, text in zip(found.texts.tolist(), written_groups(found), strict=True):
            digests[i] = sha256(text).hexdigest()
        codes = found.a[found.cuts_a] * size_b + found.b[found.cuts_b]
        where = np.searchsorted(linkable(path_a, path_b), codes)
        doc = np.repeat(found.texts, np.diff(found.first))
        held, times = np.unique(doc * pairs + where, return_counts=True)
        offsets = pa.array(np.searchsorted(held, np.arange(rows + 1) * pairs), pa.int32())
        return {
            "n_a": pa.array(spread(np.diff(found.first_a))),
            "n_b": pa.array(spread(np.diff(found.first_b))),
            "n_groups": pa.array(spread(np.diff(found.first))),
            "groups_sha256": pa.array(digests, pa.string()),
            "__pairs": pa.ListArray.from_arrays(offsets, pa.array(held % pairs, pa.int32())),
            "__times": pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32())),
        }

    read = docs.select(*[f"`{c}`" for c in dict.fromkeys([*kept, column])])
    found = staged(add_columns(read, make, f"{names}, __pairs array<int>, __times array<int>", column, kept), "alignments")
    counts = link_counts(found.select(F.col("__pairs").alias("pairs"), F.col("__times").alias("times")), pairs)
    highest = np.zeros(size_b, np.int64)
    of_b = linkable(path_a, path_b) % size_b
    np.maximum.at(highest, of_b, counts)
    shared = docs.sparkSession.sparkContext.broadcast((counts, (counts == highest[of_b]).astype(np.int64)))

    def look_up(part: pa.RecordBatch) -> dict[str, pa.Array]:
        which, times = part.column("__pairs"), part.column("__times")
        at = np.r_[0, np.cumsum(which.value_lengths().to_numpy())].astype(np.int64)
        which, times = (x.flatten().to_numpy(zero_copy_only=False) for x in (which, times))

        def sums(values: np.ndarray) -> pa.Array:
            upto = np.r_[0, np.cumsum(values * times)].astype(np.int64)
            return pa.array(np.diff(upto[at]))

        counts, best = shared.value
        return {
            "n_links": part.column("n_groups"),
            "n_best": sums(best[which]),
            "count_sum": sums(counts[which]),
        }

    keep = [*kept, *StructType.fromDDL(names).names]
    return add_columns(found, look_up, "n_links bigint, n_best bigint, count_sum bigint", "groups_sha256", keep, ("__pairs", "__times"))
