"""Quality rules as a cascade that stops at the first rule that rejects a text.

``order_rules`` runs every rule on a sample, measures what it costs and how much it
rejects, and puts the rule with most rejections per second first. ``apply_rules`` then
evaluates each rule only on the texts that all rules before it have passed. The order
moves the work, never the verdict: a text is kept when no rule rejects it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.batches import add_columns, byte_slices, filled
from termloom.llm.words import Words, find_words, gram_hashes, gram_starts, sums_by_text, word_hashes

#: Rows on which costs and selectivities are estimated.
SAMPLE_ROWS = 256

# Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True


def repeated_words(words: Words, n: int = 3) -> np.ndarray:
    """Per text, the words in windows of n words that the text has twice or more."""
    grams, inside = gram_hashes(word_hashes(words), n), gram_starts(words, n)
    at = np.flatnonzero(inside)
    order = at[np.lexsort((grams[at], words.doc[at]))]
    same = (grams[order][1:] == grams[order][:-1]) & (words.doc[order][1:] == words.doc[order][:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    covered = np.zeros(len(words.doc), bool)
    for i in range(n):
        covered[order[twice] + i] = True
    return np.bincount(words.doc[covered], minlength=len(words.counts))


def repeated_lines(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Per text, its lines with a word, and how many of them equal an earlier one."""
    total, again = [], []
    for text in filled(column).cast(pa.binary()).to_pylist():
        lines = [line for line in text.split(b"\n") if line and not line.isspace()]
        total.append(len(lines))
        again.append(len(lines) - len(set(lines)))
    return np.array(total, np.int64), np.array(again, np.int64)


def _symbols(words: Words) -> np.ndarray:
    return sums_by_text(words, _IS_SYMBOL[words.data])


def _word_chars(words: Words) -> np.ndarray:
    return sums_by_text(words, words.solid & ((words.data & 0xC0) != 0x80))


def text_stats(column: pa.Array) -> dict[str, np.ndarray]:
    words = find_words(column)
    return {
        "n_words": words.counts,
        "word_chars": _word_chars(words),
        "n_symbols": _symbols(words),
        "n_dup_lines": repeated_lines(column)[1],
        "n_repeat_words": repeated_words(words),
    }


@dataclass(frozen=True)
class Rule:
    """``rejects`` says of each text of a column whether the rule rejects it."""

    name: str
    rejects: Callable[[pa.Array], np.ndarray]


def _few_words(column: pa.Array) -> np.ndarray:
    return find_words(column).counts < MIN_WORDS


def _repeats(column: pa.Array) -> np.ndarray:
    words = find_words(column)
    return 100 * repeated_words(words) > MAX_REPEAT_PERCENT * words.counts


def _many_symbols(column: pa.Array) -> np.ndarray:
    """More than three symbols for ten words: tables, markup, decorated text."""
    words = find_words(column)
    return 10 * _symbols(words) > 3 * words.counts


def _many_equal_lines(column: pa.Array) -> np.ndarray:
    total, again = repeated_lines(column)
    return 10 * again > 6 * total


def _mostly_capitals(column: pa.Array) -> np.ndarray:
    words = find_words(column)
    upper = sums_by_text(words, (words.data - np.uint8(65)) < 26)
    lower = sums_by_text(words, (words.data - np.uint8(97)) < 26)
    return upper > lower


def _odd_word_length(column: pa.Array) -> np.ndarray:
    """Words of under 2 or over 25 code points on average."""
    words = find_words(column)
    chars = _word_chars(words)
    return (chars < 2 * words.counts) | (chars > 25 * words.counts)


BASE_RULES = [Rule("few_words", _few_words), Rule("repeats", _repeats)]
FURTHER_RULES = [
    Rule("many_symbols", _many_symbols),
    Rule("many_equal_lines", _many_equal_lines),
    Rule("mostly_capitals", _mostly_capitals),
    Rule("odd_word_length", _odd_word_length),
]
RULES = [*BASE_RULES, *FURTHER_RULES]


def order_rules(
    docs: DataFrame,
    rules: list[Rule] = RULES,
    key: str = "doc_id",
    column: str = "text",
    after: tuple[Rule, ...] | list[Rule] = (),
) -> list[Rule]:
    """The rules by rejections per second on the rows with the smallest hashes of the key.

    Rows that the rules ``after`` which these run reject are left out, as the cascade leaves
    them out. Rules that reject nothing there come last, the cheapest first. Without rows the
    order stays as it is. The sample is found by hashes alone; only its own texts move.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for part in byte_slices(batch, column):
                texts = filled(part.column(column))
                for rule in after:
                    texts = texts.filter(pa.array(~rule.rejects(texts)))
                for number, rule in enumerate(rules):
                    began = time.perf_counter()
                    rejected = int(rule.rejects(texts).sum())
                    rows.append((number, time.perf_counter() - began, rejected))
        arrays = [pa.array(list(values), kind) for values, kind in zip(zip(*rows, strict=True), _MEASURED, strict=False)]
        if rows:
            yield pa.RecordBatch.from_arrays(arrays, names=["number", "seconds", "rejected"])

    place = F.xxhash64(key, F.length(column))
    lowest = docs.select(place.alias("place")).orderBy("place").limit(SAMPLE_ROWS)
    last = lowest.agg(F.max("place")).first()[0]
    if last is None:
        return rules
    # Equal rows have equal hashes: the limit holds where many share the last one.
    sample = docs.filter(place <= last).select(column).limit(SAMPLE_ROWS)
    measured = sample.mapInArrow(measure, "number int, seconds double, rejected bigint")
    found = {
        row["number"]: (row["seconds"], row["rejected"])
        for row in measured.groupBy("number").agg(F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected")).collect()
    }
    rank = {n: (-rejected / max(seconds, 1e-9), seconds) for n, (seconds, rejected) in found.items()}
    return [rules[n] for n in sorted(range(len(rules)), key=lambda n: rank.get(n, (0.0, 0.0)))]


_MEASURED = (pa.int32(), pa.float64(), pa.int64())


def cascade(column: pa.Array, rules: list[Rule]) -> np.ndarray:
    """Per text, the number of the first rule that rejects it, or -1."""
    texts = filled(column)
    verdict = np.full(len(texts), -1)
    for number, rule in enumerate(rules):
        left = np.flatnonzero(verdict < 0)
        if not len(left):
            break
        rejected = rule.rejects(texts if len(left) == len(texts) else texts.take(pa.array(left)))
        verdict[left[rejected]] = number
    return verdict


def apply_rules(docs: DataFrame, rules: list[Rule], column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns, ``kept`` and ``rejected_by``, the first rule in this order that rejects the text.

    A null text is an empty one.
    """
    names = np.array([rule.name for rule in rules] + [None], object)

    def make(part: pa.RecordBatch) -> dict[str, pa.Array]:
        verdict = cascade(part.column(column), rules)
        return {"kept": pa.array(verdict < 0), "rejected_by": pa.array(names[verdict].tolist(), pa.string())}

    return add_columns(docs, make, "kept boolean, rejected_by string", column, keep)


def stats_and_verdict(docs: DataFrame, rules: list[Rule], column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns, all statistics of the text, ``base_failed`` and ``kept``.

    The base rules are read off the statistics; ``rules`` run as a cascade on the texts
    that pass them. A null text has no words, and a text without words is base_failed.
    """

    def make(part: pa.RecordBatch) -> dict[str, pa.Array]:
        texts = filled(part.column(column))
        stats = text_stats(texts)
        failed = (stats["n_words"] < MIN_WORDS) | (
            100 * stats["n_repeat_words"] > MAX_REPEAT_PERCENT * stats["n_words"]
        )
        kept = ~failed
        left = np.flatnonzero(kept)
        if len(left):
            kept[left] = cascade(texts.take(pa.array(left)), rules) < 0
        out = {name: pa.array(values, pa.int64()) for name, values in stats.items()}
        return out | {"base_failed": pa.array(failed), "kept": pa.array(kept)}

    ddl = (
        "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
        "base_failed boolean, kept boolean"
    )
    return add_columns(docs, make, ddl, column, keep)
