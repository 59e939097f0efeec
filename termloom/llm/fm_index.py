"""A full-text index of a shard: Burrows-Wheeler transform in a wavelet tree, searched backwards.

All steps work on arrays, for many patterns at once. Symbols are positive integers; 0
separates texts.
"""

from __future__ import annotations

import numpy as np

#: Patterns searched at a time: what a step makes of so many stays in the processor's cache.
TOGETHER = 1 << 14
#: Bits of a symbol that one level of the tree tells apart.
DIGIT_BITS = 4
_BELOW = (np.uint64(1) << np.arange(64, dtype=np.uint64)) - np.uint64(1)


class Digits:
    """A sequence of digits: a bit vector for each value, with counts up to every 64th place."""

    def __init__(self, digits: np.ndarray) -> None:
        self.stride = len(digits) // 64 + 1
        padded = np.full(self.stride * 64, 1 << DIGIT_BITS, np.uint8)
        padded[: len(digits)] = digits
        vectors = [np.packbits(padded == d, bitorder="little").view("<u8") for d in range(1 << DIGIT_BITS)]
        self.words = np.concatenate(vectors)
        # Counts go on from one digit's vector to the next.
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    def sorted_place(self, digit: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """Smaller digits in all, and equal ones among the first ``upto``."""
        word = digit * self.stride + (upto >> 6)
        return self.before[word] + np.bitwise_count(self.words[word] & _BELOW[upto & 63])


class WaveletTree:
    """A sequence by the digits of its symbols: level by level, it is sorted by one digit, the highest first."""

    def __init__(self, symbols: np.ndarray, largest: int) -> None:
        depth = -(-max(1, int(largest).bit_length()) // DIGIT_BITS)
        self.levels: list[tuple[int, Digits]] = []
        for shift in range((depth - 1) * DIGIT_BITS, -1, -DIGIT_BITS):
            digits = ((symbols >> shift) & ((1 << DIGIT_BITS) - 1)).astype(np.uint8)
            self.levels.append((shift, Digits(digits)))
            symbols = symbols[np.argsort(digits, kind="stable")]

    def rank(self, symbol: np.ndarray, *places: np.ndarray) -> list[np.ndarray]:
        """Where the symbols before each place stand at the end: differences of these are counts."""
        at = list(places)
        for shift, digits in self.levels:
            digit = (symbol >> shift) & ((1 << DIGIT_BITS) - 1)
            at = [digits.sorted_place(digit, place) for place in at]
        return at


class FMIndex:
    """Index of a text for patterns of up to ``depth`` symbols."""

    def __init__(self, text: np.ndarray, depth: int) -> None:
        self.text = text
        self.suffixes = suffix_order(text, depth)
        largest = int(text.max(initial=0))
        self.starts = np.zeros(largest + 2, np.int64)
        np.cumsum(np.bincount(text, minlength=largest + 1), out=self.starts[1:])
        self.tree = WaveletTree(text[self.suffixes - 1], largest)
        # From a place in the tree to one among the suffixes that begin with the symbol.
        every = np.arange(largest + 1)
        self.shift = self.starts[:-1] - self.tree.rank(every, np.zeros(largest + 1, np.int64))[0]

    def search(self, ends: np.ndarray, source: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of ``source`` at ``ends`` (exclusive), up to ``length``.

        Returns, per end, how many symbols before it occur in the text in one piece, and
        the range of suffixes that begin with them. Separators match nothing.
        """
        low = np.zeros(len(ends), np.int64)
        high = np.full(len(ends), len(self.text), np.int64)
        matched = np.zeros(len(ends), np.int64)
        for first in range(0, len(ends), TOGETHER):
            part = slice(first, first + TOGETHER)
            self._search(ends[part], source, length, matched[part], low[part], high[part])
        return matched, low, high

    def _search(self, ends, source, length, matched, low, high) -> None:
        """Search some patterns, and write what is found into the last three arrays."""
        alive = np.arange(len(ends))
        for step in range(1, length + 1):
            at = ends[alive] - step
            alive, at = alive[at >= 0], at[at >= 0]
            symbol = source[at]
            known = (symbol > 0) & (symbol < len(self.starts) - 1)
            alive, symbol = alive[known], symbol[known]
            if not len(alive):
                break
            if step == 1:  # all suffixes that begin with the symbol
                lower, upper = self.starts[symbol], self.starts[symbol + 1]
                shift = 0
            else:
                lower, upper = self.tree.rank(symbol, low[alive], high[alive])
                shift = self.shift[symbol]
            found = upper > lower
            if not found.all():
                alive, lower, upper = alive[found], lower[found], upper[found]
                shift = shift[found] if step > 1 else 0
            low[alive], high[alive] = lower + shift, upper + shift
            matched[alive] = step


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols at least.

    A sort puts as many ranks side by side as a 64-bit key holds, two or more, so that
    each multiplies the symbols that count. Suffixes that agree in all of these may stand in any order.
    """
    n = len(text)
    if int(text.max(initial=0)) <= n:
        rank = text.astype(np.int64) + 1
    else:
        rank = np.unique(text, return_inverse=True)[1].astype(np.int64) + 1
    together = max(2, 63 // (n + 2).bit_length())
    done = 1
    while True:
        key = rank.copy()
        for i in range(1, together):
            key *= n + 2
            if i * done < n:
                key[: n - i * done] += rank[i * done :]
        order = np.argsort(key)
        ordered = key[order]
        new = np.ones(n, np.int64)
        new[1:] += np.cumsum(ordered[1:] != ordered[:-1])
        rank[order] = new
        done *= together
        if done >= depth or not n or new[-1] == n:
            return order
