"""FM-index of many short word sequences: a wavelet matrix over the Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np


class BitVector:
    """Packed bits with a count of ones before each 64-bit word."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words).astype(np.int64))])[:-1].astype(np.int32)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first i bits."""
        word = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below).astype(np.int64)


class WaveletMatrix:
    """Rank of any symbol in about log2(symbols) bits an entry."""

    def __init__(self, symbols: np.ndarray, n_symbols: int) -> None:
        self.levels = []
        rest = symbols
        for level in range(max(1, int(n_symbols - 1).bit_length()) - 1, -1, -1):
            bits = ((rest >> level) & 1).astype(np.uint8)
            zeros = len(bits) - int(bits.sum())
            self.levels.append((level, BitVector(bits), zeros))
            rest = np.concatenate([rest[bits == 0], rest[bits == 1]])
        self.start = self._descend(np.arange(n_symbols), np.zeros(n_symbols, np.int64))

    def _descend(self, symbols: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, bits, zeros in self.levels:
            ones = bits.rank(i)
            i = np.where((symbols >> level) & 1, zeros + ones, i - ones)
        return i

    def rank(self, symbols: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol among the first i entries."""
        return self._descend(symbols, i) - self.start[symbols]


def _ranks(pairs: np.ndarray) -> np.ndarray:
    return np.unique(pairs, return_inverse=True)[1].astype(np.int64)


class FmIndex:
    """Sequences in one text, a separator after each; matches of up to ``depth`` words, at most 63."""

    def __init__(self, words: np.ndarray, lengths: np.ndarray, depth: int) -> None:
        self.depth, self.lengths = depth, lengths
        self.ends = np.cumsum(lengths + 1) - 1  # place of each separator
        n = int(self.ends[-1]) + 1
        inside = np.ones(n, bool)
        inside[self.ends] = False
        names = np.unique(words)
        self.text = np.zeros(n, np.int64)
        self.text[inside] = np.searchsorted(names, words) + 1
        by_length = {1: self.text}
        for h in (1, 2, 4, 8, 16, 32):
            by_length[2 * h] = self._join(by_length[h], by_length[h], h)
        self.order = np.argsort(by_length[64], kind="stable")
        self.counts = np.searchsorted(np.sort(self.text), np.arange(len(names) + 2))
        self.bwt = WaveletMatrix(self.text[self.order - 1], len(names) + 1)
        half = max(h for h in (1, 2, 4, 8, 16, 32) if h <= depth - 1)
        # Bounds, in suffix order, of the suffixes that agree in all but the last word, and in all words.
        self.shorter = self._bounds(self._join(by_length[half], by_length[half], depth - 1 - half))
        self.full = self._bounds(self._join(by_length[half], by_length[half], depth - half))

    @staticmethod
    def _join(left: np.ndarray, right: np.ndarray, apart: int) -> np.ndarray:
        """Rank of every place by its left part, then by the right part that starts some places on."""
        shifted = np.zeros_like(right)
        if apart < len(right):
            shifted[: len(right) - apart] = right[apart:] + 1
        return _ranks(left * (int(shifted.max()) + 1) + shifted)

    def _bounds(self, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        in_order = ranks[self.order]
        opens = np.flatnonzero(np.concatenate([[True], in_order[1:] != in_order[:-1]]))
        sizes = np.diff(np.concatenate([opens, [len(in_order)]]))
        return opens, np.repeat(opens, sizes), np.repeat(opens + sizes, sizes)

    def _extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = self.counts[symbols]
        return first + self.bwt.rank(symbols, low), first + self.bwt.rank(symbols, high)

    def least_at_matches(self, values: np.ndarray) -> list[np.ndarray]:
        """Streams every sequence from its end. For each window of ``depth`` words, the least value of the sequences that hold it.

        The matching statistic of a place is cut at ``depth``: before a longer match is extended, its
        interval gives up the last word, as the parent of a node in a suffix tree would.
        """
        owner = np.repeat(np.arange(len(self.lengths)), self.lengths + 1)
        least = np.minimum.reduceat(values[owner[self.order]], self.full[0])
        place = np.cumsum(np.bincount(self.full[0], minlength=len(self.order))) - 1  # class of each suffix
        out = [np.empty(max(0, n - self.depth + 1), np.int64) for n in self.lengths.tolist()]
        flat = np.empty(int(sum(map(len, out))), np.int64)
        first = np.concatenate([[0], np.cumsum([len(x) for x in out])])
        active = np.flatnonzero(self.lengths >= self.depth)
        low, high = np.zeros(len(active), np.int64), np.full(len(active), len(self.order), np.int64)
        step = 0
        while len(active):
            if step >= self.depth:
                low, high = self.shorter[1][low], self.shorter[2][low]
            low, high = self._extend(self.text[self.ends[active] - 1 - step], low, high)
            if step >= self.depth - 1:
                flat[first[active] + self.lengths[active] - 1 - step] = least[place[low]]
            step += 1
            going = self.lengths[active] > step
            active, low, high = active[going], low[going], high[going]
        return [flat[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
