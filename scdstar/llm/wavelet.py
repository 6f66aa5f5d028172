"""A wavelet matrix over small symbols, with many queries answered at a time."""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector in 64-bit words, with the ones before each word."""

    def __init__(self, bits: np.ndarray) -> None:
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, "<u8")
        self.words.view("u1")[: len(packed)] = packed
        self.before = np.zeros(len(self.words), np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), dtype=np.int64, out=self.before[1:])

    def ones(self, ends: np.ndarray) -> np.ndarray:
        """The ones before each of ``ends``."""
        word = ends >> 6
        below = (np.uint64(1) << (ends & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class WaveletMatrix:
    """Symbols below ``2 ** levels``. Each level holds one bit of every symbol, the highest
    first, in the order that sorting stably by the bits above gives."""

    def __init__(self, symbols: np.ndarray, levels: int) -> None:
        self.size, self.levels = len(symbols), []
        for level in reversed(range(levels)):
            bits = (symbols >> level & 1).astype(bool)
            self.levels.append((Bits(bits), len(bits) - int(bits.sum())))
            symbols = np.concatenate((symbols[~bits], symbols[bits]))

    def rank(self, symbol: int, ends: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before each of ``ends``."""
        first, ends = np.zeros(1, np.int64), np.asarray(ends, np.int64)
        for level, (bits, zeros) in zip(reversed(range(len(self.levels))), self.levels):
            if symbol >> level & 1:
                first, ends = zeros + bits.ones(first), zeros + bits.ones(ends)
            else:
                first, ends = first - bits.ones(first), ends - bits.ones(ends)
        return ends - first

    def ranks(self, symbols: tuple[int, ...], ends: np.ndarray) -> np.ndarray:
        """How often any of ``symbols`` stands before each of ``ends``."""
        return sum(self.rank(s, ends) for s in symbols)

    def locate(
        self, symbols: tuple[int, ...], times: np.ndarray, low: np.ndarray, high: np.ndarray
    ) -> np.ndarray:
        """The least end from ``low`` on before which ``symbols`` stand ``times`` times, by
        bisection on ranks; ``high`` where they do so at no lower end."""
        low, high = low.copy(), high.copy()
        # Rows that are found are ranked no more, as ``high`` may be one beyond the symbols.
        while (rows := np.flatnonzero(low < high)).size:
            middle = (low[rows] + high[rows]) >> 1
            enough = self.ranks(symbols, middle) >= times[rows]
            high[rows] = np.where(enough, middle, high[rows])
            low[rows] = np.where(enough, low[rows], middle + 1)
        return low
