"""Elias-Fano sequences in memory-mapped files, and a two-level n-gram trie made of them."""

from __future__ import annotations

import os
import tempfile

import numpy as np

SUCCESSOR_BITS = 40
_ONE = np.uint64(1)


class EliasFano:
    """An ascending sequence of 64-bit numbers: low bits packed, high bits in unary."""

    def __init__(self, low_bits: int, length: int, lows: np.ndarray, highs: np.ndarray) -> None:
        self.low_bits, self.length, self.lows, self.highs = low_bits, length, lows, highs
        ones = np.bitwise_count(highs).astype(np.int64)
        # Set and clear bits before each word of the unary part.
        self.ones = np.concatenate([[0], np.cumsum(ones)])
        self.zeros = np.arange(len(highs) + 1) * 64 - self.ones

    @staticmethod
    def encode(values: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
        """Number of low bits, packed low bits, unary high bits, as 64-bit words."""
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        lows = np.zeros(n * low_bits // 64 + 2, np.uint64)
        if low_bits:
            low = values & np.uint64((1 << low_bits) - 1)
            at = np.arange(n, dtype=np.int64) * low_bits
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            np.bitwise_or.at(lows, word, low << bit)
            over = (at & 63) + low_bits > 64
            np.bitwise_or.at(lows, word[over] + 1, low[over] >> (np.uint64(64) - bit[over]))
        places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        highs = np.zeros((int(places[-1]) if n else 0) // 64 + 2, np.uint64)
        np.bitwise_or.at(highs, places >> 6, _ONE << (places & 63).astype(np.uint64))
        return low_bits, lows, highs

    def _low(self, index: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(index), np.uint64)
        at = index * self.low_bits
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        value = self.lows[word] >> bit
        spill = (at & 63) + self.low_bits > 64
        value[spill] |= self.lows[word[spill] + 1] << (np.uint64(64) - bit[spill])
        return value & np.uint64((1 << self.low_bits) - 1)

    def _select(self, rank: np.ndarray, clear: bool) -> np.ndarray:
        """Place of the set (or clear) bit number ``rank``."""
        before = self.zeros if clear else self.ones
        word = np.searchsorted(before, rank, side="right") - 1
        bits = self.highs[word]
        bits = ~bits if clear else bits.copy()
        left = (rank - before[word]).astype(np.int64)
        place = np.zeros(len(rank), np.int64)
        for half in (32, 16, 8, 4, 2, 1):
            count = np.bitwise_count(bits & np.uint64((1 << half) - 1)).astype(np.int64)
            upper = left >= count
            left -= np.where(upper, count, 0)
            place += np.where(upper, half, 0)
            bits = np.where(upper, bits >> np.uint64(half), bits)
        return word * 64 + place

    def access(self, index: np.ndarray) -> np.ndarray:
        """The numbers at these places."""
        high = (self._select(index, False) - index).astype(np.uint64)
        return (high << np.uint64(self.low_bits)) | self._low(index)

    def successor(self, values: np.ndarray) -> np.ndarray:
        """Place of the first number not less than each value; ``length`` if there is none."""
        high = (values >> np.uint64(self.low_bits)).astype(np.int64)
        last = int(self.zeros[-1]) - 1
        inside = high <= last
        high = np.minimum(high, last)
        # Numbers with the same high part lie between two clear bits.
        end = self._select(high, True) - high
        start = np.where(high > 0, self._select(np.maximum(high - 1, 0), True) - high + 1, 0)
        start, end = np.minimum(start, self.length), np.minimum(end, self.length)
        low = values & np.uint64((1 << self.low_bits) - 1)
        while True:
            open_ = np.flatnonzero(start < end)
            if not len(open_):
                return np.where(inside, start, self.length)
            middle = (start[open_] + end[open_]) // 2
            less = self._low(middle) < low[open_]
            start[open_[less]] = middle[less] + 1
            end[open_[~less]] = middle[~less]


class Trie:
    """Contexts, and the successors of each, in files that are mapped and not read whole.

    Level 1 holds the hashes of the contexts and a value for each. Level 2 holds
    successors relative to their context: number of the context in the upper
    bits, 40 bits of the successor's hash below, one ascending sequence.
    Pointers tell where a context's successors begin and end.
    """

    def __init__(self, folder: str) -> None:
        self._folder = folder
        self._kept: dict[str, np.ndarray] = {}

    def _map(self, name: str, data: np.ndarray) -> np.ndarray:
        path = os.path.join(self._folder, name)
        data.tofile(path)
        return np.memmap(path, data.dtype, "r", shape=data.shape) if data.size else data

    def _level(self, name: str, values: np.ndarray) -> EliasFano:
        low_bits, lows, highs = EliasFano.encode(values)
        return EliasFano(
            low_bits, len(values), self._map(f"{name}.low", lows), self._map(f"{name}.high", highs)
        )

    @classmethod
    def build(
        cls,
        folder: str,
        contexts: np.ndarray,
        context_of: np.ndarray,
        successors: np.ndarray,
        context_values: np.ndarray,
        values: np.ndarray,
    ) -> Trie:
        """From sorted contexts, and successors sorted by the number of their context."""
        trie = cls(folder)
        trie.contexts = trie._level("contexts", contexts)
        starts = np.searchsorted(context_of, np.arange(len(contexts) + 1)).astype(np.uint64)
        trie.pointers = trie._level("pointers", starts)
        keys = (context_of.astype(np.uint64) << np.uint64(SUCCESSOR_BITS)) | successors
        trie.successors = trie._level("successors", keys)
        trie.context_values = trie._map("context_values", context_values)
        trie.values = trie._map("values", values)
        return trie

    def find_contexts(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each context, -1 where it is not in the trie."""
        if not self.contexts.length:
            return np.full(len(hashes), -1)
        at = self.contexts.successor(hashes)
        there = at < self.contexts.length
        there[there] = self.contexts.access(at[there]) == hashes[there]
        return np.where(there, at, -1)

    def find(self, context: np.ndarray, successors: np.ndarray) -> np.ndarray:
        """Value of each successor in its context's range, 0 where it has none."""
        result = np.zeros(len(context), self.values.dtype)
        known = np.flatnonzero(context >= 0)
        if not len(known) or not self.successors.length:
            return result
        number = context[known]
        keys = (number.astype(np.uint64) << np.uint64(SUCCESSOR_BITS)) | successors[known]
        at = self.successors.successor(keys)
        end = self.pointers.access(number + 1).astype(np.int64)
        inside = at < end
        inside[inside] = self.successors.access(at[inside]) == keys[inside]
        result[known[inside]] = self.values[at[inside]]
        return result


def scratch() -> tempfile.TemporaryDirectory:
    """A folder of one task, gone when the task is done with its trie."""
    return tempfile.TemporaryDirectory(prefix="trie-")
