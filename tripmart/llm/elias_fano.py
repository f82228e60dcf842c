"""Elias-Fano sequences and a two-level n-gram trie over them, in numpy.

All parts are flat arrays in one buffer: a level can be read in place from an
Arrow buffer or a memory-mapped file, and is queried in batches.
"""

from __future__ import annotations

import struct

import numpy as np

U = np.uint64
_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_NTH = np.array([[([b for b in range(8) if i >> b & 1] + [8] * 8)[k] for k in range(8)] for i in range(256)], np.uint8)


class EliasFano:
    """A non-decreasing sequence below ``universe``, in 2 + log2(universe / n) bits an item."""

    def __init__(self, n: int, universe: int, low: np.ndarray, words: np.ndarray):
        self.n, self.universe, self.low, self.words = n, universe, low, words
        self.bits = self.low_bits(n, universe)
        self.ones = np.zeros(len(words) + 1, np.int64)
        counts = _POP[words.view(np.uint8)].reshape(-1, 8).sum(axis=1, dtype=np.int64) if len(words) else []
        np.cumsum(counts, out=self.ones[1:])

    @staticmethod
    def low_bits(n: int, universe: int) -> int:
        return max(0, (universe // max(1, n)).bit_length() - 1)

    @classmethod
    def encode(cls, values: np.ndarray, universe: int) -> EliasFano:
        n, values = len(values), values.astype(U)
        bits = cls.low_bits(n, universe)
        high = (values >> U(bits)).astype(np.int64) + np.arange(n)
        flags = np.zeros(-(-(n + (universe >> bits) + 2) // 64) * 64, bool)
        flags[high] = True
        words = np.packbits(flags, bitorder="little").view("<u8").astype(U)
        spread = (values[:, None] >> np.arange(bits).astype(U)) & U(1) if bits else np.zeros((n, 0), U)
        low = np.packbits(spread.astype(bool).ravel(), bitorder="little")
        return cls(n, universe, np.r_[low, np.zeros(8, np.uint8)], words)

    def to_bytes(self) -> bytes:
        head = struct.pack("<qqqq", self.n, self.universe, len(self.words), len(self.low))
        return head + self.words.astype("<u8").tobytes() + self.low.tobytes() + bytes(-len(self.low) % 8)

    @classmethod
    def read(cls, buffer: np.ndarray, at: int) -> tuple[EliasFano, int]:
        """The sequence that starts at byte ``at``, and the byte after it."""
        n, universe, n_words, n_low = struct.unpack("<qqqq", buffer[at : at + 32].tobytes())
        words = buffer[at + 32 : at + 32 + 8 * n_words]
        at += 32 + 8 * n_words
        return cls(n, universe, buffer[at : at + n_low], words.view("<u8") if words.ctypes.data % 8 == 0 else words.copy().view("<u8")), at + n_low + -n_low % 8

    def _select(self, k: np.ndarray, zeros: bool) -> np.ndarray:
        """Place of the k-th (from 0) one, or zero."""
        prefix = np.arange(len(self.ones)) * 64 - self.ones if zeros else self.ones
        word = np.searchsorted(prefix, k, "right") - 1
        left = k - prefix[word]
        bits = self.words[word]
        if zeros:
            bits = ~bits
        place, chosen = word * 64, np.zeros(len(k), np.int64)
        open_ = np.ones(len(k), bool)
        for b in range(8):
            byte = ((bits >> U(8 * b)) & U(255)).astype(np.int64)
            count = _POP[byte]
            here = open_ & (left < count)
            chosen[here] = 8 * b + _NTH[byte[here], left[here]]
            open_ &= ~here
            left = np.where(open_, left - count, left)
        return place + chosen

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), U)
        at = i * self.bits
        window = self.low[(at >> 3)[:, None] + np.arange(8)]
        value = np.ascontiguousarray(window).view("<u8").ravel() >> (at & 7).astype(U)
        return value & U((1 << self.bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        high = self._select(i, False) - i
        return (high.astype(U) << U(self.bits)) | self._low(i)

    def successor(self, values: np.ndarray) -> np.ndarray:
        """Number of the first item >= value, for each value below the universe."""
        values = values.astype(U)
        high = (values >> U(self.bits)).astype(np.int64)
        rank = lambda h: np.where(h > 0, self._select(np.maximum(h - 1, 0), True) - (h - 1), 0)  # noqa: E731  items with a smaller high part
        first, end = rank(high), rank(high + 1)
        wanted = values & U((1 << self.bits) - 1)
        while True:
            open_ = np.flatnonzero(first < end)
            if not len(open_):
                return first
            mid = (first[open_] + end[open_]) >> 1
            less = self._low(mid) < wanted[open_]
            first[open_] = np.where(less, mid + 1, first[open_])
            end[open_] = np.where(less, end[open_], mid)


class NgramTrie:
    """Contexts, monotone pointers to their successors, and a quantised value each.

    Level one holds the contexts; pointer c..c+1 bounds the successors of
    context c; level two holds ``c * vocabulary + successor``, so that one
    Elias-Fano sequence keeps every context's successors in order and a
    search among them starts relative to the context.
    """

    STEP = 1 / 32  # quantum of a value (log10); values are 0..255 quanta

    def __init__(self, vocabulary: int, contexts: EliasFano, pointers: EliasFano, successors: EliasFano, values: np.ndarray):
        self.vocabulary, self.contexts, self.pointers, self.successors, self.values = vocabulary, contexts, pointers, successors, values

    @classmethod
    def build(cls, context: np.ndarray, word: np.ndarray, value: np.ndarray, vocabulary: int) -> NgramTrie:
        """From n-grams sorted by (context, word)."""
        known, first, c = np.unique(context, return_index=True, return_inverse=True)
        quanta = np.clip(np.rint(value / cls.STEP), 0, 255).astype(np.uint8)
        return cls(
            vocabulary, EliasFano.encode(known, vocabulary), EliasFano.encode(np.r_[first, len(context)], len(context) + 1),
            EliasFano.encode(c.astype(U) * U(vocabulary) + word.astype(U), max(1, len(known)) * vocabulary), quanta)

    def to_bytes(self) -> bytes:
        return struct.pack("<qq", self.vocabulary, len(self.values)) + self.contexts.to_bytes() + self.pointers.to_bytes() + self.successors.to_bytes() + self.values.tobytes()

    @classmethod
    def read(cls, buffer: np.ndarray) -> NgramTrie:
        vocabulary, n = struct.unpack("<qq", buffer[:16].tobytes())
        contexts, at = EliasFano.read(buffer, 16)
        pointers, at = EliasFano.read(buffer, at)
        successors, at = EliasFano.read(buffer, at)
        return cls(vocabulary, contexts, pointers, successors, buffer[at : at + n])

    @classmethod
    def open(cls, path: str) -> NgramTrie:
        """A trie in a local file, memory-mapped."""
        return cls.read(np.memmap(path, np.uint8, "r"))

    def lookup(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Value of each n-gram, 0 where it is unknown."""
        out = np.zeros(len(context))
        if not len(context) or not self.contexts.n:
            return out
        c = self.contexts.successor(context)
        some = np.flatnonzero(c < self.contexts.n)
        some = some[self.contexts.get(c[some]) == context[some].astype(U)]
        key = c[some].astype(U) * U(self.vocabulary) + word[some].astype(U)
        at = self.successors.successor(key)
        inside = at < self.pointers.get(c[some] + 1).astype(np.int64)
        some, at, key = some[inside], at[inside], key[inside]
        hit = self.successors.get(at) == key
        out[some[hit]] = self.values[at[hit]] * self.STEP
        return out
