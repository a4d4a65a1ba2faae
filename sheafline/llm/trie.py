"""A compact n-gram trie: Elias-Fano sequences and quantised probabilities.

Level k holds one entry for each n-gram of k words: the words that follow a context lie
together, in order, and are stored as one rising sequence over all contexts. Pointers
from a level to the next rise too. Both are Elias-Fano coded: the low bits of every
number as they are, the high bits in unary, about two bits each. Levels lie in anonymous
memory maps.
"""

from __future__ import annotations

import mmap

import numpy as np

#: Number of bits that are set in a byte, as a rule rather than a table.
ONES = np.array([bin(b).count("1") for b in range(256)], dtype=np.uint8)
#: log10 probabilities are kept in steps of this size, down to 65535 steps.
STEP = 1 / 2048


def mapped(raw: bytes) -> np.ndarray:
    """Bytes in a memory map of their own, outside the heap."""
    if not raw:
        return np.zeros(0, np.uint8)
    area = mmap.mmap(-1, len(raw))
    area.write(raw)
    return np.frombuffer(area, np.uint8)


class EliasFano:
    """A sequence of whole numbers that never falls."""

    def __init__(self, numbers: np.ndarray):
        self.count = len(numbers)
        top = int(numbers[-1]) + 1 if self.count else 1
        self.low = max(0, (top // max(self.count, 1)).bit_length() - 1)
        bits = np.zeros((self.count, self.low), dtype=np.uint8)
        for bit in range(self.low):
            bits[:, bit] = (numbers >> bit) & 1
        self.lows = mapped(np.packbits(bits.ravel(), bitorder="little").tobytes())
        unary = np.zeros(self.count + (top >> self.low) + 1, dtype=np.uint8)
        unary[(numbers >> self.low) + np.arange(self.count)] = 1
        self.highs = mapped(np.packbits(unary, bitorder="little").tobytes())

    def decode(self) -> np.ndarray:
        """The whole sequence."""
        high = np.flatnonzero(np.unpackbits(self.highs, bitorder="little"))[: self.count] - np.arange(self.count)
        numbers = high << self.low
        bits = np.unpackbits(self.lows, bitorder="little")[: self.count * self.low].reshape(self.count, self.low)
        for bit in range(self.low):
            numbers |= bits[:, bit].astype(np.int64) << bit
        return numbers

    def bytes(self) -> int:
        return len(self.lows) + len(self.highs)


def quantised(log10: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-log10 / STEP), 0, 65535).astype(np.uint16)


def restored(codes: np.ndarray) -> np.ndarray:
    return codes * -STEP


class Level:
    """The n-grams of one length: successors of each context, and where they begin."""

    def __init__(self, context: np.ndarray, word: np.ndarray, contexts: int, words: int, score: np.ndarray, backoff: np.ndarray):
        """Entries sorted by context (an entry of the level above) and word."""
        self.words = words
        self.successors = EliasFano(context * words + word)
        self.pointers = EliasFano(np.searchsorted(context, np.arange(contexts + 1)))
        self.scores = mapped(quantised(score).tobytes()).view(np.uint16)
        self.backoffs = mapped(quantised(backoff).tobytes()).view(np.uint16)

    def find(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Entries of words after contexts, -1 where the trie has none.

        A successor is sought relative to its context: the sequence rises by contexts first,
        and what is found counts only between the context's two pointers. A context of -1 has
        no successors.
        """
        pointers, successors = self.pointers.decode(), self.successors.decode()
        wanted = context * self.words + word
        at = np.searchsorted(successors, wanted)
        inside = (context >= 0) & (at < pointers[np.maximum(context, 0) + 1])
        inside[inside] = successors[at[inside]] == wanted[inside]
        return np.where(inside, at, -1)

    def bytes(self) -> int:
        return self.successors.bytes() + self.pointers.bytes() + self.scores.nbytes + self.backoffs.nbytes


class Trie:
    """Smoothed log10 probabilities of n-grams."""

    def __init__(self, levels: list[Level], unknown: float):
        self.levels, self.unknown = levels, unknown

    def score(self, history: list[np.ndarray]) -> np.ndarray:
        """log10 probability of each word after the words before it.

        ``history[0]`` are the words, ``history[k]`` the words k places before, -1 where a
        text has no such place. The longest n-gram in the trie decides; each longer context
        that is known but lacks the word costs its back-off weight.
        """
        words = history[0]
        entry = self.levels[0].find(np.zeros(len(words), np.int64), words)
        total = np.where(entry >= 0, restored(self.levels[0].scores[entry]), self.unknown)
        for order in range(2, len(self.levels) + 1):
            context = self._context(history[1:order])
            level = self.levels[order - 1]
            entry = level.find(context, words)
            backoff = np.where(context >= 0, restored(self.levels[order - 2].backoffs[context]), 0.0)
            total = np.where(entry >= 0, restored(level.scores[entry]) if len(level.scores) else 0.0, total + backoff)
        return total

    def _context(self, before: list[np.ndarray]) -> np.ndarray:
        """Entries of the words before, oldest first."""
        entry = np.zeros(len(before[0]), np.int64)
        for level, word in zip(self.levels, reversed(before), strict=False):
            entry = np.where(word >= 0, level.find(np.where(word >= 0, entry, -1), word), -1)
        return entry
