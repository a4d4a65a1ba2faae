"""Words of whole texts as flat arrays, for work inside tasks.

A word is a maximal run of characters other than space and U+0009 to U+000D, the white
space of ASCII. A block of texts becomes one array of word numbers, so that shingles,
windows and counts are array operations instead of loops over words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# Odd multipliers of a 64-bit mixing function (fixed values).
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)

# The bytes of ASCII white space (fixed values).
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


@dataclass(frozen=True)
class Block:
    """Words of several texts: ``number[i]`` is the i-th word's place in ``vocabulary``."""

    vocabulary: pa.Array
    number: np.ndarray
    offsets: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.offsets)

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.sizes)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, equal in every task."""
        return hash_strings(self.vocabulary)[self.number]


def as_array(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    return column


def whole_texts(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """Texts with 64-bit offsets, a null as the empty text, in buffers of their own.

    Kernels of Arrow that change text can misread a slice of a larger array.
    """
    texts = as_array(pc.fill_null(as_array(column).cast(pa.large_string()), ""))
    raw, offsets = raw_bytes(texts)
    buffers = [None, pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(np.ascontiguousarray(raw))]
    return pa.Array.from_buffers(pa.large_string(), len(texts), buffers)


def word_block(column: pa.Array | pa.ChunkedArray, *, lower: bool = False) -> Block:
    """The words of each text; ``lower`` turns A-Z into a-z, and nothing else."""
    texts = whole_texts(column)
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0]) if len(texts) else pa.array([], pa.large_string())
    offsets = offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)
    coded = pc.dictionary_encode(flat)
    number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    vocabulary = coded.dictionary
    # white space at either end of a text is split off as an empty word
    empty = pc.index(vocabulary, pa.scalar("", vocabulary.type)).as_py() if len(vocabulary) else -1
    if empty >= 0:
        real = number != empty
        offsets = np.concatenate([[0], np.cumsum(real)])[offsets]
        number = number[real]
    return Block(vocabulary, number, offsets)


def hash_strings(strings: pa.Array) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(s) for s in strings.to_pylist()), dtype=np.uint64, count=len(strings))


def mixed(state: np.ndarray, value: np.ndarray) -> np.ndarray:
    """An order-dependent combination of two arrays of hashes."""
    out = (state * GOLDEN) ^ value
    out ^= out >> np.uint64(29)
    out *= MIX
    out ^= out >> np.uint64(32)
    return out


def window_hashes(block: Block, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of every ``size`` consecutive words of one text."""
    count = max(0, len(hashes) - size + 1)
    state = np.full(count, size, dtype=np.uint64)
    for step in range(size):
        state = mixed(state, hashes[step : step + count])
    owner = block.owner()
    starts = np.flatnonzero(owner[:count] == owner[size - 1 : size - 1 + count]) if count else np.zeros(0, np.int64)
    return state[starts], starts


def sequence_hashes(block: Block, hashes: np.ndarray) -> np.ndarray:
    """One hash per text over its whole word sequence, order included."""
    place = np.arange(len(hashes), dtype=np.uint64) - np.repeat(block.offsets[:-1], block.sizes).astype(np.uint64)
    terms = mixed(place + np.uint64(1), hashes)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
    return mixed(sums[block.offsets[1:]] - sums[block.offsets[:-1]], block.sizes.astype(np.uint64))


def covered(starts: np.ndarray, size: int, total: int) -> np.ndarray:
    """Which of ``total`` words lie in a window of ``size`` words beginning at ``starts``."""
    edges = np.zeros(total + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, np.minimum(starts + size, total), -1)
    return np.cumsum(edges[:-1]) > 0


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` over each text's words."""
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def blocks(texts: pa.Array, size: int = 4_000_000) -> Iterator[pa.Array]:
    """Slices of about ``size`` bytes, so that memory does not follow the batch."""
    ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))])
    begin = 0
    while begin < len(texts):
        end = max(begin + 1, int(np.searchsorted(ends, ends[begin] + size, side="right")) - 1)
        yield texts.slice(begin, end - begin)
        begin = end


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of texts from ``whole_texts``, and where each text begins and the last ends."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return raw, offsets - offsets[0]


def without_words(texts: pa.Array, removed: np.ndarray) -> pa.Array:
    """Texts without the words marked in ``removed``, one flag per word of all texts.

    A word goes together with the white space after it. Other characters stay as they are.
    """
    raw, offsets = raw_bytes(texts)
    word = ~SPACE[raw]
    first = word.copy()
    first[1:] &= SPACE[raw[:-1]]
    first[offsets[:-1][offsets[:-1] < len(raw)]] = word[offsets[:-1][offsets[:-1] < len(raw)]]
    number = np.cumsum(first)
    # white space before a text's first word belongs to no word
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    before = np.concatenate([[0], number])[offsets[:-1]]
    keep = np.concatenate([[False], removed])[np.where(number > before[owner], number, 0)] == 0
    ends = np.concatenate([[0], np.cumsum(keep)])[offsets].astype(np.int64)
    return pa.Array.from_buffers(
        pa.large_string(), len(texts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(raw[keep]))]
    )


def give_back() -> None:
    """Return the freed memory of this process to the machine, Arrow's and, where the C library can, the heap's."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


Batches = Iterator[pa.RecordBatch]


def tidy(work: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``work`` on batches, with freed memory given back before and after.

    Python workers outlive their tasks, and what an idle one holds is missing to the stages after it.
    """

    def tidied(batches: Batches) -> Batches:
        give_back()
        yield from work(batches)
        give_back()

    return tidied


def tidy_group(work: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """``work`` on the rows of a group, with the memory that it freed given back after it."""

    def tidied(rows: pa.Table) -> pa.Table:
        found = work(rows)
        give_back()
        return found

    return tidied


def tidy_groups(work: Callable[[pa.Table, pa.Table], pa.Table]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """``tidy_group`` for two groups of one key."""

    def tidied(rows: pa.Table, others: pa.Table) -> pa.Table:
        found = work(rows, others)
        give_back()
        return found

    return tidied
