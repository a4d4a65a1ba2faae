"""Byte-level BPE by corpus-level merge replay, and its inverse.

Merges do not depend on the text around a piece, so a task collects the distinct pieces
of its documents and merges each of them once. The pieces lie end to end in one array of
tokens. An inverted index leads from each pair that merges, named by the rank of its merge,
to the positions where it stands in all these pieces. Merges are replayed from it in rank
order; a merge touches its two neighbours only, whose new pairs enter the index.

A pair of lower rank may appear late, as one token can be split in several ways. Then that
merge comes before the rest of the one at hand, which waits in the index. As merges of
different pieces do not meet, this gives each piece its own order: lowest rank first, then
leftmost.

The corpus is replayed batch by batch: the index of a batch holds the pieces that the
task has not met before, cut into indexes of bounded size. No piece is shuffled, so a piece
that a third of all documents share costs nothing extra, and memory is bounded by the batch,
by ``remembered`` and by the longest piece, which takes time in proportion to its length.
"""

from __future__ import annotations

import base64
import heapq
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType

from sheafline.llm.words import blocks

#: Distinct pieces whose ids a task keeps; beyond it the table starts anew.
REMEMBERED = 500_000
#: Bytes of pieces in one index, beside those of its last piece.
INDEXED = 4_000_000
NEVER = np.iinfo(np.int64).max


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks by token bytes, from a file with a base64 token and a rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class PairRanks:
    """The token that two adjacent tokens become; its id is also the rank of the merge."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {
            (ranks[token[:cut]] << 32) | ranks[token[cut:]]: rank
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        }
        self.of = pairs
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.ranks = np.array([pairs[k] for k in self.keys.tolist()], dtype=np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of many pairs, ``NEVER`` for pairs that do not merge."""
        if not len(self.keys):
            return np.full(len(left), NEVER)
        wanted = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NEVER)


class PairIndex:
    """Inverted index: for each rank of a merge the positions where its pair stands.

    ``rank`` says what stands at a position now; an entry that differs from it is stale.
    """

    def __init__(self, size: int):
        self.rank = np.full(size, NEVER)
        self.places: dict[int, list[np.ndarray]] = {}
        self.queue: list[int] = []

    def enter(self, at: np.ndarray, ranks: np.ndarray) -> None:
        """Positions and the ranks of their pairs, ``NEVER`` for pairs that do not merge."""
        self.rank[at] = ranks
        order = np.argsort(ranks, kind="stable")
        order = order[: np.searchsorted(ranks, NEVER, sorter=order)]
        if not len(order):
            return
        at, ranks = at[order], ranks[order]
        begins = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist()]
        for rank, begin, end in zip(ranks[begins].tolist(), begins, [*begins[1:], len(at)], strict=True):
            self.wait(rank, at[begin:end])

    def wait(self, rank: int, at: np.ndarray) -> None:
        if not len(at):
            return
        if rank in self.places:
            self.places[rank].append(at)
        else:
            self.places[rank] = [at]
            heapq.heappush(self.queue, rank)

    def lowest(self) -> int | None:
        return self.queue[0] if self.queue else None

    def take(self, rank: int) -> np.ndarray:
        """The positions of the lowest rank, ascending, without stale ones."""
        heapq.heappop(self.queue)
        parts = self.places.pop(rank)
        at = np.concatenate(parts) if len(parts) > 1 else parts[0]
        at = np.sort(at[self.rank[at] == rank])
        return at[np.concatenate([[True], at[1:] != at[:-1]])] if len(at) > 1 else at


class MergeReplay:
    """Ids of pieces, each distinct piece merged once."""

    def __init__(self, ranks: dict[bytes, int], remembered: int = REMEMBERED):
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.pairs = PairRanks(ranks)
        self.remembered = remembered
        self._forget()

    def _forget(self) -> None:
        # a piece not met before gets the next number
        self.place: defaultdict[str, int] = defaultdict()
        self.place.default_factory = self.place.__len__
        self.ids = np.zeros(0, np.int32)
        self.begins = np.zeros(1, np.int64)

    def replay(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all pieces in order, and where each piece begins."""
        ids, counts = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
        ends = np.cumsum(np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)))
        # pieces that end within the same stretch of bytes share an index
        cuts = np.flatnonzero(np.diff(ends // INDEXED)) + 1
        for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(pieces)], strict=True):
            token, piece = self._merged(pieces[begin:end])
            ids.append(token.astype(np.int32))
            counts.append(np.bincount(piece, minlength=end - begin))
        return np.concatenate(ids), np.cumsum(np.concatenate(counts))

    def _merged(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids that remain of pieces when all merges are replayed, and whose they are."""
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        piece = np.repeat(np.arange(len(pieces)), sizes)
        token = self.byte[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        inner = np.flatnonzero(piece[:-1] == piece[1:])
        before, after = np.full((2, len(piece)), -1)
        before[inner + 1], after[inner] = inner, inner + 1
        index = PairIndex(len(piece))
        index.enter(inner, self.pairs(token[inner], token[inner + 1]))
        while (rank := index.lowest()) is not None:
            at = index.take(rank)
            owner = piece[at]
            if (owner[1:] == owner[:-1]).any():
                at, waiting = self._together(rank, at, owner, token, before, after)
                index.wait(rank, waiting)
            right = after[at]
            beyond = after[right]
            token[at], token[right], index.rank[right] = rank, -1, NEVER
            after[at] = beyond
            inside = beyond >= 0
            before[beyond[inside]] = at[inside]
            # only the pairs on both sides of a merge change
            left = before[at]
            changed = np.concatenate([left[left >= 0], at])
            has_pair = after[changed] >= 0
            index.rank[at[~inside]] = NEVER
            changed = changed[has_pair]
            index.enter(changed, self.pairs(token[changed], token[after[changed]]))
        return token[token >= 0], piece[token >= 0]

    def _together(
        self, rank: int, at: np.ndarray, owner: np.ndarray, token: np.ndarray, before: np.ndarray, after: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Of one pair's positions those that merge now, and those that wait for a lower rank.

        Within a piece the leftmost comes first, so of positions in a row that overlap every
        second one merges. If a merge gives its piece a pair of lower rank, even one that the next
        merge would take again, the rest of that piece waits.
        """
        nth = np.arange(len(at))
        apart = np.concatenate([[True], after[at[:-1]] != at[1:]])
        merging = at[(nth - np.maximum.accumulate(np.where(apart, nth, 0))) % 2 == 0]
        right = after[merging]
        left, beyond = before[merging], after[right]
        # what stands left is merged already where the merge before this one is its neighbour
        taken = np.concatenate([[False], left[1:] == right[:-1]])
        new_left = self.pairs(np.where(taken, rank, token[left]), np.full(len(merging), rank))
        new_right = self.pairs(np.full(len(merging), rank), token[beyond])
        lower = ((left >= 0) & (new_left < rank)) | ((beyond >= 0) & (new_right < rank))
        if not lower.any():
            return merging, at[:0]
        ends = np.full(owner[-1] + 1, NEVER)
        flagged = merging[lower]
        np.minimum.at(ends, owner[np.searchsorted(at, flagged)], flagged)
        last = ends[owner]
        return merging[merging <= last[np.searchsorted(at, merging)]], at[at > last]

    def encode(self, texts: Iterable[str | None], split: Callable[[str], list[str]]) -> pa.Array:
        """Ids of texts, which ``split`` cuts into pieces."""
        if len(self.place) > self.remembered:
            self._forget()
        known, number = len(self.place), self.place.__getitem__
        numbers = [np.fromiter(map(number, split(t or "")), dtype=np.int32) for t in texts]
        if len(self.place) > known:
            ids, begins = self.replay([p.encode("utf-8") for p in islice(self.place, known, None)])
            self.begins = np.concatenate([self.begins[:-1], begins + len(self.ids)])
            self.ids = np.concatenate([self.ids, ids])
        parts, sizes = [self.ids[:0]], np.zeros(len(numbers), dtype=np.int64)
        for n, at in enumerate(numbers):
            begin, size = self.begins[at], self.begins[at + 1] - self.begins[at]
            ends = np.cumsum(size)
            sizes[n] = ends[-1] if len(ends) else 0
            parts.append(self.ids[np.arange(sizes[n]) + np.repeat(begin - (ends - size), size)])
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts)))


def encode(text: Column | str, *, ranks: str, pattern: str, remembered: int = REMEMBERED) -> Column:
    """Token ids of each whole text as an array of integers.

    ``ranks`` is a file of the driver, read once; ``pattern`` splits a text into pieces,
    each merged alone. A null text and an empty one have no ids. There are no special
    tokens. Repeated texts have equal ids, and no row depends on another.
    """
    table = read_ranks(ranks)

    @F.arrow_udf(ArrayType(IntegerType()))
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        split = regex.compile(pattern).findall
        replay = MergeReplay(table, remembered)
        for texts in batches:
            parts = [replay.encode((t.as_py() for t in block), split) for block in blocks(texts)]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    return ids(text)


def decode(ids: Column | str, *, ranks: str) -> Column:
    """The bytes that token ids stand for; a null has no bytes. An unknown id fails."""
    table = read_ranks(ranks)

    @F.arrow_udf(BinaryType())
    def raw(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        token = {rank: value for value, rank in table.items()}
        for lists in batches:
            numbers = lists.values.to_numpy(zero_copy_only=False)
            ends = lists.offsets.to_numpy().tolist()
            yield pa.array(
                [b"".join([token[i] for i in numbers[a:b].tolist()]) for a, b in zip(ends, ends[1:], strict=False)],
                pa.binary(),
            )

    return raw(F.coalesce(ids, F.array().cast("array<int>")))
