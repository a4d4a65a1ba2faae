"""Exact top-k search by inner product with vector-approximation files.

Vectors are cut into packs. A pack keeps, beside the exact vectors, the number of the
cell that each component lies in. A query scans the cells of a pack first: they bound
its inner product with every vector from below and above. Exact vectors are then read in
order of their bounds, best first, until the k-th score found is above every bound left.

Queries are packed too and dealt to parts, packs of vectors to places. Each part meets
each place once, in one task: it holds the queries of the part with the best found for
each so far, and the packs of the place pass by one at a time. What leaves such a meeting
is at most k rows a query. Copies are dealt by a shuffle of our own and sorted, not by a
join: the optimizer takes copies made by ``explode`` for one row and would broadcast all
of them through the driver. Memory is bounded by the queries of a part and one pack.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sheafline.llm.words import tidy

#: Vectors in a pack, queries in a pack, cells per component.
PACK = 8192
QUERIES = 1024
CELLS = 64
#: Packs of vectors in a place, packs of queries in a part: a vector is copied once a part, a query once a place.
PLACE = 4
PART = 16
#: Tasks that meetings are dealt to at most; beyond that, a task has several, one after the other.
TASKS = 10_000
#: Exact vectors read at a time, and queries that scan a pack at a time.
READ = 32
SCAN = 128

PACKS = "pack long, part int, width int, ids binary, vectors binary, cells binary, lows binary, steps binary"
FOUND = "query_id long, vec_id long, score long"
#: What tells meetings apart.
MEETING = ["place", "part", "width"]


def _narrow(vectors: np.ndarray) -> np.ndarray:
    """The same whole numbers in as few bytes as hold all of them."""
    least, most = vectors.min(initial=0), vectors.max(initial=0)
    kinds = (np.int8, np.int16, np.int32, np.int64)
    return vectors.astype(next(x for x in kinds if np.iinfo(x).min <= least and most <= np.iinfo(x).max))


def _wide(packed: pa.Buffer, rows: int, width: int) -> np.ndarray:
    """Vectors of a pack, in the bytes that they were packed in."""
    size = len(packed) // max(1, rows * width) or 8
    return np.frombuffer(packed, f"i{size}").reshape(rows, width)


def _packed(ids: np.ndarray, vectors: np.ndarray, cells: int) -> dict[str, bytes | int]:
    low, high = vectors.min(axis=0), vectors.max(axis=0)
    # whole steps, so that bounds are whole numbers
    step = np.maximum((high - low + cells) // cells, 1)
    cell = (vectors - low) // step
    return {
        "width": vectors.shape[1],
        "ids": ids.tobytes(),
        "vectors": _narrow(vectors).tobytes(),
        "cells": cell.astype(np.uint8).tobytes(),
        "lows": low.tobytes(),
        "steps": step.tobytes(),
    }


def packs(rows: DataFrame, size: int, cells: int = CELLS) -> DataFrame:
    """Packs of ``size`` vectors of one part and length at most, from columns ``part``, ``id`` and ``vector``.

    A task numbers its packs one after the other, from a number that follows from its first pack.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[list[np.ndarray], list[np.ndarray]]] = {}
        number: int | None = None

        def full(key: tuple[int, int]) -> pa.RecordBatch:
            nonlocal number
            ids, vectors = (np.concatenate(part) for part in held.pop(key))
            row = _packed(ids, vectors.reshape(len(ids), key[1]), cells)
            number = crc32(row["vectors"], crc32(row["ids"])) if number is None else number + 1
            return pa.RecordBatch.from_pylist([{"pack": number, "part": key[0]} | row], schema=_ARROW)

        for batch in batches:
            parts, ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            lists = batch.column(2)
            values, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy().astype(np.int64)
            widths = np.diff(ends)
            for key in sorted(set(zip(parts.tolist(), widths.tolist(), strict=True))):
                at = np.flatnonzero((parts == key[0]) & (widths == key[1]))
                while len(at):
                    own = held.setdefault(key, ([], []))
                    part, at = np.split(at, [size - sum(map(len, own[0]))])
                    own[0].append(ids[part])
                    own[1].append(values[(ends[part][:, None] + np.arange(key[1])).ravel()])
                    if sum(map(len, own[0])) >= size:
                        yield full(key)
        for key in list(held):
            yield full(key)

    return rows.select("part", "id", "vector").mapInArrow(tidy(pack), PACKS)


_ARROW = pa.schema(
    [("pack", pa.int64()), ("part", pa.int32()), ("width", pa.int32())]
    + [(name, pa.binary()) for name in ("ids", "vectors", "cells", "lows", "steps")]
)


class Best:
    """Queries of one length, with the ids and scores of the ``k`` best vectors found so far for each, ties to smaller ids."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> None:
        self.query_ids, self.queries, self.k = query_ids, queries, k
        self.ids = np.zeros((len(query_ids), k), np.int64)
        self.scores = np.zeros((len(query_ids), k), np.int64)
        self.count = np.zeros(len(query_ids), np.int64)

    def scan(self, ids: np.ndarray, vectors: np.ndarray, cell: np.ndarray, low: np.ndarray, step: np.ndarray) -> None:
        """Take in the vectors of a pack."""
        cell = cell.astype(np.float64)
        for begin in range(0, len(self.query_ids), SCAN):
            queries = self.queries[begin : begin + SCAN].astype(np.int64)
            high, gap = bounds(queries, cell, low, step)
            own = self.query_ids[begin : begin + SCAN, None] == ids
            high[own] = -np.inf
            # no vector bounded below the k-th score so far can be among the best
            full = self.count[begin : begin + SCAN] == self.k
            floor = np.where(full, self.scores[begin : begin + SCAN, -1], -np.inf)
            if len(ids) >= self.k and not full.all():
                # nor one bounded below what k vectors of the pack score at least
                kth = np.partition(high[~full], -self.k, axis=1)[:, -self.k]
                floor[~full] = kth - gap[~full]
            left = (high >= floor[:, None]) & ~own
            for n in np.flatnonzero(left.any(axis=1)):
                order = np.flatnonzero(left[n])
                order = order[np.argsort(-high[n, order], kind="stable")]
                self._read(begin + n, queries[n], high[n], order, ids, vectors)

    def _read(
        self, n: int, query: np.ndarray, high: np.ndarray, order: np.ndarray, ids: np.ndarray, vectors: np.ndarray
    ) -> None:
        kept_ids, kept = self.ids[n, : self.count[n]], self.scores[n, : self.count[n]]
        for begin in range(0, len(order), READ):
            if len(kept) == self.k and high[order[begin]] < kept[-1]:
                break
            part = order[begin : begin + READ]
            score = np.concatenate([kept, vectors[part].astype(np.int64) @ query])
            number = np.concatenate([kept_ids, ids[part]])
            best = np.lexsort((number, -score))[: self.k]
            kept, kept_ids = score[best], number[best]
        self.count[n] = len(kept)
        self.ids[n, : len(kept)], self.scores[n, : len(kept)] = kept_ids, kept

    def found(self) -> pa.RecordBatch:
        there = np.arange(self.k) < self.count[:, None]
        columns = (np.repeat(self.query_ids, self.count), self.ids[there], self.scores[there])
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["query_id", "vec_id", "score"])


def bounds(queries: np.ndarray, cell: np.ndarray, low: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Upper bounds of the inner product of each query with each cell's vectors, and how far below them the lower ones are."""
    wide = queries.astype(np.float64)
    high = (wide * step) @ cell.T + (wide @ low.astype(np.float64))[:, None]
    reach = wide * (step - 1)
    # float64 holds whole numbers to 2**53; beyond it the slack covers rounding, also of terms that cancel out
    most = np.abs(wide * step) @ cell.max(axis=0, initial=0) + np.abs(wide) @ np.abs(low.astype(np.float64))
    over, under = np.maximum(reach, 0).sum(axis=1), np.minimum(reach, 0).sum(axis=1)
    slack = (most + over - under) * 1e-12
    high += (over + slack)[:, None]
    return high, over - under + 3 * slack


def exact_top_k(
    vectors: DataFrame,
    queries: DataFrame,
    *,
    k: int,
    id: str = "vec_id",
    vector: str = "vector",
    pack: int = PACK,
    query_pack: int = QUERIES,
    cells: int = CELLS,
) -> DataFrame:
    """The ``k`` best vectors of each query by inner product, as query_id, rank, vec_id, score.

    ``vector`` is an array of 64-bit integers; scores are 64-bit too. Ties go to the smaller
    id. A vector with the query's id is never its answer. Null vectors, vectors with a null
    component and null ids take no part; vectors of another length than the query's are not
    compared with it. Repeated ids are separate vectors. A query with fewer than ``k``
    candidates gets all of them, one without any gets no row.
    """
    usable, asked = _usable(vectors, id, vector), _usable(queries, id, vector)
    parts = max(1, ceil(asked.count() / (PART * query_pack)))
    places = max(1, ceil(vectors.count() / (PLACE * pack)))
    part = F.pmod(F.xxhash64("id", "vector"), F.lit(parts)).cast("int")
    asked = packs(asked.withColumn("part", part).repartitionById(parts, F.col("part")), query_pack, cells)
    packed = packs(usable.withColumn("part", F.lit(0)), pack, cells)
    place = F.pmod("pack", F.lit(places)).cast("int")
    none = (F.lit(None).cast("binary").alias(name) for name in ("cells", "lows", "steps"))
    asked = asked.select(_each(places).alias("place"), "part", "width", F.lit(0).alias("turn"), "ids", "vectors", *none)
    packed = packed.withColumn("place", place).drop("part").select(
        "place", _each(parts).alias("part"), "width", F.lit(1).alias("turn"), "ids", "vectors", "cells", "lows", "steps"
    )
    tasks = min(places * parts, TASKS)
    task = F.pmod(F.col("place").cast("long") * parts + F.col("part"), F.lit(tasks)).cast("int")
    dealt = asked.union(packed).repartitionById(tasks, task)
    # queries of a meeting come before its vectors
    met = dealt.sortWithinPartitions(*MEETING, "turn")
    found = met.mapInArrow(tidy(lambda batches: _meetings(batches, k)), FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _each(count: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))


def _usable(rows: DataFrame, id: str, vector: str) -> DataFrame:
    usable = F.col(id).isNotNull() & F.col(vector).isNotNull() & ~F.exists(vector, lambda x: x.isNull())
    return rows.filter(usable).select(F.col(id).cast("long").alias("id"), F.col(vector).alias("vector"))


def _meetings(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    meeting: tuple[int, ...] | None = None
    asked: list[tuple[np.ndarray, np.ndarray]] = []
    best: Best | None = None
    for batch in batches:
        for row in range(batch.num_rows):
            own = tuple(batch.column(name)[row].as_py() for name in MEETING)
            if own != meeting:
                if best:
                    yield best.found()
                meeting, asked, best = own, [], None
            ids = np.frombuffer(batch.column("ids")[row].as_buffer(), np.int64)
            vectors = _wide(batch.column("vectors")[row].as_buffer(), len(ids), own[-1])
            if not batch.column("turn")[row].as_py():
                asked.append((ids.copy(), vectors.copy()))
                continue
            if asked:
                best, asked = Best(*map(np.concatenate, zip(*asked, strict=True)), k), []
            if best:
                cell = np.frombuffer(batch.column("cells")[row].as_buffer(), np.uint8).reshape(vectors.shape)
                low, step = (np.frombuffer(batch.column(name)[row].as_buffer(), np.int64) for name in ("lows", "steps"))
                best.scan(ids, vectors, cell, low, step)
    if best:
        yield best.found()
