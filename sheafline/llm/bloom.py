"""Bloom filters as expressions.

Keys are hashed with ``xxhash64``, bits are gathered by the bitmap aggregates, and a
filter is read as a scalar subquery, so asking it needs no join.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from sheafline.llm.staging import cut_lineage

BITS_PER_KEY = 12
HASHES = 4
#: Bits that one bitmap of Spark's aggregate holds (fixed value).
BITMAP = 32768


def _positions(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    """Places of a key's bits, from 1. Levels hash differently."""
    seeds = (F.lit(level * HASHES + n) for n in range(hashes))
    return [F.pmod(F.xxhash64(seed, key), F.lit(bits)) + 1 for seed in seeds]


@dataclass(frozen=True)
class Filter:
    """A Bloom filter: one row with an array of bitmaps. Numbers hash differently."""

    number: int
    bits: int
    bitmaps: DataFrame
    hashes: int = HASHES

    def knows(self, key: Column) -> Column:
        bitmaps = self.bitmaps.scalar()
        checks = [_bit(bitmaps, position) for position in _positions(key, self.number, self.bits, self.hashes)]
        out = checks[0]
        for check in checks[1:]:
            out = out & check
        return out


def _bit(bitmaps: Column, position: Column) -> Column:
    offset = F.bitmap_bit_position(position)
    bitmap = F.element_at(bitmaps, F.bitmap_bucket_number(position).cast("int"))
    byte = F.conv(F.hex(F.substring(bitmap, (offset / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (offset % 8).cast("int")) % 2 == 1


def build(keys: DataFrame, count: int, number: int = 0, hashes: int = HASHES) -> Filter:
    """The filter of column ``key``, with bits for ``count`` keys, however many there are.

    A task holds the bits once per hash. One hash finds the more false positives with few
    keys (8 % at ``count``), but the fewer with many times ``count``.
    """
    buckets = max(1, -(-count * BITS_PER_KEY // BITMAP))
    bits = buckets * BITMAP
    set_bits = keys.select(F.explode(F.array(*_positions(F.col("key"), number, bits, hashes))).alias("bit"))
    # a null bit keeps the place of a bucket that no key falls into
    empty = keys.sparkSession.range(1, buckets + 1).select(
        F.col("id").alias("bucket"), F.lit(None).cast("long").alias("offset")
    )
    placed = set_bits.select(F.bitmap_bucket_number("bit").alias("bucket"), F.bitmap_bit_position("bit").alias("offset"))
    bitmaps = placed.unionByName(empty).groupBy("bucket").agg(F.bitmap_construct_agg("offset").alias("bitmap"))
    ordered = bitmaps.agg(F.array_sort(F.collect_list(F.struct("bucket", "bitmap"))).alias("all"))
    return Filter(number, bits, ordered.select(F.col("all.bitmap").alias("bitmaps")), hashes)


def kept(one: Filter) -> Filter:
    """The filter with its bits in the checkpoint folder: each question reads them there."""
    return replace(one, bitmaps=cut_lineage(one.bitmaps))
