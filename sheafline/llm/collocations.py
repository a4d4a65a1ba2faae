"""Phrase collocations by stripes: each prefix keys a counter of its next words.

A task turns a block of texts into stripes: for each language and prefix an associative
counter of the words that follow it. Stripes of one prefix are merged elementwise. All that is
asked for is then read from the merged stripes: their entries are the extensions of a prefix
and how often each occurs, which is the total of the prefix one word longer; the stripe of
the empty prefix sums to all words; the largest entry is what may subsume a prefix.

Stripes are written for frequent phrases only. Which phrases can be frequent is counted
first, by hashes: sums over a hash are never below the count of a phrase that has it, so a
phrase that is left out is not frequent, and one let in by chance only costs a count. Words
and pairs are counted in one pass, triples of frequent pairs in another, and a longer phrase
is let in if all its triples are. The hashes of what is frequent travel as a bitmap with
bits by their number, of at most ``MOST_BITS`` bits: beyond that it lets more pass.

Stripes are counted in a task's block before they are shuffled. A block's stripe of more than
``SLICE`` words is cut into about equal slices by a hash of the next word, and slices are merged
before the stripes are, so that a frequent prefix makes no large group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import ceil, log2

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from sheafline.llm.staging import cut_lineage
from sheafline.llm.words import as_array, blocks, hash_strings, mixed, raw_bytes, whole_texts

#: Stands for a missing language.
UNKNOWN = "und"
#: Bytes of text that a task counts at once.
BLOCK = 8_000_000
#: Next words in a slice of a block's stripe, about.
SLICE = 64
#: Bits of a bitmap for each frequent phrase, and in all (128 MB).
BITS_PER_PHRASE = 16
MOST_BITS = 1 << 30
#: Words of the longest phrases that are counted by hashes before.
FILTERED = 3

# bytes that end a piece, and bytes that end a word only (fixed values)
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = b"\x20\x09"

STRIPE = "lang string, prefix string, slice int, nexts array<string>, counts array<long>"
STRIPE_NAMES = ["lang", "prefix", "slice", "nexts", "counts"]


@dataclass(frozen=True)
class Pieces:
    """Words of several texts in order: their places in ``vocabulary``, their text, and how
    many words their piece has from each of them on."""

    vocabulary: pa.Array
    number: np.ndarray
    owner: np.ndarray
    left: np.ndarray


def pieces(texts: pa.Array) -> Pieces:
    """Words of texts from ``whole_texts``, A-Z as a-z, and the pieces that they are in."""
    raw, offsets = raw_bytes(as_array(pc.ascii_lower(texts)))
    kind = np.zeros(256, np.uint8)
    kind[list(BLANKS)], kind[list(PIECE_ENDS)] = 1, 2
    kinds = kind[raw]
    inside = kinds == 0
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    filled = np.diff(offsets) > 0
    begins, ends = offsets[:-1][filled], offsets[1:][filled] - 1
    first[begins], last[ends] = inside[begins], inside[ends]
    starts = np.flatnonzero(first)
    letters = np.concatenate([[0], np.cumsum(np.flatnonzero(last) + 1 - starts)]).astype(np.int64)
    buffers = [None, pa.py_buffer(letters), pa.py_buffer(np.ascontiguousarray(raw[inside]))]
    coded = pc.dictionary_encode(pa.Array.from_buffers(pa.large_string(), len(starts), buffers))
    owner = np.searchsorted(offsets, starts, side="right") - 1
    piece = np.searchsorted(np.flatnonzero(kinds == 2), starts)
    closing = np.ones(len(starts), dtype=bool)
    closing[:-1] = (piece[1:] != piece[:-1]) | (owner[1:] != owner[:-1])
    after = np.flatnonzero(closing) + 1
    left = np.repeat(after, np.diff(np.concatenate([[0], after]))) - np.arange(len(starts))
    return Pieces(coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), owner, left)


@dataclass(frozen=True)
class Bitmap:
    """Hashes of frequent phrases, by their leading bits."""

    words: np.ndarray

    def knows(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes >> np.uint64(64 - (len(self.words) * 64).bit_length() + 1)
        return (self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


NOTHING = Bitmap(np.zeros(1024, np.uint64))


def phrase_hashes(languages: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """A hash of each language with the words at each place of its phrase, all given as hashes."""
    state = languages
    for word in words:
        state = mixed(state, word)
    return state


def _flags(found: Pieces, languages: np.ndarray, hashes: np.ndarray, size: int, bitmaps: dict[int, Bitmap]) -> list[np.ndarray]:
    """For phrases of 1 to ``size`` words whether one that can be frequent begins at each word."""
    flags = [np.ones(len(found.number), dtype=bool)]
    for count in range(1, size + 1):
        able = flags[-1] & (found.left >= count)
        if count > 1:
            able[:-1] &= flags[-1][1:]
        if count in bitmaps:
            at = np.flatnonzero(able)
            able[at] = bitmaps[count].knows(phrase_hashes(languages[at], [hashes[at + k] for k in range(count)]))
        flags.append(able)
    return flags[1:]


def _read(languages: pa.Array, texts: pa.Array) -> tuple[Pieces, pa.Array, np.ndarray]:
    """Words of a block, names of its languages, and the language of each word."""
    found = pieces(whole_texts(texts))
    coded = pc.dictionary_encode(languages)
    return found, as_array(coded.dictionary), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[found.owner]


def _by_block(documents: DataFrame, work: Callable[[pa.Array, pa.Array], list[pa.RecordBatch]], schema: str) -> DataFrame:
    def worked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for block in blocks(batch.column(1), BLOCK):
                yield from work(batch.column(0).slice(done, len(block)), block)
                done += len(block)

    return documents.select("lang", "text").mapInArrow(worked, schema)


def frequent_hashes(documents: DataFrame, sizes: list[int], bitmaps: dict[int, Bitmap], least: int) -> Bitmap | None:
    """The bitmap of hashes that phrases of these sizes have ``least`` times or more together."""
    shared = documents.sparkSession.sparkContext.broadcast(bitmaps)

    def hashed(languages: pa.Array, texts: pa.Array) -> list[pa.RecordBatch]:
        found, names, language = _read(languages, texts)
        hashes, tongue = hash_strings(found.vocabulary)[found.number], hash_strings(names)[language]
        flags = _flags(found, tongue, hashes, max(sizes), shared.value)
        own = []
        for size in sizes:
            at = np.flatnonzero(flags[size - 1])
            own.append(phrase_hashes(tongue[at], [hashes[at + k] for k in range(size)]))
        keys, counts = np.unique(np.concatenate(own), return_counts=True)
        return [pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["hash", "n"])]

    counted = _by_block(documents, hashed, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    frequent = cut_lineage(counted.filter(F.col("n") >= least).select("hash"))
    count = frequent.count()
    if not count:
        return None
    bits = min(MOST_BITS, 1 << max(16, ceil(log2(count * BITS_PER_PHRASE))))
    place = F.shiftrightunsigned("hash", 64 - bits.bit_length() + 1)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
    rows = frequent.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return Bitmap(words)


def block_stripes(languages: pa.Array, texts: pa.Array, longest: int, bitmaps: dict[int, Bitmap]) -> list[pa.RecordBatch]:
    """Rows of ``STRIPE`` of a block of texts, for prefixes of no word to one word less than ``longest``.

    A row without a prefix counts all words of its language.
    """
    found, names, language = _read(languages, texts)
    word_hashes = hash_strings(found.vocabulary)
    flags = _flags(found, hash_strings(names)[language], word_hashes[found.number], longest, bitmaps)
    counts = np.bincount(language, minlength=len(names))
    ones = pa.array(np.arange(len(names) + 1, dtype=np.int32))
    totals = pa.RecordBatch.from_arrays(
        [
            names.cast(pa.string()),
            pa.nulls(len(names), pa.string()),
            pa.array(np.zeros(len(names), np.int32)),
            pa.ListArray.from_arrays(ones, pa.nulls(len(names), pa.string())),
            pa.ListArray.from_arrays(ones, pa.array(counts.astype(np.int64))),
        ],
        names=STRIPE_NAMES,
    )
    return [totals, *(_stripes(found, names, language, length, flags[length], word_hashes) for length in range(longest))]


def _stripes(
    found: Pieces, names: pa.Array, language: np.ndarray, length: int, flagged: np.ndarray, word_hashes: np.ndarray
) -> pa.RecordBatch:
    number, size = found.number, max(1, len(found.vocabulary))
    at = np.flatnonzero(flagged)
    prefix = language[at]
    for k in range(length):
        _, prefix = np.unique(prefix * size + number[at + k], return_inverse=True)
    _, example, prefix = np.unique(prefix, return_index=True, return_inverse=True)
    entry, counts = np.unique(prefix * size + number[at + length], return_counts=True)
    prefix, following = entry // size, entry % size
    # one slice, numbered 0, or as many as there are next words for; numbers of 4 slices are 4 to 7
    slices = np.left_shift(1, np.ceil(np.log2(np.maximum(np.bincount(prefix) / SLICE, 1))).astype(np.int64))[prefix] if len(prefix) else prefix
    part = np.where(slices > 1, slices + (word_hashes[following] % np.maximum(slices, 1).astype(np.uint64)).astype(np.int64), 0)
    order = np.lexsort((part, prefix))
    prefix, following, part, counts = prefix[order], following[order], part[order], counts[order]
    new = np.ones(len(prefix), dtype=bool)
    new[1:] = (prefix[1:] != prefix[:-1]) | (part[1:] != part[:-1])
    begins = np.flatnonzero(new)
    bounds = pa.array(np.concatenate([begins, [len(prefix)]]).astype(np.int32))
    shown = at[example][prefix[begins]]
    words = [found.vocabulary.take(pa.array(number[shown + k])) for k in range(length)]
    text = pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string())) if length else pa.array([""] * len(begins), pa.string())
    nexts = found.vocabulary.take(pa.array(following))
    return pa.RecordBatch.from_arrays(
        [
            names.take(pa.array(language[shown])).cast(pa.string()),
            text.cast(pa.string()),
            pa.array(part[begins].astype(np.int32)),
            pa.ListArray.from_arrays(bounds, nexts.cast(pa.string())),
            pa.ListArray.from_arrays(bounds, pa.array(counts.astype(np.int64))),
        ],
        names=STRIPE_NAMES,
    )


def merged_stripes(documents: DataFrame, longest: int, bitmaps: dict[int, Bitmap], least: int) -> DataFrame:
    """Entries of merged stripes, of columns ``lang`` and ``text``: lang, prefix, next and ``n`` of ``least`` or more.

    The entry without a prefix is the number of all words.
    """
    shared = documents.sparkSession.sparkContext.broadcast(bitmaps)
    key = ["lang", "prefix", "slice"]
    stripes = _by_block(documents, lambda languages, texts: block_stripes(languages, texts, longest, shared.value), STRIPE)
    # entries are merged where their slice lies, in the shuffle of slices; then slices of all numbers
    entries = stripes.repartition(*key).select(*key, F.inline(F.arrays_zip("nexts", "counts")))
    entries = entries.withColumnsRenamed({"nexts": "next", "counts": "n"}).groupBy(*key, "next").agg(F.sum("n").alias("n"))
    merged = entries.groupBy("lang", "prefix", "next").agg(F.sum("n").alias("n"))
    return merged.filter(F.col("prefix").isNull() | (F.col("n") >= least))


def collocations(
    documents: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    longest: int = 5,
    least: int = 100,
    percent: int = 100,
    top: int = 2000,
) -> DataFrame:
    """Per language the ``top`` phrases: lang, rank (from 1), phrase, a, l, r, n, score.

    Texts are cut into pieces at ``PIECE_ENDS`` and pieces into words at blanks, A-Z as a-z. ``n``
    counts a language's words, ``a`` all places of a phrase within pieces. Candidates are phrases
    of 2 to ``longest`` words with ``a`` of ``least`` or more. A cut after ``k`` words gives ``l``
    and ``r``, the counts of both parts, and floor(1000 * a * n / (l * r)), exactly; the cut of
    lowest score counts, of several the first. A candidate inside a longer one that occurs at
    least ``percent`` percent as often is dropped. Order: score and ``a`` descending, phrase
    ascending by its bytes. A null text has no words; a null language is ``und``. A language
    without candidates has no row. Rows are not told apart: a repeated row counts twice.
    """
    rows = documents.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).cast("string").alias("text")
    )
    bitmaps: dict[int, Bitmap] = {}
    for sizes in ([1, 2], *([size] for size in range(3, min(FILTERED, longest) + 1))):
        found = frequent_hashes(rows, sizes, bitmaps, least)
        bitmaps |= dict.fromkeys(sizes, found or NOTHING)
    merged = cut_lineage(merged_stripes(rows, longest, bitmaps, least))
    words = merged.filter(F.col("prefix").isNull()).select("lang", "n")
    phrase = F.when(F.col("prefix") == "", F.col("next")).otherwise(F.concat_ws(" ", "prefix", "next"))
    parts = merged.filter(F.col("prefix").isNotNull()).select("lang", "prefix", phrase.alias("phrase"), F.col("n").alias("a"))
    candidates = parts.filter(F.col("prefix") != "")
    listed = F.split("phrase", " ")
    inner = F.explode(F.array(F.col("prefix"), F.array_join(F.slice(listed, F.lit(2), F.size(listed) - 1), " ")))
    subsuming = candidates.select("lang", inner.alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    own = candidates.select("lang", "phrase", "a").join(subsuming, ["lang", "phrase"], "left")
    own = own.filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * percent)).select("lang", "phrase", "a")
    cuts = own.withColumn("words", listed).withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")), " ").alias("rest"),
    )
    left = parts.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    cuts = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(words, "lang")
    # decimals of 38 digits: products of two counts and a thousand stay exact
    exact = {name: F.col(name).cast("decimal(19,0)") for name in ("a", "n", "l", "r")}
    cuts = cuts.withColumns({"above": exact["a"] * exact["n"] * F.lit(1000), "below": exact["l"] * exact["r"]})
    lowest = F.min(F.struct(F.expr("above div below").alias("score"), "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(lowest)
    scored = scored.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
