"""Language identification by nearest centroid.

A text becomes a TF-IDF vector of hashed letter n-grams of one to three bytes. Each language has
several centroids, found by spherical k-means on a bounded sample of labelled rows; the
nearest centroid by cosine names the language. A text farther from every centroid than
any learning text of its length class (plus a margin) is rejected. Very short texts are
never far. A long text is the mean of its pieces of bounded size: as one vector it would
fill all hashed cells, and drift from every centroid as it grows.

Only the sample of vectors and the centroids pass through the driver; their sizes are
parameters. Predicting is a projection of each row alone: nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, FloatType, StringType, StructField, StructType

from sheafline.llm.staging import cut_lineage
from sheafline.llm.words import GOLDEN, blocks, raw_bytes, whole_texts

#: The answer for a text without a letter.
UNDETERMINED = "und"
#: Vectors per language in the sample, and in the whole sample, that the driver fits on; with
#: many languages each gives fewer, but about this many at least.
PER_LANGUAGE = 250
SAMPLE = 2500
SOME = 20
#: Hashed dimensions, lengths of n-grams in bytes, centroids per language.
DIMENSIONS = 2048
LENGTHS = (1, 2, 3)
CENTROIDS = 4
#: Added to the largest distance seen in a length class.
MARGIN = 0.1
#: A text with fewer n-grams says too little to be far from a language.
EVIDENCE = 256
#: Bytes of a piece at most, and pieces counted at once.
PIECE = 4096
PIECES_AT_ONCE = 512
#: Learning texts from which a length class sets a limit that longer classes inherit.
FILLED = 10

# A-Z as a-z, other ASCII that is no letter as a space, all other bytes unchanged.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[:128] = 0x20
FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)


@dataclass(frozen=True)
class Model:
    """Centroids in rows, the language of each, and the distance allowed per length class."""

    languages: list[str]
    centroids: np.ndarray
    owner: np.ndarray
    idf: np.ndarray
    allowed: np.ndarray


def frequencies(raw: np.ndarray, offsets: np.ndarray, dimensions: int, lengths: tuple[int, ...]) -> np.ndarray:
    """Counts of hashed n-grams, a row per text or piece. Runs of spaces count as one space."""
    # a space before each text keeps n-grams from spanning two of them
    rows = len(offsets) - 1
    sizes = np.diff(offsets)
    folded = np.insert(FOLD[raw], offsets[:-1], 0x20)
    owner = np.repeat(np.arange(rows), sizes + 1)
    keep = np.ones(len(folded), dtype=bool)
    keep[1:] = (folded[1:] != 0x20) | (folded[:-1] != 0x20) | (owner[1:] != owner[:-1])
    folded, owner = folded[keep].astype(np.uint64), owner[keep]
    counts = np.zeros(rows * dimensions, dtype=np.float64)
    for length in lengths:
        count = max(0, len(folded) - length + 1)
        code = np.full(count, length, dtype=np.uint64)
        for step in range(length):
            code = (code << np.uint64(8)) | folded[step : step + count]
        cell = ((code * GOLDEN) >> np.uint64(40)).astype(np.int64) % dimensions
        inside = (owner[:count] == owner[length - 1 : length - 1 + count]) & (code != ((length << 8) | 0x20))
        counts += np.bincount((owner[:count] * dimensions + cell)[inside], minlength=len(counts))
    return counts.reshape(rows, dimensions)


def features(texts: pa.Array, dimensions: int, lengths: tuple[int, ...]) -> np.ndarray:
    """A row per text: the mean over its equal pieces of log(1 + counts), then its number of n-grams."""
    raw, offsets = raw_bytes(whole_texts(texts))
    sizes = np.diff(offsets)
    pieces = np.maximum(1, -(-sizes // PIECE))
    owner = np.repeat(np.arange(len(texts)), pieces)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    bounds = np.append(offsets[owner] + place * sizes[owner] // pieces[owner], len(raw))
    out = np.zeros((len(texts), dimensions + 1))
    for begin in range(0, len(owner), PIECES_AT_ONCE):
        own = owner[begin : begin + PIECES_AT_ONCE]
        edges = bounds[begin : begin + len(own) + 1]
        counts = frequencies(raw[edges[0] : edges[-1]], edges - edges[0], dimensions, lengths)
        # pieces of a text stand side by side
        first = np.flatnonzero(np.diff(own, prepend=-1))
        out[own[first], :-1] += np.add.reduceat(np.log1p(counts), first)
        out[own[first], -1] += np.add.reduceat(counts.sum(axis=1), first)
    out[:, :-1] /= pieces[:, None]
    return out


def length_class(totals: np.ndarray) -> np.ndarray:
    return np.log2(totals + 1).astype(np.int64)


def weighted(logs: np.ndarray, idf: np.ndarray) -> np.ndarray:
    vectors = logs * idf
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


def learning_sample(rows: DataFrame, *, text: str, lang: str, key: Column, per_language: int, sample: int) -> DataFrame:
    """Labelled rows with a letter, about an equal number of each language and ``sample`` in all.

    A language gives about ``per_language`` rows, or fewer where there are many languages, but
    some of every language in any case; equal rows once. The rows with the smallest hashes of
    ``key`` and text within their language: the same rows in every run.
    """
    labelled = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(key, text).alias("order"))
    labelled = labelled.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    # a row per language, as the model has them
    sizes = cut_lineage(
        labelled.groupBy("lang").agg(F.approx_count_distinct("order", 0.02).alias("size"), F.min("order").alias("first"))
    )
    quota = min(per_language, max(SOME, sample // max(1, sizes.count())))
    # the hash is uniform over 64 bits, so a share of its range is a share of the rows
    place = F.col("order") / F.lit(2.0**64) + 0.5
    # all rows of a language that has no more than its quota, whatever the error of its size
    share = F.when(F.col("size") > 1.1 * quota, F.lit(float(quota)) / F.col("size")).otherwise(1.0)
    chosen = labelled.join(F.broadcast(sizes), "lang").filter((place < share) | (F.col("order") == F.col("first")))
    return chosen.dropDuplicates(["lang", "order"]).select("lang", "text", "order").orderBy("order", "lang", "text")


def fit(
    rows: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    per_language: int = PER_LANGUAGE,
    sample: int = SAMPLE,
    dimensions: int = DIMENSIONS,
    lengths: tuple[int, ...] = LENGTHS,
    centroids: int = CENTROIDS,
    margin: float = MARGIN,
) -> Model:
    """The model of labelled ``rows``. Rows without a label, text or letter teach nothing.

    Without any labelled row the model knows no language, and every text is undetermined.
    """

    @F.arrow_udf(ArrayType(FloatType()))
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            flat = [features(block, dimensions, lengths).ravel() for block in blocks(texts)]
            values = pa.array(np.concatenate([np.zeros(0), *flat]).astype(np.float32))
            ends = np.arange(len(texts) + 1, dtype=np.int32) * (dimensions + 1)
            yield pa.ListArray.from_arrays(pa.array(ends), values)

    chosen = learning_sample(
        rows, text=text, lang=lang, key=F.col(key), per_language=per_language, sample=sample
    )
    table = chosen.select("lang", vectors("text").alias("features")).toArrow()
    names = np.array(table["lang"].to_pylist(), dtype=object)
    found = np.array(table["features"].combine_chunks().flatten(), dtype=np.float32).reshape(len(names), dimensions + 1)
    return fit_vectors(names, found[:, :-1], found[:, -1], centroids, margin)


def fit_vectors(names: np.ndarray, logs: np.ndarray, totals: np.ndarray, centroids: int, margin: float) -> Model:
    idf = np.log((1 + len(names)) / (1 + (logs > 0).sum(axis=0))) + 1
    vectors = weighted(logs, idf)
    languages = sorted(set(names))
    rows, owner = [np.zeros((0, logs.shape[1]))], []
    for number, language in enumerate(languages):
        found = spherical_means(vectors[names == language], centroids)
        rows.append(found)
        owner += [number] * len(found)
    centers = np.concatenate(rows)
    allowed = np.full(64, 1.0)
    if len(names):
        distance, kinds = 1 - (vectors @ centers.T).max(axis=1), length_class(totals)
        # a longer text is never farther than a shorter one may be: classes inherit from longer ones
        largest, filled = np.zeros(64), np.bincount(kinds, minlength=64)
        np.maximum.at(largest, kinds, distance)
        largest = np.maximum.accumulate(largest[::-1])[::-1]
        # a class with few learning texts, or none, allows what the next shorter filled class does
        enough = filled >= min(FILLED, filled.max())
        nearest = np.maximum.accumulate(np.where(enough, np.arange(64), 0))
        largest = np.maximum(largest, np.where(enough[nearest], largest[nearest], 0.0))
        allowed = largest + margin
        allowed[: int(np.log2(EVIDENCE))] = 1.0
    return Model(languages, centers, np.array(owner, dtype=np.int64), idf, allowed)


def spherical_means(vectors: np.ndarray, count: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids of unit vectors; starts from vectors far from those taken before."""
    centers = vectors[:1]
    while len(centers) < min(count, len(vectors)):
        near = (vectors @ centers.T).max(axis=1)
        centers = np.vstack([centers, vectors[int(near.argmin())]])
    for _ in range(rounds):
        nearest = (vectors @ centers.T).argmax(axis=1)
        sums = np.stack([vectors[nearest == n].sum(axis=0) for n in range(len(centers))])
        norms = np.linalg.norm(sums, axis=1)
        centers = sums[norms > 0] / norms[norms > 0, None]
    return centers


PREDICTION = StructType(
    [
        StructField("lang_pred", StringType()),
        StructField("score", DoubleType()),
        StructField("rejected", BooleanType()),
    ]
)


def predict(text: Column | str, model: Model, *, lengths: tuple[int, ...] = LENGTHS) -> Column:
    """The language of each whole text, its cosine, and whether the text is too far from all.

    A null text and one without a letter are ``und`` with score 0, and rejected. The answer
    depends on the text alone; equal cosines go to the language first in order of name.
    """
    dimensions = len(model.idf)

    @F.arrow_udf(PREDICTION)
    def nearest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        centers = model.centroids.T.copy()
        for texts in batches:
            parts = []
            for block in blocks(texts, 2_000_000):
                for begin in range(0, len(block), 512):
                    parts.append(_nearest(block.slice(begin, 512), model, centers, dimensions, lengths))
            yield pa.concat_arrays(parts) if parts else pa.array([], _ARROW)

    text = F.col(text) if isinstance(text, str) else text
    undetermined = F.struct(
        F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected")
    )
    if not model.languages:
        return undetermined
    has_letter = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    return F.when(has_letter, nearest(text)).otherwise(undetermined)


_ARROW = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])


def _nearest(texts: pa.Array, model: Model, centers: np.ndarray, dimensions: int, lengths: tuple[int, ...]) -> pa.Array:
    found = features(texts, dimensions, lengths)
    cosines = weighted(found[:, :-1], model.idf) @ centers
    best = cosines.argmax(axis=1)
    score = np.clip(cosines[np.arange(len(best)), best], 0.0, 1.0)
    names = pa.array(model.languages, pa.string()).take(pa.array(model.owner[best]))
    rejected = 1 - score > model.allowed[length_class(found[:, -1])]
    return pa.StructArray.from_arrays([names, pa.array(score), pa.array(rejected)], fields=list(_ARROW))
