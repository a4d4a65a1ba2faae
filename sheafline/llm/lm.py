"""Language-model scores of documents: a smoothed n-gram model in an Elias-Fano trie.

The model is trained on all learning documents. Counts are gathered by one packed
exchange (``exchange``): a chunk of documents sends its distinct n-grams, each with its
count in the chunk's learning documents, and gets back their counts in the whole corpus.
So the counts follow the documents, no task holds the whole model, and a frequent word
travels once a chunk. A chunk then builds the trie of the n-grams it can ask for and
scores its documents.

Smoothing is Dirichlet's: with c the counts, and h' the context h without its oldest word,

    p(w | h) = (c(hw) + mass * p(w | h')) / (c(h) + mass)

down to p(w) = (c(w) + add) / (N + add * (V + 1)), in which one more unknown word has a
share. An n-gram without a count has p(w | h') times the context's back-off weight,
mass / (c(h) + mass), so the trie stores counted n-grams only. The end of a text is a
token, and also the context of its first word.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sheafline.llm.exchange import CHUNK, Reply, answers, chunked, in_order, requests
from sheafline.llm.trie import Level, Trie
from sheafline.llm.words import hash_strings, mixed, per_text, word_block

ORDER = 2
MASS = 20.0
ADD = 0.1
#: The key of the token at the end of a text. No word has it but by a chance of 2**-64.
END = np.uint64(0x9E3779B97F4A7C15)

SCORES = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


@dataclass(frozen=True)
class Tokens:
    """Tokens of a chunk: numbers into ``keys``, with the end of each text as a word."""

    keys: np.ndarray
    number: np.ndarray
    offsets: np.ndarray

    def history(self, order: int) -> list[np.ndarray]:
        """The tokens and those 1, 2, ... places before; the place before a text is its end token."""
        owner_begin = np.repeat(self.offsets[:-1], np.diff(self.offsets))
        place = np.arange(len(self.number)) - owner_begin
        out = [self.number]
        for back in range(1, order):
            before = np.full(len(self.number), -1)
            inside = place >= back
            before[inside] = self.number[np.flatnonzero(inside) - back]
            # the place before the first word: the end token, the last of every text
            before[place == back - 1] = self.number[-1]
            out.append(before)
        return out


def tokens(texts: pa.ChunkedArray) -> Tokens:
    block = word_block(texts, lower=True)
    keys, order = np.unique(np.concatenate([hash_strings(block.vocabulary), [END]]), return_inverse=True)
    ends = block.offsets[1:] + np.arange(len(block.sizes))
    number = np.full(len(block.number) + len(block.sizes), order[-1])
    words = np.ones(len(number), dtype=bool)
    words[ends] = False
    number[words] = order[:-1][block.number]
    return Tokens(keys, number, block.offsets + np.arange(len(block.offsets)))


@dataclass(frozen=True)
class Grams:
    """The distinct n-grams of one length in a chunk, and which of them each token ends."""

    keys: np.ndarray
    parts: np.ndarray
    index: np.ndarray


def grams(chunk: Tokens, order: int) -> list[Grams]:
    """Per length: n-grams as rows of token numbers, oldest first. -1 in ``index``: too near the beginning."""
    history = chunk.history(order)
    out = []
    for length in range(1, order + 1):
        whole = np.logical_and.reduce([h >= 0 for h in history[:length]])
        code = np.zeros(int(whole.sum()), dtype=np.int64)
        number = code
        rows = [h[whole] for h in reversed(history[:length])]
        # number n-grams exactly, a word at a time
        for words in rows:
            number = np.unique(number * len(chunk.keys) + words, return_inverse=True)[1]
        first = np.unique(number, return_index=True)[1] if len(number) else np.zeros(0, np.int64)
        parts = np.stack([words[first] for words in rows], axis=1) if len(number) else np.zeros((0, length), np.int64)
        keys = chunk.keys[parts[:, 0]]
        for column in range(1, length):
            keys = mixed(keys, chunk.keys[parts[:, column]])
        index = np.full(len(whole), -1)
        index[whole] = number
        out.append(Grams(keys, parts, index))
    return out


def _counts(found: list[Grams], learning: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All n-grams' keys sorted, their counts in learning texts, and their places in the sorted order."""
    counts = [np.bincount(g.index[(g.index >= 0) & learning], minlength=len(g.keys)) for g in found]
    # the lowest bit of a count tells single words from longer n-grams
    marked = [c * 2 + (n == 0) for n, c in enumerate(counts)]
    keys, values = np.concatenate([g.keys for g in found]), np.concatenate(marked)
    order = np.argsort(keys, kind="stable")
    return keys[order], values[order], order


def score_documents(
    documents: DataFrame,
    *,
    held_out: Column,
    id: str = "doc_id",
    text: str = "text",
    order: int = ORDER,
    mass: float = MASS,
    add: float = ADD,
    chunk: int = CHUNK,
) -> DataFrame:
    """Scores of whole texts by the model learned from those not ``held_out``.

    Columns: the id, held_out, n_tokens, n_known (tokens with a count), train_tokens,
    base_score (log10 probability by single tokens, exact) and score (by the model, from
    quantised probabilities). Words are compared with A-Z as a-z. A null or empty text is
    its end token. A null in ``held_out`` counts as false. Repeated rows are separate
    documents. Without learning documents every token is unknown, and both scores are 0.
    """
    plain = documents.select(
        F.col(id).alias("id"), F.col(text).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out")
    )
    chunks, parts = chunked(plain, F.coalesce(F.col("id"), F.xxhash64("text")), chunk)

    def ask(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        own = tokens(rows["text"])
        keys, values, _ = _counts(grams(own, order), _learning(rows, own))
        return keys, values

    replied = answers(requests(chunks, parts, ask), _corpus_counts)
    # training tokens and distinct ones: a subquery over the same exchange
    totals = replied.agg(F.array(F.sum(F.col("totals")[0]), F.sum(F.col("totals")[1])).alias("both")).scalar()
    known = replied.select("chunk", "part", "answer", totals.alias("both"))
    score = _scored(order, mass, add)
    scored = chunks.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(score, SCORES)
    return scored.select(F.col("id").alias(id), *(f.strip().split(" ")[0] for f in SCORES.split(",")[1:]))


def _learning(rows: pa.Table, chunk: Tokens) -> np.ndarray:
    """Which tokens belong to learning documents."""
    held_out = rows["held_out"].to_numpy()
    return np.repeat(~held_out.astype(bool), np.diff(chunk.offsets))


def _corpus_counts(index: np.ndarray, values: np.ndarray, begins: np.ndarray) -> Reply:
    """The corpus's count of each asked n-gram; training tokens and distinct tokens of the part."""
    counts = np.bincount(index, weights=values >> 1).astype(np.int64)
    single = np.zeros(len(counts), dtype=bool)
    single[index] = values & 1
    return counts[index], [int(counts[single].sum()), int((counts[single] > 0).sum())]


def _scored(order: int, mass: float, add: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def scored(rows: pa.Table, replies: pa.Table) -> pa.Table:
        own = tokens(rows["text"])
        found = grams(own, order)
        learned, distinct = (value or 0 for value in replies["both"][0].as_py())
        place = _counts(found, _learning(rows, own))[2]
        counts = np.empty(len(place), dtype=np.int64)
        counts[place] = in_order(replies)
        by_length = np.split(counts, np.cumsum([len(g.keys) for g in found])[:-1])
        base = np.log10((by_length[0] + add) / (learned + add * (distinct + 1)))
        single = found[0].index
        score = np.zeros(len(single))
        if learned:
            model = trie(found, by_length, base, len(own.keys), mass, np.log10(add / (learned + add * (distinct + 1))))
            # every distinct n-gram is scored once
            last = found[-1].index
            score[last >= 0] = model.score([*found[-1].parts.T[::-1]])[last[last >= 0]]
            early = last < 0
            score[early] = model.score([h[early] for h in own.history(order)])
        columns = {
            "id": rows["id"],
            "held_out": rows["held_out"],
            "n_tokens": pa.array(np.diff(own.offsets)),
            "n_known": pa.array(per_text(by_length[0][single] > 0, own.offsets)),
            "train_tokens": pa.array(np.full(rows.num_rows, learned)),
            "base_score": pa.array(np.add.reduceat(base[single], own.offsets[:-1])),
            "score": pa.array(np.add.reduceat(score, own.offsets[:-1])),
        }
        return pa.table(columns)

    return scored


def trie(found: list[Grams], counts: list[np.ndarray], base: np.ndarray, words: int, mass: float, unknown: float) -> Trie:
    """The trie of the counted n-grams of a chunk."""
    levels: list[Level] = []
    # log10 of each n-gram's probability, from the shorter ones
    for length, (own, count) in enumerate(zip(found, counts, strict=True), start=1):
        if length == 1:
            score, context = base, np.zeros(len(count), np.int64)
        else:
            shorter = Trie(levels, unknown)
            context = shorter._context([*own.parts[:, :-1].T[::-1]])
            lower = shorter.score([*own.parts[:, 1:].T[::-1]])
            above = np.where(context >= 0, kept[np.maximum(context, 0)], 0) if len(kept) else np.zeros(len(count))
            score = np.log10((count + mass * 10**lower) / (above + mass))
        backoff = np.log10(mass / (count + mass))
        counted = np.flatnonzero(count > 0)
        counted = counted[np.lexsort((own.parts[counted, -1], context[counted]))]
        contexts = len(kept) if length > 1 else 1
        kept = count[counted]
        levels.append(
            Level(context[counted], own.parts[counted, -1], contexts, words, score[counted], backoff[counted])
        )
    return Trie(levels, unknown)
