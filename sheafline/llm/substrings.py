"""Substring deduplication by relative Lempel-Ziv parsing.

Each document is factored, from left to right, against the text of all documents with
smaller ids. The references are indexed by their windows of ``window`` words, in blocks
by the leading bits of a window's hash; a document looks every window up in the block
that can hold it, and so in every indexed block. Consecutive windows found in the same
reference form one greedy factor. A factor shorter than a window can't be a duplicate
span, so looking up every start, also those where a factor ends and the next begins,
finds all windows that cross the border of two factors as well.

Windows are compared by 64-bit hashes. Lookups are one packed exchange (``exchange``):
every distinct window of a chunk travels once, with the smallest id that has it.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from sheafline.llm.exchange import CHUNK, Reply, answers, chunked, in_order, requests
from sheafline.llm.words import covered, per_text, tidy_groups, whole_texts, window_hashes, without_words, word_block

WINDOW = 13
#: Stands for a missing id: larger than any other.
LAST = np.iinfo(np.int64).max

SPANS = StructType(
    [
        StructField("n_words", LongType()),
        StructField("n_removed", LongType()),
        StructField("kept_text", StringType()),
        StructField(
            "spans",
            ArrayType(
                StructType(
                    [StructField("begin", LongType()), StructField("end", LongType()), StructField("reference", LongType())]
                )
            ),
        ),
    ]
)


def remove_repeated(documents: DataFrame, *, id: str = "doc_id", text: str = "text", window: int = WINDOW, chunk: int = CHUNK) -> DataFrame:
    """The documents' columns, with ``n_words``, ``n_removed``, ``kept_text`` and ``spans``.

    A word is removed if a window of ``window`` words covers it whose sequence also starts in a
    document with a smaller id. ``spans`` are the factors: words ``begin`` to ``end`` (not
    included) were found in the text of ``reference``, the smallest id that has them.
    A null text has no words, and its ``kept_text`` is empty; a document of fewer words than
    a window loses nothing. A null id counts as larger than every other id; rows with equal
    ids are no reference for each other. Columns of the same names are replaced.
    """
    kept_columns = [c for c in documents.columns if c not in SPANS.names]
    names = [f"c{n}" for n in range(len(kept_columns))]
    plain = documents.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(kept_columns, names, strict=True)))
    own_id, own_text = names[kept_columns.index(id)], names[kept_columns.index(text)]
    key = F.coalesce(F.col(own_id), F.xxhash64(own_text))
    chunks, parts = chunked(plain, key, chunk)

    def ask(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        keys, smallest, *_ = _windows(rows, own_id, own_text, window)
        return keys, smallest

    asked = requests(chunks.select(own_id, own_text, "chunk"), parts, ask)
    replied = answers(asked, _smaller_id)
    schema = StructType([*plain.schema.fields, *SPANS.fields])
    result = chunks.groupBy("chunk").cogroup(replied.groupBy("chunk")).applyInArrow(
        tidy_groups(_cut(own_id, own_text, names, window)), schema
    )
    return result.select(*(F.col(n).alias(c) for c, n in zip(kept_columns, names, strict=True)), *SPANS.names)


def _ids(rows: pa.Table, id: str) -> np.ndarray:
    return pc.fill_null(rows[id].cast(pa.int64()), LAST).to_numpy()


def _windows(rows: pa.Table, id: str, text: str, window: int):
    """Distinct windows with the smallest id of each, and all windows of the block."""
    block = word_block(rows[text])
    hashes, starts = window_hashes(block, block.hashes(), window)
    ids = _ids(rows, id)[block.owner()[starts]]
    keys, index = np.unique(hashes, return_inverse=True)
    smallest = np.full(len(keys), LAST)
    np.minimum.at(smallest, index, ids)
    return keys, smallest, index, starts, ids, block


def _smaller_id(index: np.ndarray, values: np.ndarray, begins: np.ndarray) -> Reply:
    """For each asked key the smallest id of all chunks, if it is smaller than the chunk's own; else -1 as none."""
    smallest = np.full(int(index.max()) + 1 if len(index) else 0, LAST)
    np.minimum.at(smallest, index, values)
    found = smallest[index]
    return np.where(found < values, found, NONE), []


#: No smaller id: a number that no id has in practice, and that is skipped before it is used as one.
NONE = np.iinfo(np.int64).min


def _cut(id: str, text: str, names: list[str], window: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def cut(rows: pa.Table, replies: pa.Table) -> pa.Table:
        keys, smallest, index, starts, ids, block = _windows(rows, id, text, window)
        elsewhere = in_order(replies)
        reference = np.where(elsewhere != NONE, elsewhere, smallest)[index]
        found = reference < ids
        starts, reference = starts[found], reference[found]
        removed = covered(starts, window, len(block.number))
        owner = block.owner()[starts]
        # a factor goes on while the next window is found in the same reference
        follows = np.zeros(len(starts), dtype=bool)
        follows[1:] = (starts[1:] == starts[:-1] + 1) & (reference[1:] == reference[:-1]) & (owner[1:] == owner[:-1])
        begins = np.flatnonzero(~follows)
        ends = np.concatenate([begins[1:], [len(starts)]]) - 1 if len(begins) else begins
        first = block.offsets[owner[begins]]
        spans = pa.StructArray.from_arrays(
            [pa.array(starts[begins] - first), pa.array(starts[ends] + window - first), pa.array(reference[begins])],
            names=["begin", "end", "reference"],
        )
        counts = np.bincount(owner[begins], minlength=rows.num_rows)
        texts = whole_texts(rows[text])
        columns = {n: rows[n] for n in names} | {
            "n_words": pa.array(block.sizes),
            "n_removed": pa.array(per_text(removed, block.offsets)),
            "kept_text": without_words(texts, removed).cast(pa.string()),
            "spans": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), spans),
        }
        return pa.table(columns)

    return cut
