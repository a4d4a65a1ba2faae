"""Looking up many keys of many documents in one shuffle, packed.

Documents are dealt into chunks of bounded size. A chunk asks for each of its distinct
keys once: keys are sorted and cut by their leading bits into parts, and a part of a
chunk travels as one compressed row. All chunks' rows of a part meet in one group, which
answers each of them in the order of its keys; answers return to their chunk, where the
documents are joined with them. A key that a third of all documents hold is asked for
once a chunk, so no group grows with the number of its copies.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sheafline.llm.words import tidy_group

#: Documents in a chunk.
CHUNK = 2048
#: Keys of a chunk, sorted and distinct, with a number for each.
Asked = tuple[np.ndarray, np.ndarray]
#: Answers in the order of the asked keys, and totals of the part.
Reply = tuple[np.ndarray, list[int]]

REQUEST = "part long, chunk long, keys binary, values binary"
ANSWER = "chunk long, part long, answer binary, totals array<long>"


def squeezed(numbers: np.ndarray) -> bytes:
    """64-bit numbers, compressed by byte planes: sorted and small numbers take few bytes."""
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), 8).T
    return len(numbers).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(planes.tobytes(), asbytes=True)


def unsqueezed(packed: bytes, dtype: type = np.int64) -> np.ndarray:
    count = int.from_bytes(packed[:8], "little")
    raw = pa.Codec("zstd").decompress(packed[8:], count * 8, asbytes=True)
    return np.frombuffer(raw, np.uint8).reshape(8, count).T.copy().view(dtype).ravel()


def chunked(documents: DataFrame, key: Column, size: int = CHUNK) -> tuple[DataFrame, int]:
    """The documents with a column ``chunk``, and how many parts keys are cut into."""
    chunks = max(1, ceil(documents.count() / size))
    # as many parts as chunks: a part then has about as many keys as a chunk
    parts = 1 << ceil(log2(chunks))
    return documents.withColumn("chunk", F.pmod(F.xxhash64(key), F.lit(chunks))), parts


def requests(chunks: DataFrame, parts: int, ask: Callable[[pa.Table], Asked]) -> DataFrame:
    """Rows of ``REQUEST``: what each chunk asks of each part."""
    bits = (parts - 1).bit_length()

    def asked(documents: pa.Table) -> pa.Table:
        keys, values = ask(documents)
        cuts = part_bounds(keys, bits)
        at = [p for p in range(parts) if cuts[p] < cuts[p + 1]]
        chunk = documents["chunk"][0].as_py()
        return pa.table(
            {
                "part": pa.array(at, pa.int64()),
                "chunk": pa.array([chunk] * len(at), pa.int64()),
                "keys": pa.array([squeezed(keys[cuts[p] : cuts[p + 1]]) for p in at], pa.binary()),
                "values": pa.array([squeezed(values[cuts[p] : cuts[p + 1]]) for p in at], pa.binary()),
            }
        )

    return chunks.groupBy("chunk").applyInArrow(tidy_group(asked), REQUEST)


def part_bounds(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each part begins among sorted keys, and the end of the last."""
    parts = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(0, np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, parts), [len(keys)]])


def answers(asked: DataFrame, reply: Callable[[np.ndarray, np.ndarray, np.ndarray], Reply]) -> DataFrame:
    """Rows of ``ANSWER``, a number for each key that was asked.

    ``reply`` gets the place of each asked key among the part's distinct keys, the values
    sent with the keys, and where each chunk's keys begin. It returns the answers, and
    totals of the part, which one of its rows carries.
    """

    def replied(rows: pa.Table) -> pa.Table:
        keys = [unsqueezed(k.as_py(), np.uint64) for k in rows["keys"]]
        values = np.concatenate([unsqueezed(v.as_py()) for v in rows["values"]])
        begins = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
        index = np.unique(np.concatenate(keys), return_inverse=True)[1]
        found, totals = reply(index, values, begins)
        packed = [squeezed(found[a:b]) for a, b in zip(begins[:-1], begins[1:], strict=True)]
        return pa.table(
            {
                "chunk": rows["chunk"],
                "part": rows["part"],
                "answer": pa.array(packed, pa.binary()),
                "totals": pa.array([totals] + [None] * (len(packed) - 1), pa.list_(pa.int64())),
            }
        )

    return asked.groupBy("part").applyInArrow(tidy_group(replied), ANSWER)


def in_order(rows: pa.Table) -> np.ndarray:
    """A chunk's answers, in the order of its sorted keys."""
    order = np.argsort(rows["part"].to_numpy())
    packed = rows["answer"].to_pylist()
    return np.concatenate([np.zeros(0, np.int64), *(unsqueezed(packed[n]) for n in order)])
