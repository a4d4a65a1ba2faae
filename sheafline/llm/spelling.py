"""Spelling variants: words one edit apart, compared in dense tiles of prefixes and suffixes.

Two words differ by one inserted, deleted or replaced code point exactly if their common
prefix and common suffix together are at least as long as the longer word less one. Words
lie in padded matrices of code points, and a tile compares every word of one block with
every word of another, column by column from both ends.

Which blocks meet is decided by where the edit can be: the longer length is cut into
``REGIONS`` ranges, and words meet if all code points outside one range are equal. A pair is
counted in the range in which its common prefix ends, so once only. A group of more than
``BLOCK`` words is cut into blocks, and each pair of blocks is a tile of its own: no task
needs more than two blocks at a time, however many words agree outside a range.

What leaves a tile is a row per word, with its number of near words and the best of them,
never the pairs.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from sheafline.llm.staging import cut_lineage
from sheafline.llm.words import as_array, whole_texts

#: Ranges of a word in which its edit can be.
REGIONS = 4
#: Words in a block.
BLOCK = 512
#: Cells of the tiles compared at once.
CELLS = 1 << 21
#: Distinct words that a task counts before it passes them on.
COUNTED = 400_000

GROUP = ["size", "region", "outside", "block_a", "block_b"]
NEAR = "word string, n_near long, best_n long, best string"


def run_counts(
    documents: DataFrame, *, id: str = "doc_id", text: str = "text", least: int = 7, noise: int | None = None
) -> DataFrame:
    """Columns ``word`` and ``n``: runs of letters of whole texts, A-Z as a-z, of ``least`` code points or more.

    With ``noise``, a run loses one code point wherever ``noise`` divides the checksum (crc32) of
    id, colon and run: a known rate of misspellings. A null text has no runs, a null id is empty.
    """
    runs = re.compile(rf"[a-zÀ-ÿ]{{{least},}}")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for batch in batches:
            texts = pc.ascii_lower(whole_texts(batch.column(1)))
            for key, one in zip(batch.column(0).to_pylist(), texts, strict=True):
                start = zlib.crc32(f"{'' if key is None else key}:".encode())
                own: dict[str, int] = {}
                for found in runs.finditer(one.as_py()):
                    run = found.group()
                    own[run] = own.get(run, 0) + 1
                for run, n in own.items():
                    if noise:
                        checksum = zlib.crc32(run.encode(), start)
                        if checksum % noise == 0:
                            at = checksum % len(run)
                            run = run[:at] + run[at + 1 :]
                            if len(run) < least:
                                continue
                    counts[run] = counts.get(run, 0) + n
                if len(counts) > COUNTED:
                    yield _counts(counts)
                    counts = {}
        yield _counts(counts)

    rows = documents.select(F.col(id).cast("long"), F.col(text).cast("string"))
    return rows.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _counts(counts: dict[str, int]) -> pa.RecordBatch:
    words, numbers = pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())
    return pa.RecordBatch.from_arrays([words, numbers], names=["word", "n"])


def _grouped(words: DataFrame, regions: int, block: int) -> DataFrame:
    """A row for each word and tile that it is in, columns ``GROUP``, ``own`` block, ``word``, ``n``."""
    length = F.length("word")
    places = []
    for longer in (0, 1):
        size = length + longer
        for region in range(regions):
            begin = F.floor(size * region / regions).cast("int")
            after = size - F.floor(size * (region + 1) / regions).cast("int")
            outside = F.xxhash64(F.substring("word", F.lit(1), begin), F.substring("word", length - after + 1, after))
            places.append(
                F.struct(size.alias("size"), F.lit(region).alias("region"), outside.alias("outside"), F.lit(longer).alias("longer"))
            )
    keys = ["size", "region", "outside"]
    placed = words.select("word", "n", F.inline(F.array(*places)))
    # words of the shorter length alone meet in their own groups
    crowds = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("crowd"), F.min("longer").alias("longer"))
    crowds = crowds.filter((F.col("crowd") > 1) & (F.col("longer") == 0))
    blocks = F.ceil(F.col("crowd") / block).cast("int")
    met = placed.drop("longer").join(crowds.select(*keys, blocks.alias("blocks")), keys)
    met = met.withColumn("own", F.pmod(F.xxhash64(F.lit(7), "word"), F.col("blocks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = met.select(
        *keys, F.least("own", "other").alias("block_a"), F.greatest("own", "other").alias("block_b"), "own", "word", "n"
    )
    # by tile, not by group: the tiles of a large group spread over tasks
    return tiles.repartition(*GROUP).sortWithinPartitions(*GROUP)


def _code_points(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, and where each word's begin."""
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    points = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32)
    if not len(points) or points.max() < 0xFFFE:
        points = points.astype(np.uint16)
    return points, np.concatenate([[0], np.cumsum(lengths)])


def _matrices(points: np.ndarray, begins: np.ndarray, chosen: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of chosen words, padded after their end, and from the last to the first."""
    pad = np.iinfo(points.dtype).max
    lengths = begins[chosen + 1] - begins[chosen]
    columns = np.arange(width)
    inside = columns < lengths[:, None]
    last = max(len(points) - 1, 0)
    forth = np.where(inside, points[np.minimum(begins[chosen][:, None] + columns, last)], pad)
    back = np.where(inside, points[np.maximum(begins[chosen + 1][:, None] - 1 - columns, 0)], pad)
    return forth.astype(points.dtype), back.astype(points.dtype)


def common_lengths(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Equal leading columns of every row of ``left`` (tiles, rows, columns) with every row of ``right``."""
    alive = np.ones((left.shape[0], left.shape[1], right.shape[1]), dtype=bool)
    lengths = np.zeros(alive.shape, dtype=np.int32)
    for column in range(left.shape[2]):
        alive &= left[:, :, None, column] == right[:, None, :, column]
        if not alive.any():
            break
        lengths += alive
    return lengths


def _near_pairs(
    table: pa.Table, begins: np.ndarray, size: int, region: int, regions: int, points: np.ndarray, starts: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of near words, left and right, in groups of one size and region that begin at ``begins``."""
    low, high = size * region // regions, size * (region + 1) // regions
    own, first = table["own"].to_numpy(), table["block_a"].to_numpy()
    second = table["block_b"].to_numpy()
    rows = np.arange(begins[0], begins[-1])
    group = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    lists = []
    for side in (first, second):
        mine = own[rows] == side[rows]
        place = np.cumsum(mine) - 1
        counts = np.bincount(group[mine], minlength=len(begins) - 1)
        place = place[mine] - np.concatenate([[0], np.cumsum(counts)])[group[mine]]
        lists.append((rows[mine], group[mine], place, counts))
    alone = first[begins[:-1]] == second[begins[:-1]]
    rank = np.maximum(lists[0][3], lists[1][3])
    height = 1 << np.ceil(np.log2(np.maximum(rank, 2))).astype(np.int64)
    for tall in np.unique(height):
        members = np.flatnonzero(height == tall)
        step = max(1, CELLS // (int(tall) * max(int(tall), size)))
        for begin in range(0, len(members), step):
            tile = members[begin : begin + step]
            number = np.full(len(begins) - 1, -1)
            number[tile] = np.arange(len(tile))
            sides = []
            for chosen, of, place, _ in lists:
                taken = number[of] >= 0
                filled = np.full((len(tile), tall), -1)
                filled[number[of[taken]], place[taken]] = chosen[taken]
                forth, back = _matrices(points, starts, filled.ravel(), size)
                shape = (len(tile), tall, size)
                sides.append((filled, forth.reshape(shape), back.reshape(shape)))
            (rows_a, forth_a, back_a), (rows_b, forth_b, back_b) = sides
            prefix = common_lengths(forth_a, forth_b)
            near = (prefix >= low) & (prefix < high)
            near &= prefix + common_lengths(back_a, back_b) >= size - 1
            lengths = np.diff(starts)
            full_a, full_b = lengths[rows_a] == size, lengths[rows_b] == size
            near &= full_a[:, :, None] | full_b[:, None, :]
            near &= (rows_a >= 0)[:, :, None] & (rows_b >= 0)[:, None, :]
            # in a tile of one block with itself every pair is there twice, and a word meets itself
            near &= ~alone[tile][:, None, None] | np.triu(np.ones((tall, tall), dtype=bool), 1)
            at, x, y = np.nonzero(near)
            yield rows_a[at, x], rows_b[at, y]


def _best(table: pa.Table, left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
    """Per word of a pair: near words, and the one of largest ``n``, of several the first in order."""
    words, n = as_array(table["word"]), table["n"].to_numpy()
    rank = pc.rank(words, sort_keys="ascending", tiebreaker="dense").to_numpy().astype(np.int64)
    word, near = np.concatenate([left, right]), np.concatenate([right, left])
    order = np.lexsort((rank[near], -n[near], word))
    word, near = word[order], near[order]
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]) if len(word) else np.zeros(0, bool))
    counts = np.diff(np.concatenate([first, [len(word)]]))
    return pa.RecordBatch.from_arrays(
        [words.take(pa.array(word[first])), pa.array(counts), pa.array(n[near[first]]), words.take(pa.array(near[first]))],
        names=["word", "n_near", "best_n", "best"],
    )


def _tiled(batches: Iterator[pa.RecordBatch], regions: int) -> Iterator[pa.RecordBatch]:
    """Rows ``NEAR`` of sorted rows of tiles; a tile that the batch cuts waits for the next one."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        table = pa.Table.from_batches([*waiting, batch]).combine_chunks()
        begins = _group_begins(table)
        if len(begins) < 2:
            waiting.append(batch)
            continue
        yield _table_best(table.slice(0, begins[-1]), begins, regions)
        waiting = table.slice(begins[-1]).to_batches()
    if waiting:
        table = pa.Table.from_batches(waiting).combine_chunks()
        yield _table_best(table, np.append(_group_begins(table), table.num_rows), regions)


def _group_begins(table: pa.Table) -> np.ndarray:
    new = np.zeros(table.num_rows, dtype=bool)
    new[:1] = True
    for name in GROUP:
        values = table[name].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _table_best(table: pa.Table, begins: np.ndarray, regions: int) -> pa.RecordBatch:
    points, starts = _code_points(as_array(table["word"]))
    size, region = table["size"].to_numpy()[begins[:-1]], table["region"].to_numpy()[begins[:-1]]
    cuts = np.flatnonzero((size[1:] != size[:-1]) | (region[1:] != region[:-1])) + 1
    edges = [0, *cuts.tolist(), len(size)]
    found = [
        pair
        for a, b in zip(edges[:-1], edges[1:], strict=True)
        for pair in _near_pairs(table, begins[a : b + 1], int(size[a]), int(region[a]), regions, points, starts)
    ]
    none = np.zeros(0, np.int64)
    return _best(table, np.concatenate([none, *(x for x, _ in found)]), np.concatenate([none, *(y for _, y in found)]))


def near_words(words: DataFrame, *, regions: int = REGIONS, block: int = BLOCK) -> DataFrame:
    """Per word with a near word: ``n_near``, and the near word ``best`` with the largest ``n``, ``best_n``.

    ``words`` has distinct words and their counts ``n``. Of several best words the first in
    code-point order is taken.
    """
    rows = _grouped(words, regions, block).mapInArrow(lambda batches: _tiled(batches, regions), NEAR)
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("best")))
    gathered = rows.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("first"))
    return gathered.select("word", "n_near", (-F.col("first.minus")).alias("best_n"), F.col("first.best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the end of its chain of forms; each round doubles the steps taken."""
    roots = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = roots.join(further, "root", "left")
        roots = cut_lineage(moved.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("on")))
        if roots.filter("on").isEmpty():
            return roots.drop("on")
        roots = roots.drop("on")


def variant_groups(words: DataFrame, *, ratio: int = 10, regions: int = REGIONS, block: int = BLOCK) -> DataFrame:
    """Columns word, form, root, n, n_near, form_n, for each row of ``words`` (distinct ``word``, and ``n``).

    ``form`` is the near word of largest count (ties: first in code-point order), if it occurs at
    least ``ratio`` times as often as the word. ``root`` is where the chain of forms ends, the word
    itself if it has no form. A table without words gives no rows; extra columns are left out.
    """
    if ratio < 2:
        raise ValueError("forms lead to a root only if each is more frequent than the last: ratio must be 2 or more")
    words = cut_lineage(words.select("word", F.col("n").cast("long").alias("n")))
    near = near_words(words, regions=regions, block=block)
    often = F.col("best_n") >= F.col("n") * ratio
    found = cut_lineage(
        words.join(near, "word", "left").select(
            "word",
            F.when(often, F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(often, F.col("best_n")).alias("form_n"),
        )
    )
    roots = _roots(found.filter(F.col("form").isNotNull()).select("word", "form"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
