"""Document fingerprints by MinHash, and classes of near copies from bands of signatures.

A signature holds, for each of ``PERMUTATIONS`` universal hash functions, the smallest value
over the shingles of a text; two signatures agree in about as many places as the shingle sets
are alike (Jaccard). All functions are evaluated in numpy over whole blocks of texts.

For classes of near copies signatures are cut into bands. Texts that agree in a band meet in
Spark: texts of equal sets as one, each with the leader of its band. That is the text whose bands
have the most texts in all: copies resemble their original more than each other, so most are linked
to it and are one class. Of two texts with one leader, overlaps with it and what it lacks bound what
they share, so that only those that can be similar, and are in different classes still, are
compared: a crowd of copies gives few pairs a text. What the leader lacks is gone through from the
rarest n-gram on, so that one that a crowd has alone brings no two of it together. A pair
counts if the exact Jaccard similarity of its shingles, from whole texts, reaches the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from sheafline.llm.bloom import build, kept
from sheafline.llm.components import components
from sheafline.llm.jaccard import needed, overlaps
from sheafline.llm.staging import Tables, cut_lineage
from sheafline.llm.words import MIX, as_array, blocks, mixed, sequence_hashes, tidy, whole_texts, window_hashes, word_block

#: Words of a shingle, and hash functions.
SHINGLE = 5
PERMUTATIONS = 128
#: Places of a band: at a similarity of 0.8, 25 bands of 5 miss a pair once in 20,000 times.
BAND = 5
#: Bytes of text that are hashed at once, so that arrays stay in a core's cache.
CACHED = 1_000_000
#: Keys that the filter of texts to compare has bits for, at most (30 MB).
MOST_KEYS = 20_000_000
#: Rows of class ids that are broadcast at most.
MOST_BROADCAST = 2_000_000
#: Stands for a missing id: the largest.
LAST = np.iinfo(np.int64).max

FINGERPRINT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word shingles of each text, A-Z as a-z, and where each text's begin.

    A text of fewer words has its whole sequence as its only shingle, one without words none.
    """
    block = word_block(texts, lower=True)
    hashes = block.hashes()
    found, starts = window_hashes(block, hashes, size)
    owner = block.owner()[starts]
    short = np.flatnonzero((block.sizes > 0) & (block.sizes < size))
    if len(short):
        found = np.concatenate([found, sequence_hashes(block, hashes)[short]])
        owner = np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        found, owner = found[order], owner[order]
    return found, np.searchsorted(owner, np.arange(len(block.sizes) + 1))


def minima(found: np.ndarray, begins: np.ndarray, permutations: int) -> np.ndarray:
    """Signatures: 32-bit minima of each hash function over each text's shingles.

    The functions are (a x + b) mod 2^64 without its lower half, with odd ``a``: a universal
    family over 32-bit ``x``. A text without shingles has the largest value everywhere.
    """
    out = np.full((len(begins) - 1, permutations), 0xFFFFFFFF, np.uint32)
    filled = np.flatnonzero(np.diff(begins))
    if len(filled):
        x = found >> np.uint64(32)
        places = np.arange(1, permutations + 1, dtype=np.uint64)
        factors, terms = mixed(places, places * MIX) | np.uint64(1), mixed(places * MIX, places)
        starts = begins[filled]
        for k in range(permutations):
            values = (x * factors[k] + terms[k]) >> np.uint64(32)
            out[filled, k] = np.minimum.reduceat(values, starts)
    return out


def signatures(texts: pa.Array, *, size: int = SHINGLE, permutations: int = PERMUTATIONS) -> np.ndarray:
    """Signatures of texts from ``whole_texts``, a row each."""
    parts = [minima(*shingles(block, size), permutations) for block in blocks(texts, CACHED)]
    return np.concatenate([np.zeros((0, permutations), np.uint32), *parts])


def printed(signature: np.ndarray) -> list[str]:
    """Fingerprints: the lower 16 bits of each minimum, as four hexadecimal digits."""
    return [row.tobytes().hex() for row in signature.astype(np.uint16).astype(">u2")]


def likeness(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The share of places in which fingerprints agree, 0 between a text with words and one without."""
    same = (left.astype(np.uint16) == right.astype(np.uint16)).mean(axis=1)
    empty = [(x == 0xFFFFFFFF).all(axis=1) for x in (left, right)]
    return np.where(empty[0] == empty[1], same, 0.0)


def edited_texts(texts: list[str], followers: list[str]) -> list[str]:
    """Texts whose last quarter of code points is replaced by as many first ones of the follower."""
    out = []
    for text, follower in zip(texts, followers, strict=True):
        quarter = len(text) // 4
        out.append(text[: len(text) - quarter] + follower[:quarter])
    return out


def _in_order(documents: DataFrame) -> DataFrame:
    """Rows ``id``, ``text``, ``key``, ``place``, ``foreign``, sorted within the parts of one order.

    Each part ends with a copy of the first row of the next part, marked ``foreign``, the last
    part with the first row of all.
    """
    rows = documents.withColumns({"key": F.coalesce("id", F.lit(LAST)), "place": F.xxhash64("text")})
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = rows.select("key", "place").repartitionByRange(parts, "key", "place")
    lowest = ranges.withColumn("part", F.spark_partition_id()).groupBy("part").agg(F.min(F.struct("key", "place")).alias("low"))
    # a row per part, not per document
    bounds = sorted((r["low"]["key"], r["low"]["place"]) for r in lowest.collect())
    count = max(1, len(bounds))
    keys = np.array([b[0] for b in bounds], np.int64)
    places = np.array([b[1] for b in bounds], np.int64)

    def located(key: pa.Array, place: pa.Array) -> pa.Array:
        own, at = key.to_numpy(zero_copy_only=False), place.to_numpy(zero_copy_only=False)
        low, high = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
        begins, first = low.copy(), np.zeros(len(own), dtype=bool)
        for bound in np.unique(low[low < high]).tolist():
            tied = np.flatnonzero((low == bound) & (high > bound))
            among = places[bound : high[tied[0]]]
            begins[tied] += np.searchsorted(among, at[tied], "right")
            first[tied] = np.isin(at[tied], among)
        return pa.array((begins - 1) * 2 + first, pa.int64())

    place_of: Column = F.arrow_udf(located, "long")("key", "place")
    found = rows.withColumn("at", place_of)
    own = F.struct(F.shiftright("at", 1).cast("int").alias("part"), F.lit(False).alias("foreign"))
    before = F.struct(F.pmod(F.shiftright("at", 1) - 1, F.lit(count)).cast("int").alias("part"), F.lit(True).alias("foreign"))
    copies = F.when(F.col("at") % 2 == 1, F.array(own, before)).otherwise(F.array(own))
    dealt = found.select("id", "text", "key", "place", F.inline(copies))
    return dealt.repartitionById(count, "part").sortWithinPartitions("foreign", "key", "place")


def fingerprints(
    documents: DataFrame, *, id: str = "doc_id", text: str = "text", size: int = SHINGLE, permutations: int = PERMUTATIONS
) -> DataFrame:
    """Rows of ``FINGERPRINT``, one per row of ``documents``.

    The next document is that of the next larger id, after the last one the first. The edited
    text has its last floor(n_chars / 4) code points replaced by the first as many (or all) of
    the next document. ``near_edited`` and ``near_next`` compare the fingerprint with those of the
    edited text and of the next document. A null text is empty; texts without words are alike
    among themselves only. Rows with one id follow each other in the order of a hash of their
    texts; a null id comes last. One row alone is its own next. Other columns are left out.
    """

    def fingerprinted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            table = pa.Table.from_batches([*waiting, batch]).combine_chunks()
            texts, done = whole_texts(table["text"]), 0
            # a block's last row waits for the one after it
            for block in blocks(texts.slice(0, len(texts) - 1), 4 * CACHED):
                count = len(block)
                yield _fingerprinted(table.slice(done, count), whole_texts(texts.slice(done, count + 1)), size, permutations)
                done += count
            waiting = table.slice(table.num_rows - 1).to_batches()

    rows = documents.select(
        F.col(id).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    return _in_order(rows).select("id", "text", "foreign").mapInArrow(fingerprinted, FINGERPRINT)


def _fingerprinted(rows: pa.Table, texts: pa.Array, size: int, permutations: int) -> pa.RecordBatch:
    """Fingerprints of rows that are not foreign; ``texts`` has one text more, after the last row."""
    plain = texts.to_pylist()
    own = np.flatnonzero(~rows["foreign"].to_numpy())
    all_signatures = signatures(texts, size=size, permutations=permutations)
    edited = edited_texts([plain[k] for k in own], [plain[k + 1] for k in own])
    edited_signatures = signatures(pa.array(edited, pa.large_string()), size=size, permutations=permutations)
    return pa.RecordBatch.from_arrays(
        [
            as_array(rows["id"]).take(pa.array(own)),
            pc.utf8_length(texts.take(pa.array(own))).cast(pa.int64()),
            pa.array([sha256(one.encode()).hexdigest() for one in edited], pa.string()),
            pa.array(printed(all_signatures[own]), pa.string()),
            pa.array(printed(edited_signatures), pa.string()),
            pa.array(likeness(all_signatures[own], edited_signatures), pa.float64()),
            pa.array(likeness(all_signatures[own], all_signatures[own + 1]), pa.float64()),
        ],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


BANDED = "id long, mark long, size long, set_a long, set_b long, bands array<long>"


def _banded(documents: DataFrame, size: int, permutations: int, band: int) -> DataFrame:
    """Rows of ``BANDED``: shingles of a text, a hash of their set in two halves, and hashes of its bands."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for block in blocks(batch.column(2), CACHED):
                ids, marks = (batch.column(k).slice(done, len(block)) for k in (0, 1))
                done += len(block)
                found, begins = _distinct(*shingles(whole_texts(block), size))
                signature = minima(found, begins, permutations).astype(np.uint64)
                count = permutations // band
                bands = np.empty((len(block), count), np.uint64)
                for k in range(count):
                    state = np.full(len(block), k, np.uint64)
                    for column in range(k * band, (k + 1) * band):
                        state = mixed(state, signature[:, column])
                    bands[:, k] = state
                sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(v, dtype=np.uint64)]) for v in (found, mixed(found, found))]
                halves = [s[begins[1:]] - s[begins[:-1]] for s in sums]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        marks,
                        pa.array(np.diff(begins)),
                        *(pa.array(half.view(np.int64)) for half in halves),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(len(block) + 1, dtype=np.int32) * count), pa.array(bands.ravel().view(np.int64))
                        ),
                    ],
                    names=["id", "mark", "size", "set_a", "set_b", "bands"],
                )

    return documents.select("id", "mark", "text").mapInArrow(tidy(hashed), BANDED)


def _distinct(found: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingles, sorted."""
    owner = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    order = np.lexsort((found, owner))
    found = found[order]
    new = np.ones(len(found), dtype=bool)
    new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    return found[new], np.concatenate([[0], np.cumsum(np.bincount(owner[new], minlength=len(begins) - 1))])


#: Sets with their overlap with a leader, and the ``rest`` of their n-grams, which it lacks.
STAR = "a long, b long, size long, both long, linked boolean, rest array<long>"


def _compared(pairs: DataFrame, named: DataFrame, rows: DataFrame, size: int, percent: int) -> DataFrame:
    """Rows of ``STAR`` for pairs of sets ``a`` and ``b``; ``named`` has the mark of a text of each set."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                both, linked, rest = overlaps(part.column("text_a"), part.column("text_b"), size, percent)
                sizes = both + np.diff(rest.offsets.to_numpy())
                yield pa.RecordBatch.from_arrays(
                    [part.column("a"), part.column("b"), pa.array(sizes), pa.array(both), pa.array(linked), rest],
                    names=["a", "b", "size", "both", "linked", "rest"],
                )

    ids = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    marks = cut_lineage(named.join(ids, "node"))
    # most texts are in no pair: leave them out before texts are shuffled; a full filter lets more pass
    wanted = kept(build(marks.select(F.col("mark").alias("key")), max(1, min(MOST_KEYS, marks.count())), hashes=1))
    whole = rows.filter(wanted.knows(F.col("mark"))).select("mark", "text").dropDuplicates(["mark"])
    whole = whole.join(marks, "mark").select("node", "text")
    for side in ("a", "b"):
        pairs = pairs.join(whole.select(F.col("node").alias(side), F.col("text").alias(f"text_{side}")), side)
    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(tidy(compared), STAR)


def _stars(entries: DataFrame) -> DataFrame:
    """Distinct pairs of a set ``a`` and the leader ``b`` of one of its bands, from rows ``a`` and ``key``.

    A band's leader is its set whose bands have the most sets, counted once for each band.
    """
    ends = entries.groupBy("key").agg(F.min("a").alias("least"), F.max("a").alias("most"))
    crowds = cut_lineage(ends.filter(F.col("least") < F.col("most")).select("key"))
    known = kept(build(crowds, max(1, min(MOST_KEYS, crowds.count())), hashes=1)).knows(F.col("key"))
    crowd = cut_lineage(entries.filter(known).join(crowds, "key").distinct())
    counts = crowd.groupBy("key").agg(F.count(F.lit(1)).alias("sets"))
    met = crowd.join(counts, "key").groupBy("a").agg(F.sum("sets").alias("met"))
    leaders = crowd.join(met, "a").groupBy("key").agg(F.max_by("a", F.struct("met", "a")).alias("b"))
    return crowd.join(leaders, "key").filter(F.col("a") != F.col("b")).select("a", "b").distinct()


def _apart(rows: DataFrame, key: list[str], component: DataFrame) -> DataFrame:
    """Rows of sets ``a`` with their ``component``, of those keys that several components have, and rows of a key."""
    own = rows.join(component.withColumnRenamed("node", "a"), "a", "left").withColumn("component", F.coalesce("component", "a"))
    spread = own.groupBy(*key).agg(F.min("component").alias("least"), F.max("component").alias("most"), F.count(F.lit(1)).alias("holders"))
    return own.join(spread.filter(F.col("least") < F.col("most")).select(*key, "holders"), key)


def _rests(stars: DataFrame, component: DataFrame, percent: int) -> DataFrame:
    """Rows ``a``, ``b``, ``size``, ``both``, ``gram``, ``left``: n-grams that a leader lacks and several components have.

    Only these add to what two sets of different components share with their leader. In the order
    of a leader's n-grams from the rarest on, ``left`` are from this one to the last. Of two sets
    the first that both have bounds what they share by the smaller ``left``; it is not among
    those of a set that are left out here, as too few are left for any set.
    """
    rests = _apart(stars.select("a", "b", "size", "both", "rest"), ["b"], component).drop("component", "holders")
    rests = _apart(rests.withColumn("gram", F.explode("rest")).drop("rest"), ["b", "gram"], component)
    common_first = Window.partitionBy("a", "b").orderBy(F.desc("holders"), "gram")
    rests = rests.withColumn("left", F.row_number().over(common_first)).drop("component", "holders")
    return rests.filter((F.col("both") + F.col("left")) * 100 >= F.col("size") * percent)


def _met(left: DataFrame, right: DataFrame, key: list[str], percent: int, both: Column) -> DataFrame:
    """Distinct pairs of rows ``x`` and ``y`` of a key, of different components, whose sets share ``both`` at most."""
    x, y = left.select(*key, F.struct("*").alias("x")), right.select(*key, F.struct("*").alias("y"))
    able = both >= needed(F.col("x.size"), F.col("y.size"), percent)
    met = x.join(y, key).filter(able & (F.col("x.component") != F.col("y.component")))
    return met.select(F.least("x.a", "y.a").alias("a"), F.greatest("x.a", "y.a").alias("b")).distinct()


def near_copies(
    documents: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    percent: int = 80,
    permutations: int = PERMUTATIONS,
    band: int = BAND,
) -> DataFrame:
    """Per distinct id: its id and ``class_id``, the smallest id that its links lead to.

    Texts with equal shingle sets are one class. Other texts that agree in a band are linked if
    their shingle sets are similar enough, by exact count: each is compared with the leaders of its
    bands, and then with those others of them, in different classes still, that can be similar
    after what both share with that leader. A null text or one without words is alone; a row
    without an id takes no part. Rows with one id are one document in links. The result is a
    table in the checkpoint folder; larger ones that lead to it are deleted.
    """
    rows = documents.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    rows = rows.filter(F.col("id").isNotNull()).withColumn("mark", F.xxhash64("text"))
    with Tables(documents.sparkSession) as tables:
        classes = _classes(rows, tables, size=size, percent=percent, permutations=permutations, band=band)
        return Tables(documents.sparkSession).stored(classes.withColumnRenamed("id", id))


def _classes(rows: DataFrame, tables: Tables, *, size: int, percent: int, permutations: int, band: int) -> DataFrame:
    """Columns ``id`` and ``class_id`` of rows ``id``, ``text`` and ``mark``, a hash of the text."""
    banded = tables.stored(_banded(rows, size, permutations, band).withColumn("node", F.xxhash64("size", "set_a", "set_b")))
    filled = banded.filter(F.col("size") > 0)
    named = filled.groupBy("node").agg(F.min("mark").alias("mark"))
    # a band's hash depends on its place, so bands of one place meet; equal sets share all bands and make no crowd
    entries = filled.select(F.col("node").alias("a"), F.explode("bands").alias("key"))
    met = cut_lineage(_stars(entries))
    stars = tables.stored(_compared(met, named, rows, size, percent))
    # an id with several texts links them
    several = filled.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("last")).filter(F.col("a") < F.col("last"))
    links = filled.join(several.select("id", "a"), "id").select("a", F.col("node").alias("b"))
    links = cut_lineage(links.unionByName(stars.filter("linked").select("a", "b")).distinct())
    component = components(links)
    # of sets whose rests share an n-gram, the one nearest to the leader is compared with the others before all are
    key = ["b", "gram"]
    rests = tables.stored(_rests(stars, component, percent))
    most = F.least("x.both", "y.both") + F.least("x.left", "y.left")
    crowd = _apart(rests, key, component)
    first = crowd.groupBy(*key).agg(F.max_by(F.struct("a", "size", "both", "left", "component"), F.struct("both", "a")).alias("first"))
    inner = cut_lineage(_met(first.select(*key, "first.*"), crowd, key, percent, most))
    links = links.unionByName(cut_lineage(_compared(inner, named, rows, size, percent).filter("linked").select("a", "b")))
    component = components(links)
    # all others whose rests share an n-gram, and those that share enough without
    covered = stars.filter(F.col("both") * 100 >= F.col("size") * percent).select("a", "b", "size", "both")
    pairs = [
        _met(one, one, on, percent, upto)
        for one, on, upto in (
            (_apart(rests, key, component), key, most),
            (_apart(covered, ["b"], component), ["b"], F.least("x.both", "y.both")),
        )
    ]
    left = cut_lineage(pairs[0].unionByName(pairs[1]).distinct().join(inner, ["a", "b"], "left_anti"))
    links = links.unionByName(cut_lineage(_compared(left, named, rows, size, percent).filter("linked").select("a", "b")))
    component = components(links)
    members = banded.select("id", F.when(F.col("size") > 0, F.col("node")).alias("node"))
    members = cut_lineage(members.join(component, "node", "left").select("id", F.coalesce("component", "node").alias("component")))
    classes = members.groupBy("component").agg(F.min("id").alias("class_id"))
    # a class of one id needs no join, and a null component has none
    joined = members.join(classes, "component", "left").withColumn("class_id", F.coalesce("class_id", "id"))
    return joined.groupBy("id").agg(F.min("class_id").alias("class_id"))


def with_classes(found: DataFrame, classes: DataFrame, *, id: str = "doc_id") -> DataFrame:
    """``found`` with a column ``class_id`` from ``classes``, as ``near_copies`` gives them.

    Only ids in a class of another id are joined. They are broadcast if there are no more than
    ``MOST_BROADCAST`` (a checked size of 32 MB), and shuffled beyond that.
    """
    others = cut_lineage(classes.filter(F.col(id) != F.col("class_id")))
    small = others.count() <= MOST_BROADCAST
    joined = found.join(F.broadcast(others) if small else others, id, "left")
    return joined.withColumn("class_id", F.coalesce("class_id", id))
