"""N-gram Jaccard join: rare-first prefix filtering, verified once per pair.

A document is the set of its distinct word n-grams. Two sets can only reach the threshold
if they share an n-gram of their prefixes: the few first n-grams in one order that all
documents share. Rare n-grams come first in it, so that prefixes meet seldom. Of the
candidates that share a prefix n-gram, the length filter drops pairs whose sizes differ
too much, the positional filter those whose remaining n-grams cannot suffice, and the
suffix filter those whose n-grams fall too differently into fixed ranges of their hashes.
The rest is verified by counting shared n-grams exactly.

Equal sets form one class, of which only the smallest id is compared. A group of near
copies would still give all pairs within it. As components are wanted, stars come first:
each prefix n-gram has a leader, the document of the most frequent n-grams on average;
each document is compared with the first leader of its n-grams, and if that is similar,
it becomes its center. Of two documents with one
center, all that is known of one is its overlap with the center and its rest, the n-grams
that the center lacks. Their overlap is at most the smaller overlap with the center plus
what their rests share. So pairs in a group are compared only if their rests share an
n-gram, or if the overlaps with the center would suffice; and only if links found so far
leave them in different components. No link between components is lost by this.

Frequencies of all n-grams are counted, by hashes whose length follows the size of the table. Tasks
get those of the most frequent ones, as many as ``MOST_HEAVY`` allows; all others come first, in
the order of their hashes. Any order is right; this one keeps n-grams that many documents share
out of prefixes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sheafline.llm.bloom import Filter, build, kept
from sheafline.llm.components import components
from sheafline.llm.staging import Tables, cut_lineage
from sheafline.llm.words import blocks, mixed, per_text, sequence_hashes, tidy, window_hashes, word_block

#: N-grams with a frequency below count as rare; of the others as many go to every task (36 MB).
LEAST_HEAVY, MOST_HEAVY = 8, 4_000_000
#: A center may be less similar than a link by this many percent.
LOOSER = 30
#: Documents with one prefix n-gram from which stars come before all pairs.
CROWD = 12
#: Keys for which filters of n-grams and of documents have bits at most (30 MB); a full one lets more pass.
MOST_FILTERED = 20_000_000
#: Bytes of text whose n-grams a task holds at once. Tasks give memory back before and after (``tidy``).
BLOCK = 8_000_000
#: Ranges of hashes of the suffix filter.
RANGES = 16

PROFILE = "id long, size long, class_a long, class_b long, leading long, prefix array<long>, ranges array<int>"


def _all_grams(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """N-gram hashes of each text in order of texts, repeated ones too, and where each text's begin."""
    block = word_block(texts, lower=True)
    hashes = block.hashes()
    grams, starts = window_hashes(block, hashes, n)
    owner = block.owner()[starts]
    short = np.flatnonzero((block.sizes > 0) & (block.sizes < n))
    if len(short):
        grams = np.concatenate([grams, sequence_hashes(block, hashes)[short]])
        owner = np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        grams, owner = grams[order], owner[order]
    return grams, np.searchsorted(owner, np.arange(len(block.sizes) + 1))


def gram_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text, sorted, and where each text's begin.

    A text with fewer than ``n`` words has its whole sequence as its only n-gram.
    """
    grams, begins = _all_grams(texts, n)
    for begin, end in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True):
        grams[begin:end].sort()
    new = np.ones(len(grams), dtype=bool)
    new[1:] = grams[1:] != grams[:-1]
    new[begins[:-1][begins[:-1] < len(grams)]] = True
    return grams[new], np.concatenate([[0], np.cumsum(new)])[begins]


@dataclass(frozen=True)
class Heavy:
    """Leading bits of hashes of frequent n-grams, sorted, and how frequent they are, as quarters of log2."""

    grams: np.ndarray
    levels: np.ndarray
    shift: np.uint64

    def level(self, grams: np.ndarray) -> np.ndarray:
        """The levels of n-grams, 0 for rare ones."""
        grams = grams >> self.shift
        if not len(self.grams):
            return np.zeros(len(grams), np.int64)
        place = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        return np.where(self.grams[place] == grams, self.levels[place], 0).astype(np.int64)


def heavy_grams(documents: DataFrame, *, text: str, n: int, least: int = LEAST_HEAVY, most: int = MOST_HEAVY) -> Heavy:
    """The most frequent n-grams: all that occur ``least`` times or, if these are too many, those of the highest levels.

    Counted by as many leading bits of their hashes as give several times more numbers than there
    can be n-grams: shorter numbers are cheaper to shuffle, and the few n-grams that share one
    are ordered as if they were one.
    """
    size = documents.agg(F.sum(F.octet_length(text))).first()[0] or 0
    shift = np.uint64(64 - min(64, max(16, (2 * size).bit_length())))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(0), BLOCK):
                grams, counts = np.unique(_all_grams(block, n)[0] >> shift, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(counts)], names=["gram", "count"])

    # a block's n-grams are distinct already: no second count before they are shuffled
    rows = documents.select(text).mapInArrow(tidy(counted), "gram long, count long").repartition("gram")
    rows = rows.groupBy("gram").agg(F.sum("count").alias("count"))
    level = F.round(F.log2("count") * 4).cast("int")
    frequent = cut_lineage(rows.filter(F.col("count") >= least).select("gram", level.alias("level")))
    left, lowest = most, 256
    for row in frequent.groupBy("level").count().orderBy(F.desc("level")).collect():
        left -= row["count"]
        if left < 0:
            break
        lowest = row["level"]
    table = frequent.filter(F.col("level") >= lowest).toArrow()
    grams = table["gram"].to_numpy().view(np.uint64)
    order = np.argsort(grams)
    return Heavy(grams[order], table["level"].to_numpy().astype(np.uint8)[order], shift)


def sized_filter(keys: DataFrame) -> Filter:
    """The filter of a checkpointed column ``key``, with bits for as many keys as there are."""
    return kept(build(keys, max(1, min(MOST_FILTERED, keys.count())), hashes=1))


def prefix_length(size: Column | np.ndarray | int, percent: int) -> Column | np.ndarray | int:
    """N-grams of which one must be shared: all but the smallest overlap needed, and one more."""
    return size - (percent * size + 99) // 100 + 1


def profiles(documents: DataFrame, *, id: str, text: str, n: int, percent: int, heavy: Heavy) -> DataFrame:
    """Rows of ``PROFILE``: size, a hash of the whole set in two halves, prefix, and n-grams by range."""
    shared = documents.sparkSession.sparkContext.broadcast(heavy)

    def profiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for block in blocks(batch.column(1), BLOCK):
                yield _profiles(batch.column(0).slice(done, len(block)), block, n, percent, shared.value)
                done += len(block)

    rows = documents.select(F.col(id).cast("long"), F.col(text).cast("string"))
    return rows.mapInArrow(tidy(profiled), PROFILE)


def _profiles(ids: pa.Array, texts: pa.Array, n: int, percent: int, heavy: Heavy) -> pa.RecordBatch:
    grams, begins = gram_sets(texts, n)
    sizes = np.diff(begins)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    level = heavy.level(grams)
    rank = np.argsort((owner << 8) | level, kind="stable")
    place = np.arange(len(grams)) - begins[owner]
    length = np.where(sizes > 0, prefix_length(sizes, percent), 0)
    first = place < length[owner]
    halves = [per_set(mixed(grams, np.full(len(grams), seed, np.uint64)), begins) for seed in (1, 2)]
    # the smallest number leads: texts of frequent n-grams first, as a copy's edits are rare
    typical = np.bincount(owner, weights=level, minlength=len(sizes)) / np.maximum(sizes, 1)
    leading = ((1 << 14) - (typical * 32).astype(np.int64) << 40) | (halves[0] >> np.uint64(24)).astype(np.int64)
    within = np.bincount(owner * RANGES + (grams >> np.uint64(60)).astype(np.int64), minlength=len(sizes) * RANGES)
    return pa.RecordBatch.from_arrays(
        [
            ids,
            pa.array(sizes),
            *(pa.array(half.view(np.int64)) for half in halves),
            pa.array(leading),
            pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(length)]).astype(np.int32)),
                pa.array(grams[rank][first].view(np.int64)),
            ),
            pa.ListArray.from_arrays(
                pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * RANGES), pa.array(within.astype(np.int32))
            ),
        ],
        names=["id", "size", "class_a", "class_b", "leading", "prefix", "ranges"],
    )


def per_set(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return sums[begins[1:]] - sums[begins[:-1]]


def needed(left: Column, right: Column, percent: int) -> Column:
    """The smallest overlap of two sets of these sizes that links them."""
    return F.ceil((left + right) * F.lit(percent) / F.lit(100 + percent))


def _possible(x: str, y: str, percent: int) -> Column:
    """Length and positional filters of two entries with the same n-gram."""
    size_x, size_y = F.col(f"{x}.size"), F.col(f"{y}.size")
    place_x, place_y = F.col(f"{x}.place"), F.col(f"{y}.place")
    long_enough = F.least(size_x, size_y) * 100 >= F.greatest(size_x, size_y) * percent
    # shared n-grams before this one, this one, and those after it
    most = F.least(place_x, place_y) + 1 + F.least(size_x - place_x - 1, size_y - place_y - 1)
    return long_enough & (most >= needed(size_x, size_y, percent))


def _stars(entries: DataFrame, bucket: list[str], percent: int) -> DataFrame:
    """Each document with the first in order of its buckets' leaders, columns ``a`` and ``b``.

    Only buckets of a crowd with several components have a leader.
    """
    own = F.struct("id", "size", "place", "component")
    leaders = entries.groupBy(*bucket).agg(
        F.min(F.struct("leading", own.alias("entry"))).alias("first"),
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.count(F.lit(1)).alias("crowd"),
    )
    crowded = leaders.filter((F.col("low") < F.col("high")) & (F.col("crowd") >= CROWD))
    met = entries.select(*bucket, own.alias("x")).join(crowded, bucket)
    met = met.withColumn("y", F.col("first.entry"))
    met = met.filter((F.col("x.component") != F.col("y.component")) & _possible("x", "y", percent))
    best = F.min(F.struct("first.leading", F.col("y.id").alias("id")))["id"]
    return met.groupBy(F.col("x.id").alias("a")).agg(best.alias("b"))


def _all_pairs(entries: DataFrame, bucket: list[str], allowed: Column, percent: int) -> DataFrame:
    """Distinct pairs of entries ``x`` and ``y`` of a bucket, of different components, if ``allowed``."""
    several = entries.groupBy(*bucket).agg(F.min("component").alias("low"), F.max("component").alias("high"))
    several = several.filter(F.col("low") < F.col("high")).select(*bucket)
    own = F.struct("id", "size", "place", "component", "center", "both")
    left = entries.join(several, bucket).select(*bucket, own.alias("x"))
    right = left.withColumnRenamed("x", "y")
    kept = left.join(right, bucket).filter(
        (F.col("x.component") < F.col("y.component")) & allowed & _possible("x", "y", percent)
    )
    return kept.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()


COMPARED = "a long, b long, both long, linked boolean, rest array<long>"


def suffix_filtered(pairs: DataFrame, ranges: DataFrame, percent: int) -> DataFrame:
    """The pairs whose n-grams fall alike enough into ranges of hashes to reach ``percent``."""
    for side in ("a", "b"):
        sized = ranges.select(
            F.col("id").alias(side), F.col("size").alias(f"size_{side}"), F.col("ranges").alias(f"ranges_{side}")
        )
        pairs = pairs.join(sized, side)
    common = F.aggregate(
        F.zip_with("ranges_a", "ranges_b", lambda x, y: F.least(x, y)), F.lit(0), lambda total, x: total + x
    )
    return cut_lineage(pairs.filter(common >= needed(F.col("size_a"), F.col("size_b"), percent)).select("a", "b"))


def compared(pairs: DataFrame, documents: DataFrame, *, n: int, percent: int) -> DataFrame:
    """Rows of ``COMPARED`` for pairs of ids; ``documents`` have a row per id.

    ``both`` is the size of the overlap, ``rest`` what ``a`` has and ``b`` lacks.
    """
    ids = cut_lineage(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct())
    # most documents are in no pair: leave them out before their texts are shuffled
    wanted = documents.filter(sized_filter(ids).knows(F.col("id")))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                both, linked, rest = overlaps(part.column("text_a"), part.column("text_b"), n, percent)
                yield pa.RecordBatch.from_arrays(
                    [part.column("a"), part.column("b"), pa.array(both), pa.array(linked), rest],
                    names=["a", "b", "both", "linked", "rest"],
                )

    for side in ("a", "b"):
        texts = wanted.select(F.col("id").alias(side), F.col("text").alias(f"text_{side}"))
        pairs = pairs.join(texts, side)
    return cut_lineage(pairs.select("a", "b", "text_a", "text_b").mapInArrow(tidy(counted), COMPARED))


def overlaps(left: pa.Array, right: pa.Array, n: int, percent: int) -> tuple[np.ndarray, np.ndarray, pa.ListArray]:
    """Per pair of texts: overlap, whether 100 * overlap >= percent * union, and n-grams of the left alone."""
    grams, owners, sizes = [], [], []
    for texts in (left, right):
        own, begins = gram_sets(texts, n)
        grams.append(own)
        sizes.append(np.diff(begins))
        owners.append(np.repeat(np.arange(len(texts)), sizes[-1]))
    gram, owner = np.concatenate(grams), np.concatenate(owners)
    # stable: of two equal n-grams of a pair the left one comes first
    order = np.lexsort((gram, owner))
    gram, owner, of_left = gram[order], owner[order], order < len(grams[0])
    twice = np.zeros(len(gram), dtype=bool)
    twice[:-1] = (gram[1:] == gram[:-1]) & (owner[1:] == owner[:-1])
    both = np.bincount(owner[twice], minlength=len(left))
    alone = of_left & ~twice
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner[alone], minlength=len(left)))]).astype(np.int32)
    rest = pa.ListArray.from_arrays(pa.array(ends), pa.array(gram[alone].view(np.int64)))
    return both, (100 * both >= percent * (sizes[0] + sizes[1] - both)) & (both > 0), rest


def _centers(stars: DataFrame, ranges: DataFrame, similar: int) -> DataFrame:
    """Per document of a star its center: the first in order of itself and its similar leaders.

    With its overlap ``both`` with the center, and the ``rest`` that the center lacks.
    """
    sizes = ranges.select("id", "size", "leading")
    led_by = sizes.select(F.col("id").alias("b"), F.col("size").alias("size_b"), "leading")
    sized = stars.join(led_by, "b").join(sizes.select(F.col("id").alias("a"), "size"), "a")
    near = sized.filter(F.col("both") * 100 >= F.greatest("size", "size_b") * similar)
    led = near.select(F.col("a").alias("id"), "size", F.col("b").alias("center"), "leading", "both", "rest")
    ids = led.select("id").unionByName(led.select(F.col("center").alias("id"))).distinct()
    own = ids.join(sizes, "id").select(
        "id", "size", F.col("id").alias("center"), "leading", F.col("size").alias("both"), F.array().cast("array<bigint>").alias("rest")
    )
    best = F.min(F.struct("leading", "center", "both", "rest", "size"))
    return led.unionByName(own).groupBy("id").agg(best.alias("best")).select(
        "id", "best.size", "best.center", "best.both", "best.rest"
    )


def _with_component(rows: DataFrame, component: DataFrame) -> DataFrame:
    named = rows.join(component.withColumnRenamed("node", "id"), "id", "left")
    return named.withColumn("component", F.coalesce("component", "id"))


def _several_centers(entries: DataFrame) -> DataFrame:
    """Entries of the n-grams that documents of different centers have."""
    several = entries.groupBy("gram").agg(F.min("center").alias("low"), F.max("center").alias("high"))
    return entries.join(several.filter(F.col("low") < F.col("high")).select("gram"), "gram")


def near_duplicates(
    documents: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    n: int = 5,
    percent: int = 80,
    looser: int = LOOSER,
    most_heavy: int = MOST_HEAVY,
) -> DataFrame:
    """Per document: its id, ``n_shingles`` (size of its set) and ``component_id``.

    Documents are linked if 100 * intersection >= ``percent`` * union of their sets of ``n``
    words, with A-Z compared as a-z. ``component_id`` is the smallest id reachable by links.
    A null or empty text has an empty set, is linked with nothing, and is its own component.
    Rows with one id are one document in links. A row with a null id is linked with nothing
    and has a null component, unless its set equals that of a document with an id. The result is
    a table in the checkpoint folder; the larger ones that lead to it are deleted.
    """
    plain = documents.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    with Tables(documents.sparkSession) as tables:
        groups = _groups(plain, tables, n=n, percent=percent, looser=looser, most_heavy=most_heavy)
        named = groups.select(F.col("id").alias(id), F.col("size").alias("n_shingles"), "component_id")
        return Tables(documents.sparkSession).stored(named)


def _groups(plain: DataFrame, tables: Tables, *, n: int, percent: int, looser: int, most_heavy: int) -> DataFrame:
    """Columns ``id``, ``size`` and ``component_id`` of the documents ``id`` and ``text``, from ``tables``."""
    heavy = heavy_grams(plain, text="text", n=n, most=most_heavy)
    profile = tables.stored(profiles(plain, id="id", text="text", n=n, percent=percent, heavy=heavy))
    key = ["class_a", "class_b", "size"]
    filled = profile.filter(F.col("size") > 0)
    classes = filled.groupBy(*key).agg(F.min("id").alias("class"))
    members = cut_lineage(filled.select("id", *key).join(classes, key).select("id", "size", "class"))
    heads = classes.select(F.col("class").alias("id"), *key)
    head = tables.stored(filled.join(heads, ["id", *key]).dropDuplicates(["id"]))
    ranges = head.select("id", "size", "leading", "ranges")
    entries = head.select("id", "size", F.posexplode("prefix").alias("place", "gram"))
    # an n-gram in one prefix only leads to no pair
    common = entries.groupBy("gram").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select("gram")
    common = cut_lineage(common)
    known = sized_filter(common.withColumnRenamed("gram", "key")).knows(F.col("gram"))
    entries = entries.filter(known).join(common, "gram").join(ranges.select("id", "leading"), "id")
    entries = tables.stored(entries)
    similar = max(1, percent - looser)
    limits = {"n": n, "percent": percent}
    alone = entries.withColumn("component", F.col("id"))
    near = suffix_filtered(_stars(alone, ["gram"], similar), ranges, similar)
    # the leader's own leader as well, so that a group shares one center
    hops = near.join(near.select(F.col("a").alias("b"), F.col("b").alias("c")), "b").select("a", F.col("c").alias("b"))
    stars = compared(near.unionByName(hops.filter(F.col("a") != F.col("b"))).distinct(), plain, **limits)
    center = cut_lineage(_centers(stars, ranges, similar))
    links = stars.filter("linked").select("a", "b")
    tried = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    # groups within a group: leaders of the n-grams that the center lacks
    rests = center.select("id", "size", "center", "both", F.explode("rest").alias("gram")).withColumn("place", F.lit(0))
    rests = rests.join(ranges.select("id", "leading"), "id")
    rests = _with_component(rests, components(links))
    inner = suffix_filtered(_stars(rests, ["center", "gram"], percent), ranges, percent)
    inner = compared(inner, plain, **limits)
    links = links.unionByName(inner.filter("linked").select("a", "b"))
    tried = tried.unionByName(inner.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    # all that is left, between components only
    component = components(links)
    rests = _with_component(rests.drop("component"), component)
    centered = entries.join(center.select("id", "center", "both"), "id", "left").withColumns(
        {"center": F.coalesce("center", "id"), "both": F.coalesce("both", "size")}
    )
    centered = tables.stored(_with_component(centered, component))
    shortest = centered.groupBy("center").agg(F.min("size").alias("shortest"))
    enough = centered.join(shortest, "center").filter(F.col("both") >= needed(F.col("size"), F.col("shortest"), percent))
    same_center = F.least("x.both", "y.both") >= needed(F.col("x.size"), F.col("y.size"), percent)
    pairs = (
        _all_pairs(rests, ["center", "gram"], F.lit(True), percent)
        .unionByName(_all_pairs(enough.drop("shortest"), ["center", "gram"], same_center, percent))
        .unionByName(_all_pairs(_several_centers(centered), ["gram"], F.col("x.center") != F.col("y.center"), percent))
        .distinct()
        .join(tried, ["a", "b"], "left_anti")
    )
    last = compared(suffix_filtered(pairs, ranges, percent), plain, **limits)
    component = components(links.unionByName(last.filter("linked").select("a", "b")))
    own = F.coalesce("component", "class", "id")
    reached = members.join(component.withColumnRenamed("node", "class"), "class", "left")
    reached = reached.select("id", "size", own.alias("component_id"))
    empty = profile.filter(F.col("size") == 0).select("id", "size", F.col("id").alias("component_id"))
    return reached.unionByName(empty)
