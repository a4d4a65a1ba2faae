"""Mixing sources to target weights by hierarchical budgets.

Sources stand in a tree, for example domain, language, source. A budget of tokens enters
at the root and is shared among the children of each node by weight. A child cannot take
more than its subtree can give (its tokens times the epochs allowed); what it leaves goes
to its siblings by their weights, and only what no sibling can take is short for the
parent, which was given no more than its own subtree can give. So shortages are made good
among siblings before ancestors. Each leaf then takes the longest prefix of its documents
within its budget, in a seeded order of its own for every epoch.

Leaves and nodes are small tables from one aggregate. A prefix of a leaf, which may hold a
third of all documents, is found in two steps: sums over ranges of the order, then rows of
the one range that the budget ends in. Documents are not shuffled: whether one is taken
follows from its own place in the order and its leaf's cut.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sheafline.llm.staging import cut_lineage

#: Documents in a range of the order.
RANGE = 4096
#: Leaves up to which their cuts are sent to every task; beyond it documents are joined with them.
MOST_LEAVES = 50_000


def leaf_budgets(
    leaves: DataFrame, levels: Sequence[str], *, budget: Column | float, weights: Mapping[tuple[str | None, ...], float], epochs: int
) -> DataFrame:
    """Columns of ``levels``, ``tokens``, ``docs`` and ``budget``: the tokens that each leaf gives.

    ``leaves`` has a row per leaf with its ``tokens``. ``weights`` gives the weight of a node by
    its path, for example ``("web", "en")``; a node without one weighs 1.
    """
    frame = leaves.withColumn("capacity", F.col("tokens").cast("double") * epochs)
    total = budget if isinstance(budget, Column) else F.lit(float(budget))
    nodes = frame.agg(F.sum("capacity").alias("capacity")).select(F.least(total, F.col("capacity")).alias("budget"))
    for depth in range(1, len(levels) + 1):
        path, parent = list(levels[:depth]), list(levels[: depth - 1])
        children = frame.groupBy(*path).agg(F.sum("capacity").alias("capacity")).withColumn("weight", _weight(path, weights))
        if parent:
            same = [F.col(f"c.{c}").eqNullSafe(F.col(f"p.{c}")) for c in parent]
            joined = children.alias("c").join(nodes.alias("p"), same).select("c.*", F.col("p.budget").alias("given"))
        else:
            joined = children.withColumn("given", nodes.scalar())
        nodes = _shared(joined, parent).select(*path, "budget")
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"n.{c}")) for c in levels]
    return leaves.alias("l").join(nodes.alias("n"), same).select("l.*", F.col("n.budget").alias("budget"))


def _weight(path: list[str], weights: Mapping[tuple[str | None, ...], float]) -> Column:
    out = F.lit(1.0)
    for names, weight in weights.items():
        if weight < 0:
            raise ValueError("a weight below 0")
        if len(names) == len(path):
            fits = [F.col(c).eqNullSafe(F.lit(n)) for c, n in zip(path, names, strict=True)]
            out = F.when(F.forall(F.array(*fits), lambda x: x), F.lit(float(weight))).otherwise(out)
    return out


def _shared(children: DataFrame, parent: list[str]) -> DataFrame:
    """``given`` shared among the children of a parent: min(capacity, level * weight) each.

    Children that fill first come first. Up to the first that does not fill, capacities are
    taken whole; the rest is shared by weight. A child without weight takes nothing.
    """
    fill = F.when(F.col("weight") > 0, F.try_divide("capacity", "weight"))
    order = [F.col("fill").asc_nulls_last(), F.xxhash64("capacity", "weight")]
    before = Window.partitionBy(*parent).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*parent).orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    seen = children.withColumn("fill", fill).withColumns(
        {
            "taken": F.coalesce(F.sum(F.when(F.col("weight") > 0, F.col("capacity"))).over(before), F.lit(0.0)),
            "open": F.sum("weight").over(after),
        }
    )
    # how high every open child could be filled if all before it are full
    level = F.greatest(F.try_divide(F.col("given") - F.col("taken"), F.col("open")), F.lit(0.0))
    leveled = seen.withColumn("level", F.when(F.col("open") > 0, level).otherwise(0.0))
    # the first child that the level does not fill fixes it for all after it
    fixed = F.first(F.when(F.col("fill") > F.col("level"), F.col("level")), ignorenulls=True)
    at_end = fixed.over(before.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    share = F.when(at_end.isNull(), F.col("capacity")).otherwise(at_end * F.col("weight"))
    return leveled.withColumn("budget", F.when(F.col("weight") > 0, F.least(share, F.col("capacity"))).otherwise(0.0))


def mix(
    documents: DataFrame,
    *,
    levels: Mapping[str, Column],
    tokens: Column,
    share: float,
    weights: Mapping[tuple[str | None, ...], float] | None = None,
    epochs: int = 1,
    seed: int = 0,
    id: str = "doc_id",
) -> DataFrame:
    """The documents taken, with all their columns and ``mix_epoch`` (from 0), a row per epoch.

    ``levels`` names the levels of the tree from the top, with the column of each; a null is
    a node like any other. The budget is ``share`` of all tokens. A leaf takes whole documents
    only, and never more tokens than its budget; the full epochs that fit, then the longest
    prefix of the next one. Documents with equal ids and equal numbers of tokens are taken or
    left together. A document without tokens costs nothing, and is taken with those before
    it. An empty table gives an empty result. Columns of any names are kept; a column of the
    documents named ``mix_epoch`` is replaced.
    """
    names = [f"mix_level_{n}" for n in range(len(levels))]
    # the documents' own columns lie in a struct, out of the way of those added here
    marked = documents.select(
        F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("mix_row"),
        *(level.alias(name) for name, level in zip(names, levels.values(), strict=True)),
        F.coalesce(tokens, F.lit(0)).cast("long").alias("mix_tokens"),
        F.col(id).alias("mix_id"),
    )
    slim = marked.select(*names, "mix_tokens", "mix_id")
    leaves = cut_lineage(
        slim.groupBy(*names).agg(F.sum("mix_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    )
    total = leaves.agg(F.sum("tokens") * F.lit(float(share))).scalar()
    budgets = leaf_budgets(leaves, names, budget=total, weights=weights or {}, epochs=epochs)
    # whole epochs, and what is left for the last one
    budgets = budgets.select(
        *names,
        F.least(F.coalesce(F.floor(F.try_divide("budget", "tokens")), F.lit(0)), F.lit(epochs)).alias("whole"),
        "tokens",
        "budget",
        F.greatest(F.ceil(F.col("docs") / RANGE), F.lit(1)).alias("ranges"),
    ).withColumn("left", F.floor(F.col("budget") - F.col("whole") * F.col("tokens")))
    budgets = cut_lineage(budgets)
    if (leaf_count := budgets.count()) <= MOST_LEAVES:
        sent = F.broadcast(budgets)
    else:
        sent = budgets
    placed = _joined(slim, sent, names).withColumn("place", _place("mix_id", "mix_tokens", F.col("whole"), seed))
    within = F.pmod(F.shiftrightunsigned("place", 1), F.col("ranges"))
    placed = placed.withColumn("range", within)
    sums = placed.groupBy(*names, "range").agg(F.sum("mix_tokens").alias("sum"), F.max("left").alias("left"))
    before = Window.partitionBy(*names).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("sum").over(before), F.lit(0)))
    # the range that the budget ends in: the last that begins within it
    ends = sums.filter(F.col("before") <= F.col("left")).groupBy(*names).agg(
        F.max(F.struct("range", "before")).alias("end")
    )
    ends = ends.select(*names, F.col("end.range").alias("end_range"), F.col("end.before").alias("end_before"))
    cuts = cut_lineage(_joined(budgets, ends, names, "left"))
    last = _joined(slim, F.broadcast(cuts) if leaf_count <= MOST_LEAVES else cuts, names)
    last = last.withColumn("place", _place("mix_id", "mix_tokens", F.col("whole"), seed))
    last = last.filter(F.pmod(F.shiftrightunsigned("place", 1), F.col("ranges")) == F.col("end_range"))
    # equal places are taken together
    upto = Window.partitionBy(*names).orderBy("place").rangeBetween(Window.unboundedPreceding, 0)
    fine = last.withColumn("sum", F.col("end_before") + F.sum("mix_tokens").over(upto)).filter(F.col("sum") <= F.col("left"))
    highest = fine.groupBy(*names).agg(F.max("place").alias("end_place"))
    cuts = cut_lineage(_joined(cuts, highest, names, "left"))
    taken = _joined(marked, F.broadcast(cuts) if leaf_count <= MOST_LEAVES else cuts, names)
    place = _place("mix_id", "mix_tokens", F.col("whole"), seed)
    own_range = F.pmod(F.shiftrightunsigned(place, 1), F.col("ranges"))
    prefix = (own_range < F.col("end_range")) | ((own_range == F.col("end_range")) & (place <= F.col("end_place")))
    times = F.col("whole") + F.when(F.coalesce(prefix, F.lit(False)) & (F.col("whole") < epochs), 1).otherwise(0)
    rows = taken.filter(times > 0).withColumn("mix_epoch", F.explode(F.sequence(F.lit(0), times.cast("int") - 1)))
    own = [F.col("mix_row")[c].alias(c) for c in documents.columns if c != "mix_epoch"]
    return rows.select(*own, "mix_epoch")


def _place(id: str | Column, tokens: str | Column, epoch: Column, seed: int) -> Column:
    """A document's place in its leaf's order of an epoch."""
    return F.xxhash64(F.lit(seed), epoch, id, tokens)


def _joined(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Joined on the levels, where a null equals a null."""
    other = right.select(*(F.col(c).alias(f"other_{c}") for c in names), *(c for c in right.columns if c not in names))
    same = [F.col(c).eqNullSafe(F.col(f"other_{c}")) for c in names]
    return left.join(other, same, how).drop(*(f"other_{c}" for c in names))
