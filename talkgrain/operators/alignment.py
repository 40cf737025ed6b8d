"""What happened to each utterance of a transcript between two releases."""

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkgrain.operators.linkage import utterance_digest
from talkgrain.operators.numbering import numbered, numbered_within, written

# Stretches of a transcript that are worked on together. What is carried from one to the next is a
# row for each of them.
BLOCK = 8192


def compare_utterances(
    old: DataFrame, new: DataFrame, compared: Sequence[str] = ("speaker", "text")
) -> DataFrame:
    """Align the utterances of each transcript of two releases and say what became of them.

    Takes utterances with ``transcript_id`` and ``utterance_order`` and compares the columns named
    in ``compared`` by digests. Returns ``transcript_id``, ``old_order``, ``new_order`` and
    ``status``, a row per utterance of either release:

    - ``same``: it is in both, in the same order among the others that are;
    - ``moved``: it is in both, but not in order;
    - ``changed``: another one stands in its place: between two that are the same, the k-th old one
      that is left and the k-th new one;
    - ``deleted`` and ``inserted``: there is nothing in its place.

    A transcript with equal utterances and orders is done at once, and one that only one release has
    is deleted or inserted whole. In the others, utterances that occur once on both sides are
    anchors; a longest run of anchors whose places increase on both sides is the same, and cuts the
    transcript into gaps, in which utterances that occur once are looked for again. When there is
    none left, the k-th occurrences of an utterance in a gap are anchors. Utterances of one order
    are put in the order of their digests; a NULL id is not compared, its utterances are left out.

    Anchors are found by grouped counts on (gap, digest), and places are numbered over the whole
    table, so a transcript with a third of all utterances is spread over all tasks. Anchors that
    follow each other on both sides are one run, and a run is three numbers; only the runs of one
    gap, about as many as there were moves in it, are put in a task together to find the longest
    chain of them.
    """
    digest = utterance_digest(compared).alias("digest")

    def side(rows: DataFrame) -> DataFrame:
        rows = rows.where(F.col("transcript_id").isNotNull())
        order = F.col("utterance_order").alias("order")
        return rows.select(F.col("transcript_id").alias("t"), order, digest)

    sides = [side(old), side(new)]
    unchanged = written(_profile(sides[0]).intersect(_profile(sides[1])).select("t"), "unchanged")
    whole = sides[0].join(unchanged, "t", "semi").select(
        F.col("t").alias("transcript_id"),
        F.col("order").alias("old_order"),
        F.col("order").alias("new_order"),
        F.lit("same").alias("status"),
    )
    # Places count over the whole table, by transcript and then by order.
    places = [
        written(
            numbered(rows.join(unchanged, "t", "anti"), ["t", "order", "digest"], "at", 0), "places"
        )
        for rows in sides
    ]
    start = F.lit(-1).cast("long").alias("gap")
    left = [rows.select("t", start, "at", "digest") for rows in places]
    matched = None
    for find in (_unique, _occurrences):
        while True:
            found = written(_longest(find(*left)), "matched")
            if found.isEmpty():
                break
            matched = found if matched is None else written(matched.unionByName(found), "matched")
            left = [
                written(_in_gaps(rows.select("t", "at", "digest"), matched, name), "gaps")
                for rows, name in zip(places, ("old_at", "new_at"))
            ]
    moved = _paired(left, ["t", "digest"], "inner").select("t", "old_at", "new_at")
    moved = written(moved, "moved")
    rest = [
        rows.join(moved.select(F.col(name).alias("at")), "at", "anti")
        for rows, name in zip(left, ("old_at", "new_at"))
    ]
    replaced = _paired(rest, ["t", "gap"], "full").select("t", "old_at", "new_at")
    status = (
        F.when(F.col("new_at").isNull(), "deleted")
        .when(F.col("old_at").isNull(), "inserted")
        .otherwise("changed")
    )
    rows = moved.withColumn("status", F.lit("moved")).unionByName(
        replaced.withColumn("status", status)
    )
    if matched is not None:
        rows = rows.unionByName(matched.withColumn("status", F.lit("same")))
    orders = [
        table.select(F.col("at").alias(f"{name}_at"), F.col("order").alias(f"{name}_order"))
        for table, name in zip(places, ("old", "new"))
    ]
    aligned = rows.join(orders[0], "old_at", "left").join(orders[1], "new_at", "left")
    return whole.unionByName(
        aligned.select(F.col("t").alias("transcript_id"), "old_order", "new_order", "status")
    )


def _profile(rows: DataFrame) -> DataFrame:
    """Equal for transcripts with the same utterances under the same orders."""
    row = F.xxhash64("order", F.col("order").isNull(), "digest")
    return rows.groupBy("t").agg(
        F.count("*").alias("n"),
        F.bit_xor(row).alias("x"),
        F.sum(row.cast("decimal(38,0)")).alias("s"),
    )


def _unique(old: DataFrame, new: DataFrame) -> DataFrame:
    """Anchors: the digests that occur once in a gap on both sides."""

    def once(rows: DataFrame, name: str) -> DataFrame:
        counted = rows.groupBy("t", "gap", "digest").agg(
            F.count("*").alias("n"), F.min("at").alias(name)
        )
        return counted.where("n = 1").drop("n")

    return once(old, "old_at").join(once(new, "new_at"), ["t", "gap", "digest"])


def _occurrences(old: DataFrame, new: DataFrame) -> DataFrame:
    """Anchors: the k-th occurrences of a digest in a gap on both sides."""
    return _paired([old, new], ["t", "gap", "digest"], "inner")


def _paired(sides: Sequence[DataFrame], group: Sequence[str], how: str) -> DataFrame:
    """The k-th old row of each group beside the k-th new one."""
    first, second = (
        numbered_within(rows.select(*group, F.col("at").alias(name)), group, [name], "k")
        for rows, name in zip(sides, ("old_at", "new_at"))
    )
    return first.join(second, [*group, "k"], how)


def _longest(anchors: DataFrame) -> DataFrame:
    """The anchors of a longest run in each gap whose places increase on both sides.

    Gives ``t``, ``old_at``, ``new_at``. Of several the one is taken that a scan in old order finds
    first (see ``_heaviest``).
    """
    ranked = numbered(anchors.select("t", "gap", "old_at", "new_at"), ["old_at"], "old_rank", 0)
    ranked = written(numbered(ranked, ["new_at"], "new_rank", 0), "anchors")
    # An anchor begins a run unless it follows its predecessor on both sides. Long runs are cut, so
    # that each can be spelt out again.
    before = ranked.select(
        (F.col("old_rank") + 1).alias("old_rank"),
        F.col("t").alias("_t"),
        F.col("gap").alias("_gap"),
        (F.col("new_rank") + 1).alias("_next"),
    )
    follows = (
        F.col("t").eqNullSafe(F.col("_t"))
        & F.col("gap").eqNullSafe(F.col("_gap"))
        & F.col("new_rank").eqNullSafe(F.col("_next"))
        & (F.col("old_rank") % BLOCK != 0)
    )
    starts = ranked.join(before, "old_rank", "left").where(~follows)
    starts = starts.select("t", "gap", "old_rank", "new_rank")
    starts = written(numbered(starts, ["old_rank"], "run", 0), "runs")
    ends = starts.select((F.col("run") - 1).alias("run"), F.col("old_rank").alias("end"))
    size = F.coalesce("end", F.lit(ranked.count())) - F.col("old_rank")
    runs = written(starts.join(ends, "run", "left").withColumn("size", size), "runs")
    several = runs.groupBy("t", "gap").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    chained = (
        runs.join(several, ["t", "gap"], "semi")
        .select("t", "gap", "old_rank", "new_rank", "size")
        .groupBy("t", "gap")
        .applyInPandas(_heaviest, "old_rank long, size long")
    )
    alone = runs.join(several, ["t", "gap"], "anti").select("old_rank", "size")
    kept = alone.unionByName(chained).select(
        F.explode(F.sequence("old_rank", F.col("old_rank") + F.col("size") - 1)).alias("old_rank")
    )
    return ranked.join(kept, "old_rank", "semi").select("t", "old_at", "new_at")


def _heaviest(runs: pd.DataFrame) -> pd.DataFrame:
    """The runs of a gap that make the heaviest chain with increasing places on both sides.

    Runs are taken in old order, and each is put behind the heaviest chain that ends before it on
    the new side, the earliest of equals; the first of the heaviest chains is kept. The best chain
    below each place is held in a tree of running maxima.
    """
    runs = runs.sort_values("old_rank", ignore_index=True)
    n = len(runs)
    place = runs["new_rank"].rank().astype(int).to_numpy()
    sizes = runs["size"].to_numpy()
    weight = np.zeros(n, np.int64)
    back = np.full(n, -1)
    # By node, the weight of the best chain and the run at its end, counted down so that of equal
    # weights the earliest is the larger.
    tree: list[tuple[int, int]] = [(0, 1)] * (n + 1)
    for i in range(n):
        best, at = (0, 1), int(place[i]) - 1
        while at > 0:
            best = max(best, tree[at])
            at -= at & -at
        weight[i] = best[0] + sizes[i]
        back[i] = -best[1] if best[0] else -1
        at = int(place[i])
        while at <= n:
            tree[at] = max(tree[at], (int(weight[i]), -i))
            at += at & -at
    chain, i = [], int(np.argmax(weight))
    while i >= 0:
        chain.append(i)
        i = int(back[i])
    return runs.loc[chain, ["old_rank", "size"]]


def _in_gaps(places: DataFrame, matched: DataFrame, name: str) -> DataFrame:
    """The rows of one side that are not matched, with their gap: the last match before them.

    A running maximum: within blocks of places, and over the blocks of a transcript.
    """
    block = F.floor(F.col("at") / BLOCK).alias("block")
    # Both sides name a match by its old place.
    marks = matched.select(F.col(name).alias("at"), F.col("old_at").alias("mark"))
    rows = places.join(marks, "at", "left").select("*", block)
    tops = rows.groupBy("t", "block").agg(F.max("mark").alias("top"))
    over = Window.partitionBy("t").orderBy("block")
    earlier = over.rowsBetween(Window.unboundedPreceding, -1)
    carried = tops.select("t", "block", F.max("top").over(earlier).alias("carried"))
    inside = Window.partitionBy("t", "block").orderBy("at")
    so_far = F.max("mark").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    gap: Column = F.greatest(F.coalesce(so_far, F.lit(-1)), F.coalesce("carried", F.lit(-1)))
    placed = rows.join(carried, ["t", "block"])
    placed = placed.select("t", gap.cast("long").alias("gap"), "at", "digest", "mark")
    return placed.where(F.col("mark").isNull()).drop("mark")
