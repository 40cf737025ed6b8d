"""Which transcript of an old release is which of a new one, by what is said in them."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgrain.operators.numbering import numbered_within, written
from talkgrain.sources.scans import broadcast_if_small

SIDES = ("old", "new")


def utterance_digest(compared: Sequence[str]) -> Column:
    """64 bits that stand for the named columns of an utterance. NULL is a value like any other."""
    return F.xxhash64(*compared, *(F.col(name).isNull() for name in compared))


def under_old_ids(new: DataFrame, links: DataFrame) -> DataFrame:
    """The utterances of ``new`` whose transcript is linked to an old one, under the id of that.

    ``links`` is the result of ``match_transcripts``. With it ``compare_utterances`` can follow
    transcripts through a change of their ids; those that were added are left out.
    """
    pairs = links.where("old_id IS NOT NULL AND new_id IS NOT NULL")
    pairs = broadcast_if_small(pairs.select(F.col("new_id").alias("_new"), F.col("old_id").alias("_old")))
    joined = new.join(pairs, F.col("transcript_id") == F.col("_new"))
    return joined.select(
        *(F.col("_old").alias(c) if c == "transcript_id" else F.col(c) for c in new.columns)
    )


def match_transcripts(
    old: DataFrame,
    new: DataFrame,
    compared: Sequence[str] = ("speaker", "text"),
    least: float = 0.5,
    rare: int = 8,
) -> DataFrame:
    """Link the transcripts of two releases whose ids cannot be trusted, such as after a re-parse.

    ``old`` and ``new`` are utterances with ``transcript_id``. A transcript is its set of distinct
    utterances, known by digests of the ``compared`` columns, and each is linked to one other at
    most:

    - ``same``: the set is found under the same id.
    - ``renumbered``: it is found under another id. Of several transcripts with one set, the k-th
      old by id is linked to the k-th new.
    - ``revised``: of the others, the sets whose Jaccard similarity is ``least`` or more and that
      are each other's most similar; ties go to the same id and then to the smaller. They must
      share an utterance that ``rare`` sets of either release have at most, so common ones are no
      evidence and make no candidates: an utterance gives at most ``rare`` squared pairs, however
      many transcripts have it.
    - ``removed`` and ``added``: old and new ones that are left.

    Returns ``old_id``, ``new_id``, ``status``, ``n_old``, ``n_new`` and ``n_common`` (distinct
    utterances) and ``similarity``; the last two are NULL where there is nothing to compare.
    Utterances of a NULL id are left out. What is shuffled are digests. Equal sets count as one in the search and their members are
    linked by number, so a set that a third of all transcripts have is one candidate.
    """
    digest = utterance_digest(compared).alias("digest")
    sides = [
        rows.where(F.col("transcript_id").isNotNull()).select(
            F.lit(side).alias("side"), F.col("transcript_id").alias("id"), digest
        )
        for side, rows in zip(SIDES, (old, new))
    ]
    sets = written(sides[0].unionByName(sides[1]).distinct(), "utterance-sets")
    # A set of digests is named by their number and two hashes that no order changes.
    named = [F.bit_xor(F.xxhash64(F.lit(seed), "digest")).alias(f"x{seed}") for seed in (0, 1)]
    profiles = written(sets.groupBy("side", "id").agg(F.count("*").alias("n"), *named), "profiles")
    content = ["n", "x0", "x1"]

    def of(side: str, rows: DataFrame, *columns: str) -> DataFrame:
        picked = rows.where(F.col("side") == side)
        return picked.select(F.col("id").alias(f"{side}_id"), *columns)

    def linked(rows: DataFrame, by: Sequence[str]) -> DataFrame:
        return of("old", rows, *by).join(of("new", rows, *by), list(by))

    def without(rows: DataFrame, pairs: DataFrame) -> DataFrame:
        done = pairs.select(
            F.inline(F.array(*(
                F.struct(F.lit(side).alias("side"), F.col(f"{side}_id").alias("id")) for side in SIDES
            )))
        )
        return written(rows.join(done, ["side", "id"], "anti"), "left-transcripts")

    same = linked(profiles.withColumn("same_id", F.col("id")), [*content, "same_id"])
    same = written(same.select("old_id", "new_id", "n"), "links")
    left = without(profiles, same)
    members = numbered_within(left, ["side", *content], ["id"], "k")
    renumbered = written(linked(members, [*content, "k"]).select("old_id", "new_id", "n"), "links")
    left = without(left, renumbered)

    classes = left.groupBy("side", *content).agg(F.min("id").alias("class"))
    classes = written(classes, "classes")
    held = sets.join(classes.select("side", F.col("class").alias("id"), "n"), ["side", "id"])
    held = written(held, "class-sets")
    holders = [F.count_if(F.col("side") == side) for side in SIDES]
    distinctive = held.groupBy("digest").agg(*(h.alias(s) for h, s in zip(holders, SIDES)))
    distinctive = distinctive.where(
        F.col("old").between(1, rare) & F.col("new").between(1, rare)
    ).select("digest")
    search = written(held.join(distinctive, "digest", "semi"), "distinctive")
    pairs = of("old", search, "digest", F.col("n").alias("n_old")).join(
        of("new", search, "digest", F.col("n").alias("n_new")), "digest"
    )
    alike_in_size = F.least("n_old", "n_new") >= least * F.greatest("n_old", "n_new")
    pairs = pairs.where(alike_in_size).drop("digest").distinct()
    common = (
        pairs.join(of("old", held, "digest"), "old_id")
        .join(of("new", held, "digest"), ["new_id", "digest"])
        .groupBy("old_id", "new_id", "n_old", "n_new")
        .agg(F.count("*").alias("n_common"))
    )
    union = F.col("n_old") + F.col("n_new") - F.col("n_common")
    scored = common.withColumn("similarity", F.col("n_common") / union)
    scored = written(scored.where(F.col("similarity") >= least), "scored")

    def best(mine: str, other: str) -> DataFrame:
        choice = F.struct(-F.col("similarity"), F.col("old_id") != F.col("new_id"), F.col(other).alias("id"))
        chosen = scored.groupBy(mine).agg(F.min(choice).alias("best"))
        return chosen.select(mine, F.col("best.id").alias(other))

    mutual = best("old_id", "new_id").join(best("new_id", "old_id"), ["old_id", "new_id"])
    of_class = scored.join(mutual, ["old_id", "new_id"]).select(
        F.col("old_id").alias("old_class"),
        F.col("new_id").alias("new_class"),
        "n_old",
        "n_new",
        "n_common",
        "similarity",
    )
    members = numbered_within(left, ["side", *content], ["id"], "k")
    members = members.join(classes, ["side", *content])
    revised = (
        of_class.join(of("old", members, F.col("class").alias("old_class"), "k"), "old_class")
        .join(of("new", members, F.col("class").alias("new_class"), "k"), ["new_class", "k"])
        .select("old_id", "new_id", "n_old", "n_new", "n_common", "similarity")
    )
    revised = written(revised, "links")
    left = without(left, revised)

    def equal(pairs: DataFrame, status: str) -> DataFrame:
        return pairs.select(
            "old_id",
            "new_id",
            F.lit(status).alias("status"),
            F.col("n").alias("n_old"),
            F.col("n").alias("n_new"),
            F.col("n").alias("n_common"),
            F.lit(1.0).alias("similarity"),
        )

    id_type = profiles.schema["id"].dataType

    def alone(side: str, status: str) -> DataFrame:
        def own(column: Column, of_side: str, kind) -> Column:
            return column if side == of_side else F.lit(None).cast(kind)

        return left.where(F.col("side") == side).select(
            own(F.col("id"), "old", id_type).alias("old_id"),
            own(F.col("id"), "new", id_type).alias("new_id"),
            F.lit(status).alias("status"),
            own(F.col("n"), "old", "long").alias("n_old"),
            own(F.col("n"), "new", "long").alias("n_new"),
            F.lit(None).cast("long").alias("n_common"),
            F.lit(None).cast("double").alias("similarity"),
        )

    found = revised.withColumn("status", F.lit("revised"))
    return (
        equal(same, "same")
        .unionByName(equal(renumbered, "renumbered"))
        .unionByName(found)
        .unionByName(alone("old", "removed"))
        .unionByName(alone("new", "added"))
    )
