"""What changed between two releases."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compare_releases(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    attrs: Sequence[str] = (),
    moved_by: Sequence[str] = ("collection",),
    digests: Sequence[str] = (),
    unique_keys: bool = False,
    co_located: bool = False,
) -> DataFrame:
    """The status of every key: added, removed, moved, revised or same.

    A key in both releases is ``moved`` when it is found under other values of the attributes
    named in ``moved_by``, else ``revised`` when any other attribute differs, else ``same``.
    ``n_old`` and ``n_new`` say how many rows each release has under the key.

    The releases are stacked and counted instead of joined. That gives the rows of a full outer
    join and also holds where a join does not: NULL keys meet, and a key that is repeated many
    times on both sides is folded before the shuffle instead of being paired with itself. Every
    step is a count, so all of it is hash aggregation with a partial step.

    ``digests`` names wide STRING attributes, such as a whole text, to compare by SHA-256: then
    32 bytes are shuffled for each instead of the value. All others are compared as they are.

    ``unique_keys`` is for releases in which no key is repeated; one that is stops the run. Each
    release then crosses the network once instead of three times, and 128 bits of hash stand for
    the attributes, whatever ``digests`` says. ``co_located`` is for such releases that are laid out
    by their one key (``write_bucketed``): they are grouped and joined where they are, and nothing
    crosses the network.
    """
    if not set(digests) <= set(attrs):
        raise ValueError("digests must name attributes")
    moving = [name for name in attrs if name in moved_by]
    if co_located:
        if not unique_keys or len(keys) != 1:
            raise ValueError("co_located is for one key that is not repeated: unique_keys=True")
        return _compare_co_located(old, new, keys[0], moving, list(attrs))
    if unique_keys:
        return _compare_unique(old, new, keys, moving, list(attrs))
    columns = [*keys, *attrs]

    def side(release: DataFrame, in_old: int, in_new: int) -> DataFrame:
        compared = [
            F.unhex(F.sha2(name, 256)).alias(name) if name in digests else F.col(name)
            for name in columns
        ]
        return release.select(
            *compared, F.lit(in_old).alias("in_old"), F.lit(in_new).alias("in_new")
        )

    stacked = side(old, 1, 0).unionByName(side(new, 0, 1))
    # Rows that are alike in keys and attributes: unequal numbers mean something differs.
    per_row = stacked.groupBy(*columns).agg(
        F.sum("in_old").alias("n_old"), F.sum("in_new").alias("n_new")
    )
    per_place = per_row.groupBy(*keys, *moving).agg(
        F.sum("n_old").alias("n_old"),
        F.sum("n_new").alias("n_new"),
        F.max(F.col("n_old") != F.col("n_new")).alias("differs"),
    )
    per_key = per_place.groupBy(*keys).agg(
        F.sum("n_old").alias("n_old"),
        F.sum("n_new").alias("n_new"),
        F.max("differs").alias("differs"),
        F.max((F.col("n_old") == 0) != (F.col("n_new") == 0)).alias("elsewhere"),
    )
    status = (
        F.when(F.col("n_old") == 0, "added")
        .when(F.col("n_new") == 0, "removed")
        .when(F.col("elsewhere"), "moved")
        .when(F.col("differs"), "revised")
        .otherwise("same")
    )
    return per_key.select(*keys, "n_old", "n_new", status.alias("status"))


def _compare_unique(
    old: DataFrame, new: DataFrame, keys: Sequence[str], moving: list[str], attrs: list[str]
) -> DataFrame:
    """One grouping by key of both releases; only numbers are aggregated."""

    def side(release: DataFrame, in_old: int) -> DataFrame:
        return release.select(*keys, *_hashes(moving, attrs), F.lit(in_old).alias("in_old"))

    stacked = side(old, 1).unionByName(side(new, 0))
    is_old = F.col("in_old") == 1
    counts = stacked.groupBy(*keys).agg(
        F.count_if(is_old).alias("n_old"),
        F.count_if(~is_old).alias("n_new"),
        *(F.max(F.when(is_old, F.col(f"h{i}"))).alias(f"old{i}") for i in range(4)),
        *(F.max(F.when(~is_old, F.col(f"h{i}"))).alias(f"new{i}") for i in range(4)),
    )
    return counts.select(*keys, "n_old", "n_new", _unique_status())


def _compare_co_located(
    old: DataFrame, new: DataFrame, key: str, moving: list[str], attrs: list[str]
) -> DataFrame:
    """Each release grouped by its key, and the two joined on it."""

    def side(release: DataFrame, name: str) -> DataFrame:
        rows = release.where(F.col(key).isNotNull()).select(key, *_hashes(moving, attrs))
        values = (F.max(f"h{i}").alias(f"{name}{i}") for i in range(4))
        return rows.groupBy(key).agg(F.count(F.lit(1)).alias(f"n_{name}"), *values)

    joined = side(old, "old").join(side(new, "new"), key, "full")
    counts = (F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("n_old", "n_new"))
    values = (f"{name}{i}" for name in ("old", "new") for i in range(4))
    found = joined.select(key, *counts, *values).select(key, "n_old", "n_new", _unique_status())
    # A join does not match a NULL key; there is one at most.
    bare = [release.where(F.col(key).isNull()) for release in (old, new)]
    return found.unionByName(_compare_unique(*bare, [key], moving, attrs))


def _hashes(moving: list[str], attrs: list[str]) -> list[Column]:
    def pair(names: list[str]) -> list[Column]:
        # A hash skips NULL, so it is told where NULLs are.
        values = [*names, *(F.col(name).isNull() for name in names)]
        return [F.xxhash64(F.lit(salt), *values) for salt in (0, 1)]

    return [h.alias(f"h{i}") for i, h in enumerate([*pair(moving), *pair(attrs)])]


def _unique_status() -> Column:
    differ = [F.col(f"old{i}") != F.col(f"new{i}") for i in range(4)]
    repeated = F.raise_error(F.lit("a key is repeated: compare with unique_keys=False"))
    status = (
        F.when((F.col("n_old") > 1) | (F.col("n_new") > 1), repeated)
        .when(F.col("n_old") == 0, "added")
        .when(F.col("n_new") == 0, "removed")
        .when(differ[0] | differ[1], "moved")
        .when(differ[2] | differ[3], "revised")
        .otherwise("same")
    )
    return status.alias("status")
