"""Row numbers and running totals over a whole table, without bringing it to one task.

A table is dealt out by ranges of its order, sorted in each range, and written to the shared folder
with the place of each row in its range. What comes before a range is one number, added when the
rows are read again; one number for each range reaches the driver. A run that is cut short leaves
nothing behind that a later one would read.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkgrain.sources.shared import shared_folder

# Spark's row ids hold the partition above this many bits and the place in it below them.
PLACE_BITS = 33


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, and safe from lost executors."""
    spark = df.sparkSession
    folder = f"{shared_folder(spark, name)}/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def numbered(
    rows: DataFrame, order: Sequence[str | Column], name: str = "number", first: int = 1
) -> DataFrame:
    """``rows`` with their place in the order of the whole table, from ``first`` on, as LONG.

    Rows that are alike in ``order`` come in any order; without such rows the numbers are the same
    on every run.
    """
    table = _ranges(rows, order)
    bases = _bases(table, F.count(F.lit(1)), first)
    number = (F.col("base") + F.col("place")).alias(name)
    return _joined(table, bases).select(*_columns(rows, name), number)


def numbered_within(
    rows: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    name: str = "number",
    first: int = 1,
) -> DataFrame:
    """``rows`` with their place in the order of their group; a null is a group like any other.

    No group is brought together: its rows get their place in the whole table, and the first place
    of each group is a grouped minimum.
    """
    whole = numbered(rows, [*group, *order], name, 0)
    starts = whole.groupBy(*(F.col(c).alias(f"_of_{c}") for c in group)).agg(F.min(name).alias("_start"))
    joined = whole.join(starts, alike(group, "_of_"))
    number = (F.col(name) - F.col("_start") + first).alias(name)
    return joined.select(*(c for c in rows.columns if c != name), number)


def running_total(
    rows: DataFrame, order: Sequence[str | Column], value: str, name: str = "before"
) -> DataFrame:
    """``rows`` with the sum of ``value`` (LONG) over all rows before them in the whole table."""
    table = _ranges(rows, order)
    amount = F.coalesce(F.col("row")[value], F.lit(0)).cast("long")
    bases = _bases(table, F.sum(amount), 0)
    earlier = Window.partitionBy("range").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(amount).over(earlier), F.lit(0))
    summed = table.withColumn("sum", before)
    return _joined(summed, bases).select(
        *_columns(rows, name), (F.col("base") + F.col("sum")).alias(name)
    )


def alike(columns: Sequence[str], prefix: str) -> Column:
    """That columns equal those of the same names behind ``prefix``, nulls being equal to nulls."""
    return reduce(
        lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"{prefix}{c}")) for c in columns)
    )


def _ranges(rows: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    keys = [F.col(key) if isinstance(key, str) else key for key in order]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    row_id = F.monotonically_increasing_id()
    table = written(placed.select(F.struct("*").alias("row"), row_id.alias("id")), "ranges")
    return table.select(
        "row",
        F.shiftrightunsigned("id", PLACE_BITS).alias("range"),
        F.col("id").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).alias("place"),
    )


def _bases(table: DataFrame, amount: Column, first: int) -> DataFrame:
    sizes = sorted(map(tuple, table.groupBy("range").agg(amount).collect()))
    before, total = [], first
    for part, size in sizes:
        before.append((part, total))
        total += size
    return table.sparkSession.createDataFrame(before, "range long, base long")


def _joined(table: DataFrame, bases: DataFrame) -> DataFrame:
    # As many rows as there are ranges, which a setting bounds.
    return table.join(F.broadcast(bases), "range")


def _columns(rows: DataFrame, name: str) -> list[Column]:
    return [F.col("row")[c].alias(c) for c in rows.columns if c != name]
