"""Copies of large tables by ranges of their key, each proven equal, that go on where they stopped."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkgrain.sources.releases import COMPRESSION, conformed, release_directory

LEDGER = "range int, low long, high long, n long, total decimal(38,0), parity long"


def multiset_digest(columns: Sequence[str]) -> list[Column]:
    """Aggregates that tell multisets of rows apart, whatever their order: ``n``, ``total``, ``parity``.

    The number of rows, the sum of one hash of each and the exclusive or of another. The sum tells
    how often rows are repeated, which the exclusive or does not; NULLs are told from every value.
    """
    values = [*columns, *(F.col(name).isNull() for name in columns)]
    hashes = [F.xxhash64(F.lit(seed), *values) for seed in (0, 1)]
    return [
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(hashes[0].cast("decimal(20,0)")).cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)")).alias("total"),
        F.coalesce(F.bit_xor(hashes[1]), F.lit(0).cast("long")).alias("parity"),
    ]


def differing_ranges(
    first: DataFrame, second: DataFrame, key: str, width: int, columns: Sequence[str] | None = None
) -> DataFrame:
    """Ranges of ``key`` (``low``, ``high``) in which two tables do not hold the same rows.

    One digest for each range of ``width`` of either table is compared; no row meets another.
    A NULL key is a range of its own, with NULL ``low`` and ``high``.
    """
    columns = list(columns or first.columns)

    def digests(rows: DataFrame, name: str) -> DataFrame:
        low = (F.floor(F.col(key) / width) * width).cast("long").alias("low")
        grouped = rows.groupBy(low).agg(*multiset_digest(columns))
        return grouped.select("low", F.struct("n", "total", "parity").alias(name))

    a, b = digests(first, "a"), digests(second, "b").withColumnRenamed("low", "_low")
    joined = a.join(b, F.col("low").eqNullSafe(F.col("_low")), "full")
    start = F.coalesce("low", "_low")
    return joined.where(~F.col("a").eqNullSafe(F.col("b"))).select(
        start.alias("low"), (start + width).alias("high"), F.col("a.n").alias("n_first"), F.col("b.n").alias("n_second")
    )


def mirror_ranges(
    spark: SparkSession,
    source: Callable[[int | None, int | None], DataFrame],
    table: str,
    release: str,
    bounds: Sequence[int],
    out: str,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Copy one table of a release range by range, prove each range equal, and go on after a stop.

    ``source(low, high)`` gives the rows with a key from ``low`` on and below ``high``, None being
    without end; the ranges are those between ``bounds`` and the two beyond them, of which the first
    must also give the rows with a NULL key. Each range is written over what an earlier run may have
    left of it, read back, and compared with what left the source by a digest that no order changes,
    so a row that is changed, lost or repeated stops the run even where the counts agree. A range
    that is proven is entered in a ledger beside the copy and is not read again by a later run.

    Returns the ledger: ``range``, ``low``, ``high``, ``n``, ``total``, ``parity``. ``release_table`` reads the
    copy as one table; name the release in the manifest after this has returned.
    """
    folder = release_directory(out, table, release)
    ledger = f"{out}/_copied/{table}/{release}"
    edges = [None, *sorted(set(bounds)), None]
    ranges = list(enumerate(zip(edges, edges[1:])))
    # Ranges of other bounds are not those that were proven.
    done = {row["range"]: (row["low"], row["high"]) for row in _ledger(spark, ledger).collect()}
    stale = [k for k, span in done.items() if k >= len(ranges) or ranges[k][1] != span]
    if stale:
        raise ValueError(f"{folder} was begun with other bounds: copy to another place")
    for k, (low, high) in ranges:
        if k in done:
            continue
        rows = conformed(source(low, high), table, release, schema)
        sent = Observation(f"{table}-{k}")
        part = f"{folder}/range={k}"
        proven = rows.observe(sent, *multiset_digest(rows.columns))
        proven.write.mode("overwrite").option("compression", COMPRESSION).parquet(part)
        copy = spark.read.schema(rows.schema).parquet(part).agg(*multiset_digest(rows.columns)).first()
        if sent.get != copy.asDict():
            raise RuntimeError(f"{table}, keys from {low} to {high}: sent {sent.get}, the copy has {copy.asDict()}")
        entry = spark.createDataFrame([(k, low, high, copy["n"], copy["total"], copy["parity"])], LEDGER)
        entry.coalesce(1).write.mode("append").parquet(ledger)
    return _ledger(spark, ledger)


def _ledger(spark: SparkSession, folder: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)
