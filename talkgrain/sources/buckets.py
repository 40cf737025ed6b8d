"""Releases laid out by transcript, so that joins and groupings by it need no shuffle.

The tables are Spark's own bucketed tables: rows with one transcript are in one bucket of every
table, and Spark plans joins and groupings on that column without an exchange.
"""

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkgrain.sources.releases import conformed, release_directory


def bucketed_name(table: str, release: str, prefix: str = "") -> str:
    """The name of a table of a release in Spark's catalog; no two releases share one."""
    spelt = re.sub("[^A-Za-z0-9]", lambda m: f"_{ord(m[0]):x}_", release)
    return f"{prefix}{table}_of_{spelt}"


def write_bucketed(
    df: DataFrame,
    base: str,
    table: str,
    release: str,
    buckets: int,
    key: str = "transcript_id",
    schema=None,
    prefix: str = "",
    most_share: float = 4.0,
) -> str:
    """Write one table of a release in ``buckets`` by ``key`` and return its name in the catalog.

    Columns are those of ``write_release``. All tables of a release, and of releases that are to be
    compared, take the same number of buckets; about 256 MB each is right for the largest. The files
    go to ``<base>/bucketed/<table>/release=<release>``, one for each bucket, sorted by the key.

    A bucket is read by one task. The rows are therefore counted first: if a bucket would hold more
    than ``most_share`` times the mean, because one transcript holds much of the release, the run
    stops, and the release is better left as ``write_release`` makes it, where a hot transcript is
    spread. Few rows in all (under 10,000 in the largest bucket) are no matter.
    """
    spark = df.sparkSession
    rows = conformed(df, table, release, schema)
    bucket = F.pmod(F.hash(key), F.lit(buckets)).alias("bucket")
    largest, total = (
        rows.groupBy(bucket).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"), F.sum("n")).first()
    )
    if largest and largest >= 10_000 and largest > most_share * total / buckets:
        raise ValueError(
            f"one bucket of {table} would hold {largest} of {total} rows: a transcript is too large for it"
        )
    name = bucketed_name(table, release, prefix)
    folder = release_directory(f"{base}/bucketed", table, release)
    # Dealt out by the hash that buckets go by, so that each is one file.
    dealt = rows.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    dealt.option("path", folder).mode("overwrite").format("parquet").saveAsTable(name)
    return name


def bucketed_table(spark: SparkSession, table: str, release: str, prefix: str = "") -> DataFrame:
    """A table of ``write_bucketed``, with the ``release`` as a column."""
    return spark.table(bucketed_name(table, release, prefix)).withColumn("release", F.lit(release))
