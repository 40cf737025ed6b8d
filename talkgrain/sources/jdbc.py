"""Tables straight from the SQL database that serves a release."""

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcSplit:
    """How to cut a table for a parallel read: ``n`` ranges of ``key`` between two bounds.

    The bounds only place the cuts. Rows outside them, and rows without a key, are read too.
    """

    key: str
    lo: int
    hi: int
    n: int


def read_release_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    lo: int,
    hi: int,
    n: int,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Scan a table of a SQL database over ``n`` connections, one range of ``key`` each.

    Filters and column choice go into the SQL of each connection. The login comes from the
    caller in ``properties``; there is no default. ``fetchsize`` keeps a connection from
    holding its whole range in memory; some drivers also need a switch in the URL for that
    (MySQL: ``useCursorFetch=true``).
    """
    return spark.read.jdbc(
        url,
        table,
        column=key,
        lowerBound=lo,
        upperBound=hi,
        numPartitions=n,
        properties={"fetchsize": "10000", **(properties or {})},
    )


def jdbc_tables(
    spark: SparkSession,
    url: str,
    splits: Mapping[str, JdbcSplit],
    properties: Mapping[str, str] | None = None,
) -> Callable[[str], DataFrame]:
    """The tables of one database by name, as a source for ``mirror_release``."""

    def table(name: str) -> DataFrame:
        split = splits[name]
        return read_release_jdbc(
            spark, url, name, split.key, split.lo, split.hi, split.n, properties
        )

    return table
