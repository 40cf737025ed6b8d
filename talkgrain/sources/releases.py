"""Releases on Parquet, one snapshot per ``release=`` directory under each entity table.

    <base>/manifest.json
    <base>/<table>/release=<name>/*.parquet
"""

import re
import warnings
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkgrain.schemas import ENTITIES, OPTIONAL, PICKED_BY
from talkgrain.sources.manifest import load_manifest, resolve_release, write_manifest

# A release is written once and copied and read often: smaller files are worth the time.
COMPRESSION = "zstd"

# Names that need no escaping in a directory name.
RELEASE_NAME = re.compile(r"[A-Za-z0-9_.\-]+")


def read_release(
    spark: SparkSession,
    base: str,
    table: str,
    version: str | None = None,
    manifest: str | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Scan one table of one release, by default the manifest's current one."""
    known = load_manifest(spark, manifest or f"{base}/manifest.json")
    return release_table(spark, base, table, resolve_release(known, version), schema)


def release_table(
    spark: SparkSession,
    base: str,
    table: str,
    release: str,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Scan one table of a release that is already resolved.

    Only the directory of that release is listed; the other releases, whose files may number
    in the millions, are not looked at even for planning.
    """
    rows = (
        _reader(spark, table, schema)
        .option("basePath", f"{base}/{table}")
        .parquet(release_directory(base, table, release))
        .where(F.col("release") == release)
    )
    # A copy made by ranges has a folder for each, which is no column of the table.
    return rows.drop("range") if "range" not in _columns(table, schema).names else rows


def read_releases(
    spark: SparkSession, base: str, table: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """Scan one table of all releases, told apart by the ``release`` column."""
    rows = _reader(spark, table, schema).parquet(f"{base}/{table}")
    return rows.drop("range") if "range" not in _columns(table, schema).names else rows


def write_release(
    df: DataFrame,
    base: str,
    table: str,
    release: str,
    schema: T.StructType | str | None = None,
    arranged: bool = False,
) -> None:
    """Write one table of one release. Writing it again replaces that release and no other.

    The columns are those of ``schema``, or of the table in ``schemas.ENTITIES``, cast to its types,
    so that they read back; a missing one is an error unless it is in ``schemas.OPTIONAL``, and a
    warning names those of ``df`` that are left out. Rows are sorted by corpus and speaker inside
    each file, in row groups of 32 MB, so that a pick of either skips most of them.

    The sort takes the memory of a partition of ``df``. Lines or words are many times the rows they
    are cut from: sort those before (in partitions that ``spread`` bounds) and say ``arranged``, and
    the rows are written as they come.
    """
    rows = conformed(df, table, release, schema)
    order = [name for name in PICKED_BY if name in rows.columns]
    if order and not arranged:
        rows = rows.sortWithinPartitions(*order)
    # Straight into the directory of the release: unlike partitionBy on a constant, this needs
    # no sort of the rows by it, and it also replaces a release by an empty table.
    writer = rows.write.mode("overwrite").option("parquet.block.size", 32 * 1024 * 1024)
    writer.option("compression", COMPRESSION).parquet(release_directory(base, table, release))


def mirror_release(
    spark: SparkSession,
    source: Callable[[str], DataFrame],
    tables: Iterable[str],
    release: str,
    out: str,
    schemas: Mapping[str, T.StructType | str] | None = None,
) -> dict[str, int]:
    """Copy the tables of a release to a store of one's own, for heavy use.

    ``source`` gives the DataFrame of a table by its name: ``jdbc_tables(...)`` for a SQL
    database, or ``read_release`` bound to another store. ``schemas`` are those of tables with
    columns of their own. Returns the rows per table; the number that left the source, counted
    as they were written, must be the number that the copy has.

    The reads share no snapshot, so mirror finished releases only; those do not change. Name
    the release in the manifest of the copy after this has returned (``write_manifest``): readers
    find releases by the manifest, so they never see one that is half written. A run that failed
    is repeated.
    """
    written = {}
    for table in tables:
        sent = Observation(f"mirror-{table}")
        rows = source(table).observe(sent, F.count(F.lit(1)).alias("n"))
        schema = (schemas or {}).get(table)
        write_release(rows, out, table, release, schema)
        written[table] = release_table(spark, out, table, release, schema).count()
        if sent.get["n"] != written[table]:
            raise RuntimeError(f"{table}: {sent.get['n']} rows read, {written[table]} in the copy")
    return written


def mirror_store(
    spark: SparkSession,
    source: Callable[[str, str], DataFrame],
    tables: Iterable[str],
    releases: Sequence[str],
    current: str,
    out: str,
    schemas: Mapping[str, T.StructType | str] | None = None,
) -> dict[tuple[str, str], int]:
    """Copy several releases and then write the manifest, so that ``read_release`` opens the copy.

    ``source`` takes the name of a table and of a release.
    """
    tables, written = list(tables), {}
    for release in releases:

        def of_release(table: str, release: str = release) -> DataFrame:
            return source(table, release)

        counts = mirror_release(spark, of_release, tables, release, out, schemas)
        written |= {(release, table): n for table, n in counts.items()}
    write_manifest(spark, f"{out}/manifest.json", releases, current)
    return written


def conformed(
    df: DataFrame, table: str, release: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """The columns of a table as they are written: those of its schema, cast to its types."""
    wanted = _columns(table, schema)
    missing = [f.name for f in wanted if f.name not in df.columns and f.name not in OPTIONAL]
    if missing:
        raise ValueError(f"{table} of release {release} has no {', '.join(missing)}")
    left_out = [name for name in df.columns if name not in {*wanted.names, "release"}]
    if left_out:
        warnings.warn(f"not written to {table}: {', '.join(left_out)}", stacklevel=3)
    present = [f for f in wanted if f.name in df.columns]
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in present))


def _columns(table: str, schema: T.StructType | str | None) -> T.StructType:
    columns = ENTITIES[table] if schema is None else schema
    return T.StructType.fromDDL(columns) if isinstance(columns, str) else columns


def _reader(spark: SparkSession, table: str, schema: T.StructType | str | None):
    columns = _columns(table, schema)
    # The release is always STRING. Left to inference, "2018.10" would be read as 2018.1.
    return spark.read.schema(T.StructType([*columns, T.StructField("release", T.StringType())]))


def release_directory(base: str, table: str, release: str) -> str:
    if not RELEASE_NAME.fullmatch(release):
        raise ValueError(f"not a release name: {release!r}")
    return f"{base}/{table}/release={release}"
