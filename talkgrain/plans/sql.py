"""Releases and measures as SQL table functions, for users who write SQL.

The functions are Spark's own temporary SQL functions, which it expands into the query, so that the
release becomes a partition filter of the scan and only columns that are used are read.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from talkgrain.functions.text import WORD_PATTERN
from talkgrain.schemas import ENTITIES
from talkgrain.sources.manifest import load_manifest, resolve_release
from talkgrain.sources.releases import read_releases

# What the measures take beside the version: names to pick, all if not given.
_PICKS = "speakers ARRAY<STRING> DEFAULT NULL, corpora ARRAY<STRING> DEFAULT NULL"


def register_sql(spark: SparkSession, base: str, prefix: str = "") -> list[str]:
    """Make the releases under ``base`` known to SQL in this session, and return the functions' names.

    - ``corpora(version)``, ``transcripts(version)``, ``utterances(version)`` and ``tokens(version)``:
      the tables of a release, of those that the store has.
    - ``word_frequency``, ``mlu_w``, ``type_token_ratio`` and ``population``, each of ``(version,
      speakers, corpora)``: the measures, with the release they are of.
    - ``word_runs(text)`` and ``word_count(text)``: the words of a text, as written, and their number.

    A version that is not given is the manifest's current one as of now, and one that the manifest
    does not support is an error. ``prefix`` goes before every name, for a second store.

        SELECT * FROM word_frequency(version => '2019.1', speakers => array('CHI')) LIMIT 20
    """
    manifest = load_manifest(spark, f"{base}/manifest.json")
    current = resolve_release(manifest)
    supported = sorted(row["release"] for row in manifest.select("release").collect())
    names: list[str] = []

    def create(name: str, arguments: str, returns: str, body: str) -> None:
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({arguments}) "
            f"RETURNS {returns} RETURN {body}"
        )
        names.append(f"{prefix}{name}")

    listed = ", ".join(f"'{release}'" for release in supported)
    for table, schema in ENTITIES.items():
        try:
            rows = read_releases(spark, base, table)
        except AnalysisException as error:
            # A store need not have every table.
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        rows.createOrReplaceTempView(f"{prefix}all_{table}")
        columns = [*schema.names, "release"]
        typed = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        create(
            table,
            "version STRING DEFAULT NULL",
            f"TABLE ({typed}, release STRING)",
            f"""SELECT {", ".join(columns)} FROM {prefix}all_{table}
            WHERE release = CASE
                WHEN {prefix}{table}.version IS NULL THEN '{current}'
                WHEN {prefix}{table}.version IN ({listed}) THEN {prefix}{table}.version
                ELSE raise_error(concat('release ', {prefix}{table}.version, ' is not supported')) END""",
        )

    runs = f'regexp_extract_all(text, r"{WORD_PATTERN}", 0)'
    count = f"coalesce(array_size({runs}), 0)"
    create("word_runs", "text STRING", "ARRAY<STRING>", runs)
    create("word_count", "text STRING", "BIGINT", count)

    def measure(name: str, returns: str, select: str, group: str) -> None:
        own = f"{prefix}{name}"
        create(
            name,
            f"version STRING DEFAULT NULL, {_PICKS}",
            f"TABLE ({returns}, release STRING)",
            select.format(
                rows=f"""(SELECT * FROM {prefix}utterances({own}.version)
                WHERE ({own}.speakers IS NULL OR array_contains({own}.speakers, speaker))
                  AND ({own}.corpora IS NULL OR array_contains({own}.corpora, corpus)))""",
                runs=runs,
                count=count,
                plain="lower(replace(run, '’', \"'\"))",
            )
            + f" GROUP BY {group}",
        )

    measure(
        "word_frequency",
        "speaker STRING, word STRING, n BIGINT",
        """SELECT speaker, word, count(*), release FROM (
            SELECT speaker, {plain} AS word, release
            FROM (SELECT speaker, release, explode({runs}) AS run FROM {rows}))""",
        "speaker, word, release",
    )
    measure(
        "mlu_w",
        "speaker STRING, n_utterances BIGINT, n_tokens BIGINT, mlu_w DOUBLE",
        """SELECT speaker, count_if(k > 0), sum(k), try_divide(sum(k), count_if(k > 0)), release
        FROM (SELECT speaker, release, {count} AS k FROM {rows})""",
        "speaker, release",
    )
    measure(
        "type_token_ratio",
        "speaker STRING, n_types BIGINT, n_tokens BIGINT, ttr DOUBLE",
        # Counting each word first keeps the words of a common speaker spread over all tasks.
        """SELECT speaker, count(word), sum(n), try_divide(count(word), sum(n)), release FROM (
            SELECT speaker, word, release, count(word) AS n FROM (
                SELECT speaker, {plain} AS word, release
                FROM (SELECT speaker, release, explode_outer({runs}) AS run FROM {rows}))
            GROUP BY speaker, word, release)""",
        "speaker, release",
    )
    measure(
        "population",
        "corpus STRING, speaker STRING, n_utterances BIGINT, n_tokens BIGINT",
        """SELECT corpus, speaker, count(*), sum(k), release
        FROM (SELECT corpus, speaker, release, {count} AS k FROM {rows})""",
        "corpus, speaker, release",
    )
    return names
