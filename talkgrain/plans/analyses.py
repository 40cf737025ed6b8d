"""The three analyses, from a release to a stamped result."""

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkgrain.operators.filters import for_corpora, for_speakers
from talkgrain.operators.measures import (
    growth_curve,
    growth_curve_by_transcript,
    population,
    word_frequency,
)
from talkgrain.operators.utterances import of_transcripts
from talkgrain.operators.versions import stamp_release
from talkgrain.sources.manifest import load_manifest, resolve_release
from talkgrain.sources.releases import release_table
from talkgrain.sources.scans import broadcast_if_small, spread


Names = Iterable[str] | None


def frequency(
    spark: SparkSession,
    base: str,
    speakers: Names = None,
    corpora: Names = None,
    version: str | None = None,
    spread_scan: bool = False,
) -> DataFrame:
    """Word counts by speaker."""
    release = _release(spark, base, version)
    utterances = _utterances(spark, base, release, speakers, corpora, spread_scan)
    return stamp_release(word_frequency(utterances), release)


def derived_measures(
    spark: SparkSession,
    base: str,
    measure: str,
    time_col: str = "utterance_order",
    bin_width: float = 1,
    speakers: Names = None,
    corpora: Names = None,
    version: str | None = None,
    spread_scan: bool = False,
    schema: T.StructType | str | None = None,
    transcripts_schema: T.StructType | str | None = None,
) -> DataFrame:
    """Growth curve of ``mlu_w`` or ``ttr`` by speaker.

    The time is a column of the utterances (of ``schema``, if they have columns of their own) or,
    with ``transcripts_schema``, one of the transcripts, such as the age at a recording.
    """
    release = _release(spark, base, version)
    utterances = _utterances(spark, base, release, speakers, corpora, spread_scan, schema)
    if transcripts_schema is None:
        curve = growth_curve(utterances, measure, time_col, bin_width)
    else:
        transcripts = release_table(spark, base, "transcripts", release, transcripts_schema)
        curve = growth_curve_by_transcript(utterances, transcripts, measure, time_col, bin_width)
    return stamp_release(curve, release)


def population_properties(
    spark: SparkSession,
    base: str,
    speakers: Names = None,
    corpora: Names = None,
    version: str | None = None,
    spread_scan: bool = False,
) -> DataFrame:
    """Number of utterances and of words by corpus and speaker.

    Utterances of no transcript are counted with a NULL corpus, unless corpora are picked.
    """
    release = _release(spark, base, version)
    transcripts = release_table(spark, base, "transcripts", release)
    if corpora is not None:
        corpora = list(corpora)
        transcripts = for_corpora(transcripts, corpora)
    utterances = _utterances(spark, base, release, speakers, corpora, spread_scan).drop("corpus")
    return stamp_release(population(utterances, transcripts), release)


def _release(spark: SparkSession, base: str, version: str | None) -> str:
    return resolve_release(load_manifest(spark, f"{base}/manifest.json"), version)


def _utterances(
    spark: SparkSession,
    base: str,
    release: str,
    speakers: Names,
    corpora: Names,
    spread_scan: bool,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """What an analysis measures: picked first, and only then spread, where that is asked for."""
    utterances = release_table(spark, base, "utterances", release, schema)
    if speakers is not None:
        utterances = for_speakers(utterances, speakers)
    if corpora is not None:
        corpora = list(corpora)
        if "corpus" in utterances.columns:
            # Lets the scan skip other corpora; a release without the column has NULL there. The
            # stored corpus is that of the transcript, which ``check_release`` makes sure of.
            utterances = utterances.where(
                F.col("corpus").isin(corpora) | F.col("corpus").isNull()
            )
        # Rows without a stored corpus are picked by their transcript. If the transcripts that are
        # picked fit in memory, no text is shuffled for it.
        picked = for_corpora(release_table(spark, base, "transcripts", release), corpora)
        utterances = of_transcripts(utterances, broadcast_if_small(picked.select("transcript_id")))
    keys = [c for c in ("transcript_id", "utterance_order") if c in utterances.columns]
    return spread(utterances, keys) if spread_scan else utterances
