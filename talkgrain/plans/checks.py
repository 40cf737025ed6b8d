"""What a release must keep to, checked when it has been written and before it is named."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkgrain.operators.utterances import one_per_transcript
from talkgrain.sources.releases import release_table


def corpus_conflicts(rows: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Transcripts some of whose ``rows`` (utterances or tokens) are stored under another corpus.

    Gives ``transcript_id``, ``stored``, ``corpus`` (of the transcript) and ``n_rows``. The rows are
    counted by transcript and corpus before they meet the transcripts. A NULL in the stored column
    is no conflict, and neither are rows of no transcript.
    """
    stored = rows.where("transcript_id IS NOT NULL AND corpus IS NOT NULL")
    counted = stored.groupBy("transcript_id", F.col("corpus").alias("stored")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    joined = counted.join(one_per_transcript(transcripts, ["corpus"]), "transcript_id")
    differ = ~F.col("stored").eqNullSafe(F.col("corpus"))
    return joined.where(differ).select("transcript_id", "stored", "corpus", "n_rows")


def check_release(spark: SparkSession, base: str, release: str, tables=("utterances", "tokens")) -> None:
    """Stop if the corpus stored on utterances or tokens is not that of their transcript.

    An analysis of some corpora skips rows by the stored corpus, so a row with a wrong one would be
    missing. Run it on a release that has been written before the manifest names it.
    """
    transcripts = release_table(spark, base, "transcripts", release)
    for table in tables:
        wrong = corpus_conflicts(release_table(spark, base, table, release), transcripts).head(1)
        if wrong:
            row = wrong[0]
            raise ValueError(
                f"{table} of release {release}: {row['n_rows']} rows of transcript {row['transcript_id']} "
                f"are stored under corpus {row['stored']!r}, the transcript is of {row['corpus']!r}"
            )
