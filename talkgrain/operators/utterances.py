"""Row-level steps between text, utterances, tokens and corpora."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkgrain.functions.text import array_length, plain, runs, words


def tokenize(utterances: DataFrame) -> DataFrame:
    """Add ``words`` (lower-cased, in order) and ``n_tokens`` (LONG, 0 for NULL text)."""
    return utterances.withColumn("words", words(F.col("text"))).withColumn(
        "n_tokens", array_length(F.col("words"))
    )


def tokens(utterances: DataFrame) -> DataFrame:
    """One row per word, with its position in the utterance counted from 1.

    A ``corpus`` of the utterances is kept.
    """
    array = F.col("words") if "words" in utterances.columns else runs(F.col("text"))
    names = ["transcript_id", "utterance_order", "speaker"]
    if "corpus" in utterances.columns:
        names.insert(2, "corpus")
    return utterances.select(*names, F.posexplode(array).alias("position", "word")).select(
        *names,
        (F.col("position") + 1).cast("long").alias("token_order"),
        plain(F.col("word")).alias("word"),
    )


def lines_as_utterances(documents: DataFrame) -> DataFrame:
    """One utterance per line of each document, in order, counted from 1.

    The document is the transcript, its ``source`` the corpus and its ``lang`` the speaker.
    """
    return documents.select(
        F.col("doc_id").alias("transcript_id"),
        F.col("source").alias("corpus"),
        F.col("lang").alias("speaker"),
        F.posexplode(F.split("text", "\n")).alias("position", "text"),
    ).select(
        "transcript_id",
        (F.col("position") + 1).cast("long").alias("utterance_order"),
        "corpus",
        "speaker",
        "text",
    )


def with_corpus(utterances: DataFrame, transcripts: DataFrame, salts: int = 1) -> DataFrame:
    """Add the corpus of each utterance's transcript, NULL where it has none.

    Every utterance comes out once: rows that repeat a transcript are one, and a transcript with
    two corpora stops the run. A ``corpus`` that the utterances already have is replaced.

    There is no broadcast hint: ``transcripts`` grows with the collection, so it is left to
    Spark to broadcast it when its size is below ``spark.sql.autoBroadcastJoinThreshold``.
    Above that the join shuffles on ``transcript_id``, and adaptive execution splits a
    partition that one very long transcript has made too big.

    ``salts`` > 1 spreads every transcript over that many partitions without the help of
    adaptive execution. The transcripts, which are small rows, are then repeated ``salts`` times.
    """
    utterances = utterances.drop("corpus")
    corpus_of = one_per_transcript(transcripts, ["corpus"])
    if salts <= 1:
        return utterances.join(corpus_of, "transcript_id", "left")
    # The salt is a hash of the row, not a random number: a task that is run again after an
    # executor loss must send its rows to the same place.
    salted = utterances.withColumn(
        "salt", F.pmod(F.xxhash64("utterance_order"), F.lit(salts)).cast("int")
    )
    repeated = corpus_of.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, ["transcript_id", "salt"], "left").drop("salt")


def of_transcripts(utterances: DataFrame, picked: DataFrame) -> DataFrame:
    """The utterances whose transcript is in ``picked``, each once: a semi join."""
    return utterances.join(picked.select("transcript_id"), "transcript_id", "semi")


def one_per_transcript(transcripts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per transcript with the values of ``columns``; unlike values stop the run."""
    found = F.collect_set(F.struct(*columns)).alias("found")
    several = F.raise_error(F.lit(f"a transcript_id has more than one {', '.join(columns)}"))
    value = F.when(F.size("found") == 1, F.col("found")[0]).otherwise(several)
    grouped = transcripts.where(F.col("transcript_id").isNotNull()).groupBy("transcript_id")
    return grouped.agg(found).select("transcript_id", value.alias("value")).select(
        "transcript_id", "value.*"
    )
