"""The measures: word frequency, MLU-w, type-token ratio, population counts, growth curves.

All are counts of counts. Spark folds them inside each scan task before the shuffle, so a
speaker with a third of all utterances costs at most one row per task and group, and no task
ever holds the words of one speaker together.

Each takes utterances with ``text``; a ``words`` or ``n_tokens`` column that is already there
(see ``tokenize``) is used instead of cutting the text again. Word frequency and the type-token
ratio also take a table of tokens, with one ``word`` a row.
"""

from collections.abc import Callable, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkgrain.functions.text import array_length, plain, ratio, runs, word_count
from talkgrain.operators.utterances import one_per_transcript
from talkgrain.sources.scans import broadcast_if_small


def word_frequency(utterances: DataFrame, by: Sequence[str] = ("speaker",)) -> DataFrame:
    """How often each word occurs in the utterances of each group."""
    return (
        _exploded(utterances, by, F.explode)
        .groupBy(*by, "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def mlu_w(utterances: DataFrame, by: Sequence[str] = ("speaker",)) -> DataFrame:
    """Mean length in words of the utterances that have at least one word."""
    return (
        _counted(utterances, by)
        .groupBy(*by)
        .agg(
            F.count_if(F.col("n_tokens") > 0).alias("n_utterances"),
            F.sum("n_tokens").alias("n_tokens"),
        )
        .withColumn("mlu_w", ratio(F.col("n_tokens"), F.col("n_utterances")))
    )


def type_token_ratio(utterances: DataFrame, by: Sequence[str] = ("speaker",)) -> DataFrame:
    """Distinct words over all words, pooled over the group. A group without words gives NULL."""
    # Counting each word first keeps the shuffle on (group, word): the distinct words of a hot
    # group are spread over all tasks, and only their counts meet.
    return _ratio_of_types(_per_word(utterances, by), by)


def population_utterances(
    utterances: DataFrame, by: Sequence[str] = ("corpus", "speaker")
) -> DataFrame:
    """Number of utterances, with or without words, in each group."""
    return utterances.groupBy(*by).agg(F.count(F.lit(1)).alias("n_utterances"))


def population_tokens(
    utterances: DataFrame, by: Sequence[str] = ("corpus", "speaker")
) -> DataFrame:
    """Number of words in each group."""
    return _counted(utterances, by).groupBy(*by).agg(F.sum("n_tokens").alias("n_tokens"))


def population(
    utterances: DataFrame,
    transcripts: DataFrame,
    by: Sequence[str] = ("corpus", "speaker"),
) -> DataFrame:
    """Both population counts in one pass, for utterances that do not carry their corpus.

    The utterances are counted per transcript before the join, so what the join moves is one
    small row per transcript and group instead of every utterance with its text. Utterances of
    no transcript are counted with NULL for what would be looked up.
    """
    own = [name for name in by if name in utterances.columns]
    per_transcript = (
        _counted(utterances, ["transcript_id", *own])
        .groupBy("transcript_id", *own)
        .agg(
            F.count(F.lit(1)).alias("n_utterances"),
            F.sum("n_tokens").alias("n_tokens"),
        )
    )
    looked_up = [name for name in by if name not in own]
    return (
        _looked_up(per_transcript, transcripts, looked_up)
        .groupBy(*by)
        .agg(
            F.sum("n_utterances").alias("n_utterances"),
            F.sum("n_tokens").alias("n_tokens"),
        )
    )


MEASURES = {"mlu_w": mlu_w, "ttr": type_token_ratio}


def growth_curve(
    utterances: DataFrame,
    measure: str,
    time_col: str,
    bin_width: float | str | Decimal = 1,
    by: Sequence[str] = ("speaker",),
    ordered: bool = True,
) -> DataFrame:
    """A measure over time: one row per group and bin, the bin being floor(time / bin_width).

    ``ordered`` sorts the result by group and bin.
    """
    _checked(measure)
    keys = [*by, "bin"]
    result = MEASURES[measure](_binned(utterances, time_col, bin_width), keys)
    return result.orderBy(*keys) if ordered else result


def growth_curve_by_transcript(
    utterances: DataFrame,
    transcripts: DataFrame,
    measure: str,
    time_col: str,
    bin_width: float | str | Decimal = 1,
    by: Sequence[str] = ("speaker",),
    ordered: bool = True,
) -> DataFrame:
    """A measure over a time that the transcripts have, such as the age at a recording.

    For the mean length the text never meets the transcripts: what is joined are counts by
    transcript and group. For the type-token ratio that would be a row for most words of the text,
    so there the text is joined to the bins, which are broadcast if measured to be small, and its
    words are counted by bin at once. Utterances of no transcript, or of one without a time, are in
    the bin NULL.
    """
    _checked(measure)
    keys = [*by, "bin"]
    if measure == "mlu_w":
        per_transcript = mlu_w(utterances, ["transcript_id", *by]).drop("mlu_w")
        placed = _binned(_looked_up(per_transcript, transcripts, [time_col]), time_col, bin_width)
        summed = placed.groupBy(*keys).agg(
            F.sum("n_utterances").alias("n_utterances"), F.sum("n_tokens").alias("n_tokens")
        )
        result = summed.withColumn("mlu_w", ratio(F.col("n_tokens"), F.col("n_utterances")))
    else:
        spoken = next(c for c in ("word", "words", "text") if c in utterances.columns)
        times = one_per_transcript(transcripts, [time_col])
        bins = _binned(times, time_col, bin_width).select("transcript_id", "bin")
        cut = utterances.select("transcript_id", *by, spoken)
        result = type_token_ratio(cut.join(broadcast_if_small(bins), "transcript_id", "left"), keys)
    return result.orderBy(*keys) if ordered else result


def _checked(measure: str) -> None:
    if measure not in MEASURES:
        raise ValueError(f"unknown measure {measure!r}, use one of {sorted(MEASURES)}")


def _binned(rows: DataFrame, time_col: str, bin_width: float | str | Decimal) -> DataFrame:
    """Adds ``bin``. Times and widths that are not whole are divided as decimal numbers, for 0.3
    is not three times 0.1 in binary; a time is rounded to nine places."""
    width = Decimal(str(bin_width))
    if width <= 0:
        raise ValueError("bin_width must be positive")
    whole = isinstance(rows.schema[time_col].dataType, T.IntegralType) and width == int(width)
    if whole:
        time, step = F.col(time_col), F.lit(int(width))
    else:
        time = F.col(time_col).cast("decimal(28,9)")
        step = F.lit(str(width)).cast("decimal(28,9)")
    return rows.withColumn("bin", F.floor(time / step).cast("long"))


def _looked_up(counts: DataFrame, transcripts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts by transcript with columns of the transcripts, NULL for those of no transcript."""
    if not columns:
        return counts
    return counts.join(one_per_transcript(transcripts, columns), "transcript_id", "left")


def _per_word(utterances: DataFrame, by: Sequence[str]) -> DataFrame:
    """How often each word occurs, and a NULL word of no occurrence for a group without words."""
    exploded = _exploded(utterances, by, F.explode_outer)
    return exploded.groupBy(*by, "word").agg(F.count("word").alias("n"))


def _ratio_of_types(per_word: DataFrame, by: Sequence[str]) -> DataFrame:
    return (
        per_word.groupBy(*by)
        .agg(F.count("word").alias("n_types"), F.sum("n").alias("n_tokens"))
        .withColumn("ttr", ratio(F.col("n_types"), F.col("n_tokens")))
    )


def _exploded(
    utterances: DataFrame, by: Sequence[str], explode: Callable[[Column], Column]
) -> DataFrame:
    """The grouping columns and ``word``, one row per word."""
    if "word" in utterances.columns:
        return utterances.select(*by, "word")
    array = F.col("words") if "words" in utterances.columns else runs(F.col("text"))
    return utterances.select(*by, explode(array).alias("run")).select(
        *by, plain(F.col("run")).alias("word")
    )


def _counted(utterances: DataFrame, by: Sequence[str]) -> DataFrame:
    """The grouping columns and ``n_tokens``, without exploding the words."""
    if "n_tokens" in utterances.columns:
        counts = F.col("n_tokens")
    elif "words" in utterances.columns:
        counts = array_length(F.col("words"))
    else:
        counts = word_count(F.col("text"))
    return utterances.select(*by, counts.alias("n_tokens"))
