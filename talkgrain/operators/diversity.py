"""Lexical diversity beyond the pooled type-token ratio."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkgrain.functions.text import array_length, plain, ratio, runs
from talkgrain.operators.numbering import alike, running_total, written
from talkgrain.sources.scans import broadcast_if_small

# How many runs a chunk is long, and how many words a task takes at most of chunks dealt out whole.
_RUNS, _MOST_CHUNK = 64, 1_000_000


def moving_type_token_ratio(
    utterances: DataFrame,
    window: int = 100,
    by: Sequence[str] = ("speaker",),
    order: Sequence[str] = ("transcript_id", "utterance_order"),
) -> DataFrame:
    """The type-token ratio of each run of ``window`` words, averaged over all runs of a group.

    Takes utterances with ``text`` (or ``words``, see ``tokenize``). The words of a group are one
    sequence, in ``order``, which should tell its utterances apart. Returns the group, ``n_tokens``,
    ``n_windows`` (0 for a group of fewer words) and ``mttr`` (then NULL).

    No run is counted by itself. A word counts in the runs that hold it but not its previous
    occurrence; their number follows from the two places, and the sum over all words is that of
    all distinct counts, so the work grows with the words, whatever the window. Places are running
    totals over the whole table. A previous occurrence further back than a run does not matter, so
    words are looked up within chunks of ``_RUNS`` runs, each with the words of the one run before
    it: no group, nor a word that it repeats, is ever brought together. Chunks of a bounded length
    are dealt out whole; longer ones, of long runs, word by word.
    """
    if window < 1:
        raise ValueError("window must be positive")
    stated = "words" in utterances.columns

    # Words of a text hold no space: as one string they take half the bytes of an array.
    def packed(array: Column) -> Column:
        return array if stated else F.array_join(array, " ")

    def unpacked(column: Column) -> Column:
        return column if stated else F.split(column, " ")

    found = F.col("words") if stated else runs(F.col("text"))
    words = packed(F.col("_words"))
    places = [F.col(c).alias(f"_by_{c}") for c in order]
    # Written, so that words are cut once and not again for the ranges and the groups.
    cut = written(
        utterances.select(*by, *places, found.alias("_words")).select(
            *by,
            *(f"_by_{c}" for c in order),
            array_length(F.col("_words")).alias("_size"),
            (words if stated else plain(words)).alias("_words"),
        ),
        "words",
    )
    groups = cut.groupBy(*by).agg(F.sum("_size").alias("n_tokens"))
    # One row a group: the words of a common one do not meet in a task for it.
    starts = running_total(groups, by, "n_tokens", "_start").select(
        *(F.col(c).alias(f"_of_{c}") for c in by), "_start", F.col("n_tokens").alias("_all")
    )
    starts = broadcast_if_small(written(starts.where(F.col("_all") >= window), "starts"))
    spoken = cut.where("_size > 0")
    placed = running_total(spoken, [*by, *(f"_by_{c}" for c in order)], "_size", "_before")
    chunk = _RUNS * window
    first, end = F.col("first"), F.col("first") + F.col("_size")
    own = F.col("chunk") * chunk
    # An utterance is cut where a chunk begins, and its end may also be the run before the next.
    held = (
        placed.join(starts, alike(by, "_of_"))
        .select(*by, "_size", "_words", (F.col("_all") - window).alias("last"), (F.col("_before") - F.col("_start")).alias("first"))
        .select("*", F.explode(F.sequence(F.floor(first / chunk), F.floor((end - 1 + window) / chunk))).alias("chunk"))
        .withColumn("at", F.greatest(first, own - window))
    )
    piece = F.slice(
        unpacked(F.col("_words")),
        (F.col("at") - first + 1).cast("int"),
        (F.least(end, own + chunk) - F.col("at")).cast("int"),
    )
    pieces = held.select(*by, "chunk", "last", "at", packed(piece).alias("piece"))
    if chunk <= _MOST_CHUNK:
        total = groups.agg(F.sum("n_tokens")).first()[0] or 0
        pieces = pieces.repartition(total // _MOST_CHUNK + 1, *by, "chunk")
    # The last place where a run begins is the same for a whole group.
    tokens = (
        pieces.select(*by, "chunk", "last", "at", F.posexplode(unpacked(F.col("piece"))))
        .select(*by, "chunk", "last", (F.col("at") + F.col("pos")).alias("at"), F.col("col").alias("word"))
    )
    # The hash only makes the sort quick: rows that differ in it differ in one of the others.
    key = [*by, "chunk", "word"]
    hashed = tokens.withColumn("_hash", F.xxhash64("chunk", "word"))
    before = F.lag("at").over(Window.partitionBy("_hash", *key).orderBy("at"))
    since = hashed.withColumn("before", before).where(F.col("at") >= own)
    first_run = F.greatest(F.col("at") - window + 1, F.coalesce("before", F.lit(-1)) + 1, F.lit(0))
    n_runs = F.greatest(F.least("at", "last") - first_run + 1, F.lit(0))
    sums = since.groupBy(*(F.col(c).alias(f"_of_{c}") for c in by)).agg(F.sum(n_runs).alias("types"))
    n_windows = F.greatest(F.col("n_tokens") - window + 1, F.lit(0)).cast("long")
    joined = groups.join(sums, alike(by, "_of_"), "left").withColumn("n_windows", n_windows)
    return joined.select(
        *by, "n_tokens", "n_windows", ratio(F.col("types"), window * F.col("n_windows")).alias("mttr")
    )


def type_sketches(
    utterances: DataFrame, by: Sequence[str] = ("transcript_id", "speaker"), precision: int = 12
) -> DataFrame:
    """What a type-token ratio of any coarser grouping can be estimated from without the text.

    Returns the group, ``n_tokens`` and ``types``, a sketch of its distinct words: some kilobytes at
    most, however many they are (2 to the power of ``precision`` registers). Sketches add up, so
    those by transcript and speaker, stored with a release, answer for corpora, ages or all of it.
    """
    array = F.col("words") if "words" in utterances.columns else runs(F.col("text"))
    found = utterances.select(*by, F.explode_outer(array).alias("run"))
    word = plain(F.col("run"))
    return found.groupBy(*by).agg(
        F.count("run").alias("n_tokens"), F.hll_sketch_agg(word, precision).alias("types")
    )


def estimated_type_token_ratio(sketches: DataFrame, by: Sequence[str] = ("speaker",)) -> DataFrame:
    """As ``type_token_ratio`` for any grouping by columns of ``sketches``, with ``n_types`` estimated.

    ``n_tokens`` is exact. The standard error of ``n_types`` is about 0.8 over the square root of the
    number of registers, 1.3 % at a precision of 12, whatever was united. Use ``type_token_ratio``
    where the text may be read; it is exact.
    """
    united = sketches.groupBy(*by).agg(
        F.hll_sketch_estimate(F.hll_union_agg("types")).alias("n_types"),
        F.sum("n_tokens").alias("n_tokens"),
    )
    united = united.select(*by, "n_types", "n_tokens")
    return united.withColumn("ttr", ratio(F.col("n_types"), F.col("n_tokens")))
