"""Measures kept up to date from release to release, by what changed between them.

A state holds counts that add up: by group the utterances and words, and by group and word how
often it occurs. All measures come out of it. The state of a new release is that of the old one,
less the counts of the old text of transcripts that changed, and with those of their new text, so
transcripts that are the same in both are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgrain.functions.text import ratio, word_count
from talkgrain.operators.compare import compare_releases
from talkgrain.operators.linkage import utterance_digest
from talkgrain.operators.measures import word_frequency
from talkgrain.operators.numbering import alike
from talkgrain.operators.utterances import of_transcripts
from talkgrain.sources.scans import broadcast_if_small

# Up to so many changed transcripts are named in the filter of the scan, which then skips the row
# groups that have none of them; more are a semi join.
NAMED = 10_000

SIZES = ("n_all", "n_utterances", "n_tokens")


@dataclass(frozen=True)
class MeasureState:
    """Counts of one release: ``sizes`` by group, ``words`` by group and word."""

    by: tuple[str, ...]
    sizes: DataFrame
    words: DataFrame


def transcript_digests(utterances: DataFrame, compared: Sequence[str]) -> DataFrame:
    """What tells whether a transcript changed: ``transcript_id``, ``n_rows``, ``content``.

    ``content`` stands for the ``compared`` columns and the order of its utterances. Written with
    a release, it spares the comparison with the next one from reading the text again.
    """
    row = F.xxhash64("utterance_order", utterance_digest(compared))
    summed = F.sum(row.cast("decimal(38,0)")).cast("string")
    content = F.concat_ws(":", F.hex(F.bit_xor(row)), summed)
    return utterances.groupBy("transcript_id").agg(
        F.count(F.lit(1)).alias("n_rows"), content.alias("content")
    )


def changed_transcripts(old_digests: DataFrame, new_digests: DataFrame) -> DataFrame:
    """``transcript_id`` and ``status`` of the transcripts that are not the same in both releases."""
    compared = compare_releases(
        old_digests, new_digests, ["transcript_id"], ["n_rows", "content"], unique_keys=True
    )
    return compared.where("status <> 'same'").select("transcript_id", "status")


def measure_state(utterances: DataFrame, by: Sequence[str] = ("speaker",)) -> MeasureState:
    """The state of a whole release. ``by`` may hold any columns of the utterances, such as a bin of
    a time for growth curves."""
    counted = utterances.select(*by, word_count(F.col("text")).alias("n"))
    sizes = counted.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_all"),
        F.count_if(F.col("n") > 0).alias("n_utterances"),
        F.sum("n").alias("n_tokens"),
    )
    return MeasureState(tuple(by), sizes, word_frequency(utterances, by))


def updated_state(
    state: MeasureState, old: DataFrame, new: DataFrame, changed: DataFrame
) -> MeasureState:
    """The state of the new release.

    ``state`` is that of the old one, ``old`` and ``new`` are the utterances of both and ``changed``
    has the ids (``transcript_id``) of all transcripts that differ. Counts of the old text are taken
    off and those of the new text added, group by group; groups and words that come to nothing go.
    The old state is never split by transcript, so its size is that of the result.
    """
    gone, come = (measure_state(rows, state.by) for rows in _picked((old, new), changed))
    by = list(state.by)
    return MeasureState(
        state.by,
        _merged(state.sizes, gone.sizes, come.sizes, by, SIZES),
        _merged(state.words, gone.words, come.words, [*by, "word"], ("n",)),
    )


def state_frequency(state: MeasureState) -> DataFrame:
    """As ``word_frequency``."""
    return state.words


def state_mlu_w(state: MeasureState) -> DataFrame:
    """As ``mlu_w``."""
    counts = state.sizes.select(*state.by, "n_utterances", "n_tokens")
    return counts.withColumn("mlu_w", ratio(F.col("n_tokens"), F.col("n_utterances")))


def state_type_token_ratio(state: MeasureState) -> DataFrame:
    """As ``type_token_ratio``: the types of a group are its words that are left."""
    types = state.words.groupBy(*(F.col(c).alias(f"_{c}") for c in state.by)).agg(
        F.count(F.lit(1)).alias("types")
    )
    joined = state.sizes.join(types, alike(state.by, "_"), "left")
    n_types = F.coalesce("types", F.lit(0)).cast("long").alias("n_types")
    counts = joined.select(*state.by, n_types, "n_tokens")
    return counts.withColumn("ttr", ratio(F.col("n_types"), F.col("n_tokens")))


def state_population(state: MeasureState) -> DataFrame:
    """As ``population``."""
    return state.sizes.select(*state.by, F.col("n_all").alias("n_utterances"), "n_tokens")


def _picked(sides: Sequence[DataFrame], changed: DataFrame) -> list[DataFrame]:
    ids = changed.select("transcript_id").where("transcript_id IS NOT NULL").distinct()
    first = [row[0] for row in ids.limit(NAMED + 1).collect()]
    if len(first) <= NAMED:
        picked = [rows.where(F.col("transcript_id").isin(first)) for rows in sides]
    else:
        lookup = broadcast_if_small(ids)
        picked = [of_transcripts(rows, lookup) for rows in sides]
    # Utterances of no transcript have no id to be compared by, and are always counted anew.
    return [p.unionByName(rows.where("transcript_id IS NULL")) for p, rows in zip(picked, sides)]


def _merged(
    state: DataFrame, gone: DataFrame, come: DataFrame, keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    def signed(rows: DataFrame, sign: int) -> DataFrame:
        return rows.select(*keys, *((sign * F.col(v)).alias(v) for v in values))

    stacked = signed(state, 1).unionByName(signed(gone, -1)).unionByName(signed(come, 1))
    summed = stacked.groupBy(*keys).agg(*(F.sum(v).alias(v) for v in values))
    # A group is there as long as it has rows, whatever they hold.
    present: Column = F.col(values[0]) != 0
    return summed.where(present)
