from talkgrain.operators.alignment import compare_utterances
from talkgrain.operators.compare import compare_releases
from talkgrain.operators.diversity import (
    estimated_type_token_ratio,
    moving_type_token_ratio,
    type_sketches,
)
from talkgrain.operators.filters import for_corpora, for_speakers
from talkgrain.operators.increments import (
    MeasureState,
    changed_transcripts,
    measure_state,
    state_frequency,
    state_mlu_w,
    state_population,
    state_type_token_ratio,
    transcript_digests,
    updated_state,
)
from talkgrain.operators.linkage import match_transcripts, under_old_ids
from talkgrain.operators.measures import (
    growth_curve,
    growth_curve_by_transcript,
    mlu_w,
    population,
    population_tokens,
    population_utterances,
    type_token_ratio,
    word_frequency,
)
from talkgrain.operators.numbering import numbered, numbered_within, running_total
from talkgrain.operators.utterances import lines_as_utterances, tokenize, tokens, with_corpus
from talkgrain.operators.versions import common_type, stamp_release, union_releases

__all__ = [
    "MeasureState",
    "changed_transcripts",
    "common_type",
    "compare_releases",
    "compare_utterances",
    "estimated_type_token_ratio",
    "for_corpora",
    "for_speakers",
    "growth_curve",
    "growth_curve_by_transcript",
    "lines_as_utterances",
    "match_transcripts",
    "measure_state",
    "mlu_w",
    "moving_type_token_ratio",
    "numbered",
    "numbered_within",
    "population",
    "population_tokens",
    "population_utterances",
    "running_total",
    "stamp_release",
    "state_frequency",
    "state_mlu_w",
    "state_population",
    "state_type_token_ratio",
    "tokenize",
    "tokens",
    "transcript_digests",
    "type_sketches",
    "type_token_ratio",
    "under_old_ids",
    "union_releases",
    "updated_state",
    "with_corpus",
    "word_frequency",
]
