"""Analytics over large, versioned collections of transcripts, as Spark DataFrame functions."""

from talkgrain.functions import ratio, word_count, words
from talkgrain.operators import (
    MeasureState,
    changed_transcripts,
    common_type,
    compare_releases,
    compare_utterances,
    estimated_type_token_ratio,
    for_corpora,
    for_speakers,
    growth_curve,
    growth_curve_by_transcript,
    lines_as_utterances,
    match_transcripts,
    measure_state,
    mlu_w,
    moving_type_token_ratio,
    numbered,
    numbered_within,
    population,
    population_tokens,
    population_utterances,
    running_total,
    stamp_release,
    state_frequency,
    state_mlu_w,
    state_population,
    state_type_token_ratio,
    tokenize,
    tokens,
    transcript_digests,
    type_sketches,
    type_token_ratio,
    under_old_ids,
    union_releases,
    updated_state,
    with_corpus,
    word_frequency,
)
from talkgrain.plans import (
    Collection,
    CollectionLayout,
    check_release,
    corpus_conflicts,
    ingest_collection,
    register_sql,
)
from talkgrain.sources import (
    JdbcSplit,
    TranscriptLayout,
    broadcast_if_small,
    bucketed_table,
    differing_ranges,
    ingest_transcripts,
    jdbc_tables,
    load_manifest,
    mirror_ranges,
    mirror_release,
    mirror_store,
    multiset_digest,
    read_release,
    read_release_jdbc,
    read_releases,
    release_table,
    resolve_release,
    spread,
    write_bucketed,
    write_manifest,
    write_release,
)

__all__ = [
    "Collection",
    "CollectionLayout",
    "JdbcSplit",
    "MeasureState",
    "TranscriptLayout",
    "broadcast_if_small",
    "bucketed_table",
    "changed_transcripts",
    "check_release",
    "common_type",
    "compare_releases",
    "compare_utterances",
    "corpus_conflicts",
    "differing_ranges",
    "estimated_type_token_ratio",
    "for_corpora",
    "for_speakers",
    "growth_curve",
    "growth_curve_by_transcript",
    "ingest_collection",
    "ingest_transcripts",
    "jdbc_tables",
    "lines_as_utterances",
    "load_manifest",
    "match_transcripts",
    "measure_state",
    "mirror_ranges",
    "mirror_release",
    "mirror_store",
    "mlu_w",
    "moving_type_token_ratio",
    "multiset_digest",
    "numbered",
    "numbered_within",
    "population",
    "population_tokens",
    "population_utterances",
    "ratio",
    "read_release",
    "read_release_jdbc",
    "read_releases",
    "register_sql",
    "release_table",
    "resolve_release",
    "running_total",
    "spread",
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
    "word_count",
    "word_frequency",
    "words",
    "write_bucketed",
    "write_manifest",
    "write_release",
]
