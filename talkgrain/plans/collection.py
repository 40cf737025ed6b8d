"""A whole collection from its files: corpora, transcripts, participants, utterances and tokens.

The files are parsed once, into a table in the shared folder; the five tables are made from it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkgrain.operators.numbering import numbered, written
from talkgrain.operators.utterances import tokens
from talkgrain.sources.scans import broadcast_if_small
from talkgrain.sources.xml import TranscriptLayout, scan, utterance_columns

# The folder that a file is in.
FOLDER = r"([^/]+)/[^/]*$"


@dataclass(frozen=True)
class CollectionLayout(TranscriptLayout):
    """Where the parts of a transcript are found in a row of the XML scan.

    ``row_tag`` is the element of a transcript and ``utterances`` its array. The natural key is the
    field ``transcript_id``, or the path of the file if that is None. ``corpus`` is a field of the
    row; None takes the first group of ``corpus_pattern`` in the path, which is the folder of the
    file. ``collection`` is a field, such as the bank a corpus belongs to. ``participants`` is an
    array of structs with the field ``participant``, the name that utterances are spoken under, and
    ``role``. ``details`` are more fields of the row, kept on the transcripts.
    """

    corpus: str | None = None
    corpus_pattern: str = FOLDER
    collection: str | None = None
    participants: str | None = None
    participant: str | None = None
    role: str | None = None
    details: tuple[str, ...] = ()

    def __post_init__(self):
        super().__post_init__()
        if self.utterances is None:
            raise ValueError("row_tag must be the element of a transcript, with its utterances")
        if (self.participants is None) != (self.participant is None):
            raise ValueError("name both the participants and the field that utterances refer to")
        if re.compile(self.corpus_pattern).groups != 1:
            raise ValueError("corpus_pattern must have one group")


@dataclass(frozen=True)
class Collection:
    """The tables of a collection; ``transcript_id`` and ``corpus`` are the same in all of them."""

    corpora: DataFrame
    transcripts: DataFrame
    participants: DataFrame
    utterances: DataFrame
    tokens: DataFrame


def ingest_collection(
    spark: SparkSession, path: str, layout: CollectionLayout, known: DataFrame | None = None
) -> Collection:
    """The tables of all transcript files under ``path``.

    - ``corpora``: ``corpus``, ``collection``, ``n_transcripts``.
    - ``transcripts``: ``transcript_id``, ``transcript_key``, ``corpus``, ``collection`` and the details.
    - ``participants``: ``transcript_id``, ``corpus``, ``speaker``, ``role``.
    - ``utterances``: ``transcript_id``, ``utterance_order``, ``corpus``, ``speaker``, ``role`` (of the
      participant that ``speaker`` names, NULL if it names none), ``text``, ``phonology``, and
      ``words`` if the layout has word elements.
    - ``tokens``: as ``tokens`` makes them.

    A transcript is known by its corpus and its natural key, which may be any text; two with the
    same stop the run. Ids are LONG: the place in the order of (corpus, key) over the whole
    collection, so that the same files always give the same ids, however they are shared out.
    ``known`` (``transcript_id``, ``transcript_key``, ``corpus``) is an earlier release: transcripts
    in it keep their id, and new ones are numbered after the largest.
    """
    rows = scan(spark, path, layout)
    file = F.col("_metadata.file_path")
    key = F.col(layout.transcript_id).cast("string") if layout.transcript_id else file
    in_path = F.regexp_extract(file, layout.corpus_pattern, 1)
    corpus = F.col(layout.corpus).cast("string") if layout.corpus else in_path

    def field(name: str | None) -> Column:
        return F.col(name).cast("string") if name else F.lit(None).cast("string")

    parsed = rows.select(
        key.alias("transcript_key"),
        corpus.alias("corpus"),
        field(layout.collection).alias("collection"),
        *(F.col(name) for name in layout.details),
        _people(layout).alias("people"),
        F.col(layout.utterances).alias("utterances"),
    )
    parsed = written(parsed, "parsed-transcripts")
    identified = parsed.join(
        broadcast_if_small(written(_ids(parsed, known), "transcript-ids")),
        F.col("corpus").eqNullSafe(F.col("_corpus")) & F.col("transcript_key").eqNullSafe(F.col("_key")),
    ).drop("_corpus", "_key")

    corpora = parsed.groupBy("corpus").agg(
        F.collect_set("collection").alias("in"), F.count(F.lit(1)).alias("n_transcripts")
    )
    several = F.raise_error(F.lit("a corpus is in more than one collection"))
    collection = F.when(F.size("in") <= 1, F.get("in", F.lit(0))).otherwise(several)
    corpora = corpora.select("corpus", collection.alias("collection"), "n_transcripts")

    transcripts = identified.select(
        "transcript_id", "transcript_key", "corpus", "collection", *layout.details
    )
    participants = identified.select("transcript_id", "corpus", F.inline("people"))
    spoken = identified.select(
        "transcript_id", "corpus", "people", F.posexplode("utterances").alias("position", "utterance")
    )
    kept = {name: F.col(name) for name in ("transcript_id", "corpus", "people")}
    utterances = utterance_columns(
        spoken, layout, F.col("utterance").getField, F.col("position") + 1, kept
    )
    role = F.get(F.filter("people", lambda p: p["speaker"] == F.col("speaker")), F.lit(0))["role"]
    phonology = F.col("phonology") if layout.phonology else F.lit(None).cast("string")
    utterances = utterances.select(
        "transcript_id",
        "utterance_order",
        "corpus",
        "speaker",
        role.alias("role"),
        "text",
        phonology.alias("phonology"),
        *(["words"] if layout.words else []),
    )
    return Collection(corpora, transcripts, participants, utterances, tokens(utterances))


def _people(layout: CollectionLayout) -> Column:
    kind = "array<struct<speaker:string,role:string>>"
    if layout.participants is None:
        return F.array().cast(kind)

    def person(p: Column) -> Column:
        role = p[layout.role].cast("string") if layout.role else F.lit(None).cast("string")
        return F.struct(p[layout.participant].cast("string").alias("speaker"), role.alias("role"))

    return F.coalesce(F.transform(layout.participants, person), F.array().cast(kind))


def _ids(parsed: DataFrame, known: DataFrame | None) -> DataFrame:
    """``_corpus``, ``_key`` and ``transcript_id`` of each transcript."""
    counted = parsed.groupBy(F.col("corpus").alias("_corpus"), F.col("transcript_key").alias("_key")).agg(
        F.count(F.lit(1)).alias("n")
    )
    twice = counted.where("n > 1").head(1)
    if twice:
        raise ValueError(f"more than one transcript {twice[0]['_key']!r} in corpus {twice[0]['_corpus']!r}")
    keys, first = counted.drop("n"), 1
    if known is None:
        return numbered(keys, ["_corpus", "_key"], "transcript_id", first)
    earlier = known.select(
        F.col("corpus").alias("_old_corpus"), F.col("transcript_key").alias("_old_key"), "transcript_id"
    )
    first += earlier.agg(F.max("transcript_id")).first()[0] or 0
    same = F.col("_corpus").eqNullSafe(F.col("_old_corpus")) & F.col("_key").eqNullSafe(F.col("_old_key"))
    kept = keys.join(earlier, same).select("_corpus", "_key", "transcript_id")
    fresh = numbered(keys.join(earlier, same, "anti"), ["_corpus", "_key"], "transcript_id", first)
    return kept.unionByName(fresh)
