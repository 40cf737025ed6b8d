"""Transcript files in XML.

The layout of the files is the caller's: ``TranscriptLayout`` names the fields, nothing is
built in.
"""

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class TranscriptLayout:
    """Where the parts of an utterance are found in a row of the XML scan.

    ``utterances`` names the array of a transcript row that holds its utterances; None when
    ``row_tag`` is the utterance element itself. ``transcript_id`` is a field of the row, the
    others are fields of the utterance. ``order`` None numbers the array from 1. The text is
    either one field (``text``) or an array of word elements (``words``). Word elements that have
    attributes or annotation inside them are structs; ``word`` names the field with their text.
    ``phonology`` is the field of the phonological transcription, where there is one. Ids are cast to
    ``id_type``: STRING for transcripts that are named by a text.
    """

    row_tag: str
    schema: T.StructType
    transcript_id: str | None
    speaker: str
    text: str | None = None
    words: str | None = None
    order: str | None = None
    utterances: str | None = None
    word: str | None = None
    phonology: str | None = None
    id_type: str = "long"

    def __post_init__(self):
        if (self.text is None) == (self.words is None):
            raise ValueError("name either the text field or the words field")
        if self.utterances is None and self.order is None:
            raise ValueError("utterances that are rows need a field for their order")


def ingest_transcripts(
    spark: SparkSession, path: str, layout: TranscriptLayout, split_files: bool = False
) -> DataFrame:
    """The utterances of the transcript files under ``path``.

    Gives ``transcript_id``, ``utterance_order``, ``speaker``, ``text``, ``phonology`` if the layout names
    it, and with word elements also ``words``, the elements as they are, whose text is joined with spaces. ``tokens`` and
    the measures take the words from there and cut no text. A file that does not parse stops the
    run instead of leaving rows of NULLs, and so does markup inside a word that is read as text.

    The files are shared out over the tasks, and a file is read by one task, row by row. For
    files too large for that, ``split_files`` cuts UTF-8 files at the closing tags of the rows,
    so that many tasks share one file. It gives the same rows, or stops the run where it cannot:
    where a row is not closed by exactly ``</row_tag>``, such as an empty ``<row_tag/>``, and where a
    comment or CDATA section reaches over a closing tag. It reads the files once more before,
    to count the openings and closings of each.
    """
    if layout.transcript_id is None:
        raise ValueError("name the field of the transcript; its file is used by ingest_collection only")
    rows = _split_scan(spark, path, layout) if split_files else scan(spark, path, layout)
    own = {"transcript_id": F.col(layout.transcript_id).cast(layout.id_type)}
    if layout.utterances is None:
        return utterance_columns(rows, layout, F.col, None, own)
    parts = rows.select(
        F.col(layout.transcript_id), F.posexplode(layout.utterances).alias("position", "utterance")
    )
    field = F.col("utterance").getField
    return utterance_columns(parts, layout, field, F.col("position") + 1, own)


def utterance_columns(
    parts: DataFrame,
    layout: TranscriptLayout,
    field: Callable[[str], Column],
    position: Column | None,
    own: Mapping[str, Column],
) -> DataFrame:
    """The columns ``own`` and those of an utterance, whose fields ``field`` gives by their name."""
    order = field(layout.order) if layout.order else position
    columns = [
        *(column.alias(name) for name, column in own.items()),
        order.cast("long").alias("utterance_order"),
        field(layout.speaker).alias("speaker"),
    ]
    phonology = [field(layout.phonology).alias("phonology")] if layout.phonology else []
    if layout.text is not None:
        return parts.select(*columns, field(layout.text).alias("text"), *phonology)
    words = field(layout.words)
    if layout.word is not None:
        words = words.getField(layout.word)
    # No word elements read as NULL; such an utterance exists and has an empty text.
    words = F.coalesce(F.array_compact(words), F.array().cast("array<string>"))
    text = F.array_join("words", " ")
    nested = F.raise_error(F.lit("a word holds markup: read it as a struct and name its text field"))
    return parts.select(*columns, words.alias("words"), *phonology).select(
        *own,
        "utterance_order",
        "speaker",
        F.when(text.rlike(r"</[^>]+>|/>"), nested).otherwise(text).alias("text"),
        *(["phonology"] if phonology else []),
        "words",
    )


def scan(spark: SparkSession, path: str, layout: TranscriptLayout) -> DataFrame:
    return (
        spark.read.schema(layout.schema)
        .format("xml")
        .option("rowTag", layout.row_tag)
        .option("mode", "FAILFAST")
        .load(path)
    )


def _split_scan(spark: SparkSession, path: str, layout: TranscriptLayout) -> DataFrame:
    closing = f"</{layout.row_tag}>"
    opening = rf"<{re.escape(layout.row_tag)}[\s/>]"
    pieces = spark.read.option("lineSep", closing).text(path)
    # A closing tag inside a comment or CDATA section cuts it, and its ends are left over.
    bare = F.regexp_replace("value", r"(?s)<!--.*?-->", "")
    no_data = F.regexp_replace(bare, r"(?s)<!\[CDATA\[.*?\]\]>", "")
    pieces = pieces.select(
        bare.alias("bare"),
        F.regexp_count(no_data, F.lit(opening)).alias("openings"),
        no_data.rlike(r"<!--|-->|<!\[CDATA\[|\]\]>").alias("cut"),
        F.octet_length("value").alias("size"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("file_size"),
    )
    again = "read with split_files=False"
    # What the pieces do not hold of a file are its closing tags.
    files = pieces.groupBy("file", "file_size").agg(
        F.sum("openings").alias("openings"), F.sum("size").alias("size")
    )
    closings = (F.col("file_size") - F.col("size")) / len(closing.encode())
    uneven = files.where(F.col("openings") != closings).head(1)
    if uneven:
        raise ValueError(
            f"{uneven[0]['file']}: not every row that opens is closed by {closing}: {again}"
        )
    unclosed = F.raise_error(F.lit(f"a row is not closed by {closing}: {again}"))
    across = F.raise_error(F.lit(f"a comment or CDATA section holds {closing}: {again}"))
    # What follows the last row of a file opens none.
    row = (
        F.when(F.col("cut"), across)
        .when(F.col("openings") > 1, unclosed)
        .otherwise(F.concat(F.regexp_extract("bare", rf"(?s){opening}.*", 0), F.lit(closing)))
    )
    return (
        pieces.where((F.col("openings") > 0) | F.col("cut"))
        .select(F.from_xml(row, layout.schema, {"mode": "FAILFAST"}).alias("row"))
        .select("row.*")
    )
