"""Entity tables of a release. Every read passes one of these, so nothing is inferred.

Columns a release does not have yet (``phonology`` in the early ones) read as NULL. ``corpus`` on
utterances and tokens is that of their transcript, kept there so that a pick of corpora can skip
the others in the scan.
"""

from pyspark.sql import types as T

CORPORA = T.StructType(
    [
        T.StructField("corpus", T.StringType()),
        T.StructField("collection", T.StringType()),
    ]
)

TRANSCRIPTS = T.StructType(
    [
        T.StructField("transcript_id", T.LongType()),
        T.StructField("corpus", T.StringType()),
        T.StructField("collection", T.StringType()),
    ]
)

UTTERANCES = T.StructType(
    [
        T.StructField("transcript_id", T.LongType()),
        T.StructField("utterance_order", T.LongType()),
        T.StructField("corpus", T.StringType()),
        T.StructField("speaker", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("phonology", T.StringType()),
    ]
)

TOKENS = T.StructType(
    [
        T.StructField("transcript_id", T.LongType()),
        T.StructField("utterance_order", T.LongType()),
        T.StructField("corpus", T.StringType()),
        T.StructField("speaker", T.StringType()),
        T.StructField("token_order", T.LongType()),
        T.StructField("word", T.StringType()),
    ]
)

# May be absent from what is written; they are then read as NULL.
OPTIONAL = ("corpus", "phonology", "collection")

# A release is sorted by these, of the columns it has, inside each file.
PICKED_BY = ("corpus", "speaker")

ENTITIES = {
    "corpora": CORPORA,
    "transcripts": TRANSCRIPTS,
    "utterances": UTTERANCES,
    "tokens": TOKENS,
}
