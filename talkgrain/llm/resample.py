"""Importance resampling: documents drawn towards the n-grams of a target text."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgrain.llm.common import pieces, text_key, written
from talkgrain.operators.numbering import numbered

# Fixed value: what stands between words; anything beyond ASCII is part of a word.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Texts that are worked on together.
_ROWS = 1_000


def ngrams(
    texts: pa.Array, longest: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The runs of 1 to ``longest`` words of lower-cased texts, by length.

    Gives the text of each run, its number among the distinct ones, and the CRC-32 of the distinct
    ones, words joined by one space. Words are numbered by Arrow's dictionary; a longer run is the
    number of the run one shorter and that of the word behind it, and only distinct pairs are
    hashed, each from the hash of the shorter run.
    """
    split = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), SEPARATORS)
    words, of = pc.list_flatten(split), pc.list_parent_indices(split)
    # A text that begins or ends with a separator has an empty word there.
    held = pc.greater(pc.binary_length(words), 0)
    coded = pc.dictionary_encode(words.filter(held))
    of = of.filter(held).to_numpy()
    index = coded.indices.to_numpy().astype(np.int64)
    names = coded.dictionary.cast(pa.binary()).to_pylist()
    crcs = np.fromiter(map(zlib.crc32, names), np.int64, len(names))
    yield of, index, crcs
    codes = index
    for n in range(2, longest + 1):
        m = max(0, len(index) - n + 1)
        inside = of[:m] == of[len(of) - m :]
        pairs = codes[:m][inside] * len(names) + index[len(index) - m :][inside]
        distinct, inverse = np.unique(pairs, return_inverse=True)
        before, last = distinct // max(1, len(names)), distinct % max(1, len(names))
        crcs = np.fromiter(
            (zlib.crc32(b" " + names[w], c) for w, c in zip(last.tolist(), crcs[before].tolist())),
            np.int64,
            len(distinct),
        )
        # The places of the longer run, for the next length; none is used outside a text.
        codes = np.zeros(m, np.int64)
        codes[inside] = inverse
        yield of[:m][inside], inverse, crcs


def bucket_counts(docs: DataFrame, buckets: int, longest: int, text_col: str = "text") -> list[int]:
    """How many runs of words of all texts fall in each bucket; one row a bucket and task is moved."""

    def rows(batches):
        counts = np.zeros(buckets, np.int64)
        for batch in pieces(batches, _ROWS):
            for _, codes, crcs in ngrams(batch.column("_text"), longest):
                counts += np.bincount((crcs % buckets)[codes], minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["bucket", "n"])

    source = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    found = source.mapInArrow(rows, "bucket long, n long")
    out = [0] * buckets
    for row in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains_of(source: list[int], target: list[int]) -> list[int]:
    """By bucket, thousandths of the log of how much likelier the target is, one count added."""
    size = len(source)
    all_source, all_target = sum(source), sum(target)
    return [
        math.floor(1000 * math.log((t + 1.0) * (all_source + size) / ((s + 1.0) * (all_target + size))))
        for s, t in zip(source, target)
    ]


def _noise(doc_id: Column, seed: int) -> Column:
    """Thousandths of a Gumbel variate that is drawn from the id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.ln(-F.ln((drawn + 0.5) / 4294967296)))


def weigh(
    docs: DataFrame,
    gains: list[int],
    longest: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id``, ``_key`` (hash of the text), ``n_words``, ``n_features`` and ``weight`` of each row."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(gains)
    id_type = docs.schema[id_col].dataType.simpleString()

    def rows(batches):
        table = pa.array(shared.value, pa.int64())
        for batch in pieces(batches, _ROWS):
            words = None
            features = np.zeros(batch.num_rows, np.int64)
            total = np.zeros(batch.num_rows, np.int64)
            for of, codes, crcs in ngrams(batch.column("_text"), longest):
                taken = pc.take(pc.take(table, pa.array(crcs % len(table))), pa.array(codes)).to_numpy()
                # The runs of a text stand together, so a segment is a text.
                starts = np.flatnonzero(np.diff(of, prepend=-1))
                if len(starts):
                    total[of[starts]] += np.add.reduceat(taken, starts)
                features += np.bincount(of, minlength=batch.num_rows)
                if words is None:
                    words = features.copy()
            weight = np.where(features > 0, total // np.maximum(features, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("_key"),
                    *map(pa.array, (words, features, weight)),
                ],
                ["doc_id", "_key", "n_words", "n_features", "weight"],
            )

    source = docs.select(
        F.col(id_col).alias("doc_id"),
        text_key(F.col(text_col)).alias("_key"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
    )
    schema = f"doc_id {id_type}, _key long, n_words long, n_features long, weight long"
    return source.mapInArrow(rows, schema)


def resample(
    docs: DataFrame,
    target: DataFrame,
    longest: int = 1,
    buckets: int = 10_000,
    seed: int = 2024,
    percent: int = 10,
    least_words: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
) -> DataFrame:
    """Draw ``percent`` in 100 of ``docs`` without replacement, by likeness to ``target``.

    Returns ``doc_id``, ``n_features``, ``weight``, ``score``, ``rank`` (from 1, null if not drawn),
    a row per row of ``docs``. Features are the runs of 1 to ``longest`` words, hashed to buckets
    that are counted over all texts of both sides; a document's weight is the floored mean of their
    gains, and its score adds a Gumbel variate drawn from its id, so the highest scores are a
    sample by weight. Of the documents with ``least_words`` or more that many are drawn, ties going
    to the smaller id, then to the smaller hash of the text.

    Scores are whole thousandths between bounds that the logarithms set, so the counts by score
    that reach the driver are some ten thousand rows whatever the number of documents. Only what
    reaches the lowest drawn score is sorted, by ranges. Null and empty texts have no features, the
    weight 0, and are not drawn; long texts are read whole. A null id draws as an empty name and
    comes after all others. Repeated rows have ranks of their own. Other columns are not read.
    """
    source, wanted = (bucket_counts(d, buckets, longest, c) for d, c in ((docs, text_col), (target, target_col)))
    weighed = weigh(docs, gains_of(source, wanted), longest, id_col, text_col)
    scored = weighed.withColumn("score", F.col("weight") + _noise(F.col("doc_id"), seed))
    table = written(scored, "scores")
    able = F.col("n_words") >= least_words
    counts = table.where(able).groupBy("score").agg(F.count("*").alias("n")).collect()
    drawn = percent * sum(row["n"] for row in counts) // 100
    left, lowest = drawn, None
    for row in sorted(counts, key=lambda row: -row["score"]):
        if left <= 0:
            break
        left, lowest = left - row["n"], row["score"]
    columns = ["doc_id", "n_features", "weight", "score"]
    unranked = F.lit(None).cast("long").alias("rank")
    if lowest is None:
        return table.select(*columns, unranked)
    high = able & (F.col("score") >= lowest)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_key")]
    ranked = numbered(table.where(high), order, "rank")
    rank = F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")
    return ranked.select(*columns, rank).union(table.where(~high).select(*columns, unranked))
