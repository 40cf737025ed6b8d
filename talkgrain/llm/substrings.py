"""Exact repeated passages, found by doubling the window length."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkgrain.llm.common import (
    LAST_ID,
    bloom_filter,
    in_bloom,
    mixed,
    pieces,
    sliding_min,
    text_key,
    window_hashes,
    written,
)

_SOURCE = "_id long, _key long, _text binary"


def _word_hashes(text: bytes | None) -> np.ndarray:
    words = text.split() if text else []
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _candidates(words: np.ndarray, length: int, blooms: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Starts of the windows whose shorter windows were repeated at every level so far."""
    starts = np.arange(max(0, len(words) - length + 1))
    for level, bloom in blooms:
        if len(starts):
            lowest = sliding_min(window_hashes(words, level), length - level + 1)
            starts = starts[in_bloom(bloom, lowest[starts])]
    return starts


def _level_keys(batches, length, level, blooms) -> Iterator[pa.RecordBatch]:
    """One row per document and distinct key: the least ``level``-word hash inside a window."""
    for batch in pieces(batches):
        ids, keys = [], []
        for i, text in zip(batch.column("_id").to_pylist(), batch.column("_text").to_pylist()):
            words = _word_hashes(text)
            starts = _candidates(words, length, blooms.value)
            if len(starts):
                hashes = window_hashes(words, level)
                found = np.unique(sliding_min(hashes, length - level + 1)[starts])
                keys.append(found)
                ids.append(np.full(len(found), i, np.int64))
        if keys:
            key = np.concatenate(keys)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(np.concatenate(ids))], ["_hash", "_id"]
            )


def _window_rows(batches, length, blooms) -> Iterator[pa.RecordBatch]:
    """One row per window that may be repeated, with 96 bits of hash of its words."""
    for batch in pieces(batches):
        out: list[list[np.ndarray]] = [[], [], [], [], []]
        columns = (batch.column(c).to_pylist() for c in ("_id", "_key", "_text"))
        for i, key, text in zip(*columns):
            words = _word_hashes(text)
            starts = _candidates(words, length, blooms.value)
            if len(starts):
                hashes = window_hashes(words, length)[starts]
                checks = window_hashes(mixed(words, 1), length)[starts]
                n = len(starts)
                row = (
                    hashes.view(np.int64),
                    (checks >> np.uint64(32)).astype(np.uint32).view(np.int32),
                    np.full(n, i, np.int64),
                    np.full(n, key, np.int64),
                    starts.astype(np.int32),
                )
                for column, values in zip(out, row):
                    column.append(values)
        if out[0]:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c)) for c in out],
                ["_hash", "_check", "_id", "_key", "_start"],
            )


def _kept_rows(batches, length) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        ids = batch.column("doc_id")
        n_words, n_removed, digests, kept_texts = [], [], [], []
        columns = (batch.column(c).to_pylist() for c in ("_text", "_starts"))
        for text, starts in zip(*columns):
            words = text.split() if text else []
            kept = words
            if starts:
                edges = np.zeros(len(words) + 1, np.int64)
                starts = np.array(starts)
                np.add.at(edges, starts, 1)
                np.add.at(edges, starts + length, -1)
                stay = np.cumsum(edges[:-1]) == 0
                kept = [w for w, s in zip(words, stay.tolist()) if s]
            n_words.append(len(words))
            n_removed.append(len(words) - len(kept))
            joined = b" ".join(kept)
            kept_texts.append(joined)
            digests.append(hashlib.sha256(joined).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [
                ids,
                pa.array(n_words, pa.int64()),
                pa.array(n_removed, pa.int64()),
                pa.array(digests, pa.string()),
                pa.array(kept_texts, pa.binary()).cast(pa.string()),
            ],
            ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
        )


def _levels(base: int, length: int) -> list[int]:
    levels = [base]
    while levels[-1] < length:
        levels.append(min(2 * levels[-1], length))
    return levels


def repeated_windows(
    docs: DataFrame,
    length: int = 50,
    base: int = 25,
    id_col: str = "doc_id",
    text_col: str = "text",
    most_bits: int = 1 << 27,
) -> DataFrame:
    """Windows of ``length`` words that also start in a document with a smaller id.

    One row per such window and document: ``_id``, ``_key`` (hash of the text, for rows that share
    an id), ``_start`` (word position). A null id counts as larger than every other.

    Level by level, from ``base`` words to twice that and on to ``length``, only windows that are
    repeated so far go on. The key of a window at a level is the least hash of the shorter windows
    in it, so equal windows have equal keys and about 2 in (length - base) positions make one at
    the base. Each level counts the documents of its keys in a grouped minimum and maximum, folded
    in the scan tasks, and hands on a Bloom filter of bounded size (``most_bits``); a full filter
    costs shuffle, never a window. At full length an equi-join on 96 bits of hash decides.
    """
    spark = docs.sparkSession
    source = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("_id"),
        text_key(F.col(text_col)).alias("_key"),
        F.col(text_col).cast("binary").alias("_text"),
    )
    blooms: list[tuple[int, np.ndarray]] = []
    least, most = F.min("_id").alias("_first"), F.max("_id").alias("_last")
    for level in _levels(base, length)[:-1]:
        shared = spark.sparkContext.broadcast(list(blooms))

        def keys(batches, level=level, shared=shared):
            return _level_keys(batches, length, level, shared)

        counted = source.select("_id", "_text").mapInArrow(keys, "_hash long, _id long")
        repeated = counted.groupBy("_hash").agg(least, most).where("_first < _last")
        table = written(repeated.select("_hash"), "repeated-keys")
        blooms.append((level, bloom_filter(table, "_hash", most_bits)))
    shared = spark.sparkContext.broadcast(list(blooms))

    def rows(batches, shared=shared):
        return _window_rows(batches, length, shared)

    names = ["_hash", "_check"]
    schema = "_hash long, _check int, _id long, _key long, _start int"
    windows = source.mapInArrow(rows, schema)
    repeated = windows.groupBy(*names).agg(least, most).where("_first < _last").drop("_last")
    repeated = written(repeated, "repeated-windows")
    final = [*blooms, (length, bloom_filter(repeated, "_hash", most_bits))]
    last = spark.sparkContext.broadcast(final)

    def rows_again(batches, shared=last):
        return _window_rows(batches, length, shared)

    found = source.mapInArrow(rows_again, schema).join(repeated, names)
    return found.where("_id > _first").select("_id", "_key", "_start")


def dedup_substrings(
    docs: DataFrame,
    length: int = 50,
    base: int = 25,
    id_col: str = "doc_id",
    text_col: str = "text",
    most_bits: int = 1 << 27,
) -> DataFrame:
    """Each document without the words of windows that an earlier document also has.

    Returns ``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` and ``kept_text`` (kept words
    joined by one space), a row per row of ``docs``. Windows are judged on the input. A null or
    empty text has no words and keeps the empty text; rows that share an id are judged each by its
    own text, against smaller ids only; a null id is larger than all. Long texts are windowed whole.
    Other columns are not read.
    """
    removed = (
        repeated_windows(docs, length, base, id_col, text_col, most_bits)
        .groupBy("_id", "_key")
        .agg(F.collect_set("_start").alias("_starts"))
    )
    texts = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("_id"),
        text_key(F.col(text_col)).alias("_key"),
        F.col(text_col).cast("binary").alias("_text"),
    )
    id_type = docs.schema[id_col].dataType.simpleString()

    def kept(batches):
        return _kept_rows(batches, length)

    return (
        texts.join(removed, ["_id", "_key"], "left")
        .select("doc_id", "_text", "_starts")
        .mapInArrow(
            kept,
            f"doc_id {id_type}, n_words long, n_removed long, kept_sha256 string, kept_text string",
        )
    )
