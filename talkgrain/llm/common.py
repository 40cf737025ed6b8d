"""What the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgrain.sources.shared import shared_folder

# Stands for a null id where ids are compared: it is larger than every other id.
LAST_ID = 2**63 - 1

# The words of most operators: runs of anything but a space, tab, line feed, vertical tab, form
# feed or carriage return. ``bytes.split()`` cuts at the same six characters.
BLANKS = r"[\x20\x09-\x0D]+"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, and safe from lost executors."""
    spark = df.sparkSession
    folder = f"{shared_folder(spark, name)}/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def split_words(text: Column) -> Column:
    """The words of a text between blanks, as an array; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS, -1), "")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once a row, also where a lambda refers to it."""
    return F.transform(F.array(value), use)[0]


def text_key(text: Column) -> Column:
    """With the id it tells rows apart that share an id but not a text."""
    return F.xxhash64(text)


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches of a partition cut small, which bounds what a task makes of texts at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


# --------------------------------------------------------------------- hashes as NumPy arrays

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


def mixed(hashes: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of unsigned 64-bit numbers that spreads every bit over all others."""
    with np.errstate(over="ignore"):
        x = hashes + np.uint64(seed)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of every run of ``length`` word hashes, by differences of running sums."""
    n = len(words)
    if n < length:
        return words[:0]
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(n, _BASE, np.uint64))
        inverses = np.cumprod(np.full(n - length + 1, _INVERSE, np.uint64))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers)])
        return mixed((sums[length:] - sums[:-length]) * inverses)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` neighbours, in about log2(width) passes."""
    if len(values) < width:
        return values[:0]
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[: len(values) - step], values[step:])
        done += step
    return values


# ------------------------------------------------------------------------------ Bloom filters


def bloom_filter(hashes: DataFrame, column: str, most_bits: int) -> np.ndarray:
    """A Bloom filter of the 64-bit values in ``column``, as unsigned 64-bit words.

    It has about 16 bits a value, but never more than ``most_bits`` (a power of two): that bounds
    what reaches the driver and is broadcast, however many values there are. A full filter lets
    more values pass that an exact join must then drop; it never stops one it holds.
    """
    n = hashes.count()
    bits = 1 << 10
    while bits < min(16 * n, most_bits):
        bits *= 2
    first, second = (
        F.shiftrightunsigned(F.col(column), shift).bitwiseAND(F.lit(bits - 1)) for shift in (0, 32)
    )
    words = (
        hashes.select(F.explode(F.array(first, second)).alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 AS int))")).alias("bits"))
    )
    out = np.zeros(bits // 64, np.int64)
    for batch in words.toArrow().to_batches(max_chunksize=1 << 20):
        out[batch.column("word").to_numpy()] = batch.column("bits").to_numpy()
    return out.view(np.uint64)


def in_bloom(bloom: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which unsigned 64-bit values the filter may hold."""
    last, six, low = np.uint64(64 * len(bloom) - 1), np.uint64(6), np.uint64(63)
    found = np.ones(len(hashes), bool)
    for shift in (0, 32):
        bit = (hashes >> np.uint64(shift)) & last
        found &= ((bloom[bit >> six] >> (bit & low)) & np.uint64(1)).astype(bool)
    return found
