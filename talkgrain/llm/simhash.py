"""Near-duplicate documents by SimHash fingerprints."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgrain.llm.common import LAST_ID, text_key, written
from talkgrain.llm.components import connected_components

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint_of(text: bytes | None, shingle: int, seed: int) -> int:
    """64 bits: which bits are set in over half of the hashes of the text's word shingles."""
    words = text.translate(_LOWER).split() if text else []
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    shingles = map(b" ".join, zip(*(words[i : i + n] for i in range(min(shingle, len(words))))))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, seed) for s in shingles), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8))
        counts += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(
    docs: DataFrame,
    shingle: int = 3,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id``, ``_key`` (hash of the text) and ``_fp``, its fingerprint as a signed long."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def rows(batches):
        for batch in batches:
            found = [fingerprint_of(t, shingle, seed) for t in batch.column("_text").to_pylist()]
            fps = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("_key"), pa.array(fps)],
                ["doc_id", "_key", "_fp"],
            )

    source = docs.select(
        F.col(id_col).alias("doc_id"),
        text_key(F.col(text_col)).alias("_key"),
        F.col(text_col).cast("binary").alias("_text"),
    )
    return source.mapInArrow(rows, f"doc_id {id_type}, _key long, _fp long")


# Every segment is two bits wide; its count of set bits, 0 to 2, is held as 00, 01 or 11. So the
# Manhattan distance of two vectors of 32 counts is the number of bits in which they differ.
_LOW = 0x5555555555555555


def segment_counts(fp: Column) -> Column:
    """The bit counts of the 32 segments of a fingerprint, as one long."""
    low = F.lit(_LOW)
    shifted = F.shiftrightunsigned(fp, 1)
    some = fp.bitwiseOR(shifted).bitwiseAND(low)
    both = fp.bitwiseAND(shifted).bitwiseAND(low)
    return some.bitwiseOR(F.shiftleft(both, 1))


def _raised(half: Column) -> Column:
    """The grid cells whose count is one higher in one of the 16 segments."""
    cells = []
    for i in range(16):
        some, both = F.lit(1 << 2 * i), F.lit(2 << 2 * i)
        cells.append(
            F.when(half.bitwiseAND(some) == 0, half.bitwiseOR(some)).when(
                half.bitwiseAND(both) == 0, half.bitwiseOR(both)
            )
        )
    return F.array_compact(F.array(*cells))


def fingerprint_links(fps: DataFrame, most_bits: int = 3) -> DataFrame:
    """Pairs ``a``, ``b`` of distinct fingerprints (column ``_fp``) that differ in ``most_bits`` or fewer.

    ``most_bits`` is 3 at most, for which the grid is made.

    A range join on a grid: the segment counts of a pair differ by 3 in sum at most, so in one
    half of the segments by 1 at most. A fingerprint is put in the cell of each half and asks in
    that cell and in those one count higher, 2 * (1 + up to 16) rows; equal cells are joined. In
    the join the Manhattan distance of all counts is the lower bound that is tested first, then
    the exact distance. Only the links come out of it.
    """
    if not 0 <= most_bits <= 3:
        raise ValueError("most_bits is 0 to 3")
    counted = fps.select("_fp").distinct().select("_fp", segment_counts(F.col("_fp")).alias("_c"))
    halves = F.array(
        F.col("_c").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(F.col("_c"), 32)
    )
    placed = counted.select("_fp", "_c", F.posexplode(halves).alias("_side", "_half"))
    cells = placed.select(
        F.col("_fp").alias("b"),
        F.col("_c").alias("_cb"),
        F.col("_side").alias("_in"),
        F.col("_half").alias("_at"),
    )
    asks = placed.select(
        F.col("_fp").alias("a"),
        F.col("_c").alias("_ca"),
        "_side",
        F.col("_half").alias("_own"),
        F.explode(F.concat(F.array("_half"), _raised(F.col("_half")))).alias("_cell"),
    )
    near = (
        (F.bit_count(F.col("_ca").bitwiseXOR(F.col("_cb"))) <= most_bits)
        & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= most_bits)
        & ((F.col("_own") != F.col("_cell")) | (F.col("a") < F.col("b")))
    )
    same_cell = (F.col("_side") == F.col("_in")) & (F.col("_cell") == F.col("_at"))
    return asks.join(cells, same_cell & near).select("a", "b").distinct()


def near_duplicates(
    docs: DataFrame,
    shingle: int = 3,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    most_bits: int = 3,
) -> DataFrame:
    """Each document with its fingerprint and the smallest id of its group of near copies.

    Returns ``doc_id``, ``fingerprint`` (16 hexadecimal digits), ``component_id``, ``group_id`` (a
    name of the group that is never null) and ``_key`` (hash of the text), a row per row of
    ``docs``. Documents are linked if their fingerprints differ in ``most_bits`` or fewer (3 at most);
    groups are what links reach. A long text is fingerprinted whole, and texts of one fingerprint are
    tied. A text without words (null, empty, blank) has the fingerprint zero and is linked
    like any other. Copies share a fingerprint and are one node of the graph. A null id is never
    the smallest; a group of null ids only has a null ``component_id``. Other columns are not read.
    """
    table = written(fingerprints(docs, shingle, seed, id_col, text_col), "fingerprints")
    nodes = table.groupBy("_fp").agg(F.min("doc_id").alias("_least"))
    roots = connected_components(fingerprint_links(nodes, most_bits))
    rooted = nodes.join(roots, F.col("_fp") == F.col("node"), "left").select(
        "_fp", "_least", F.coalesce("root", "_fp").alias("group_id")
    )
    least = rooted.groupBy("group_id").agg(F.min("_least").alias("component_id"))
    members = rooted.select("_fp", "group_id").join(least, "group_id")
    return table.join(members, "_fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        "group_id",
        "_key",
    )


def one_of_each_group(
    docs: DataFrame,
    shingle: int = 3,
    most_bits: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay when near copies go.

    Of each group of ``near_duplicates`` the row with the smallest id stays, a null id being larger
    than any; of rows of one id the one whose text has the smallest hash, and of rows equal in both
    the least in all their columns, which must be orderable.
    """
    names = docs.columns
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))
    groups = near_duplicates(docs, shingle, id_col=id_col, text_col=text_col, most_bits=most_bits)
    chosen = groups.groupBy("group_id").agg(F.min(F.struct(order.alias("_id"), "_key")).alias("c"))
    keyed = docs.select(
        F.struct("*").alias("_row"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("_id"),
        text_key(F.col(text_col)).alias("_key"),
    )
    # Rows alike in id and text are folded in the scan tasks, however many there are.
    least = keyed.groupBy("_id", "_key").agg(F.min("_row").alias("_row"))
    kept = least.join(chosen.select("c._id", "c._key"), ["_id", "_key"], "semi")
    return kept.select(*(F.col("_row")[name].alias(name) for name in names))
