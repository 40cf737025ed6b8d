"""Best-fit packing of documents into sequences of fixed length, with conflicts."""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgrain.llm.common import let, split_words, written


def best_fit(
    lengths: list[int], sources: list[int], clusters: list[int], capacity: int
) -> list[tuple[int, int]]:
    """The bin and the offset of each piece, taken in the order given.

    ``sources`` and ``clusters`` are small numbers, or -1 for none. Every bin carries two bitmaps
    of what it holds. Bins are ordered by what room they have left; the search starts at the first
    that is large enough and goes on to the next larger until one is compatible, so it finds the
    tightest; if there is none, a bin is opened. A full bin is closed, also for pieces of no length.
    """
    room: list[tuple[int, int]] = []
    source_bits: list[int] = []
    cluster_bits: list[int] = []
    out = []
    for length, source, cluster in zip(lengths, sources, clusters):
        s = 1 << source if source >= 0 else 0
        c = 1 << cluster if cluster >= 0 else 0
        at = bisect_left(room, (length, -1))
        while at < len(room):
            b = room[at][1]
            if not (source_bits[b] & s or cluster_bits[b] & c):
                break
            at += 1
        if at < len(room):
            left, b = room.pop(at)
        else:
            left, b = capacity, len(source_bits)
            source_bits.append(0)
            cluster_bits.append(0)
        source_bits[b] |= s
        cluster_bits[b] |= c
        out.append((b, capacity - left))
        if left > length:
            insort(room, (left - length, b))
    return out


def _pack_shard(rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Pieces of one shard: full ones have a bin each, the others are packed, longest first."""
    rows = rows.sort_values(["length", "_row"], ascending=[False, True], kind="stable")
    whole = (rows["length"] // capacity).to_numpy()
    rest = (rows["length"] % capacity).to_numpy()
    # An empty document is one piece of no length.
    parts = [(i, k, capacity) for i, n in enumerate(whole) for k in range(n)]
    tails = [(i, int(n), int(r)) for i, (n, r) in enumerate(zip(whole, rest)) if r or not n]
    tails.sort(key=lambda t: -t[2])
    at = [t[0] for t in tails]
    codes = [
        pd.factorize(rows[name], use_na_sentinel=True)[0][at].tolist()
        for name in ("source", "cluster")
    ]
    placed = best_fit([t[2] for t in tails], *codes, capacity)
    n_bins = max((b for b, _ in placed), default=-1) + 1
    table = [(*t, b, offset) for t, (b, offset) in zip(tails, placed)]
    table += [(*p, n_bins + j, 0) for j, p in enumerate(parts)]
    index = [t[0] for t in table]
    return pd.DataFrame(
        {
            "doc_id": rows["doc_id"].to_numpy()[index],
            "piece": [t[1] for t in table],
            "n_tokens": [t[2] for t in table],
            "bin": [t[3] for t in table],
            "offset": [t[4] for t in table],
            "shard": rows["_shard"].to_numpy()[index],
        }
    )


def pack(
    docs: DataFrame,
    capacity: int = 2048,
    shard_rows: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: Column | None = None,
    source: Column | None = None,
    cluster: Column | None = None,
) -> DataFrame:
    """Place every document in bins of ``capacity`` tokens, a row per piece.

    Returns ``doc_id``, ``piece`` (from 0), ``n_tokens``, ``bin_id``, ``bin_offset``. A document
    longer than a bin is cut into full bins of its own and a rest. No two rests or short documents
    in a bin have the same source or the same cluster of duplicates; a null source or cluster is in
    conflict with nothing. By default the source is the column of that name, equal texts are a
    cluster, and the length is the number of words of the text, and one more for the end of the
    document; a null text is that one. A length of null or less counts as 0 and takes a place of
    no room.

    Documents are dealt by a hash of their row number to shards of about ``shard_rows``, so no
    source, cluster or id makes a large one, and each shard is packed by itself: only numbers
    are shuffled, and the number of bins left part full is a few for each shard. Rows that are
    repeated are placed each. Other columns are not read.
    """
    by_text = let(
        split_words(F.col(text_col)),
        lambda w: F.struct(
            (F.array_size(w) + 1).alias("length"), F.xxhash64(F.array_join(w, " ")).alias("cluster")
        ),
    )
    needs_text = length is None or cluster is None
    found = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.col("source") if source is None else source).cast("string").alias("source"),
        (F.lit(None) if length is None else length).alias("own_length"),
        (F.lit(None) if cluster is None else cluster).alias("own_cluster"),
        (by_text if needs_text else F.lit(None)).alias("by_text"),
    )
    length = F.col("by_text.length" if length is None else "own_length").cast("long")
    cluster = F.col("by_text.cluster" if cluster is None else "own_cluster").cast("string")
    numbered = found.select(
        "doc_id",
        "source",
        cluster.alias("cluster"),
        F.greatest(F.coalesce(length, F.lit(0)), F.lit(0)).alias("length"),
        F.monotonically_increasing_id().alias("_row"),
    )
    table = written(numbered, "lengths")
    shards = max(1, -(-table.count() // shard_rows))
    dealt = table.withColumn("_shard", F.pmod(F.xxhash64("_row"), F.lit(shards)))
    id_type = docs.schema[id_col].dataType.simpleString()

    def packed(rows):
        return _pack_shard(rows, capacity)

    schema = f"doc_id {id_type}, piece long, n_tokens long, bin long, offset long, shard long"
    pieces = dealt.groupBy("_shard").applyInPandas(packed, schema)
    bin_id = F.shiftleft("shard", 32) + F.col("bin")
    return pieces.select(
        "doc_id", "piece", "n_tokens", bin_id.alias("bin_id"), F.col("offset").alias("bin_offset")
    )
