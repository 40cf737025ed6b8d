"""Benchmark passages in documents: an exact containment join on rare words.

Built-in functions only.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgrain.llm.common import let, text_key, written

# What is lower-cased, and what stands between words.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def plain_words(text: Column) -> Column:
    """Lower-cased words of letters, digits and everything beyond ASCII. A null text has none."""
    text = F.coalesce(text, F.lit(""))
    # Where every character is one byte, the faster function lower-cases the same letters.
    lowered = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _LOWER)
    )
    return F.array_remove(F.split(lowered, GAPS, -1), "")


def item_windows(benchmark: DataFrame, length: int, id_col: str, text_col: str) -> DataFrame:
    """``item_id`` and ``window``, the distinct runs of ``length`` words of each item.

    An item of fewer words is one window; an item without words has none.
    """
    words = benchmark.select(
        F.col(id_col).alias("item_id"), plain_words(F.col(text_col)).alias("w")
    )
    n = F.array_size("w")
    starts = F.sequence(F.lit(1), F.greatest(n - (length - 1), F.lit(1)))
    windows = F.transform(starts, lambda i: F.slice("w", i, length))
    return words.where(n > 0).select("item_id", F.explode(windows).alias("window")).distinct()


def _bitmap(values: DataFrame, column: str, most_bits: int) -> tuple[str, int]:
    """A one-hash filter of the words in ``column``: an array of longs as text, and its bits."""
    n, bits = values.count(), 1 << 10
    while bits < min(64 * n, most_bits):
        bits *= 2
    place = F.xxhash64(column).bitwiseAND(F.lit(bits - 1))
    rows = (
        values.select(place.alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 AS int))")).alias("bits"))
        .collect()
    )
    filled = [0] * (bits // 64)
    for row in rows:
        filled[row["word"]] = row["bits"]
    return json.dumps(filled), bits


def _may_hold(bitmap: tuple[str, int], word: Column) -> Column:
    """Whether a word can be in the filter. The array is a constant that is read once a query."""
    values = F.from_json(F.lit(bitmap[0]), "array<bigint>")
    place = F.xxhash64(word).bitwiseAND(F.lit(bitmap[1] - 1))
    held = F.get(values, F.shiftright(place, 6).cast("int"))
    return F.getbit(held, place.bitwiseAND(F.lit(63)).cast("int")) == 1


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    length: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    most_bits: int = 1 << 20,
) -> DataFrame:
    """How much of each document are passages of ``length`` words of a benchmark.

    Returns ``doc_id``, ``n_words``, ``n_hit`` (words inside an occurring window), ``items`` (sorted
    ids of items with an occurring window) and ``_key`` (hash of the text), a row per row of
    ``docs``. An item of fewer words counts if the whole of it occurs.

    A window is contained only if all its words are, so one word is enough of a prefix: the one
    that is rarest in ``docs`` by a count over all their words. Words are counted, and later looked
    up, past a bitmap of the windows' words of at most ``most_bits`` bits; a full one costs rows,
    never a hit. A document's occurrences of prefix words carry their neighbours, so the join on
    the word can test the bounds (the window must fit before the start and after the end) and then
    the exact words, without the text.

    A null or empty text has no words and no hits; null or empty items never occur, a null item id
    counts as none. A long text is searched whole. Rows that share an id are judged each by its own
    text. Other columns are not read.
    """
    windows = written(item_windows(benchmark, length, item_col, item_text_col), "windows")
    distinct = windows.select("window").distinct().withColumn("_w", F.xxhash64("window"))
    vocabulary = distinct.select(F.explode("window").alias("word")).distinct()
    texts = docs.select(
        F.col(id_col).alias("doc_id"),
        text_key(F.col(text_col)).alias("_key"),
        plain_words(F.col(text_col)).alias("words"),
    )
    known = _bitmap(vocabulary, "word", most_bits)
    counts = (
        texts.select(F.explode("words").alias("word"))
        .where(_may_hold(known, F.col("word")))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
    )
    # Written first: the join then has plain shuffles on both sides, which Spark can split where a
    # word is in very many windows.
    counts = written(counts, "word-counts")
    # The rarest word of each window, and where it stands; ties go to the word, then to the place.
    placed = distinct.select("window", F.posexplode("window").alias("at", "word"))
    rarest = (
        placed.join(counts, "word", "left")
        .select("window", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "at").alias("r"))
        .groupBy("window")
        .agg(F.min("r").alias("r"))
        .where("r.n > 0")
        .select("window", "r.word", "r.at")
    )
    rarest = written(rarest, "rare-words")
    prefixes = _bitmap(rarest.select("word").distinct(), "word", most_bits)

    def neighbours(words: Column) -> Column:
        """(word, its place, up to 2 * length - 1 words around it, how many of them before it)"""
        picked = F.filter(
            F.transform(words, lambda word, i: F.struct(word.alias("word"), i.alias("i"))),
            lambda p: _may_hold(prefixes, p["word"]),
        )

        def around(p: Column) -> Column:
            before = F.least(p["i"], F.lit(length - 1))
            return F.struct(
                p["word"].alias("word"),
                p["i"].alias("i"),
                before.alias("before"),
                F.slice(words, p["i"] - before + 1, before + length).alias("near"),
            )

        return F.transform(picked, around)

    # One pass: the words of a text are bound once and used for the count and for the neighbours.
    looked = let(
        F.col("words"),
        lambda w: F.struct(F.array_size(w).cast("long").alias("n"), neighbours(w).alias("found")),
    )
    scanned = texts.select("doc_id", "_key", looked.alias("x"))
    scanned = written(scanned.select("doc_id", "_key", "x.n", "x.found"), "rare-places")
    spots = scanned.select("doc_id", "_key", "n", F.inline("found"))
    fits = (F.col("before") >= F.col("at")) & (
        F.array_size("near") - F.col("before") >= F.array_size("window") - F.col("at")
    )
    exact = (
        F.slice("near", F.col("before") - F.col("at") + 1, F.array_size("window"))
        == F.col("window")
    )
    hits = (
        spots.join(rarest, "word")
        .where(fits & exact)
        .select(
            "doc_id",
            "_key",
            "window",
            (F.col("i") - F.col("at")).alias("start"),
            (F.col("i") - F.col("at") + F.array_size("window")).alias("end"),
        )
    )
    covered = (
        hits.groupBy("doc_id", "_key")
        .agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("runs"))
        .select("doc_id", "_key", _covered(F.col("runs")).alias("n_hit"))
    )
    items = (
        hits.select("doc_id", "_key", "window")
        .distinct()
        .join(windows, "window")
        .where(F.col("item_id").isNotNull())
        .groupBy("doc_id", "_key")
        .agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    )
    result = scanned.select("doc_id", "_key", F.col("n").alias("n_words"))
    for part in (covered, items):
        there = part.withColumnsRenamed({"doc_id": "_d", "_key": "_k"})
        same = F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("_key").eqNullSafe(F.col("_k"))
        result = result.join(there, same, "left").drop("_d", "_k")
    none = F.array().cast(items.schema["items"].dataType)
    return result.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", none).alias("items"),
        "_key",
    )


def _covered(runs: Column) -> Column:
    """How many places the sorted half-open runs cover together."""

    def add(done: Column, run: Column) -> Column:
        more = F.greatest(run["end"] - F.greatest(run["start"], done["to"]), F.lit(0))
        return F.struct(
            (done["n"] + more).alias("n"), F.greatest(done["to"], run["end"]).alias("to")
        )

    return F.aggregate(runs, F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")), add)["n"]


def contamination_digest(found: DataFrame) -> DataFrame:
    """``contaminated`` with the number and the hash of the items, and the verdict."""
    listed = F.array_join(F.sort_array(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.array_size("items").cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
