"""How filters of a corpus interact: what each removes alone, first, and in vain."""

from __future__ import annotations

import json
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgrain.llm.common import let, split_words, text_key, written
from talkgrain.sources.scans import broadcast_if_small

LETTERS = "ABCDE"
# The filter that needs other documents; the others look at one text.
COPY = "E"


def _bit(letter: str) -> int:
    return 1 << LETTERS.index(letter)


def own_failures(text: Column) -> Column:
    """The bits of the filters that a text fails by itself."""
    text = F.coalesce(text, F.lit(""))
    sizes = let(
        split_words(text),
        lambda w: F.struct(
            F.array_size(w).cast("long").alias("words"),
            F.array_size(F.array_distinct(w)).cast("long").alias("distinct"),
        ),
    )
    conditions = {
        "A": lambda s: s["words"] < 100,
        "B": lambda s: 100 * s["distinct"] < 80 * s["words"],
        "C": lambda s: 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long")
        > 10 * F.length(text).cast("long"),
        "D": lambda s: text.rlike(r"[#$%&*|]"),
    }

    def bits(s: Column) -> Column:
        failed = F.lit(0)
        for letter, condition in conditions.items():
            failed = failed + F.when(condition(s), _bit(letter)).otherwise(0)
        return failed

    return let(sizes, bits)


def later_copies(rows: DataFrame, keyed: DataFrame, rows_of_salt: int = 1_000) -> DataFrame:
    """The rows of ``rows`` whose text is that of a row with a smaller ``doc_id``.

    ``rows`` has ``doc_id``, ``_key`` (hash of the text) and ``text``; ``keyed`` has the keys of all
    rows. A left-semi join on the hash, the exact text and the smaller id. Only texts whose hash
    occurs twice are moved, the other side holds each distinct text once with its smallest id, and
    a hash of many rows is dealt to one place for every ``rows_of_salt`` of them.
    """
    counts = keyed.groupBy("_key").agg(F.count("*").alias("_n")).where("_n > 1")
    salts = F.ceil(F.col("_n") / rows_of_salt).cast("int").alias("_salts")
    repeated = written(counts.select("_key", salts), "repeated-texts")
    found = rows.join(broadcast_if_small(repeated), "_key")
    firsts = found.groupBy("_key", "_salts", "text").agg(F.min("doc_id").alias("_least"))
    firsts = firsts.select(
        F.col("_key").alias("_k"),
        F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_s"),
        F.col("text").alias("_first"),
        "_least",
    )
    salted = found.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.col("_salts")).cast("int"))
    same = (F.col("_key") == F.col("_k")) & (F.col("_salt") == F.col("_s"))
    return salted.join(
        firsts, same & (F.col("text") == F.col("_first")) & (F.col("_least") < F.col("doc_id")), "semi"
    )


def failure_counts(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """How many documents of each part fail which filters: ``part``, ``bits``, ``good``, ``toxic``, ``n``.

    The ids that fail by their own text and those of later copies are stacked, and the bits of each
    document or-ed. At most 32 combinations of bits and 4 of labels come out for a part.
    """
    source = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).withColumn("_key", text_key(F.col("text")))
    own = source.select("doc_id", "_key", "part", own_failures(F.col("text")).alias("bits"))
    own = written(own, "filter-failures")
    copies = later_copies(source, own.select("_key"))
    document = ["doc_id", "_key", "part"]
    stacked = own.select(*document, "bits", F.lit(1).cast("long").alias("n")).unionByName(
        copies.select(*document, F.lit(_bit(COPY)).alias("bits"), F.lit(0).cast("long").alias("n"))
    )
    failed = stacked.groupBy(*document).agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    # An id that very many rows share meets its label as a few rows.
    by_id = failed.groupBy("doc_id", "part", "bits").agg(F.sum("n").alias("n"))
    judged = labels.groupBy(F.col("doc_id").alias("_id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    labelled = by_id.join(judged, F.col("doc_id") == F.col("_id"), "left")
    flags = [F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    return labelled.groupBy("part", "bits", *flags).agg(F.sum("n").alias("n"))


def audit_filters(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """What each filter does at each step of every order, by part of the corpus.

    The filters: A, under 100 words; B, under 80 distinct words in 100; C, over 10 capitals A to Z
    in 100 code points; D, any of ``#$%&*|``; E, the text of a row with a smaller id. Returns
    ``part`` (the value of ``part_col``, an empty string for null), ``filter_order``, ``step`` and the
    counts ``kept``, ``removed``, ``redundant``, ``unique_fails``, ``good_lost``, ``toxic_lost`` and
    ``shapley`` (``removed`` summed over all orders, at any step): 600 rows a part.

    Null texts are empty: they fail A, and E but for the first. Long texts are
    counted whole. Rows that share an id are judged each by its own text and are no copies of each
    other; a null id is neither a copy nor the first of any, and has no label. A document is good or toxic if any of
    its rows in ``labels`` (``doc_id``, ``quality``, ``toxic``) says 1. An empty table has no parts
    and no rows. Other columns are not read.
    """
    counts = failure_counts(docs, labels, id_col, text_col, part_col)
    steps = [
        {
            "filter_order": "".join(order),
            "step": k + 1,
            "bit": _bit(letter),
            "before": sum(map(_bit, order[:k])),
        }
        for order in permutations(LETTERS)
        for k, letter in enumerate(order)
    ]
    kind = "array<struct<filter_order:string,step:int,bit:int,before:int>>"
    each = counts.select("*", F.inline(F.from_json(F.lit(json.dumps(steps)), kind)))
    fails = F.col("bits").bitwiseAND(F.col("bit")) != 0
    came = F.col("bits").bitwiseAND(F.col("before")) == 0

    def count(condition: Column, n: Column | None = None) -> Column:
        return F.sum(F.when(condition, F.col("n") if n is None else n).otherwise(0)).cast("long")

    # A document with k failures is removed by each of them in 1 of k orders.
    share = F.col("n") * F.expr(f"{factorial(len(LETTERS))} div greatest(1, bit_count(bits))")
    return each.groupBy("part", "filter_order", "step").agg(
        count(~fails & came).alias("kept"),
        count(fails & came).alias("removed"),
        count(fails & ~came).alias("redundant"),
        count(F.col("bits") == F.col("bit")).alias("unique_fails"),
        count(fails & came & F.col("good")).alias("good_lost"),
        count(fails & came & F.col("toxic")).alias("toxic_lost"),
        count(fails, share).alias("shapley"),
    )
