"""Places of regular-expression matches, by built-in functions only.

A pattern here must never match the empty string. Offsets count code points, the end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from talkgrain.llm.common import let

_SPAN = "struct<start:bigint,end:bigint,match:string,before:string,after:string>"

_BLOCK = 256


def no_spans() -> Column:
    return F.array().cast(f"array<{_SPAN}>")


def spans(text: Column, pattern: str, context: int = 40) -> Column:
    """Leftmost matches that do not overlap, as an array of structs in order of place.

    Each has ``start``, ``end``, ``match`` and up to ``context`` code points of the text between it
    and its neighbours, ``before`` and ``after``. Cutting a text at the pattern gives what lies
    between the matches, so places are running sums of lengths. A null text has none.
    """
    cut = F.struct(
        F.split(text, pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
    )
    parts = let(
        cut,
        lambda x: F.arrays_zip(
            F.slice(x["gaps"], 1, F.array_size(x["found"])).alias("gap"),
            x["found"].alias("match"),
            F.slice(x["gaps"], 2, F.array_size(x["found"])).alias("next"),
        ),
    )

    def add(done: Column, part: Column) -> Column:
        start = done["at"] + F.length(part["gap"])
        end = start + F.length(part["match"])
        span = F.struct(
            start.alias("start"),
            end.alias("end"),
            part["match"].alias("match"),
            F.right(part["gap"], F.lit(context)).alias("before"),
            F.left(part["next"], F.lit(context)).alias("after"),
        )
        return F.struct(end.alias("at"), F.array_append(done["spans"], span).alias("spans"))

    def join(done: Column, block: Column) -> Column:
        moved = F.transform(
            block["spans"],
            lambda s: s.withField("start", s["start"] + done["at"]).withField(
                "end", s["end"] + done["at"]
            ),
        )
        blocks = F.array_append(done["blocks"], moved)
        return F.struct((done["at"] + block["at"]).alias("at"), blocks.alias("blocks"))

    # An array grows by copying, so places are added up in blocks first: a text with many
    # matches then takes little more than linear time.
    zero = F.lit(0).cast("long").alias("at")
    begin = F.struct(zero, no_spans().alias("spans"))
    begin_all = F.struct(zero, F.array().cast(f"array<array<{_SPAN}>>").alias("blocks"))
    found = let(
        parts,
        lambda p: F.aggregate(
            F.transform(
                F.sequence(F.lit(0), F.floor((F.array_size(p) - 1) / _BLOCK).cast("int")),
                lambda b: F.aggregate(F.slice(p, b * _BLOCK + 1, _BLOCK), begin, add),
            ),
            begin_all,
            join,
            lambda done: F.flatten(done["blocks"]),
        ),
    )
    return F.when(text.rlike(pattern), found).otherwise(no_spans())


def count(of: Column) -> Column:
    return F.array_size(of).cast("long")
