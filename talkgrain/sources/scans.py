"""Help for scans that arrive in too few pieces, and for lookup tables that may be small."""

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a row costs in a broadcast table beside the bytes of its strings, rounded up.
ROW_BYTES, COLUMN_BYTES = 32, 16

MEASURED = (T.StringType, T.BinaryType)
FIXED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)

BROADCAST_BYTES = 64 * 1024 * 1024


def spread(scan: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rebalance the rows of a scan that would keep most cores waiting. Costs a full shuffle.

    Cutting text into words is the costly step, and a Parquet file with one row group, or one
    XML file, would do all of it on one core. Ask for it for such inputs only; releases written
    by ``write_release`` have many row groups and do not need it. Adaptive execution picks the
    number of pieces from their real size.

    Rows go by the hash of ``by``, which should tell them apart. Without it they are dealt in turn,
    and to do that alike on every run Spark sorts all that a task reads, in its memory.
    """
    return scan.hint("rebalance", *by)


def broadcast_if_small(lookup: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a filtered lookup table for broadcast if its rows are measured to fit in ``limit``.

    Spark plans with the size of the files, before the filter, and so would shuffle a huge
    table to meet a few rows of a large one. This reads the lookup table once more, to add up
    the real size of what the filter leaves. Over the limit, or with columns that cannot be
    measured, it is returned as it is.
    """
    strings = [f.name for f in lookup.schema if isinstance(f.dataType, MEASURED)]
    if not all(isinstance(f.dataType, (*MEASURED, *FIXED)) for f in lookup.schema):
        return lookup
    fixed = F.lit(ROW_BYTES + COLUMN_BYTES * len(lookup.columns)).cast("long")
    row = reduce(add, (F.coalesce(F.octet_length(s), F.lit(0)) for s in strings), fixed)
    measured = lookup.agg(F.sum(row)).head()[0] or 0
    return F.broadcast(lookup) if measured <= limit else lookup
