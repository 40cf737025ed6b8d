"""Release bookkeeping on DataFrames."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Whole types by the decimal digits that hold all their values.
WHOLE_DIGITS = ((T.ByteType, 3), (T.ShortType, 5), (T.IntegerType, 10), (T.LongType, 19))
# Digits of whole numbers that a binary fraction holds exactly.
BINARY_DIGITS = ((T.FloatType, 7), (T.DoubleType, 15))
MOST_DIGITS = 38


def stamp_release(df: DataFrame, release: str) -> DataFrame:
    """Report the release a result was computed from."""
    return df.withColumn("release", F.lit(release))


def union_releases(releases: Sequence[DataFrame], widen: bool = False) -> DataFrame:
    """Stack releases. A column that a release does not have is NULL in its rows.

    With ``widen``, a column whose type changed from release to release is given the narrowest type
    that holds the values of all of them (see ``common_type``), or stops the run with its name. Names
    are compared as Spark does, without case, and written as the first release has them.
    """
    if not releases:
        raise ValueError("no releases to stack")
    if widen:
        releases = _widened(releases)
    return reduce(lambda above, below: above.unionByName(below, allowMissingColumns=True), releases)


def common_type(types: Sequence[T.DataType]) -> T.DataType:
    """The narrowest type to which all of ``types`` can be cast and back without loss.

    Whole numbers and decimals become the type with as many digits as are needed on both sides of
    the point; with a binary fraction they become DOUBLE if they have no more digits than it holds;
    dates become timestamps; and anything else that differs becomes STRING, if each is a number, a
    truth value, a date or a STRING. Nested types must be the same.
    """
    kinds = [t for t in dict.fromkeys(types) if not isinstance(t, T.NullType)]
    if not kinds:
        return T.NullType()
    if len(kinds) == 1:
        return kinds[0]
    if all(isinstance(t, T.NumericType) for t in kinds):
        found = _common_number(kinds)
        if found is not None:
            return found
    # Times of day read in a zone and those that are not differ by the session.
    if {type(t) for t in kinds} in ({T.DateType, T.TimestampType}, {T.DateType, T.TimestampNTZType}):
        return next(t for t in kinds if not isinstance(t, T.DateType))
    spelt = (T.IntegralType, T.DecimalType, T.StringType, T.BooleanType, T.DateType)
    if all(isinstance(t, spelt) for t in kinds):
        return T.StringType()
    raise ValueError(f"no type holds {', '.join(t.simpleString() for t in kinds)} without loss")


def _common_number(kinds: Sequence[T.DataType]) -> T.DataType | None:
    before = after = 0
    for t in kinds:
        if isinstance(t, T.DecimalType):
            before, after = max(before, t.precision - t.scale), max(after, t.scale)
        else:
            before = max(before, next((n for kind, n in WHOLE_DIGITS if isinstance(t, kind)), 0))
    binary = [n for t in kinds for kind, n in BINARY_DIGITS if isinstance(t, kind)]
    if binary:
        # A decimal fraction has no exact binary one.
        return T.DoubleType() if after == 0 and before <= BINARY_DIGITS[-1][1] else None
    if any(isinstance(t, T.DecimalType) for t in kinds):
        return T.DecimalType(before + after, after) if before + after <= MOST_DIGITS else None
    return next(kind() for kind, n in WHOLE_DIGITS if n == before)


def _widened(releases: Sequence[DataFrame]) -> list[DataFrame]:
    found: dict[str, list[T.DataType]] = {}
    for release in releases:
        for field in release.schema:
            found.setdefault(field.name.lower(), []).append(field.dataType)
    wanted = {}
    for name, types in found.items():
        try:
            wanted[name] = common_type(types)
        except ValueError as error:
            raise ValueError(f"column {name}: {error}") from None

    def column(field: T.StructField) -> Column:
        return F.col(f"`{field.name}`").cast(wanted[field.name.lower()]).alias(field.name)

    return [release.select(*map(column, release.schema)) for release in releases]
