"""Row filters. Both are plain IN lists, so they reach the Parquet or JDBC scan."""

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def for_speakers(df: DataFrame, speakers: Iterable[str]) -> DataFrame:
    """Keep the rows of the given speakers."""
    return df.where(F.col("speaker").isin(_names(speakers)))


def for_corpora(df: DataFrame, corpora: Iterable[str]) -> DataFrame:
    """Keep the rows of the given corpora."""
    return df.where(F.col("corpus").isin(_names(corpora)))


def _names(names: Iterable[str]) -> list[str]:
    # A bare string would silently be taken as a list of letters.
    return [names] if isinstance(names, str) else list(names)
