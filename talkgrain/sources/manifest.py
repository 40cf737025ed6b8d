"""The release manifest: which releases exist, and which one is current."""

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The manifest's fields. Connection fields such as host, user and password are
# left out on purpose: they are part of the page that is read, but of nothing that comes out.
MANIFEST = T.StructType(
    [
        T.StructField("current", T.StringType()),
        T.StructField("supported", T.ArrayType(T.StringType())),
    ]
)

# A page header between two lines of dashes may stand before the JSON.
FRONT_MATTER = r"(?s)\A\s*---\s*?\n(.*?\n)?---\s*?\n"


def load_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per supported release: ``release`` and ``is_current``.

    A path that holds more than one file, or none, stops the run.
    """
    pages = spark.read.text(path, wholetext=True).agg(F.collect_list("value").alias("pages"))
    several = F.raise_error(F.lit("the manifest must be exactly one file"))
    page = pages.select(
        F.when(F.size("pages") == 1, F.col("pages")[0]).otherwise(several).alias("value")
    )
    parsed = page.select(
        F.from_json(
            F.regexp_replace("value", FRONT_MATTER, ""), MANIFEST, {"mode": "FAILFAST"}
        ).alias("manifest")
    )
    return parsed.select(
        "manifest.current", F.explode("manifest.supported").alias("release")
    ).select("release", F.col("release").eqNullSafe(F.col("current")).alias("is_current"))


def resolve_release(manifest: DataFrame, version: str | None = None) -> str:
    """The release to use: ``version`` if it is supported, the current one if not given."""
    wanted = F.col("is_current") if version is None else F.col("release") == version
    found = manifest.where(wanted).select("release").head(1)
    if not found:
        what = "the current release" if version is None else f"release {version!r}"
        raise ValueError(f"{what} is not among the supported releases of the manifest")
    return found[0]["release"]


def write_manifest(spark: SparkSession, path: str, releases: Sequence[str], current: str) -> None:
    """Name the releases of a store. Write it after their tables: readers find releases by it."""
    if current not in releases:
        raise ValueError(f"the current release {current!r} is not among {list(releases)}")
    page = json.dumps({"current": current, "supported": list(releases)})
    # One row of one partition is one file.
    spark.range(0, 1, 1, 1).select(F.lit(page).alias("value")).write.mode("overwrite").text(path)
