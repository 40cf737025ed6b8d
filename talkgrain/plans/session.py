"""Session settings that the operators are made for. All are plain Spark settings."""

from pyspark.sql import SparkSession

SETTINGS = {
    # Runtime joins and partition sizes; on by default, stated because the operators rely on it.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot transcript in with_corpus even if a later step then needs a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Cutting words is slow enough to be worth a task for little text.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.session.timeZone": "UTC",
}

# For a large cluster, over the above: longer scan tasks see each word more often before the
# shuffle, so word_frequency moves fewer rows; and many small reduce partitions are merged
# by size instead of kept for the sake of parallelism.
LARGE = {
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}


def configured(
    builder: SparkSession.Builder, large: bool = False, shuffle_partitions: int | None = None
) -> SparkSession.Builder:
    """Apply the settings to a session builder.

    ``shuffle_partitions`` is how many partitions a shuffle starts with; adaptive execution only
    merges them. Take the largest shuffle divided by what a task should read, such as 256 MB.
    """
    settings = {**SETTINGS, **(LARGE if large else {})}
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder
