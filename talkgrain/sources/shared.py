"""Where tables that a job writes for itself may go."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path under the folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of this machine: on a
    cluster the executors would not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="talkgrain-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
