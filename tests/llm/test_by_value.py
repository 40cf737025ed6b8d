"""Executors need no copy of the package: every query runs with it on the driver's path alone."""

import os
import subprocess
import sys

RUN = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = (
    SparkSession.builder.master("local[4]")
    .config("spark.sql.shuffle.partitions", "4")
    .config("spark.ui.enabled", "false")
    .config("spark.checkpoint.dir", {shared!r})
    .config("spark.sql.warehouse.dir", {shared!r})
    .getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")
from talkgrain.llm import queries
for name, query in queries.queries().items():
    print(name, query(spark, "/root/testdata/sf0.001").count(), flush=True)
"""


def test_all_queries_run_without_the_package_on_executors(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run(
        [sys.executable, "-c", RUN.format(repo=repo, shared=str(tmp_path))],
        cwd=tmp_path, env=env, capture_output=True, text=True, timeout=1200,
    )
    assert run.returncode == 0, run.stderr[-2000:]
    assert len(run.stdout.split("\n")) > 13
