import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from talkgrain.plans import configured  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("talkgrain-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    )
    session = configured(builder).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def utterances(spark):
    """Hand-made rows for what the given tables lack."""
    rows = [
        (1, 1, "CHI", "Don't DON'T go"),
        (1, 2, "CHI", "..."),
        (1, 3, "MOT", "Straße École 2 dogs"),
        (1, 4, "MOT", ""),
        (2, 1, "CHI", None),
        (2, 2, "INV", "... !"),
        (2, 3, "INV", None),
        (2, 4, "MOT", "dogs"),
    ]
    return spark.createDataFrame(
        rows, "transcript_id long, utterance_order long, speaker string, text string"
    )


@pytest.fixture
def rows_of():
    def rows_of(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(row) for row in picked.collect()), key=repr)

    return rows_of
