"""What is asked of Spark's JDBC reader. No database is started, so the reader is replaced."""

import pytest
from pyspark.sql import DataFrameReader

import talkgrain as tg

URL = "jdbc:mysql://db.invalid/release_2020_1"


@pytest.fixture
def asked(spark, monkeypatch, utterances):
    calls = []

    def jdbc(self, url, table, **options):
        calls.append((url, table, options))
        return utterances

    monkeypatch.setattr(DataFrameReader, "jdbc", jdbc)
    return calls


def test_the_read_is_cut_by_key(spark, asked):
    tg.read_release_jdbc(spark, URL, "utterances", "id", 1, 1000, 8)
    assert asked == [
        (
            URL,
            "utterances",
            {
                "column": "id",
                "lowerBound": 1,
                "upperBound": 1000,
                "numPartitions": 8,
                "properties": {"fetchsize": "10000"},
            },
        )
    ]


def test_the_caller_sets_login_and_fetch_size(spark, asked):
    tg.read_release_jdbc(
        spark, URL, "utterances", "id", 1, 9, 2, {"user": "me", "fetchsize": "500"}
    )
    assert asked[0][2]["properties"] == {"fetchsize": "500", "user": "me"}


def test_mirror_from_a_database(spark, asked, tmp_path, rows_of, utterances):
    source = tg.jdbc_tables(
        spark, URL, {"utterances": tg.JdbcSplit("id", 1, 1000, 4)}, {"user": "me"}
    )
    out = str(tmp_path)
    assert tg.mirror_release(spark, source, ["utterances"], "2020.1", out) == {"utterances": 8}
    copy = tg.read_releases(spark, out, "utterances")
    assert rows_of(copy.drop("release", "phonology", "corpus")) == rows_of(utterances)
    assert asked[0][2]["numPartitions"] == 4
    with pytest.raises(KeyError):
        source("tokens")
