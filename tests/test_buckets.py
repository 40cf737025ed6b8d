"""Releases laid out by transcript."""

import pytest
from pyspark.sql import functions as F

import talkgrain as tg
from talkgrain.sources.buckets import bucketed_name


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def tables(spark, tmp_path, monkeypatch):
    """Utterances and two releases of transcripts; small tables are not broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    base, prefix = str(tmp_path), f"t{abs(hash(str(tmp_path))):x}_"
    utterances = spark.range(3000).select(
        (F.col("id") % 70).alias("transcript_id"),
        F.col("id").alias("utterance_order"),
        F.lit("CHI").alias("speaker"),
        F.lit("a b").alias("text"),
    )
    transcripts = spark.range(60).select(
        F.col("id").alias("transcript_id"),
        F.concat(F.lit("c"), F.col("id") % 3).alias("corpus"),
        F.lit("main").alias("collection"),
    )
    later = transcripts.where("transcript_id <> 3").withColumn(
        "collection", F.when(F.col("transcript_id") == 4, "phon").otherwise("main")
    ).withColumn("corpus", F.when(F.col("transcript_id") == 5, "c9").otherwise(F.col("corpus")))
    tg.write_bucketed(utterances, base, "utterances", "2019.1", 8, prefix=prefix)
    tg.write_bucketed(transcripts, base, "transcripts", "2019.1", 8, prefix=prefix)
    tg.write_bucketed(later, base, "transcripts", "2020.1", 8, prefix=prefix)
    yield utterances, transcripts, later, prefix
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_join_by_transcript_has_no_shuffle(spark, tables, rows_of):
    utterances, transcripts, _, prefix = tables
    joined = tg.with_corpus(
        tg.bucketed_table(spark, "utterances", "2019.1", prefix),
        tg.bucketed_table(spark, "transcripts", "2019.1", prefix),
    )
    assert "Exchange" not in plan(joined)
    columns = ["transcript_id", "utterance_order", "speaker", "text", "corpus"]
    assert rows_of(joined, *columns) == rows_of(tg.with_corpus(utterances, transcripts), *columns)


def test_a_comparison_by_transcript_has_no_shuffle_of_the_release(spark, tables, rows_of):
    _, transcripts, later, prefix = tables
    old, new = (tg.bucketed_table(spark, "transcripts", r, prefix) for r in ("2019.1", "2020.1"))
    attrs = ["corpus", "collection"]
    found = tg.compare_releases(old, new, ["transcript_id"], attrs, unique_keys=True, co_located=True)
    # What is left of a shuffle is for the one NULL key.
    filters = [line for line in plan(found).splitlines() if "Exchange" in line]
    assert len(filters) <= 1
    assert rows_of(found) == rows_of(tg.compare_releases(transcripts, later, ["transcript_id"], attrs))
    assert {r["status"] for r in found.collect()} == {"same", "moved", "removed", "revised"}


def test_null_and_repeated_keys(spark, rows_of):
    schema = "k long, v string"
    old = spark.createDataFrame([(None, "a"), (1, None), (2, "x")], schema)
    new = spark.createDataFrame([(None, "b"), (1, None), (3, "x")], schema)
    found = tg.compare_releases(old, new, ["k"], ["v"], unique_keys=True, co_located=True)
    assert rows_of(found) == rows_of(tg.compare_releases(old, new, ["k"], ["v"]))
    with pytest.raises(Exception, match="a key is repeated"):
        tg.compare_releases(old.union(old), new, ["k"], ["v"], unique_keys=True, co_located=True).collect()
    with pytest.raises(ValueError, match="co_located"):
        tg.compare_releases(old, new, ["k"], ["v"], co_located=True)


def test_a_hot_transcript_is_left_where_it_is_spread(spark, tmp_path):
    hot = spark.range(40_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("transcript_id"),
        F.lit("c").alias("corpus"),
    )
    with pytest.raises(ValueError, match="too large"):
        tg.write_bucketed(hot, str(tmp_path), "transcripts", "1", 16)


def test_names_of_releases_do_not_meet():
    names = {bucketed_name("t", r) for r in ("2019.1", "2019_1", "2019-1", "20191", "2019_2e_1")}
    assert len(names) == 5


def test_a_stored_corpus_that_is_not_the_transcripts_stops(spark, tmp_path, rows_of):
    base = str(tmp_path)
    schema = "transcript_id long, utterance_order long, corpus string, speaker string, text string"
    rows = [(1, 1, "A", "CHI", "x"), (1, 2, "B", "CHI", "x"), (1, 3, None, "CHI", "x"), (9, 1, "Z", "CHI", "x"), (None, 1, "Z", "CHI", "x")]
    transcripts = spark.createDataFrame([(1, "A"), (1, "A"), (2, "B")], "transcript_id long, corpus string")
    utterances = spark.createDataFrame(rows, schema)
    assert rows_of(tg.corpus_conflicts(utterances, transcripts)) == [(1, "B", "A", 1)]
    tg.write_release(transcripts, base, "transcripts", "1")
    tg.write_release(utterances, base, "utterances", "1")
    with pytest.raises(ValueError, match="transcript 1 are stored under corpus 'B'"):
        tg.check_release(spark, base, "1", ["utterances"])
    tg.write_release(utterances.where("utterance_order <> 2"), base, "utterances", "1")
    tg.check_release(spark, base, "1", ["utterances"])
