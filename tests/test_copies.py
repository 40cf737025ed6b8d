"""Copies by ranges, releases whose types changed, sketches, and the SQL functions."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import talkgrain as tg

SCHEMA = "k long, text string"


def ranged(rows):
    """A source that counts what it is asked for."""
    asked = []

    def source(low, high):
        asked.append((low, high))
        key = F.col("k")
        below = F.lit(True) if high is None else key < high
        if low is None:
            return rows.where(key.isNull() | below)
        return rows.where((key >= low) & below)

    return source, asked


@pytest.fixture
def rows(spark):
    data = [(i, f"t{i % 7}") for i in range(100)] + [(None, "no key"), (5, None), (5, "t5")]
    return spark.createDataFrame(data, SCHEMA)


def test_a_copy_by_ranges(spark, rows, rows_of, tmp_path):
    source, asked = ranged(rows)
    ledger = tg.mirror_ranges(spark, source, "things", "1", [30, 60], str(tmp_path), SCHEMA)
    assert asked == [(None, 30), (30, 60), (60, None)]
    assert rows_of(ledger, "range", "low", "high", "n") == [(0, None, 30, 33), (1, 30, 60, 30), (2, 60, None, 40)]
    copy = tg.release_table(spark, str(tmp_path), "things", "1", SCHEMA)
    assert copy.columns == ["k", "text", "release"]
    assert rows_of(copy.drop("release")) == rows_of(rows)
    every = tg.read_releases(spark, str(tmp_path), "things", SCHEMA)
    assert rows_of(every.drop("release")) == rows_of(rows)


def test_a_stopped_copy_goes_on(spark, rows, rows_of, tmp_path):
    whole, asked = ranged(rows)

    def stops(low, high):
        if low == 60:
            raise OSError("the source is gone")
        return whole(low, high)

    arguments = ("things", "1", [30, 60], str(tmp_path), SCHEMA)
    with pytest.raises(OSError):
        tg.mirror_ranges(spark, stops, *arguments)
    # What a range that was not proven has left is written over.
    rows.limit(3).write.parquet(f"{tmp_path}/things/release=1/range=2")
    asked.clear()
    tg.mirror_ranges(spark, whole, *arguments)
    assert asked == [(60, None)]
    assert rows_of(tg.release_table(spark, str(tmp_path), "things", "1", SCHEMA).drop("release")) == rows_of(rows)
    with pytest.raises(ValueError, match="other bounds"):
        tg.mirror_ranges(spark, whole, "things", "1", [10], str(tmp_path), SCHEMA)


def test_a_copy_that_differs_stops_the_run(spark, rows, tmp_path, monkeypatch):
    """The counts agree, but a row is another one in the copy."""
    from pyspark.sql.readwriter import DataFrameReader

    source, _ = ranged(rows)
    read = DataFrameReader.parquet

    def changed(self, path):
        found = read(self, path)
        return found.withColumn("text", F.coalesce("text", F.lit("t5"))) if "range=0" in path else found

    monkeypatch.setattr(DataFrameReader, "parquet", changed)
    with pytest.raises(RuntimeError, match="things, keys from None to 30"):
        tg.mirror_ranges(spark, source, "things", "1", [30, 60], str(tmp_path), SCHEMA)


def test_digests_tell_multisets_apart(spark, rows):
    def digest(df):
        return tuple(df.agg(*tg.multiset_digest(["k", "text"])).first())

    one = spark.createDataFrame([(1, "a")], SCHEMA)
    two = spark.createDataFrame([(2, "a")], SCHEMA)
    assert digest(rows) == digest(rows.orderBy(F.desc("k")).repartition(5))
    # Two of one row and two of another cancel out in an exclusive or, but not in the sum.
    assert digest(one.union(one)) != digest(two.union(two))
    assert digest(one.union(one)) != digest(one)
    assert digest(spark.createDataFrame([(None, "1")], SCHEMA)) != digest(spark.createDataFrame([(1, None)], SCHEMA))
    assert digest(one.limit(0)) == (0, 0, 0)


def test_differing_ranges(spark, rows, rows_of):
    copy = rows.where("k IS NULL OR k <> 42").union(rows.where("k = 41"))
    assert rows_of(tg.differing_ranges(rows, copy, "k", 10)) == [(40, 50, 10, 10)]
    assert tg.differing_ranges(rows, rows, "k", 10).collect() == []
    assert rows_of(tg.differing_ranges(rows, rows.where("k IS NOT NULL"), "k", 1000)) == [(None, None, 1, None)]


# -------------------------------------------------------------------------------- types


@pytest.mark.parametrize(
    "types,wanted",
    [
        (["int", "bigint"], "bigint"),
        (["tinyint", "smallint"], "smallint"),
        (["bigint", "decimal(12,2)"], "decimal(21,2)"),
        (["decimal(10,0)", "decimal(5,4)"], "decimal(14,4)"),
        (["int", "double"], "double"),
        (["bigint", "string"], "string"),
        (["bigint", "decimal(10,0)", "string"], "string"),
        (["date", "timestamp"], "timestamp"),
        (["boolean", "int"], "string"),
        (["array<int>", "array<int>"], "array<int>"),
        (["decimal(38,0)", "decimal(38,38)"], "string"),
    ],
)
def test_common_types(types, wanted):
    fields = T.StructType.fromDDL(", ".join(f"c{i} {t}" for i, t in enumerate(types)))
    assert tg.common_type([f.dataType for f in fields]).simpleString() == wanted
    assert tg.common_type([f.dataType for f in reversed(fields.fields)]).simpleString() == wanted


@pytest.mark.parametrize("types", [["bigint", "double"], ["array<int>", "array<bigint>"], ["double", "string"], ["binary", "string"]])
def test_types_that_nothing_holds(types):
    fields = T.StructType.fromDDL(", ".join(f"c{i} {t}" for i, t in enumerate(types)))
    with pytest.raises(ValueError, match="without loss"):
        tg.common_type([f.dataType for f in fields])


def test_releases_whose_types_changed(spark, rows_of):
    big = 2**60 + 1
    releases = [
        spark.createDataFrame([(big, "a")], "id long, Name string"),
        spark.createDataFrame([("x-1", 1)], "id string, name int"),
        spark.createDataFrame([(True,)], "other boolean"),
    ]
    stacked = tg.union_releases(releases, widen=True)
    assert stacked.dtypes == [("id", "string"), ("Name", "string"), ("other", "boolean")]
    assert rows_of(stacked) == sorted([(str(big), "a", None), ("x-1", "1", None), (None, None, True)], key=repr)
    with pytest.raises(ValueError, match="column id"):
        tg.union_releases([releases[0], spark.createDataFrame([(0.5,)], "id double")], widen=True)


# ----------------------------------------------------------------------------- sketches


def test_sketches_estimate_any_grouping(spark):
    rows = [(t, "CHI" if t % 3 else "MOT", " ".join(f"w{(t * 37 + i) % 3000}" for i in range(60))) for t in range(200)]
    df = spark.createDataFrame([*rows, (999, "INV", "..."), (998, None, None)], "transcript_id long, speaker string, text string")
    sketches = tg.type_sketches(df)
    assert sketches.columns == ["transcript_id", "speaker", "n_tokens", "types"]
    for by in (["speaker"], ["transcript_id", "speaker"], []):
        exact = {tuple(r[c] for c in by): r for r in tg.type_token_ratio(df, by).collect()}
        for r in tg.estimated_type_token_ratio(sketches, by).collect():
            true = exact[tuple(r[c] for c in by)]
            assert r["n_tokens"] == true["n_tokens"]
            assert abs(r["n_types"] - true["n_types"]) <= 0.05 * true["n_types"]
            assert (r["ttr"] is None) == (true["ttr"] is None)


# ---------------------------------------------------------------------------------- SQL


@pytest.fixture
def store(spark, tmp_path, utterances):
    base = str(tmp_path)
    with_corpus = utterances.withColumn("corpus", F.when(F.col("transcript_id") == 1, "A"))
    tg.write_release(with_corpus, base, "utterances", "1")
    tg.write_release(with_corpus.where("speaker <> 'INV'"), base, "utterances", "2")
    tg.write_manifest(spark, f"{base}/manifest.json", ["1", "2"], "2")
    return base


def test_sql_gives_the_measures(spark, store, rows_of):
    names = tg.register_sql(spark, store, "s_")
    assert {"s_utterances", "s_word_frequency", "s_mlu_w", "s_type_token_ratio", "s_population"} <= set(names)
    assert "s_tokens" not in names
    for version, arguments in (("2", ""), ("1", "'1'"), ("1", "version => '1'")):
        rows = tg.release_table(spark, store, "utterances", version)
        for name, measure, by in (
            ("word_frequency", tg.word_frequency, ["speaker"]),
            ("mlu_w", tg.mlu_w, ["speaker"]),
            ("type_token_ratio", tg.type_token_ratio, ["speaker"]),
        ):
            got = spark.sql(f"SELECT * FROM s_{name}({arguments})")
            assert rows_of(got) == rows_of(tg.stamp_release(measure(rows, by), version))
    picked = spark.sql("SELECT word FROM s_word_frequency('1', array('CHI'), array('A')) WHERE n = 2")
    assert rows_of(picked) == [("don't",)]
    counts = spark.sql("SELECT corpus, speaker, n_utterances, n_tokens FROM s_population('1')")
    rows = tg.release_table(spark, store, "utterances", "1")
    both = tg.population_utterances(rows).join(tg.population_tokens(rows).withColumnsRenamed({"corpus": "c", "speaker": "s"}), F.col("corpus").eqNullSafe(F.col("c")) & (F.col("speaker") == F.col("s")))
    assert rows_of(counts) == rows_of(both, "corpus", "speaker", "n_utterances", "n_tokens")
    assert spark.sql("SELECT s_word_count(\"it's a dog's\") AS n, s_word_count(NULL) AS z").first()[:] == (3, 0)


def test_sql_reads_one_release_and_few_columns(spark, store):
    tg.register_sql(spark, store)
    plan = spark.sql("SELECT * FROM mlu_w('1')")._jdf.queryExecution().executedPlan().toString()
    assert "(release" in plan and " = 1)" in plan
    assert "ReadSchema: struct<speaker:string,text:string>" in plan


def test_sql_of_an_unknown_release_stops(spark, store):
    tg.register_sql(spark, store)
    with pytest.raises(Exception, match="release 7 is not supported"):
        spark.sql("SELECT * FROM utterances('7')").collect()


def test_copies_and_releases_are_written_small(spark, tmp_path):
    rows = spark.range(100).select(
        F.col("id").alias("transcript_id"), F.lit("a").alias("corpus"), F.lit("main").alias("collection")
    )
    tg.write_release(rows, f"{tmp_path}/a", "transcripts", "1")
    tg.mirror_ranges(spark, lambda low, high: rows.where("false") if low else rows, "transcripts", "1", [500], f"{tmp_path}/b")
    for folder in "ab":
        files = list((tmp_path / folder / "transcripts").rglob("*.parquet"))
        assert files and all(".zstd." in file.name for file in files)
