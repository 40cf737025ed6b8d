"""Measures on hand-made rows, their properties, and words against a second implementation."""

import random

import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import talkgrain as tg
from talkgrain.operators import diversity


def test_words_and_counts(utterances, rows_of):
    got = rows_of(tg.tokenize(utterances), "transcript_id", "utterance_order", "words", "n_tokens")
    assert got == sorted(
        [
            (1, 1, ["don't", "don't", "go"], 3),
            (1, 2, [], 0),
            (1, 3, ["straße", "école", "2", "dogs"], 4),
            (1, 4, [], 0),
            (2, 1, None, 0),
            (2, 2, [], 0),
            (2, 3, None, 0),
            (2, 4, ["dogs"], 1),
        ],
        key=repr,
    )


def test_null_counts_zero_whatever_size_of_null_is(spark, utterances, rows_of):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert rows_of(tg.population_tokens(utterances, ["speaker"])) == [
            ("CHI", 3),
            ("INV", 0),
            ("MOT", 5),
        ]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


WORD = r"[\p{L}\p{N}\p{M}]++(?:['’][\p{L}\p{N}\p{M}]++)*+"


def test_capital_letters_that_depend_on_context(spark):
    texts = ["İstanbul DA", "ΑΣ.Β", "ΑΣ", "Α.Σ"]
    df = spark.createDataFrame([(text,) for text in texts], "text string")
    rows = df.select("text", tg.words(F.col("text")).alias("w"), tg.word_count(F.col("text")))
    for text, words, count in rows.collect():
        runs = regex.findall(WORD, text)
        assert words == [run.replace("’", "'").lower() for run in runs]
        assert count == len(runs)


def test_words_with_marks_and_apostrophes(spark):
    texts = {
        "cafe\u0301s": ["cafe\u0301s"],
        "हिन्दी": ["हिन्दी"],
        "'hello' don’t ' x'' o'clock's": ["hello", "don't", "x", "o'clock's"],
        "a'" * 20_000: ["a'" * 19_999 + "a"],
    }
    df = spark.createDataFrame([(text,) for text in texts], "text string")
    for text, words in df.select("text", tg.words(F.col("text"))).collect():
        assert words == texts[text]


ALPHABET = "abzABZ019 '.,-\n\t’ßéÉñÑüÜçøØłŁжЖאあ中ⅣÀİΣσΑ𝐀́"


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=1, max_size=40))
def test_words_are_the_runs_lower_cased(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    rows = df.select("i", tg.words(F.col("text")).alias("w"), tg.word_count(F.col("text")))
    for i, words, count in rows.collect():
        runs = regex.findall(WORD, texts[i])
        assert words == [run.replace("’", "'").lower() for run in runs]
        assert count == len(runs)


def test_tokens_count_from_one(utterances, rows_of):
    got = rows_of(tg.tokens(utterances.where("utterance_order = 1")))
    assert got == [
        (1, 1, "CHI", 1, "don't"),
        (1, 1, "CHI", 2, "don't"),
        (1, 1, "CHI", 3, "go"),
    ]


def test_word_frequency(utterances, rows_of):
    assert rows_of(tg.word_frequency(utterances)) == [
        ("CHI", "don't", 2),
        ("CHI", "go", 1),
        ("MOT", "2", 1),
        ("MOT", "dogs", 2),
        ("MOT", "straße", 1),
        ("MOT", "école", 1),
    ]


def test_mlu_leaves_out_utterances_without_words(utterances, rows_of):
    assert rows_of(tg.mlu_w(utterances)) == [
        ("CHI", 1, 3, 3.0),
        ("INV", 0, 0, None),
        ("MOT", 2, 5, 2.5),
    ]


def test_ttr_keeps_groups_without_words(utterances, rows_of):
    assert rows_of(tg.type_token_ratio(utterances)) == [
        ("CHI", 2, 3, 2 / 3),
        ("INV", 0, 0, None),
        ("MOT", 4, 5, 0.8),
    ]


def test_population_counts_every_utterance(utterances, rows_of):
    assert rows_of(tg.population_utterances(utterances, ["speaker"])) == [
        ("CHI", 3),
        ("INV", 2),
        ("MOT", 3),
    ]


def test_population_over_transcripts(spark, utterances, rows_of):
    transcripts = spark.createDataFrame([(1, "A"), (2, "B")], "transcript_id long, corpus string")
    joined = tg.with_corpus(utterances, transcripts)
    both = rows_of(tg.population(utterances, transcripts))
    assert both == [
        ("A", "CHI", 2, 3),
        ("A", "MOT", 2, 4),
        ("B", "CHI", 1, 0),
        ("B", "INV", 2, 0),
        ("B", "MOT", 1, 1),
    ]
    assert [row[:3] for row in both] == rows_of(tg.population_utterances(joined))
    assert [row[:2] + row[3:] for row in both] == rows_of(tg.population_tokens(joined))


def test_columns_that_are_there_are_used(utterances, rows_of):
    tokenized = tg.tokenize(utterances)
    for measure in (tg.word_frequency, tg.mlu_w, tg.type_token_ratio):
        assert rows_of(measure(tokenized.drop("text"))) == rows_of(measure(utterances))
    by = ["speaker"]
    expected = rows_of(tg.population_tokens(utterances, by))
    assert rows_of(tg.population_tokens(tokenized.drop("text", "n_tokens"), by)) == expected
    assert rows_of(tg.tokens(tokenized.drop("text"))) == rows_of(tg.tokens(utterances))


def test_growth_curve_bins(utterances):
    curve = tg.growth_curve(utterances, "mlu_w", "utterance_order", bin_width=2)
    assert [tuple(row) for row in curve.collect()] == [
        ("CHI", 0, 1, 3, 3.0),
        ("CHI", 1, 0, 0, None),
        ("INV", 1, 0, 0, None),
        ("MOT", 1, 1, 4, 4.0),
        ("MOT", 2, 1, 1, 1.0),
    ]


def test_growth_curve_of_ttr_is_pooled_per_bin(spark):
    rows = [(0.5, "S", "a a b"), (0.9, "S", "a c"), (1.0, "S", "a"), (None, "S", "z")]
    df = spark.createDataFrame(rows, "age double, speaker string, text string")
    curve = tg.growth_curve(df, "ttr", "age")
    assert [tuple(row) for row in curve.collect()] == [
        ("S", None, 1, 1, 1.0),
        ("S", 0, 3, 5, 0.6),
        ("S", 1, 1, 1, 1.0),
    ]


@pytest.mark.parametrize("measure, width", [("median", 1), ("ttr", 0), ("mlu_w", -1)])
def test_growth_curve_refuses(utterances, measure, width):
    with pytest.raises(ValueError):
        tg.growth_curve(utterances, measure, "utterance_order", bin_width=width)


SPEECH = st.lists(
    st.tuples(
        st.sampled_from(["CHI", "MOT", "INV"]),
        st.one_of(st.none(), st.lists(st.sampled_from(["go", "Dog", "!", "..."])).map(" ".join)),
    ),
    min_size=1,
    max_size=30,
)


@settings(max_examples=10, deadline=None)
@given(SPEECH)
def test_measures_agree_with_each_other(spark, speech):
    df = spark.createDataFrame(speech, "speaker string, text string")
    by = ["speaker"]
    tokens = {row.speaker: row.n_tokens for row in tg.population_tokens(df, by).collect()}
    frequency = tg.word_frequency(df).groupBy("speaker").agg(F.sum("n").alias("n"))
    assert {row.speaker: row.n for row in frequency.collect()} == {
        speaker: n for speaker, n in tokens.items() if n
    }
    for row in tg.type_token_ratio(df).collect():
        assert row.n_tokens == tokens[row.speaker]
        assert row.ttr is None if row.n_tokens == 0 else 0 < row.ttr <= 1
    for row in tg.mlu_w(df).collect():
        assert row.n_tokens == tokens[row.speaker]
        assert row.mlu_w is None or row.mlu_w * row.n_utterances == pytest.approx(row.n_tokens)


def test_filters(utterances):
    assert tg.for_speakers(utterances, ["CHI", "INV"]).count() == 5
    assert tg.for_speakers(utterances, "CHI").count() == 3
    assert tg.for_speakers(utterances, []).count() == 0
    corpora = utterances.withColumn("corpus", F.concat(F.lit("C"), "transcript_id"))
    assert tg.for_corpora(corpora, {"C2", "none"}).count() == 4


def test_lines(spark, rows_of):
    documents = spark.createDataFrame(
        [(1, "a b\n\nc", "en", "S"), (2, "", "de", "S"), (3, None, "fr", "T")],
        "doc_id long, text string, lang string, source string",
    )
    assert rows_of(tg.lines_as_utterances(documents)) == [
        (1, 1, "S", "en", "a b"),
        (1, 2, "S", "en", ""),
        (1, 3, "S", "en", "c"),
        (2, 1, "S", "de", ""),
    ]


@pytest.mark.parametrize("salts", [1, 4])
@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_with_corpus_is_the_same_on_every_path(spark, salts, broadcast, rows_of):
    """One transcript holds most rows, one has no corpus, one corpus has no rows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        utterances = spark.range(3000).select(
            F.when(F.col("id") < 2000, 7).otherwise(F.col("id") % 5).cast("long")
            .alias("transcript_id"),
            F.col("id").alias("utterance_order"),
            F.lit("CHI").alias("speaker"),
            F.lit("go").alias("text"),
        )
        transcripts = spark.createDataFrame(
            [(7, "A"), (0, "A"), (1, "B"), (2, "B"), (3, None), (9, "C")],
            "transcript_id long, corpus string",
        )
        joined = tg.with_corpus(utterances, transcripts, salts)
        assert set(joined.columns) == {*utterances.columns, "corpus"}
        counts = joined.groupBy("transcript_id", "corpus").count()
        assert rows_of(counts) == [
            (0, "A", 200),
            (1, "B", 200),
            (2, "B", 200),
            (3, None, 200),
            (4, None, 200),
            (7, "A", 2000),
        ]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bins_of_decimal_width(spark):
    times = [(x, "a", "S") for x in (0.0, 0.1, 0.2, 0.3, 0.6, 0.7, -0.1)]
    df = spark.createDataFrame(times, "age double, text string, speaker string")
    curve = tg.growth_curve(df, "mlu_w", "age", 0.1)
    assert [r["bin"] for r in curve.collect()] == [-1, 0, 1, 2, 3, 6, 7]
    whole = spark.createDataFrame([(7, "a", "S"), (-1, "a", "S")], "t long, text string, speaker string")
    assert [r["bin"] for r in tg.growth_curve(whole, "mlu_w", "t", 3).collect()] == [-1, 2]


def test_orphans_and_repeated_transcripts(spark, utterances, rows_of):
    transcripts = spark.createDataFrame([(1, "A"), (1, "A")], "transcript_id long, corpus string")
    joined = tg.with_corpus(utterances, transcripts)
    assert joined.count() == 8 and joined.where("corpus IS NULL").count() == 4
    assert rows_of(tg.with_corpus(utterances, transcripts, salts=3)) == rows_of(joined)
    both = tg.population(utterances, transcripts)
    keys = ["corpus", "speaker"]
    assert rows_of(both, *keys, "n_utterances") == rows_of(tg.population_utterances(joined))
    assert rows_of(both, *keys, "n_tokens") == rows_of(tg.population_tokens(joined))
    unlike = transcripts.union(spark.createDataFrame([(1, "B")], transcripts.schema))
    with pytest.raises(Exception, match="more than one corpus"):
        tg.with_corpus(utterances, unlike).collect()


@pytest.mark.parametrize("measure", ["mlu_w", "ttr"])
def test_curve_over_a_time_of_the_transcripts(spark, utterances, rows_of, measure):
    transcripts = spark.createDataFrame([(1, 24.5)], "transcript_id long, age double")
    aged = utterances.withColumn("age", F.when(F.col("transcript_id") == 1, 24.5))
    curve = tg.growth_curve_by_transcript(utterances, transcripts, measure, "age", 12)
    assert rows_of(curve) == rows_of(tg.growth_curve(aged, measure, "age", 12))


@pytest.mark.parametrize("dealt_whole", [True, False])
def test_moving_ratio_by_chunks(spark, monkeypatch, dealt_whole):
    """Chunks of two runs, which utterances and repeated words reach over."""
    monkeypatch.setattr(diversity, "_RUNS", 2)
    if not dealt_whole:
        monkeypatch.setattr(diversity, "_MOST_CHUNK", 0)
    random.seed(4)
    spoken = [
        (who, t, u, " ".join(random.choices("a b C d’s e f".split(), k=random.choice([0, 1, 2, 30]))))
        for who in ("x", "y", None) for t in range(4) for u in range(3)
    ]
    spoken += [("z", 1, 1, "a b"), ("z", 1, 2, None)]
    df = spark.createDataFrame(spoken, "speaker string, transcript_id long, utterance_order long, text string")
    for window in (1, 3, 7):
        expected = {}
        for who in ("x", "y", None, "z"):
            words = [w for s, _, _, text in spoken if s == who for w in (text or "").lower().split()]
            sets = [len(set(words[i : i + window])) for i in range(len(words) - window + 1)]
            expected[who] = (len(words), len(sets), sum(sets) / (window * len(sets)) if sets else None)
        for given in (df, tg.tokenize(df).drop("text")):
            got = tg.moving_type_token_ratio(given, window).collect()
            assert {r["speaker"]: (r["n_tokens"], r["n_windows"]) for r in got} == {k: v[:2] for k, v in expected.items()}
            assert all(r["mttr"] == pytest.approx(expected[r["speaker"]][2]) for r in got)
