import duckdb
from brute import quality as brute
from conftest import ODD, SF_DIR
from pyspark.sql import functions as F

from talkgrain.llm.quality import fit_votes, judge_quality, keep_good

COLUMNS = [
    "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
]


def test_counts_on_documents(documents, texts, same):
    same(judge_quality(documents), COLUMNS, brute(texts))


def test_hand_made(spark, same):
    eight = " ".join(f"w{i}" for i in range(8))
    rows = [
        "a\nb\na\n \n \nb",
        f"{eight} x {eight} y {eight}",
        eight,
        eight + " " + eight,
        "z " * 30,
        "z " * 9,
        "é#   <b>& 100%\x0bq",
        "\n\n\n",
    ]
    docs = list(enumerate(rows))
    result = judge_quality(spark.createDataFrame(docs, "doc_id long, text string"))
    same(result, COLUMNS, brute(docs))


def test_odd_rows(odd, same):
    same(judge_quality(odd), COLUMNS, brute(ODD))
    assert judge_quality(odd.limit(0)).collect() == []
    assert keep_good(odd).columns == odd.columns


def test_good_documents_stay_and_junk_goes(spark, documents):
    judged = judge_quality(documents)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    long = judged.join(labels, "doc_id").where("not base_failed")
    rates = {r["quality"]: r["kept"] for r in long.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert rates[1] > 0.99
    assert rates[0] < 0.2


def test_keep_good_is_the_verdict(documents, rows_of):
    kept = judge_quality(documents).where("kept")
    assert rows_of(keep_good(documents), "doc_id") == rows_of(kept, "doc_id")


def test_estimated_accuracies(spark):
    """Votes drawn with known accuracies, the third rule mostly abstaining."""
    import random

    random.seed(1)
    true = [0.9, 0.7, 0.8, 0.75]
    rows = []
    for _ in range(4000):
        good = random.random() < 0.7
        vote = [(1 if good else -1) * (1 if random.random() < a else -1) for a in true]
        if random.random() < 0.6:
            vote[2] = 0
        rows.append((vote,))
    model = fit_votes(spark.createDataFrame(rows, "votes array<int>"), 4)
    assert abs(model.prior - 0.7) < 0.06
    assert all(abs(a - b) < 0.07 for a, b in zip(model.on_good, true))
    assert all(abs(a - b) < 0.07 for a, b in zip(model.on_bad, true))
