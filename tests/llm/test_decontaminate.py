import duckdb
from brute import contaminated as brute
from conftest import ODD, SF_DIR

from talkgrain.llm.decontaminate import contaminated, contamination_digest

COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def test_documents(spark, documents, texts, same):
    path = f"{SF_DIR}/benchmark.parquet"
    items = duckdb.sql(f"SELECT item_id, text FROM '{path}'").fetchall()
    result = contamination_digest(contaminated(documents, spark.read.parquet(path)))
    expected = list(brute(texts, items))
    assert any(row[-1] for row in expected) and not all(row[-1] for row in expected)
    same(result, COLUMNS, expected)


def test_hand_made(spark, same):
    w = [f"w{i}" for i in range(40)]
    items = [
        (1, " ".join(w[:14])),
        (2, "Short-Item here"),
        (2, "second row of the id"),
        (3, ""),
        (4, None),
        (None, " ".join(w[20:31])),
        (5, " ".join(w[4:14])),
        (6, "the the the the the the the the the the the"),
        (7, "ÀB é1"),
    ]
    docs = [
        (10, " ".join(w)),
        (10, " ".join(w[:9])),
        (11, "so: SHORT item, HERE; short item here"),
        (12, "the " * 30),
        (13, " ".join(w[3:14]).upper()),
        (None, " ".join(w[:10]) + " x " + " ".join(w[1:12])),
        (14, "Àb é1 àb é1"),
        (15, " ".join(w[5:14])),
    ]
    schema = "doc_id long, text string"
    result = contamination_digest(
        contaminated(
            spark.createDataFrame(docs, schema),
            spark.createDataFrame(items, "item_id long, text string"),
        )
    )
    same(result, COLUMNS, brute(docs, items))


def test_odd_rows(spark, odd, same):
    items = [(1, "a b c"), (2, " ".join(f"w{i % 977}" for i in range(970, 990))), (3, "text, same")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    same(contamination_digest(contaminated(odd, benchmark)), COLUMNS, brute(ODD, items))
    assert contaminated(odd.limit(0), benchmark).collect() == []
    none = contamination_digest(contaminated(odd, benchmark.limit(0)))
    same(none, COLUMNS, brute(ODD, []))


def test_a_full_bitmap_loses_nothing(spark, documents, texts, same):
    path = f"{SF_DIR}/benchmark.parquet"
    benchmark = spark.read.parquet(path)
    few = contamination_digest(contaminated(documents, benchmark, most_bits=1024))
    items = duckdb.sql(f"SELECT item_id, text FROM '{path}'").fetchall()
    same(few, COLUMNS, brute(texts, items))
