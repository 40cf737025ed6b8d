import duckdb
import pytest

SF_DIR = "/root/testdata/sf0.01"

# Empty, blank and null texts, null ids, repeated rows and ids, short texts and a very long one.
LONG = " ".join(f"w{i % 977}" for i in range(60_000))
ODD = [
    (1, ""),
    (2, None),
    (3, " \t\n"),
    (None, "a b c"),
    (None, None),
    (4, "a b c"),
    (4, "a b c"),
    (4, "another text, same id"),
    (5, LONG),
    (6, LONG + " end"),
    (7, "x" * 8_000),
    (8, "é" * 3 + " \U0001f600 ok"),
]


@pytest.fixture(scope="session")
def texts():
    sql = f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet'"
    return duckdb.sql(sql).fetchall()


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Hand-made documents with a column whose name an operator could also use."""
    return spark.createDataFrame(
        [(i, t, "x", 1) for i, t in ODD], "doc_id long, text string, spans string, _text int"
    )


@pytest.fixture
def same(rows_of):
    def same(df, columns, expected):
        got = rows_of(df, *columns)
        want = sorted((tuple(row) for row in expected), key=repr)
        assert len(got) == len(want)
        assert got == want

    return same
