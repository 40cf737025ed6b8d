"""Releases on Parquet, the manifest, and what changed between releases."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import talkgrain as tg
from talkgrain import plans, schemas

MANIFEST = """---
layout: null
---

{
    "host": "db.invalid",
    "current": "2020.1",
    "supported": ["2018.1", "2018.10", "dev_copy", "2020.1"],
    "historical": [],
    "user": "nobody",
    "password": "not-a-login"
}
"""


@pytest.fixture
def manifest(tmp_path):
    path = tmp_path / "manifest.json"
    path.write_text(MANIFEST)
    return str(path)


@pytest.fixture
def store(spark, tmp_path, manifest, utterances):
    base = str(tmp_path)
    early = utterances.where("transcript_id = 1")
    tg.write_release(early, base, "utterances", "2018.1")
    tg.write_release(early.limit(1), base, "utterances", "2018.10")
    tg.write_release(early.limit(2), base, "utterances", "dev_copy")
    tg.write_release(utterances.selectExpr("*", "'ph' AS phonology"), base, "utterances", "2020.1")
    transcripts = spark.createDataFrame(
        [(1, "A", "main"), (2, "B", "main")],
        "transcript_id long, corpus string, collection string",
    )
    tg.write_release(transcripts, base, "transcripts", "2020.1")
    return base


def test_manifest_without_its_login(spark, manifest, rows_of):
    loaded = tg.load_manifest(spark, manifest)
    assert rows_of(loaded) == [
        ("2018.1", False),
        ("2018.10", False),
        ("2020.1", True),
        ("dev_copy", False),
    ]
    assert loaded.columns == ["release", "is_current"]


@pytest.mark.parametrize(
    "page",
    [
        '{"current": "b", "supported": ["a", "b"]}',
        '---\n---\n{"current": "b", "supported": ["a", "b"]}',
        '---\r\nlayout: null\r\ntitle: x\r\n---\r\n\r\n{"current": "b", "supported": ["a", "b"]}',
        '\n---  \nlayout: null\n---  \n{"supported": ["a", "b"],\n "current": "b"}\n',
    ],
)
def test_manifest_with_and_without_front_matter(spark, tmp_path, page, rows_of):
    path = tmp_path / "manifest.json"
    path.write_bytes(page.encode())
    assert rows_of(tg.load_manifest(spark, str(path))) == [("a", False), ("b", True)]


def test_manifest_that_does_not_parse_is_an_error(spark, tmp_path):
    path = tmp_path / "manifest.json"
    path.write_text('---\nlayout: null\n---\n{"current": ')
    with pytest.raises(Exception, match="MALFORMED"):
        tg.load_manifest(spark, str(path)).collect()


def test_resolve(spark, manifest):
    loaded = tg.load_manifest(spark, manifest)
    assert tg.resolve_release(loaded) == "2020.1"
    assert tg.resolve_release(loaded, "2018.10") == "2018.10"
    with pytest.raises(ValueError, match="1999.1"):
        tg.resolve_release(loaded, "1999.1")


def test_resolve_when_the_current_release_is_not_supported(spark):
    manifest = spark.createDataFrame([("2018.1", False)], "release string, is_current boolean")
    with pytest.raises(ValueError, match="current"):
        tg.resolve_release(manifest)


def test_read_release(spark, store):
    current = tg.read_release(spark, store, "utterances")
    assert current.schema.fieldNames() == [*schemas.UTTERANCES.fieldNames(), "release"]
    assert current.count() == 8
    assert {tuple(r) for r in current.select("release", "phonology").collect()} == {
        ("2020.1", "ph")
    }


def test_release_names_are_not_numbers(spark, store):
    assert tg.read_release(spark, store, "utterances", "2018.1").count() == 4
    tenth = tg.read_release(spark, store, "utterances", "2018.10")
    assert [(r.release, r.phonology) for r in tenth.collect()] == [("2018.10", None)]
    everything = tg.read_releases(spark, store, "utterances").groupBy("release").count()
    assert {r["release"]: r["count"] for r in everything.collect()} == {
        "2018.1": 4,
        "2018.10": 1,
        "dev_copy": 2,
        "2020.1": 8,
    }


def test_read_release_refuses(spark, store):
    with pytest.raises(ValueError, match="2017.1"):
        tg.read_release(spark, store, "utterances", "2017.1")
    with pytest.raises(AnalysisException):
        tg.read_release(spark, store, "transcripts", "2018.1")
    with pytest.raises(ValueError, match="release name"):
        tg.write_release(spark.range(1), store, "transcripts", "../2018.1", schema="id long")


def test_read_release_with_a_schema_of_ones_own(spark, store):
    read = tg.read_release(
        spark, store, "utterances", schema="speaker string, text string, extra double"
    )
    assert read.dtypes == [
        ("speaker", "string"),
        ("text", "string"),
        ("extra", "double"),
        ("release", "string"),
    ]
    assert read.where("extra IS NULL").count() == 8


def test_writing_a_release_again_replaces_only_it(spark, store, utterances):
    tg.write_release(utterances.limit(3), store, "utterances", "2018.1")
    assert tg.read_release(spark, store, "utterances", "2018.1").count() == 3
    assert tg.read_release(spark, store, "utterances").count() == 8
    tg.write_release(utterances.limit(0), store, "utterances", "2018.1")
    assert tg.read_release(spark, store, "utterances", "2018.1").count() == 0


def test_written_columns_are_those_that_are_read(spark, tmp_path, utterances):
    base = str(tmp_path / "own")
    odd = utterances.selectExpr(
        "cast(transcript_id AS decimal(20,0)) AS transcript_id",
        "utterance_order",
        "speaker",
        "text",
        "24.5D AS age",
    )
    with pytest.warns(UserWarning, match="age"):
        tg.write_release(odd, base, "utterances", "1")
    assert tg.read_releases(spark, base, "utterances").count() == 8
    own = "transcript_id long, speaker string, age double"
    tg.write_release(odd, base, "utterances", "2", schema=own)
    assert tg.read_releases(spark, base, "utterances", own).where("age = 24.5").count() == 8
    with pytest.raises(ValueError, match="has no speaker"):
        tg.write_release(odd.drop("speaker"), base, "utterances", "3")


def test_a_manifest_is_one_file(spark, tmp_path, rows_of):
    path = str(tmp_path / "m.json")
    tg.write_manifest(spark, path, ["a", "b"], "b")
    tg.write_manifest(spark, path, ["a", "b"], "a")
    assert rows_of(tg.load_manifest(spark, path)) == [("a", True), ("b", False)]
    with pytest.raises(ValueError, match="current"):
        tg.write_manifest(spark, path, ["a"], "b")
    page = '{"current": "a", "supported": ["a"]}'
    for name in ("x", "y"):
        (tmp_path / "two").mkdir(exist_ok=True)
        (tmp_path / "two" / name).write_text(page)
    with pytest.raises(Exception, match="exactly one file"):
        tg.load_manifest(spark, str(tmp_path / "two")).collect()


def test_a_mirrored_store_opens(spark, store, tmp_path, rows_of):
    out = str(tmp_path / "copy")

    def source(table, release):
        return tg.read_release(spark, store, table, release)

    tg.mirror_store(spark, source, ["utterances"], ["2018.1", "2020.1"], "2020.1", out)
    for version in ("2018.1", "2020.1", None):
        copy = tg.read_release(spark, out, "utterances", version)
        assert rows_of(copy) == rows_of(tg.read_release(spark, store, "utterances", version))


def test_compare_unique_keys(spark, rows_of):
    old = [("A", str(i), "main" if i % 3 else None, "x") for i in range(8)]
    new = [("A", str(i), "main" if i % 2 else None, "x" if i % 5 else None) for i in range(2, 9)]
    old, new = (spark.createDataFrame([*rows, (None, "n", "main", "x")], SCHEMA) for rows in (old, new))
    plain = tg.compare_releases(old, new, KEYS, ATTRS)
    assert rows_of(tg.compare_releases(old, new, KEYS, ATTRS, unique_keys=True)) == rows_of(plain)
    with pytest.raises(Exception, match="repeated"):
        tg.compare_releases(old.union(old), new, KEYS, ATTRS, unique_keys=True).collect()


def test_mirror(spark, store, tmp_path, rows_of):
    out = str(tmp_path / "mirror")

    def source(table):
        return tg.read_release(spark, store, table)

    for _ in range(2):
        written = tg.mirror_release(spark, source, ["utterances", "transcripts"], "2020.1", out)
        assert written == {"utterances": 8, "transcripts": 2}
    for table in written:
        assert rows_of(tg.read_releases(spark, out, table)) == rows_of(source(table))


def test_stamp_and_union(spark, rows_of):
    early = tg.stamp_release(spark.createDataFrame([(1, "a")], "id long, text string"), "2018.1")
    late = tg.stamp_release(
        spark.createDataFrame([("b", 2, "ph")], "text string, id long, phonology string"), "2020.1"
    )
    assert rows_of(tg.union_releases([early, late]), "id", "text", "release", "phonology") == [
        (1, "a", "2018.1", None),
        (2, "b", "2020.1", "ph"),
    ]
    assert tg.union_releases([early]).columns == early.columns
    with pytest.raises(ValueError):
        tg.union_releases([])


KEYS, ATTRS = ["corpus", "file"], ["collection", "text"]
SCHEMA = "corpus string, file string, collection string, text string"


@pytest.mark.parametrize("digests", [[], ["text"]])
def test_compare(spark, rows_of, digests):
    old = [
        ("A", "same", "main", "x"),
        ("A", "removed", "main", "x"),
        ("A", "moved", "main", "x"),
        ("A", "moved too", "main", "x"),
        ("A", "revised", "main", "x"),
        ("A", "to null", "main", "x"),
        ("A", "null", None, None),
        (None, "null key", "main", "x"),
        ("A", "twice", "main", "x"),
    ]
    new = [
        ("A", "same", "main", "x"),
        ("A", "moved", "phon", "x"),
        ("A", "moved too", "phon", "y"),
        ("A", "revised", "main", "y"),
        ("A", "to null", "main", None),
        ("A", "null", None, None),
        (None, "null key", "main", "x"),
        ("A", "twice", "main", "x"),
        ("A", "twice", "main", "x"),
        ("B", "added", "main", "x"),
    ]
    compared = tg.compare_releases(
        spark.createDataFrame(old, SCHEMA),
        spark.createDataFrame(new, SCHEMA),
        KEYS,
        ATTRS,
        digests=digests,
    )
    assert {row.file: (row.status, row.n_old, row.n_new) for row in compared.collect()} == {
        "same": ("same", 1, 1),
        "removed": ("removed", 1, 0),
        "moved": ("moved", 1, 1),
        "moved too": ("moved", 1, 1),
        "revised": ("revised", 1, 1),
        "to null": ("revised", 1, 1),
        "null": ("same", 1, 1),
        "null key": ("same", 1, 1),
        "twice": ("revised", 1, 2),
        "added": ("added", 0, 1),
    }


def test_compare_without_attributes_and_by_one_of_them(spark, rows_of):
    old = spark.createDataFrame([("A", "f", "main", "x"), ("A", "g", "main", "x")], SCHEMA)
    new = spark.createDataFrame([("A", "f", "phon", "y")], SCHEMA)
    assert rows_of(tg.compare_releases(old, new, KEYS), "file", "status") == [
        ("f", "same"),
        ("g", "removed"),
    ]
    assert rows_of(tg.compare_releases(old, new, KEYS, ["text"]), "file", "status") == [
        ("f", "revised"),
        ("g", "removed"),
    ]
    assert rows_of(tg.compare_releases(old, new, ["corpus"], ["collection"])) == [
        ("A", 2, 1, "moved")
    ]
    with pytest.raises(ValueError, match="digests"):
        tg.compare_releases(old, new, KEYS, ["text"], digests=["collection"])


def test_compare_folds_a_key_that_is_on_most_rows(spark):
    """20,000 rows of one key on each side: a join would pair them 400 million times."""
    old = spark.range(20_000).selectExpr("'hot' AS corpus", "'main' AS collection")
    row = tg.compare_releases(old, old, ["corpus"], ["collection"]).collect()
    assert [tuple(r) for r in row] == [("hot", 20_000, 20_000, "same")]


RELEASE = st.lists(
    st.tuples(
        st.sampled_from(["k1", "k2", "k3", None]),
        st.sampled_from(["main", "phon", None]),
        st.sampled_from(["x", "y", None]),
    ),
    max_size=8,
)


@settings(max_examples=15, deadline=None)
@given(RELEASE, RELEASE)
def test_compare_against_brute_force(spark, old, new):
    schema = "key string, collection string, text string"
    compared = tg.compare_releases(
        spark.createDataFrame(old, schema),
        spark.createDataFrame(new, schema),
        ["key"],
        ["collection", "text"],
    )
    expected = set()
    for key in {row[0] for row in old + new}:
        before = [row[1:] for row in old if row[0] == key]
        after = [row[1:] for row in new if row[0] == key]
        if not before:
            status = "added"
        elif not after:
            status = "removed"
        elif {row[0] for row in before} != {row[0] for row in after}:
            status = "moved"
        elif sorted(before, key=repr) != sorted(after, key=repr):
            status = "revised"
        else:
            status = "same"
        expected.add((key, len(before), len(after), status))
    got = [tuple(row) for row in compared.collect()]
    assert len(got) == len(expected) and set(got) == expected


def test_analyses_read_the_current_release_and_say_which(spark, store, rows_of):
    assert rows_of(plans.frequency(spark, store, speakers=["CHI"])) == [
        ("CHI", "don't", 2, "2020.1"),
        ("CHI", "go", 1, "2020.1"),
    ]
    assert rows_of(plans.frequency(spark, store, corpora=["B"])) == [("MOT", "dogs", 1, "2020.1")]
    assert rows_of(plans.population_properties(spark, store, corpora=["B"])) == [
        ("B", "CHI", 1, 0, "2020.1"),
        ("B", "INV", 2, 0, "2020.1"),
        ("B", "MOT", 1, 1, "2020.1"),
    ]
    assert rows_of(plans.population_properties(spark, store, speakers=["INV"])) == [
        ("B", "INV", 2, 0, "2020.1")
    ]
    curve = plans.derived_measures(spark, store, "ttr", bin_width=10, version="2018.1")
    assert [tuple(row) for row in curve.collect()] == [
        ("CHI", 0, 2, 3, 2 / 3, "2018.1"),
        ("MOT", 0, 4, 4, 1.0, "2018.1"),
    ]


def test_arranged_rows_are_written_as_they_come(spark, tmp_path):
    rows = [(i, 1, corpus, "CHI", "x") for i, corpus in enumerate("bca")]
    names = "transcript_id long, utterance_order long, corpus string, speaker string, text string"
    df = spark.createDataFrame(rows, names).coalesce(1)
    for arranged, found in ((True, "bca"), (False, "abc")):
        tg.write_release(df, str(tmp_path), "utterances", "1", arranged=arranged)
        stored = tg.release_table(spark, str(tmp_path), "utterances", "1")
        assert "".join(row["corpus"] for row in stored.collect()) == found


def test_files_of_the_store_are_sorted_by_corpus_and_speaker(spark):
    import __spark_entry__ as driver

    base = driver._release_store(spark, "/root/testdata/sf0.01")
    for table in ("utterances", "tokens"):
        rows = tg.release_table(spark, base, table, "2020.1")
        here = rows.select("corpus", "speaker", F.input_file_name().alias("file")).collect()
        for file in {row["file"] for row in here}:
            keys = [(row["corpus"], row["speaker"]) for row in here if row["file"] == file]
            assert keys == sorted(keys)
