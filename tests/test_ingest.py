"""Transcripts from XML files."""

import pytest
from pyspark.sql import types as T

import talkgrain as tg

NESTED = T.StructType(
    [
        T.StructField("_id", T.StringType()),
        T.StructField(
            "u",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("_who", T.StringType()),
                        T.StructField("w", T.ArrayType(T.StringType())),
                    ]
                )
            ),
        ),
    ]
)

FIRST = """<?xml version="1.0" encoding="UTF-8"?>
<corpus>
  <t id="1">
    <u who="CHI"><w>Don't</w><w>go</w></u>
    <u who="CHI"></u>
    <u who="MOT"><w>école</w><w>&lt;b&gt;</w></u>
  </t>
  <!-- a remark -->
  <t id="2">
    <u who="MOT"><w>one</w></u>
  </t>
</corpus>
"""

SECOND = '<corpus><t id="3"><u who="INV"><w>x</w><w>y</w><w>z</w></u></t></corpus>'

ROWS = [
    (1, 1, "CHI", "Don't go"),
    (1, 2, "CHI", ""),
    (1, 3, "MOT", "école <b>"),
    (2, 1, "MOT", "one"),
    (3, 1, "INV", "x y z"),
]


def layout(**changes):
    fields = {
        "row_tag": "t",
        "schema": NESTED,
        "transcript_id": "_id",
        "utterances": "u",
        "speaker": "_who",
        "words": "w",
    }
    return tg.TranscriptLayout(**{**fields, **changes})


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "first.xml").write_text(FIRST)
    (tmp_path / "second.xml").write_text(SECOND)
    return tmp_path


@pytest.mark.parametrize("split_files", [False, True])
def test_nested_transcripts(spark, folder, rows_of, split_files):
    utterances = tg.ingest_transcripts(spark, str(folder), layout(), split_files)
    assert utterances.dtypes == [
        ("transcript_id", "bigint"),
        ("utterance_order", "bigint"),
        ("speaker", "string"),
        ("text", "string"),
        ("words", "array<string>"),
    ]
    assert rows_of(utterances.drop("words")) == ROWS
    assert rows_of(tg.tokens(utterances).where("transcript_id = 1")) == [
        (1, 1, "CHI", 1, "don't"),
        (1, 1, "CHI", 2, "go"),
        (1, 3, "MOT", 1, "école"),
        (1, 3, "MOT", 2, "<b>"),
    ]


@pytest.mark.parametrize("split_files", [False, True])
def test_a_broken_file_stops_the_run(spark, folder, split_files):
    (folder / "third.xml").write_text('<corpus><t id="4"><u who="X"><w>a</u></t></corpus>')
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
        tg.ingest_transcripts(spark, str(folder), layout(), split_files).collect()


def test_one_file_is_shared_by_many_tasks(spark, tmp_path):
    schema = T.StructType(
        [
            T.StructField("_t", T.LongType()),
            T.StructField("_n", T.LongType()),
            T.StructField("_who", T.StringType()),
            T.StructField("text", T.StringType()),
        ]
    )
    rows = "".join(f'<u t="{i % 7}" n="{i}" who="S"><text>wé {i}</text></u>\n' for i in range(20_000))
    (tmp_path / "big.xml").write_text(f"<ts>\n{rows}</ts>\n")
    by_row = tg.TranscriptLayout(
        row_tag="u", schema=schema, transcript_id="_t", order="_n", speaker="_who", text="text"
    )
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        split = tg.ingest_transcripts(spark, str(tmp_path), by_row, split_files=True)
        whole = tg.ingest_transcripts(spark, str(tmp_path), by_row)
        assert split.rdd.getNumPartitions() > whole.rdd.getNumPartitions() == 1
        assert split.exceptAll(whole).count() == whole.exceptAll(split).count() == 0
        assert split.count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("row", ['<t id="9"/>', '<t id="9"><u who="X"/></t >'])
def test_rows_that_cannot_be_cut_are_not_lost(spark, tmp_path, row):
    (tmp_path / "file.xml").write_text(f'<corpus>{row}<t id="1"><u who="A"/></t></corpus>')
    whole = tg.ingest_transcripts(spark, str(tmp_path), layout())
    assert "A" in {r.speaker for r in whole.collect()}
    with pytest.raises(Exception, match="split_files=False"):
        tg.ingest_transcripts(spark, str(tmp_path), layout(), split_files=True).collect()


@pytest.mark.parametrize("split_files", [False, True])
def test_a_row_in_a_comment_is_not_data(spark, tmp_path, split_files):
    row = '<t id="{}"><u who="A"><w>x</w></u></t>'
    (tmp_path / "file.xml").write_text(f"<c><!-- {row.format(9)} -->{row.format(1)}</c>")
    rows = tg.ingest_transcripts(spark, str(tmp_path), layout(), split_files)
    if split_files:
        with pytest.raises(Exception, match="split_files=False"):
            rows.collect()
    else:
        assert [r.transcript_id for r in rows.collect()] == [1]


@pytest.mark.parametrize("split_files", [False, True])
@pytest.mark.parametrize("end", ["", "<u who='B'>", "</u", "<!-- </t>"])
def test_a_file_that_is_cut_off_stops_the_run(spark, tmp_path, split_files, end):
    whole = '<c><t id="1"><u who="A"><w>x</w></u></t>'
    (tmp_path / "file.xml").write_text(f'{whole}<t id="2"><u who="A"><w>y</w></u>{end}')
    with pytest.raises(Exception, match="split_files=False|MALFORMED|FAILED_READ_FILE"):
        tg.ingest_transcripts(spark, str(tmp_path), layout(), split_files).collect()


@pytest.mark.parametrize("split_files", [False, True])
def test_comments_and_data_inside_a_row(spark, tmp_path, split_files):
    word = "<w><![CDATA[a<t b]]></w><!-- <t> --><w>c</w>"
    (tmp_path / "file.xml").write_text(f'<c><t id="1"><u who="A">{word}</u></t></c>')
    rows = tg.ingest_transcripts(spark, str(tmp_path), layout(), split_files).collect()
    assert [r.words for r in rows] == [["a<t b", "c"]]


ANNOTATED = '<w n="1">ice-cream<mor type="mor">n|ice+cream</mor></w><w n="2">don’t</w><w n="3"/>'


def test_word_elements_are_kept(spark, tmp_path, rows_of):
    (tmp_path / "file.xml").write_text(f'<c><t id="1"><u who="A">{ANNOTATED}</u></t></c>')
    word = T.StructType([T.StructField("_VALUE", T.StringType()), T.StructField("_n", T.LongType())])
    parts = T.StructType([T.StructField("_who", T.StringType()), T.StructField("w", T.ArrayType(word))])
    schema = T.StructType([NESTED["_id"], T.StructField("u", T.ArrayType(parts))])
    rows = tg.ingest_transcripts(spark, str(tmp_path), layout(schema=schema, word="_VALUE"))
    assert [(r.text, r.words) for r in rows.collect()] == [
        ("ice-cream don’t", ["ice-cream", "don’t"])
    ]
    assert rows_of(tg.tokens(rows), "token_order", "word") == [(1, "ice-cream"), (2, "don't")]
    assert rows_of(tg.mlu_w(rows)) == [("A", 1, 2, 2.0)]
    with pytest.raises(Exception, match="markup"):
        tg.ingest_transcripts(spark, str(tmp_path), layout()).collect()


def test_layouts_that_do_not_add_up():
    with pytest.raises(ValueError, match="text field"):
        layout(text="text")
    with pytest.raises(ValueError, match="text field"):
        layout(words=None)
    with pytest.raises(ValueError, match="order"):
        layout(utterances=None)
