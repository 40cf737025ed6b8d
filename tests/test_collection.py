"""Tables of a whole collection from its files, and measures kept up to date."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import talkgrain as tg
from talkgrain.operators import increments

A = """<bank>
<t id="b" age="30"><who><p id="CHI" job="child"/><p id="MOT" job="mother"/></who>
<u who="CHI"><w>go</w><w>Dog</w><pho>go dɒg</pho></u><u who="FAT"><w>no</w></u><u who="MOT"></u></t>
<t id="a"><u who="CHI"><w>hi</w></u></t>
</bank>"""
B = '<bank><t id="a" age="20"><who><p id="CHI"/></who><u who="CHI"><w>x</w></u></t><t id="empty"/></bank>'

SCHEMA = (
    "_id string, _age long, who struct<p: array<struct<_id: string, _job: string>>>, "
    "u array<struct<_who: string, w: array<string>, pho: string>>"
)


def layout(**changes):
    from pyspark.sql import types as T

    fields = {
        "row_tag": "t",
        "schema": T.StructType.fromDDL(SCHEMA),
        "transcript_id": "_id",
        "utterances": "u",
        "speaker": "_who",
        "words": "w",
        "phonology": "pho",
        "participants": "who.p",
        "participant": "_id",
        "role": "_job",
        "details": ("_age",),
    }
    return tg.CollectionLayout(**{**fields, **changes})


@pytest.fixture
def files(tmp_path):
    for corpus, text in (("North", A), ("South", B)):
        (tmp_path / corpus).mkdir()
        (tmp_path / corpus / "one.xml").write_text(text)
    return tmp_path


def test_tables_of_a_collection(spark, files, rows_of):
    found = tg.ingest_collection(spark, f"{files}/*", layout())
    ids = {("North", "a"): 1, ("North", "b"): 2, ("South", "a"): 3, ("South", "empty"): 4}
    assert rows_of(found.corpora) == [("North", None, 2), ("South", None, 2)]
    assert rows_of(found.transcripts, "transcript_id", "transcript_key", "corpus", "_age") == [
        (1, "a", "North", None), (2, "b", "North", 30), (3, "a", "South", 20), (4, "empty", "South", None),
    ]
    assert rows_of(found.participants) == [
        (2, "North", "CHI", "child"), (2, "North", "MOT", "mother"), (3, "South", "CHI", None),
    ]
    columns = ["transcript_id", "utterance_order", "corpus", "speaker", "role", "text", "phonology"]
    assert rows_of(found.utterances, *columns) == [
        (1, 1, "North", "CHI", None, "hi", None),
        (2, 1, "North", "CHI", "child", "go Dog", "go dɒg"),
        (2, 2, "North", "FAT", None, "no", None),
        (2, 3, "North", "MOT", "mother", "", None),
        (3, 1, "South", "CHI", None, "x", None),
    ]
    assert rows_of(found.tokens, "transcript_id", "corpus", "token_order", "word") == [
        (1, "North", 1, "hi"), (2, "North", 1, "go"), (2, "North", 1, "no"), (2, "North", 2, "dog"), (3, "South", 1, "x"),
    ]
    assert len(ids) == found.transcripts.count()


def test_a_second_run_gives_the_same_ids(spark, files, rows_of):
    first, second = (tg.ingest_collection(spark, f"{files}/*", layout()).transcripts for _ in range(2))
    assert rows_of(first) == rows_of(second)


def test_known_transcripts_keep_their_ids(spark, files, rows_of):
    known = tg.ingest_collection(spark, f"{files}/South", layout()).transcripts
    assert rows_of(known, "transcript_id", "transcript_key") == [(1, "a"), (2, "empty")]
    again = tg.ingest_collection(spark, f"{files}/*", layout(), known=known).transcripts
    assert rows_of(again, "transcript_id", "corpus", "transcript_key") == [
        (1, "South", "a"), (2, "South", "empty"), (3, "North", "a"), (4, "North", "b"),
    ]


def test_files_name_transcripts_without_a_key(spark, files):
    (files / "South" / "one.xml").write_text(B.split("<t id=\"empty\"")[0] + "</bank>")
    found = tg.ingest_collection(spark, f"{files}/South", layout(transcript_id=None)).transcripts.collect()
    assert [(r["transcript_id"], r["corpus"]) for r in found] == [(1, "South")]
    assert found[0]["transcript_key"].endswith("South/one.xml")


def test_one_key_twice_stops_the_run(spark, files):
    (files / "South" / "two.xml").write_text(B)
    with pytest.raises(ValueError, match="more than one transcript"):
        tg.ingest_collection(spark, f"{files}/*", layout())


def test_layouts_that_cannot_be_read():
    with pytest.raises(ValueError, match="row_tag"):
        layout(utterances=None, order="n")
    with pytest.raises(ValueError, match="participants"):
        layout(participants=None)
    with pytest.raises(ValueError, match="group"):
        layout(corpus_pattern="x")


def test_string_ids_and_phonology_of_utterances(spark, files, rows_of):
    plain = tg.TranscriptLayout(
        row_tag="t", schema=layout().schema, transcript_id="_id", utterances="u", speaker="_who",
        words="w", phonology="pho", id_type="string",
    )
    got = tg.ingest_transcripts(spark, f"{files}/North", plain)
    assert rows_of(got, "transcript_id", "text", "phonology") == [
        ("a", "hi", None), ("b", "", None), ("b", "go Dog", "go dɒg"), ("b", "no", None),
    ]


# ------------------------------------------------------------------------------- measures


def releases(spark, seed):
    random.seed(seed)
    old, new = [], []
    for t in range(40):
        rows = [
            (t if t else None, k, random.choice(["CHI", "MOT", None]), random.choice(["go go dog", "no", "", None, "a b c"]))
            for k in range(random.randint(1, 6))
        ]
        if t % 5 != 1:
            old += rows
        if t % 5 != 2:
            new += [(*r[:3], "was changed") if t % 5 == 3 and r[1] == 0 else r for r in rows]
    new.append((99, 1, "INV", "..."))
    old.append((98, 1, "BRO", "only here"))
    schema = "transcript_id long, utterance_order long, speaker string, text string"
    return spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)


@pytest.mark.parametrize("named", [10_000, 0])
def test_updated_measures_are_those_of_a_full_run(spark, rows_of, monkeypatch, named):
    monkeypatch.setattr(increments, "NAMED", named)
    old, new = releases(spark, named)
    digests = [tg.transcript_digests(rows, ["speaker", "text"]) for rows in (old, new)]
    changed = tg.changed_transcripts(*digests)
    status = Counter(r["status"] for r in changed.collect())
    assert status["added"] and status["removed"] and status["revised"]
    state = tg.updated_state(tg.measure_state(old), old, new, changed)
    assert rows_of(tg.state_frequency(state)) == rows_of(tg.word_frequency(new))
    assert rows_of(tg.state_mlu_w(state)) == rows_of(tg.mlu_w(new))
    assert rows_of(tg.state_type_token_ratio(state)) == rows_of(tg.type_token_ratio(new))
    sizes = new.groupBy("speaker").agg(F.count("*"), F.sum(F.size(F.coalesce(tg.words(F.col("text")), F.array()))))
    assert rows_of(tg.state_population(state)) == rows_of(sizes)


def test_only_changed_transcripts_are_read(spark, tmp_path):
    old, new = releases(spark, 1)
    for name, rows in (("old", old), ("new", new)):
        rows.write.parquet(str(tmp_path / name))
    old, new = (spark.read.schema(old.schema).parquet(str(tmp_path / n)) for n in ("old", "new"))
    changed = spark.createDataFrame([(3,), (7,)], "transcript_id long")
    state = tg.updated_state(tg.measure_state(old), old, new, changed)
    plan = state.words._jdf.queryExecution().executedPlan().toString()
    assert plan.count("In(transcript_id, [3,7])") >= 2


def test_order_and_repeats_are_told_apart(spark):
    schema = "transcript_id long, utterance_order long, speaker string, text string"
    old = [(1, 1, "A", "x"), (1, 2, "A", "y"), (2, 1, "A", "x"), (2, 1, "A", "x"), (3, 1, "A", None)]
    new = [(1, 1, "A", "y"), (1, 2, "A", "x"), (2, 1, "A", "y"), (2, 1, "A", "y"), (3, 1, "A", None)]
    digests = [tg.transcript_digests(spark.createDataFrame(r, schema), ["speaker", "text"]) for r in (old, new)]
    assert sorted(map(tuple, tg.changed_transcripts(*digests).collect())) == [(1, "revised"), (2, "revised")]


def brute_moving(rows, window, by):
    groups = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1])):
        groups.setdefault(tuple(r[2 + i] for i in range(by)), []).extend((r[-1] or "").lower().split())
    out = []
    for g, w in groups.items():
        runs = [len(set(w[i : i + window])) for i in range(len(w) - window + 1)]
        out.append((*g, len(w), len(runs), sum(runs) / (window * len(runs)) if runs else None))
    return out


@pytest.mark.parametrize("window", [1, 2, 7, 60])
def test_moving_ratio_is_that_of_all_runs(spark, rows_of, window):
    random.seed(window)
    rows = [
        (t, k, random.choice("CCCCM"), random.choice("xy"), " ".join(random.choice("aaabcdefg") for _ in range(random.randint(0, 5))))
        for t in range(20) for k in range(10)
    ]
    rows += [(30, 1, "INV", "x", None), (30, 2, "INV", "x", ""), (31, 1, None, "x", "a b a")]
    df = spark.createDataFrame(rows, "transcript_id long, utterance_order long, speaker string, corpus string, text string")
    assert rows_of(tg.moving_type_token_ratio(df, window)) == sorted(brute_moving(rows, window, 1), key=repr)
    both = tg.moving_type_token_ratio(df, window, ["speaker", "corpus"])
    assert rows_of(both) == sorted(brute_moving(rows, window, 2), key=repr)
    assert tg.moving_type_token_ratio(df.limit(0), window).collect() == []


def test_moving_ratio_has_no_window_over_a_group(spark):
    """The sort before the look-up of previous words is by group, word and block."""
    schema = "transcript_id long, utterance_order long, speaker string, text string"
    df = tg.moving_type_token_ratio(spark.createDataFrame([(1, 1, "C", "a a")], schema), 2)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("block" in line or "range" in line for line in windows)
