"""Each stage against a plain version of it, on what its predecessor kept."""

import re

import duckdb
import pytest
from brute import SECRETS, contaminated, near_duplicates
from conftest import ODD, SF_DIR
from test_models import check_packing

import corpus_pipeline
from talkgrain.llm.quality import judge_quality

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def redacted(text):
    """A text with whatever a base rule finds replaced; other rules find nothing in the tables."""
    spans = sorted(
        (m.start(), m.end()) for _, p, ok in SECRETS for m in re.finditer(p, text) if ok(m)
    )
    out, at = [], 0
    for start, end in spans:
        if start > at or not out:
            out += [text[at:start], "[secret]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def expected(name, docs, spark, frame):
    pairs = [(d["doc_id"], d["text"]) for d in docs]
    if name == "quality rules":
        kept = {r["doc_id"] for r in judge_quality(frame).where("kept").collect()}
        return [d for d in docs if d["doc_id"] in kept]
    if name == "SimHash near-dedup":
        first = {row[0] for row in near_duplicates(pairs) if row[0] == row[2]}
        return [d for d in docs if d["doc_id"] in first]
    if name == "benchmark decontamination":
        items = duckdb.sql(f"SELECT item_id, text FROM '{SF_DIR}/benchmark.parquet'").fetchall()
        bad = {row[0] for row in contaminated(pairs, items) if row[-1]}
        return [d for d in docs if d["doc_id"] not in bad]
    return [
        d if redacted(d["text"]) == d["text"] else d | {"text": redacted(d["text"]), "n_chars": len(redacted(d["text"]))}
        for d in docs
    ]


def test_stages(spark, documents, tmp_path):
    frame = documents
    docs = [row.asDict() for row in frame.collect()]
    key = lambda d: d["doc_id"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = len(docs)
        stage(spark, frame, SF_DIR).write.parquet(str(tmp_path / str(k)))
        result = spark.read.parquet(str(tmp_path / str(k)))
        if k == len(corpus_pipeline.STAGES) - 1:
            check_packing(result.collect(), [(d["doc_id"], d["text"], d["source"]) for d in docs], 2048)
            break
        assert result.columns == COLUMNS
        want = expected(name, docs, spark, frame)
        frame = result
        docs = [row.asDict() for row in frame.collect()]
        assert sorted(docs, key=key) == sorted(want, key=key)
        assert 0 < len(docs) <= before
        if k < 3:
            assert len(docs) < before
    texts = [d["text"] for d in docs]
    assert any("[secret]" in t for t in texts)


# Names that a stage or an operator could also use for a column of its own.
CLASHING = ["blob", "spans", "_redacted", "_id", "_k", "row", "changed", "votes", "_key", "key", "id", "x"]


def odd_documents(documents):
    """Odd rows, documents of the table with a benchmark passage or a secret, and one row twice."""
    table = [(r["doc_id"] + 100, r["text"]) for r in documents.where("doc_id < 60").collect()]
    secret = [(500, "password=hunter22 and more"), (500, "password=hunter22 and more")]
    return ODD + table + table[:1] + secret


def expected_on_odd(name, rows):
    """The rows that stay, as (id, text)."""
    if name == "SimHash near-dedup":
        group = {i: root for i, _, root in near_duplicates([(i, t) for i, (_, t) in enumerate(rows)])}
        order = lambda i: (rows[i][0] is None, rows[i][0])
        return [rows[min((j for j in group if group[j] == g), key=order)] for g in set(group.values())]
    if name == "benchmark decontamination":
        items = duckdb.sql(f"SELECT item_id, text FROM '{SF_DIR}/benchmark.parquet'").fetchall()
        bad = {row[0] for row in contaminated([(i, t) for i, (_, t) in enumerate(rows)], items) if row[-1]}
        return [row for i, row in enumerate(rows) if i not in bad]
    return [(i, redacted(t) if t else t) for i, t in rows]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_odd_rows_and_clashing_columns(spark, documents, rows_of, name, stage):
    rows = odd_documents(documents)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    schema += "".join(f", {c} string" for c in CLASHING)
    extra = [f"of {c}" for c in CLASHING]
    frame = spark.createDataFrame([(i, t, None, "s", -1, *extra) for i, t in rows], schema)
    assert stage(spark, frame.limit(0), SF_DIR).collect() == []
    result = stage(spark, frame, SF_DIR)
    if name == "best-fit packing":
        whole = result.groupBy("doc_id").agg({"n_tokens": "sum"}).count()
        assert whole == len({i for i, _ in rows})
        return
    assert result.columns == frame.columns
    got = rows_of(result)
    if name == "quality rules":
        judged = judge_quality(frame.select("doc_id", "text")).where("kept")
        assert rows_of(result, "doc_id") == rows_of(judged, "doc_id") and len(got) > 20
        assert set(got) <= set(map(tuple, rows_of(frame)))
        return
    want = []
    for i, t in expected_on_odd(name, rows):
        changed = name == "secret scans" and (i, t) not in rows
        want.append((i, t, None, "s", len(t) if changed else -1, *extra))
    assert got == sorted(want, key=repr)


def test_run_is_the_stages_in_order(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules",
        "SimHash near-dedup",
        "benchmark decontamination",
        "secret scans",
        "best-fit packing",
    ]
    result = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert result.columns == ["doc_id", "piece", "n_tokens", "bin_id", "bin_offset"]
    assert result.count() > 100
