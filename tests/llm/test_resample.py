"""Resampling and filter audit against plain versions."""

import hashlib
import math
import re
import zlib
from itertools import permutations

import duckdb
from brute import LOWER, words
from conftest import ODD, SF_DIR

from talkgrain.llm.interactions import audit_filters, later_copies
from talkgrain.llm.resample import resample

RESAMPLED = ["doc_id", "n_features", "weight", "score", "rank"]


def features(text, longest):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(w), [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def brute_resample(docs, target, longest=1, buckets=10_000):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    cut = [(i, *features(t, longest)) for i, t in docs]
    source, wanted = [0] * buckets, [0] * buckets
    for _, _, found in cut:
        for f in found:
            source[bucket(f)] += 1
    for text in target:
        for f in features(text, longest)[1]:
            wanted[bucket(f)] += 1
    s_all, t_all = sum(source), sum(wanted)
    gains = [
        math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets))))
        for s, t in zip(source, wanted)
    ]
    rows = []
    for i, n_words, found in cut:
        weight = sum(gains[bucket(f)] for f in found) // len(found) if found else 0
        name = f"2024:{'' if i is None else i}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(found), weight, score, n_words >= 20))
    able = [row for row in rows if row[4]]
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0]))
    rank = {id(row): k + 1 for k, row in enumerate(able[: 10 * len(able) // 100])}
    return [(*row[:4], rank.get(id(row))) for row in rows]


def items():
    return [r[0] for r in duckdb.sql(f"SELECT text FROM '{SF_DIR}/benchmark.parquet'").fetchall()]


def test_resampled_documents(spark, documents, texts, same):
    target = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    want = brute_resample(texts, items())
    same(resample(documents, target), RESAMPLED, want)
    assert sum(row[-1] is not None for row in want) > 50


def test_longer_runs_and_ties(spark, same):
    """Runs of up to three words that never cross texts; few words, so that scores tie."""
    docs = [(i, " ".join("ab"[(i + j * j) % 2] + "c" * (j % 3) for j in range(i % 40))) for i in range(300)]
    docs += [(7, docs[25][1]), (None, docs[30][1]), (None, None), (301, "")]
    target = [(1, "a bc acc"), (2, None), (3, "bc")]
    got = resample(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(target, "item_id long, text string"),
        longest=3,
        buckets=50,
    )
    same(got, RESAMPLED, brute_resample(docs, [t for _, t in target], 3, 50))


def test_resampled_odd_rows(spark, odd, same):
    target = spark.createDataFrame([("w1 w2 w3",)], "text string")
    same(resample(odd, target, percent=10), RESAMPLED, brute_resample(ODD, ["w1 w2 w3"]))
    assert resample(odd.limit(0), target).collect() == []
    assert resample(odd, target.limit(0)).count() == len(ODD)


def test_more_of_the_drawn_are_like_the_target(spark):
    """Half of the texts use the target's words, and nearly all that are drawn are of that half."""
    docs = [(i, " ".join(f"{'in' if i % 2 else 'out'}{(i + 7 * j) % 50}" for j in range(30))) for i in range(400)]
    target = spark.createDataFrame([(" ".join(f"in{j}" for j in range(50)),)] * 100, "text string")
    got = resample(spark.createDataFrame(docs, "doc_id long, text string"), target).where("rank IS NOT NULL")
    drawn = [r["doc_id"] for r in got.collect()]
    assert len(drawn) == 40 and sum(i % 2 for i in drawn) >= 36


def brute_audit(docs, labels):
    """(part, order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)"""
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    failed = []
    for i, text, _ in docs:
        text = text or ""
        w = words(text)
        failed.append(
            {
                c
                for c, bad in (
                    ("A", len(w) < 100),
                    ("B", 100 * len(set(w)) < 80 * len(w)),
                    ("C", 100 * len(re.findall("[A-Z]", text)) > 10 * len(text)),
                    ("D", re.search(r"[#$%&*|]", text)),
                    ("E", i is not None and first[text] < i),
                )
                if bad
            }
        )
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    out, removals = [], {}
    for part in {lang or "" for _, _, lang in docs}:
        own = [(i, f) for (i, _, lang), f in zip(docs, failed) if (lang or "") == part]
        for order in permutations("ABCDE"):
            left = own
            for k, c in enumerate(order):
                gone = [i for i, f in left if c in f]
                left = [(i, f) for i, f in left if c not in f]
                failing = sum(c in f for _, f in own)
                out.append(
                    [
                        part, "".join(order), k + 1, len(left), len(gone), failing - len(gone),
                        sum(f == {c} for _, f in own), sum(i in good for i in gone), sum(i in toxic for i in gone),
                    ]
                )
                removals[part, c] = removals.get((part, c), 0) + len(gone)
    return [(*row, removals[row[0], row[1][row[2] - 1]]) for row in out]


AUDIT = [
    "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
    "good_lost", "toxic_lost", "shapley",
]


def test_audit_of_odd_rows(spark, same):
    marked = [(20, "Aa #"), (21, "Aa #"), (21, "Aa #"), (22, "AA BB"), (23, "x " * 120), (9, "x " * 120)]
    docs = [(i, t, None if k % 4 else "en") for k, (i, t) in enumerate(ODD + marked)]
    labels = [(1, 1, 0), (21, 1, 1), (22, 0, 1), (23, 1, None), (23, None, 1), (None, 1, 1), (99, 1, 1)]
    frame = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, lang string, bits int, n int")
    judged = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    same(audit_filters(frame, judged), AUDIT, brute_audit(docs, labels))
    assert audit_filters(frame.limit(0), judged).collect() == []
    assert audit_filters(frame, judged.limit(0)).count() == 1200


def test_a_hot_text_is_salted(spark):
    rows = [(i, 7 if i % 3 else 8, "same" if i % 3 else f"own {i}") for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, _key long, text string")
    got = {r["doc_id"] for r in later_copies(frame, frame.select("_key"), rows_of_salt=100).collect()}
    assert got == {i for i in range(3000) if i % 3 and i > 1}
