"""Alignment, linkage and numbering against plain versions."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import talkgrain as tg
from talkgrain.operators import alignment
from talkgrain.operators.numbering import numbered, numbered_within, running_total

UTTERANCES = "transcript_id long, utterance_order long, speaker string, text string"


def frame(spark, transcripts):
    """Utterances of {id: [text, ...]}."""
    rows = [(t, k + 1, "CHI", text) for t, texts in transcripts.items() for k, text in enumerate(texts)]
    return spark.createDataFrame(rows, UTTERANCES)


# ------------------------------------------------------------------------------ numbering


def test_numbers_and_totals(spark, rows_of):
    random.seed(1)
    rows = [(random.choice([None, "a", "a", "a", "b"]), i, random.randint(0, 9)) for i in range(2000)]
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, i int, v int").repartition(7)
    in_order = sorted(rows, key=lambda r: r[1])
    got = rows_of(numbered(df, ["i"], "n"))
    assert got == sorted(((*r, k + 1) for k, r in enumerate(in_order)), key=repr)
    seen = Counter()
    want = []
    for r in in_order:
        want.append((*r, seen[r[0]]))
        seen[r[0]] += 1
    assert rows_of(numbered_within(df, ["g"], ["i"], "n", 0)) == sorted(want, key=repr)
    total, want = 0, []
    for r in in_order:
        want.append((*r, total))
        total += r[2]
    assert rows_of(running_total(df, ["i"], "v")) == sorted(want, key=repr)


def test_numbers_of_no_rows(spark):
    df = spark.createDataFrame([], "g string, i int, n int")
    assert numbered(df, ["i"], "n").dtypes == [("g", "string"), ("i", "int"), ("n", "bigint")]
    assert numbered(df, ["i"], "n").collect() == []
    assert numbered_within(df, ["g"], ["i"], "k").collect() == []
    assert running_total(df, ["i"], "n").collect() == []


# ------------------------------------------------------------------------------ alignment


def brute_chain(anchors):
    """A heaviest increasing chain by comparing all pairs of runs, the first in old order of equals."""
    anchors = sorted(anchors)
    rank = {p: k for k, p in enumerate(sorted(p for _, p in anchors))}
    runs = []
    for k, (o, p) in enumerate(anchors):
        if runs and rank[p] == rank[runs[-1][-1][1]] + 1:
            runs[-1].append((o, p))
        else:
            runs.append([(o, p)])
    best = []
    for i, run in enumerate(runs):
        before = [j for j in range(i) if runs[j][-1][1] < run[0][1]]
        j = max(before, key=lambda j: (best[j][0], -j), default=None)
        best.append((len(run) + (best[j][0] if j is not None else 0), j))
    i = max(range(len(runs)), key=lambda i: (best[i][0], -i), default=None)
    kept = []
    while i is not None:
        kept += runs[i]
        i = best[i][1]
    return kept


def brute_alignment(old, new):
    """(old_order, new_order, status) of two lists of texts."""
    matched = []

    def gaps():
        """(start, end) of the unmatched stretches of both sides, as lists of places."""
        edges = [(-1, -1), *sorted(matched), (len(old), len(new))]
        for (a, b), (c, d) in zip(edges, edges[1:]):
            yield list(range(a + 1, c)), list(range(b + 1, d))

    def unique(places, texts):
        count = Counter(texts[i] for i in places)
        return {texts[i]: i for i in places if count[texts[i]] == 1}

    def occurrences(places, texts):
        seen, out = Counter(), {}
        for i in places:
            seen[texts[i]] += 1
            out[texts[i], seen[texts[i]]] = i
        return out

    for keys in (unique, occurrences):
        while True:
            found = []
            for first, second in gaps():
                a, b = keys(first, old), keys(second, new)
                found += brute_chain([(a[k], b[k]) for k in a if k in b])
            if not found:
                break
            matched += found
    out = [(o + 1, p + 1, "same") for o, p in matched]
    left = [([i for g, _ in gaps() for i in g], old), ([i for _, g in gaps() for i in g], new)]
    where = [defaultdict(list), defaultdict(list)]
    for side, (places, texts) in enumerate(left):
        for i in places:
            where[side][texts[i]].append(i)
    moved = [pair for k in where[0] for pair in zip(where[0][k], where[1].get(k, []))]
    out += [(o + 1, p + 1, "moved") for o, p in moved]
    for first, second in gaps():
        first = [i for i in first if i not in {o for o, _ in moved}]
        second = [i for i in second if i not in {p for _, p in moved}]
        out += [(o + 1, p + 1, "changed") for o, p in zip(first, second)]
        out += [(o + 1, None, "deleted") for o in first[len(second) :]]
        out += [(None, p + 1, "inserted") for p in second[len(first) :]]
    return out


def revised(texts, edits):
    """A list after random edits: lines go, come, change, swap, and blocks move."""
    texts = list(texts)
    for _ in range(edits):
        at = random.randrange(len(texts) + 1)
        kind = random.choice("deletes insert change swap block".split())
        if kind == "insert":
            texts.insert(at, random.choice(["um", "yes", f"new {random.random()}"]))
        elif at < len(texts) and kind == "deletes":
            del texts[at : at + random.randint(1, 3)]
        elif at < len(texts) and kind == "change":
            texts[at] += " (revised)"
        elif at < len(texts) and kind == "swap":
            other = random.randrange(len(texts))
            texts[at], texts[other] = texts[other], texts[at]
        elif kind == "block":
            size = random.randint(1, 8)
            block = texts[at : at + size]
            del texts[at : at + size]
            to = random.randrange(len(texts) + 1)
            texts[to:to] = block
    return texts


def random_release(n=60):
    random.seed(5)
    old, new = {}, {}
    for t in range(n):
        size = random.randint(0, 40)
        words = random.choice([["um", "yes", "no"], ["um", *map(str, range(500))], ["a", "b", "um", *map(str, range(30))]])
        texts = [random.choice(words) for _ in range(size)]
        if t % 10 != 3:
            old[t] = texts
        if t % 10 != 4:
            new[t] = revised(texts, random.choice([0, 1, 3, 8, 20]))
    old[1000], new[1000] = list("abcdef"), list("fedcba")
    old[1001], new[1001] = ["x"] * 9, ["x"] * 5
    return old, new


@pytest.mark.parametrize("block", [8192, 4])
def test_alignment_of_random_revisions(spark, rows_of, monkeypatch, block):
    monkeypatch.setattr(alignment, "BLOCK", block)
    old, new = random_release()
    got = rows_of(tg.compare_utterances(frame(spark, old), frame(spark, new)))
    want = [(t, *row) for t in {*old, *new} for row in brute_alignment(old.get(t, []), new.get(t, []))]
    if block == 8192:
        assert got == sorted(want, key=repr)
    # However long runs are cut: every utterance once, the same ones in order, and as many of them.
    for t in {*old, *new}:
        rows = [row[1:] for row in got if row[0] == t]
        assert sorted(o for o, _, _ in rows if o) == list(range(1, len(old.get(t, [])) + 1))
        assert sorted(p for _, p, _ in rows if p) == list(range(1, len(new.get(t, [])) + 1))
        same = sorted((o, p) for o, p, s in rows if s == "same")
        assert [p for _, p in same] == sorted(p for _, p in same)
        assert all(old[t][o - 1] == new[t][p - 1] for o, p, s in rows if s in ("same", "moved"))
        assert all(old[t][o - 1] != new[t][p - 1] for o, p, s in rows if s == "changed")


def test_a_long_transcript_with_a_moved_line_is_few_runs(spark):
    """One line from the front to the end: all others stay the same, in runs of bounded length."""
    texts = [f"line {i}" for i in range(30_000)]
    moved = texts[1:] + texts[:1]
    got = tg.compare_utterances(frame(spark, {1: texts}), frame(spark, {1: moved}))
    counts = {r["status"]: r["count"] for r in got.groupBy("status").count().collect()}
    assert counts == {"same": 29_999, "moved": 1}


def test_alignment_of_odd_rows(spark, rows_of):
    rows = [(1, 1, None, None), (1, 2, "CHI", None), (1, 2, "CHI", "a"), (None, 1, "CHI", "x"), (2, None, "CHI", "y")]
    old = spark.createDataFrame(rows, UTTERANCES)
    new = spark.createDataFrame([(1, 1, None, None), (1, 3, "CHI", "a"), (2, None, "CHI", "y")], UTTERANCES)
    assert rows_of(tg.compare_utterances(old, new)) == sorted(
        [(1, 1, 1, "same"), (1, 2, None, "deleted"), (1, 2, 3, "same"), (2, None, None, "same")], key=repr
    )
    assert tg.compare_utterances(old.limit(0), new.limit(0)).collect() == []


# -------------------------------------------------------------------------------- linkage


def brute_links(old, new, least=0.5, rare=8):
    """(old_id, new_id, status) by comparing all pairs of sets."""
    sides = [{t: frozenset(x) for t, x in side.items() if x} for side in (old, new)]
    out = [(t, t, "same") for t in sides[0] if sides[1].get(t) == sides[0][t]]

    def drop(pairs):
        for a, b, *_ in pairs:
            del sides[0][a], sides[1][b]

    def members(side):
        by = defaultdict(list)
        for t in sorted(sides[side]):
            by[sides[side][t]].append(t)
        return by

    drop(out)
    first, second = members(0), members(1)
    pairs = [(a, b, "renumbered") for s in first for a, b in zip(first[s], second.get(s, []))]
    drop(pairs)
    out += pairs
    first, second = members(0), members(1)
    count = [Counter(x for s in side for x in s) for side in (first, second)]
    scored = {}
    for s, a in first.items():
        for z, b in second.items():
            shared = s & z
            if any(count[0][x] <= rare and count[1][x] <= rare for x in shared):
                similarity = len(shared) / len(s | z)
                if similarity >= least and min(len(s), len(z)) >= least * max(len(s), len(z)):
                    scored[s, z] = (-similarity, a[0] != b[0])
    best = [{}, {}]
    for (s, z), score in scored.items():
        best[0][s] = min(best[0].get(s, ((9,), None, None)), ((*score, second[z][0]), z, 0), key=lambda x: x[0])
        best[1][z] = min(best[1].get(z, ((9,), None, None)), ((*score, first[s][0]), s, 0), key=lambda x: x[0])
    pairs = []
    for s, (_, z, _) in best[0].items():
        if best[1][z][1] == s:
            pairs += [(a, b, "revised") for a, b in zip(first[s], second[z])]
    drop(pairs)
    out += pairs
    return out + [(t, None, "removed") for t in sides[0]] + [(None, t, "added") for t in sides[1]]


@pytest.mark.parametrize("rare", [8, 1])
def test_links_of_random_releases(spark, rows_of, rare):
    random.seed(2)
    old, new = {}, {}
    for t in range(150):
        common = ["um", "yes"] if t % 2 else []
        texts = common + [f"{t // 3 if t % 5 == 0 else t} {k}" for k in range(random.randint(1, 9))]
        old[t] = texts
        if t % 7 != 3:
            new[t if t % 4 else 1000 - t] = revised(texts, random.choice([0, 0, 1, 2]))
    for k in range(20):
        old[3000 + k] = ["boilerplate", "only"]
        new[(3010 if k < 10 else 4000) + k] = ["boilerplate", "only"]
        new[5000 + k] = ["boilerplate", "only", "more"]
    got = tg.match_transcripts(frame(spark, old), frame(spark, new), rare=rare)
    assert rows_of(got, "old_id", "new_id", "status") == sorted(brute_links(old, new, rare=rare), key=repr)
    numbers = got.where("similarity IS NOT NULL AND similarity <> n_common / (n_old + n_new - n_common)")
    assert numbers.count() == 0


def test_a_line_of_many_transcripts_makes_no_pairs(spark):
    """All share a line and are else their own: the join on digests gives a pair for each at most."""
    transcripts = {t: ["shared", *(f"{t} {k}" for k in range(4))] for t in range(400)}
    changed = {1000 + t: [*texts[:4], f"{t} new"] for t, texts in transcripts.items()}
    got = tg.match_transcripts(frame(spark, transcripts), frame(spark, changed))
    rows = got.collect()
    assert len(rows) == 400
    assert all(r["new_id"] == r["old_id"] + 1000 and r["status"] == "revised" for r in rows)


def test_links_of_odd_rows(spark, rows_of):
    rows = [("b", 1, None, None), ("a", 1, None, None), (None, 1, "CHI", "x"), ("c", 1, "CHI", "x")]
    schema = UTTERANCES.replace("transcript_id long", "transcript_id string")
    old = spark.createDataFrame(rows, schema)
    got = rows_of(tg.match_transcripts(old, old.where("transcript_id <> 'a'")), "old_id", "new_id", "status")
    assert ("b", "b", "same") in got and ("c", "c", "same") in got and ("a", None, "removed") in got
    assert tg.match_transcripts(old.limit(0), old.limit(0)).collect() == []


def test_utterances_are_followed_through_new_ids(spark, rows_of):
    old = {t: [f"{t} {k}" for k in range(6)] for t in range(5)}
    new = {100 + t: [*texts[:2], "um", *texts[2:]] for t, texts in old.items() if t != 3}
    new[3] = ["nothing", "in common"]
    links = tg.match_transcripts(frame(spark, old), frame(spark, new))
    followed = tg.under_old_ids(frame(spark, new), links)
    assert followed.columns == UTTERANCES.replace(" long", "").replace(" string", "").split(", ")
    found = tg.compare_utterances(frame(spark, old), followed)
    counts = Counter((r["transcript_id"], r["status"]) for r in found.collect())
    assert counts == {(t, s): n for t in (0, 1, 2, 4) for s, n in (("same", 6), ("inserted", 1))} | {(3, "deleted"): 6}
