"""Windows in target proportions: every id once, full windows, and the mixture of each."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import ODD
from tokenizers import Tokenizer

from talkgrain.llm.mixture import Rounds, pack_mixture

MODEL = public_tokenizers.path("word_bpe_49k.json")


def check(rows, docs, window=2048):
    """Pieces make up each document once, and windows have no gap; the ids are the library's."""
    tokenizer = Tokenizer.from_file(MODEL)
    coded = [e.ids + [1] for e in tokenizer.encode_batch_fast([t or "" for _, t in docs], add_special_tokens=False)]
    pieces = Counter()
    for ids in coded:
        pieces[len(ids)] += 1
    at = defaultdict(list)
    for r in rows:
        assert r["length"] > 0 and r["offset"] + r["length"] <= window
        at[r["sequence_id"]].append((r["offset"], r["length"]))
    total = sum(map(len, coded))
    assert sorted(at) == list(range(-(-total // window)))
    for k, held in at.items():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end == (window if k < len(at) - 1 else total - window * (len(at) - 1))
    by_id = defaultdict(list)
    for r in rows:
        by_id[r["doc_id"]].append(r)
    for (doc_id, _), ids in zip(docs, coded):
        if sum(i == doc_id for i, _ in docs) > 1:
            continue
        end = 0
        for r in sorted(by_id[doc_id], key=lambda r: r["start"]):
            assert r["start"] == end and r["doc_tokens"] == len(ids)
            end += r["length"]
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : end], "<u4").tobytes())
        assert end == len(ids)
    assert sum(r["length"] for r in rows) == total


def mixtures(rows):
    out = defaultdict(Counter)
    for r in rows:
        out[r["sequence_id"]][r["source"]] += r["length"]
    return out


def test_documents_in_their_own_proportions(documents, texts):
    rows = pack_mixture(documents, MODEL).collect()
    check(rows, texts)
    of = mixtures(rows)
    total = Counter()
    for held in of.values():
        total.update(held)
    share = {s: n / sum(total.values()) for s, n in total.items()}
    # What is due is carried, so the sum over any first windows is within two units of its share.
    done = Counter()
    for k in range(len(of) - 1):
        done.update(of[k])
        assert all(abs(done[s] - (k + 1) * 2048 * share[s]) <= 64 for s in share)


def test_documents_in_given_proportions(spark, documents, texts):
    """Two sources are wanted half and half; one runs empty, then the other, then all others."""
    rows = pack_mixture(documents, MODEL, {"src0": 0.5, "src3": 0.5}, window=256, grain=8).collect()
    check(rows, texts, 256)
    of = mixtures(rows)
    left = {s: sum(held[s] for held in of.values()) for s in ("src0", "src3")}
    least = min(left.values())
    done = Counter()
    for k in range(len(of)):
        done.update(of[k])
        if done["src0"] < least - 300 and done["src3"] < least - 300:
            assert set(of[k]) == {"src0", "src3"}
            assert abs(done["src0"] - done["src3"]) <= 32


def test_odd_rows(spark):
    rows = [(i, t, None if k % 3 else "s", 1) for k, (i, t) in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, ids int")
    got = pack_mixture(docs, MODEL)
    check(got.collect(), ODD)
    assert got.where("doc_id = 2").count() == 1
    assert pack_mixture(docs.limit(0), MODEL).collect() == []


@pytest.mark.parametrize("grain", [1, 8, 64])
def test_rounds_place_every_token_once(grain):
    random.seed(grain)
    for _ in range(60):
        totals = [random.choice([0, 1, 5, 33, random.randint(0, 3000), random.randint(0, 40000)]) for _ in range(random.randint(1, 12))]
        weights = random.choice([totals, [random.random() for _ in totals], [random.choice([0, 1, 0.3]) for _ in totals]])
        rounds = Rounds(totals, weights, 512, grain)
        stretches = []
        for q, total in enumerate(totals):
            at = 0
            while at < total:
                n = min(total - at, random.randint(1, 900))
                stretches.append((q, at, n))
                at += n
        random.shuffle(stretches)
        seen = np.zeros(sum(totals), int)
        # Any task finds the same places, whatever it holds.
        for k in range(0, len(stretches), 7):
            queue, start, length = (np.array(x) for x in zip(*stretches[k : k + 7]))
            row, at, n, place = rounds.places(queue, start, length)
            for i, a, size, p in zip(row, at, n, place):
                assert p // 512 == (p + size - 1) // 512
                seen[p : p + size] += 1
            assert np.array_equal(np.bincount(row, n, len(queue)), length)
        assert (seen == 1).all()
        before = rounds.before(np.arange(-(-sum(totals) // 512) + 1))
        assert (np.diff(before, axis=0) >= 0).all()
