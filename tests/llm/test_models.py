"""Language identification, packing, token ids and the n-gram model."""

import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from conftest import ODD, SF_DIR
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from talkgrain.llm import common, kneser_ney
from talkgrain.llm.kneser_ney import judge_perplexity, train_ngrams
from talkgrain.llm.language import identify_languages, predict_languages, train_languages
from talkgrain.llm.packing import best_fit, pack
from talkgrain.llm.simple8b import BLOCK, decode, encode
from talkgrain.llm.token_ids import read_token_ids, token_digest, write_token_ids

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


# ------------------------------------------------------------------------------- languages


def test_languages_of_held_out_documents(documents):
    found = identify_languages(documents).join(documents.select("doc_id", "lang"), "doc_id")
    rows = found.collect()
    assert len(rows) == 1000
    for row in rows:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1)
        assert 0 <= row["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) > 0.99 * len(held)


def test_only_the_text_decides(documents):
    model = train_languages(documents.limit(400))
    as_is = predict_languages(documents, model).select("doc_id", "lang_pred", "score")
    mixed = documents.select("doc_id", "text", F.lit("xx").alias("lang"), F.lit("s").alias("source"))
    again = predict_languages(mixed, model).select("doc_id", "lang_pred", "score")
    assert as_is.exceptAll(again).isEmpty()


def test_languages_of_odd_rows(spark, odd):
    docs = odd.withColumn("lang", F.when(F.col("doc_id") < 6, "aa").when(F.col("doc_id") > 6, "bb"))
    rows = identify_languages(docs).collect()
    assert len(rows) == len(ODD)
    by_text = {(r["doc_id"], r["lang_pred"] == "und") for r in rows}
    assert {(1, True), (2, True), (3, True), (None, True), (None, False), (8, False)} <= by_text
    assert identify_languages(docs.limit(0)).collect() == []
    nothing = identify_languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}


def test_more_languages_than_bits(spark):
    random.seed(2)
    rows = []
    for i in range(70):
        letters = [chr(0x4E00 + 5 * i + k) for k in range(5)]
        for j in range(6):
            rows.append((6 * i + j, " ".join("".join(random.choices(letters, k=6)) for _ in range(30)), f"l{i}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = predict_languages(docs, train_languages(docs)).collect()
    assert all(r["lang"] == r["lang_pred"] for r in found)


# --------------------------------------------------------------------------------- packing


def plain_best_fit(lengths, sources, clusters, capacity):
    bins, out = [], []
    for length, s, c in zip(lengths, sources, clusters):
        fits = [
            (left, b)
            for b, (left, ss, cs) in enumerate(bins)
            if left >= max(1, length) and (s < 0 or s not in ss) and (c < 0 or c not in cs)
        ]
        if fits:
            b = min(fits)[1]
        else:
            b = len(bins)
            bins.append((capacity, set(), set()))
        left, ss, cs = bins[b]
        out.append((b, capacity - left))
        bins[b] = (left - length, ss | {s}, cs | {c})
    return out


def test_best_fit_is_the_tightest_compatible_bin():
    random.seed(5)
    for _ in range(30):
        n, capacity = random.randrange(1, 200), 50
        pieces = (
            [random.randrange(0, capacity) for _ in range(n)],
            [random.choice([-1, 0, 0, 1, 2, 3, 70]) for _ in range(n)],
            [random.randrange(-1, 30) for _ in range(n)],
        )
        assert best_fit(*pieces, capacity) == plain_best_fit(*pieces, capacity)


def check_packing(rows, docs, capacity):
    """Every document in whole, no bin too full, no overlap, no two of one source or text."""
    pieces, bins = defaultdict(int), defaultdict(list)
    of = {i: (source, text) for i, text, source in docs}
    for r in rows:
        pieces[r["doc_id"]] += r["n_tokens"]
        bins[r["bin_id"]].append(r)
    assert pieces == {i: 1 + len((text or "").split()) for i, text, _ in docs}
    for held in bins.values():
        held.sort(key=lambda r: (r["bin_offset"], r["n_tokens"]))
        assert all(a["bin_offset"] + a["n_tokens"] <= b["bin_offset"] for a, b in zip(held, held[1:]))
        assert held[-1]["bin_offset"] + held[-1]["n_tokens"] <= capacity
        for k in (0, 1):
            values = [of[r["doc_id"]][k] for r in held]
            assert len(set(values)) == len(values)


def test_packing_of_documents(documents):
    docs = duckdb.sql(f"SELECT doc_id, text, source FROM '{SF_DIR}/documents.parquet'").fetchall()
    for shard_rows in (100, 4096):
        rows = pack(documents, capacity=512, shard_rows=shard_rows).collect()
        check_packing(rows, docs, 512)
    assert rows == pack(documents, capacity=512).collect()


def test_packing_of_odd_rows(odd):
    docs = odd.withColumn("source", F.lit(None).cast("string"))
    rows = pack(docs, capacity=100).collect()
    assert sum(r["n_tokens"] for r in rows) == sum(1 + len((t or "").split()) for _, t in ODD)
    assert sum(r["piece"] == 0 for r in rows) == len(ODD)
    assert pack(docs.limit(0)).collect() == []
    none = pack(odd, length=F.lit(None), source=F.lit(None), cluster=F.lit(1)).collect()
    assert len({r["bin_id"] for r in none}) == len(ODD)


# ------------------------------------------------------------------------------- token ids


@pytest.mark.parametrize("limit", [2, 300, 49_408, 1 << 21, 1 << 32, 1 << 50])
def test_simple_8b_round_trip(limit):
    rng = np.random.default_rng(limit)
    for n in (0, 1, BLOCK - 1, BLOCK, BLOCK + 1, 5000):
        ids = rng.integers(0, limit, n)
        # Runs of small ids among large ones.
        ids[: n // 2] >>= rng.integers(0, 40, n // 2) // 4 * 4
        words, offsets = encode(ids)
        assert len(offsets) == -(-n // BLOCK)
        assert (decode(words, offsets, n) == ids.astype(np.uint64)).all()


def expected_tokens(docs):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    start = 0
    for i, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        yield i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_token_ids_of_documents(spark, documents, texts, rows_of, tmp_path):
    folder = str(tmp_path / "ids")
    write_token_ids(documents, TOKENIZER, folder)
    assert rows_of(token_digest(spark, folder)) == sorted(expected_tokens(sorted(texts)), key=repr)
    ids = read_token_ids(spark, folder).where("doc_id = 3").first()
    assert len(ids["ids"]) == 4 * ids["n_tokens"]


def test_token_ids_of_odd_rows(spark, odd, rows_of, tmp_path):
    write_token_ids(odd, TOKENIZER, str(tmp_path / "a"))

    def place(row):
        """Null ids first; rows of one id by the signed hash of the text, 42 for a null one."""
        i, text = row
        key = 42 if text is None else xxhash.xxh64_intdigest(text.encode(), 42)
        return i is not None, i or 0, key - (key >> 63 << 64)

    order = sorted(ODD, key=place)
    got = [tuple(r) for r in token_digest(spark, str(tmp_path / "a")).orderBy("start").collect()]
    assert got == list(expected_tokens(order))
    write_token_ids(odd.limit(0), TOKENIZER, str(tmp_path / "b"))
    assert token_digest(spark, str(tmp_path / "b")).collect() == []


def test_words_are_encoded_as_in_the_text(spark, rows_of, tmp_path):
    docs = [
        (0, "DON'T don't. Don't, it's 'tis ΟΔΟΣ ΣΑΣ. İstanbul, ǅ ﬁ é é é. naïve"),
        (1, "<|endoftext|> <|ENDOFTEXT|> x<|startoftext|>y ... ,. a.b a.. 12.5, ١٢ \x1c\x85 x"),
        (2, "日本語 テスト。 한국어, \U0001f600\U0001f600. ß ẞ STRASSE, ̀ ʼn"),
        (3, " tab\tline\nfeed\x0bvt\x0cff\rcr\xa0nbsp​zwsp "),
    ]
    write_token_ids(
        spark.createDataFrame(docs, "doc_id long, text string"), TOKENIZER, str(tmp_path / "ids")
    )
    assert rows_of(token_digest(spark, str(tmp_path / "ids"))) == list(expected_tokens(docs))


# ------------------------------------------------------------------------------ n-gram model


def plain_kneser_ney(texts):
    """Probability of c after (a, b), straight from the definition."""
    three = Counter()
    for text in texts:
        w = ["<", "<", *text.lower().split(), ">"]
        three.update(zip(w, w[1:], w[2:]))
    two = Counter((b, c) for _, b, c in three)
    one = Counter(c for _, c in two)

    def discounts(counts):
        n = [max(1, sum(v == k for v in counts.values())) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        raw = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
        return [min(k - 0.05, max(0.05, d)) for k, d in zip((1, 2, 3), raw)]

    def step(counts, context, c, d, lower):
        here = {k: v for k, v in counts.items() if k[:-1] == context}
        if not here:
            return lower
        total = sum(here.values())
        back = sum(d[min(v, 3) - 1] for v in here.values()) / total
        v = here.get((*context, c), 0)
        return (v - d[min(v, 3) - 1] if v else 0) / total + back * lower

    d3, d2, d1 = discounts(three), discounts(two), discounts(one)
    one = Counter({(c,): v for c, v in one.items()})

    def p(a, b, c):
        lowest = step(one, (), c, d1, 1 / (len(one) + 1))
        return step(three, (a, b), c, d3, step(two, (b,), c, d2, lowest))

    return p


def test_model_is_modified_kneser_ney(spark):
    random.seed(6)
    texts = [" ".join(random.choices("a B c d e the of".split(), k=random.randrange(0, 12))) for _ in range(60)]
    model = train_ngrams(spark.createDataFrame([(t,) for t in texts], "text string"))
    p = plain_kneser_ney(texts)
    for text in ["a b c the of", "", "zz a zz", "The of d e e e a"]:
        w = ["<", "<", *text.lower().split(), ">"]
        want = [math.log(p(*t)) for t in zip(w, w[1:], w[2:])]
        got = model.log_prob(kneser_ney._tokens(text.encode()))
        assert np.allclose(got, want, atol=1e-4)
    # What a context leaves to all words adds up to one.
    words = sorted({x for t in texts for x in t.lower().split()}) + [">", "unseen"]
    assert abs(sum(p("a", "b", c) for c in words) - 1) < 1e-9


def held_out(labels):
    """Labelled documents that no model has seen: those whose id has an odd hash."""
    return labels.where(F.xxhash64("doc_id") % 2 != 0)


def test_junk_and_toxic_texts_go(spark):
    folder = "/root/testdata/sf0.1"
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judged = judge_perplexity(documents, labels.where("quality = 1 AND toxic = 0"), labels.where("toxic = 1"))
    of = held_out(labels).join(judged, "doc_id").groupBy("quality", "toxic")
    kept = {(r["quality"], r["toxic"]): r["kept"] for r in of.agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert kept[1, 0] >= 0.98
    assert kept[1, 1] <= 0.3
    assert kept[0, 0] <= 0.5


def test_sharded_joins_give_the_same_scores(spark, documents, rows_of):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    docs = documents.where("doc_id < 300").unionByName(documents.where("doc_id < 20"))
    arguments = (docs, labels.where("quality = 1 AND toxic = 0"), labels.where("toxic = 1"))
    first = rows_of(judge_perplexity(*arguments))
    second = rows_of(judge_perplexity(*arguments, most_broadcast=0, most_bits=1 << 12))
    assert len(first) == len(second) == 320
    for a, b in zip(first, second):
        assert a[:3] == b[:3] and a[-1] == b[-1]
        assert np.allclose([x or 0 for x in a[3:7]], [x or 0 for x in b[3:7]], rtol=1e-4)


def test_perplexity_of_odd_rows(spark, odd):
    docs = odd.withColumn("lang", F.lit(None).cast("string"))
    trusted = spark.createDataFrame([(4,), (8,), (None,), (99,)], "doc_id long")
    rows = judge_perplexity(docs, trusted).collect()
    assert len(rows) == len(ODD)
    assert all(r["perplexity"] > 0 and r["threshold"] > 0 for r in rows)
    assert judge_perplexity(docs.limit(0), trusted).collect() == []
    nothing = judge_perplexity(docs, trusted.limit(0)).collect()
    assert len(nothing) == len(ODD)
    joined = judge_perplexity(docs, trusted, trusted, most_broadcast=0).collect()
    assert len(joined) == len(ODD)
    assert judge_perplexity(docs.limit(0), trusted, trusted, most_broadcast=0).collect() == []


def test_models_are_fit_on_all_documents_of_their_half(spark):
    """Each trusted text has a word of its own: the model knows those of every even hash."""
    docs = spark.range(8000).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), "id").alias("text"))
    found = kneser_ney.training_documents(docs, docs.select(F.col("doc_id").alias("_id")), "doc_id", "text")
    even = docs.where(F.xxhash64("doc_id") % 2 == 0).count()
    assert found.count() == even > 3000
    judged = judge_perplexity(docs.withColumn("lang", F.lit("x")), docs.select("doc_id"))
    # A word that was seen is likelier than one that was not.
    least = judged.agg(F.min("perplexity")).first()[0]
    assert judged.where(F.col("perplexity") < least * 1.001).count() == even


def test_a_model_in_shards_is_not_written(spark, tmp_path, monkeypatch):
    """Beyond a broadcast, only what words add is kept on disk, and frequent words have many shards."""
    random.seed(9)
    vocabulary = [f"w{i}" for i in range(1000)]
    texts = [" ".join("the" if random.random() < 0.2 else random.choice(vocabulary) for _ in range(400)) for _ in range(300)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    monkeypatch.setattr(common, "shared_folder", lambda _, name: str(tmp_path / name))
    found = judge_perplexity(docs, docs, docs.where("doc_id < 40"), most_broadcast=0).orderBy("doc_id").collect()
    even = docs.where(F.xxhash64("doc_id") % 2 == 0).count()
    assert sum(p.stat().st_size for p in tmp_path.rglob("*.parquet")) < 24 * 401 * even
    whole = judge_perplexity(docs, docs, docs.where("doc_id < 40")).orderBy("doc_id").collect()
    for a, b in zip(found, whole, strict=True):
        assert a["kept"] == b["kept"]
        assert np.allclose([x or 0 for x in a[2:7]], [x or 0 for x in b[2:7]], rtol=1e-5)
