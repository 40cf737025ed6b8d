"""Documents judged by a language model: interpolated modified Kneser-Ney over word trigrams."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkgrain.llm.common import mixed, pieces, written
from talkgrain.sources.scans import broadcast_if_small

# Stand for the places before the first word and after the last.
_BEGIN, _END = np.uint64(1), np.uint64(2)
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def _tokens(text: bytes | None) -> np.ndarray:
    """Hashes of the words, A to Z in lower case, between two beginnings and an end."""
    words = text.translate(_LOWER).split() if text else []
    out = np.empty(len(words) + 3, np.uint64)
    out[:2], out[-1] = _BEGIN, _END
    out[2:-1] = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return out


def _trigrams(batches):
    for batch in pieces(batches):
        found = []
        for text in batch.column("_text").to_pylist():
            t = _tokens(text)
            found.append(np.stack([t[:-2], t[1:-1], t[2:]]))
        if found:
            grams, counts = np.unique(np.concatenate(found, axis=1), axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(g.view(np.int64)) for g in grams), pa.array(counts.astype(np.int64))],
                ["a", "b", "c", "n"],
            )


def _discounts(counts: DataFrame) -> list[float]:
    """What is taken from counts of 1, 2 and more, by how many counts are 1, 2, 3 and 4."""
    of = [F.count_if(F.col("n") == k).alias(f"n{k}") for k in (1, 2, 3, 4)]
    return _discounts_by(*counts.agg(*of).first())


def _discounts_by(*numbers: int) -> list[float]:
    n1, n2, n3, n4 = (max(1, int(x)) for x in numbers)
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return [min(k - 0.05, max(0.05, d)) for k, d in zip((1, 2, 3), raw)]


def _discounted(n: Column, d: list[float]) -> Column:
    return n - F.when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2])


def _contexts(counts: DataFrame, by: list[str], d: list[float]) -> DataFrame:
    """By context, the sum of counts and the share that is left for shorter contexts."""
    n = F.col("n")
    left = d[0] * F.count_if(n == 1) + d[1] * F.count_if(n == 2) + d[2] * F.count_if(n > 2)
    return counts.groupBy(*by).agg(F.sum("n").alias("total"), (left / F.sum("n")).alias("back"))


# What a key of the model names: a word, a word or a pair as context, a pair, a triple.
_WORD, _WORD_BACK, _PAIR, _PAIR_BACK, _TRIPLE = range(5)
# Keeps the keys of the kinds apart: hashes of words are spread, but those of the ends are small.
_APART = 0x9E3779B97F4A7C15


def _key(kind: int, *hashes: np.ndarray) -> np.ndarray:
    """One 64-bit key for a run of words and its part in the model."""
    seed = (kind + 1) * _APART % 2**64
    key = mixed(hashes[0], seed)
    for more in hashes[1:]:
        key = mixed(key ^ more, seed)
    return key


class Lookup:
    """Log-probabilities as sums: ``values`` by sorted ``keys``, 0 where there is none.

    A probability comes from the longest run that was seen, times what the longer contexts leave.
    With each value less what the shorter runs already add to it, that is the sum over all runs of
    a place, so runs can be looked up in any order and place, and one that was not seen adds 0.
    ``tables`` holds sorted keys and their values for each kind, ``unseen`` is the log-probability of
    a word that was not seen. ``alarms``, keys and values too, say how much likelier a word is in
    texts to be kept out; other words have minus infinity.
    """

    def __init__(self, tables: list[tuple[np.ndarray, np.ndarray]], alarms, unseen: float):
        self.tables, self.alarms, self.unseen = tables, alarms, unseen

    @staticmethod
    def find(table: tuple[np.ndarray, np.ndarray], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values, 0 where there is none, and whether there is one."""
        keys, values = table
        if not len(keys):
            return np.zeros(len(wanted), np.float32), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        found = keys[at] == wanted
        return np.where(found, values[at], np.float32(0)), found

    def log_prob(self, tokens: np.ndarray) -> np.ndarray:
        """By text of ``_tokens``, the log-probability of each word and of the end."""
        return self.score(tokens)[0]

    def score(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each word and the end, the log-probability and the alarm.

        The parts of a run that was seen were seen too, so longer runs are looked up only where the
        shorter ones were found.
        """
        a, b, c = tokens[:-2], tokens[1:-1], tokens[2:]
        out = np.full(len(c), self.unseen)
        words = _key(_WORD, c)
        alarm, alarming = self.find(self.alarms, words)
        alarm[~alarming] = -np.inf

        def add(kind: int, where: np.ndarray, *hashes: np.ndarray) -> np.ndarray:
            """Adds the values of a kind at some places, and says at which there is one."""
            at = np.flatnonzero(where)
            value, found = self.find(self.tables[kind], _key(kind, *(h[at] for h in hashes)))
            out[at] += value
            there = np.zeros(len(out), bool)
            there[at] = found
            return there

        value, known = self.find(self.tables[_WORD], words)
        out += value
        context = add(_WORD_BACK, np.ones(len(out), bool), b)
        pair = add(_PAIR, known & context, b, c)
        # The first two of a place are the last two of the one before, but where a text begins.
        before = (a == _BEGIN) & (b == _BEGIN)
        before[1:] |= pair[:-1]
        context = add(_PAIR_BACK, before, a, b)
        add(_TRIPLE, pair & context, a, b, c)
        return out, alarm


def _keyed(table: DataFrame, kind: int) -> DataFrame:
    """``key`` and ``v`` of a table of word hashes and, last, their value."""

    def rows(batches):
        for batch in batches:
            *hashes, value = batch.columns
            key = _key(kind, *(h.to_numpy().view(np.uint64) for h in hashes))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), value], ["key", "v"])

    return table.mapInArrow(rows, "key long, v double")


def _word_values(one: DataFrame) -> tuple[DataFrame, float] | None:
    """By word, the log-probability over that of a word that was not seen, and the latter; from the
    number ``n`` of distinct words before each word ``c``. None without words."""
    d1 = _discounts(one)
    whole = _contexts(one, [], d1).first()
    if whole["total"] is None:
        return None
    flat = whole["back"] / (one.count() + 1)
    p1 = _discounted(F.col("n"), d1) / whole["total"] + flat
    return one.select("c", p1.alias("p1")), math.log(flat)


@dataclass
class Model:
    """A model as tables: ``words`` and, by kind, ``runs`` of ``key`` and ``v`` (see ``Lookup``), the
    log-probability of a word that was not seen, and how many rows there are at most."""

    words: DataFrame
    runs: list[DataFrame]
    unseen: float
    rows: int


def ngram_model(docs: DataFrame, text_col: str = "text") -> Model:
    """The model of the texts of ``docs``.

    Counts are grouped sums sharded by n-gram; the counts of shorter n-grams are the numbers of
    distinct words before them. Discounts come from the counts of counts of each order, and
    probabilities from joining each order to its contexts and to the order below.
    """
    source = docs.select(F.col(text_col).cast("binary").alias("_text"))
    counted = source.mapInArrow(_trigrams, "a long, b long, c long, n long")
    three = written(counted.groupBy("a", "b", "c").agg(F.sum("n").alias("n")), "trigrams")
    two = written(three.groupBy("b", "c").agg(F.count("*").alias("n")), "bigrams")
    one = written(two.groupBy("c").agg(F.count("*").alias("n")), "words")
    found = _word_values(one)
    if found is None:
        return Model(docs.sparkSession.createDataFrame([], "key long, v double"), [], 0.0, 0)
    p1, unseen = found
    d3, d2 = (_discounts(t) for t in (three, two))
    c2 = _contexts(two, ["b"], d2)
    seen, back = _discounted(F.col("n"), d2) / F.col("total"), F.col("back")
    p2 = two.join(c2, "b").join(p1, "c")
    without = back * F.col("p1")
    p2 = p2.select("b", "c", (seen + without).alias("p2"), F.log((seen + without) / without).cast("float").alias("v"))
    p2 = written(p2, "bigram-probabilities")
    c3 = _contexts(three, ["a", "b"], d3)
    seen = _discounted(F.col("n"), d3) / F.col("total")
    joined = three.join(c3, ["a", "b"]).join(p2.drop("v"), ["b", "c"])
    without = back * F.col("p2")
    tables = {
        _WORD_BACK: c2.select("b", F.log("back").alias("v")),
        _PAIR: p2.select("b", "c", F.col("v").cast("double").alias("v")),
        _PAIR_BACK: c3.select("a", "b", F.log("back").alias("v")),
        _TRIPLE: joined.select("a", "b", "c", F.log((seen + without) / without).alias("v")),
    }
    words = _keyed(p1.select("c", (F.log("p1") - unseen).alias("v")), _WORD)
    runs = [_keyed(table, kind) for kind, table in tables.items()]
    # A word or a pair can also be a context.
    return Model(words, runs, unseen, 2 * one.count() + 2 * two.count() + three.count() + 2)


def word_model(docs: DataFrame, text_col: str = "text") -> Model:
    """The lowest order of the model alone: a word counts once for each word before it, so copies
    of a text add nothing."""

    def pairs(batches):
        for batch in pieces(batches):
            found = []
            for text in batch.column("_text").to_pylist():
                t = _tokens(text)
                found.append(np.stack([t[1:-1], t[2:]]))
            if found:
                distinct = np.unique(np.concatenate(found, axis=1), axis=1)
                columns = [pa.array(c.view(np.int64)) for c in distinct]
                yield pa.RecordBatch.from_arrays(columns, ["b", "c"])

    source = docs.select(F.col(text_col).cast("binary").alias("_text"))
    two = source.mapInArrow(pairs, "b long, c long").distinct()
    one = written(two.groupBy("c").agg(F.count("*").alias("n")), "words")
    found = _word_values(one)
    if found is None:
        return Model(docs.sparkSession.createDataFrame([], "key long, v double"), [], 0.0, 0)
    p1, unseen = found
    words = _keyed(p1.select("c", (F.log("p1") - unseen).alias("v")), _WORD)
    return Model(words, [], unseen, one.count())


def model_tables(model: Model, toxic: Model | None) -> list[DataFrame]:
    """The values of a model, and the alarms of one of toxic texts, by key: ``key``, ``v``, ``r``
    (log-ratio of a word's probabilities, null if no toxic text has it)."""
    none = F.lit(None).cast("double").alias("r")
    runs = [table.select("key", "v", none) for table in model.runs]
    if toxic is None:
        return [model.words.select("key", "v", none), *runs]
    there = toxic.words.select(F.col("key").alias("_key"), F.col("v").alias("_v"))
    joined = model.words.join(there, F.col("key") == F.col("_key"), "full")
    v = F.coalesce("v", F.lit(0.0))
    ratio = (F.col("_v") + toxic.unseen) - (v + model.unseen)
    words = joined.select(F.coalesce("key", "_key").alias("key"), v.alias("v"), ratio.alias("r"))
    return [words, *runs]


def _arrays(tables: list[DataFrame]) -> tuple[list[tuple[np.ndarray, np.ndarray]], tuple[np.ndarray, np.ndarray]]:
    """Sorted keys and values of each table, and those of the words that raise alarms, which are few.
    The tables reach the driver one by one."""

    def by_key(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(keys)
        return keys[order], values[order].astype(np.float32)

    parts, alarms = [], None
    for table in tables:
        # Words come first, and only they raise alarms.
        columns = ["key", F.col("v").cast("float"), F.col("r").cast("float")]
        got = table.select(*(columns if alarms is None else columns[:2])).toArrow()
        keys, values = got["key"].to_numpy().view(np.uint64), got["v"].to_numpy()
        if alarms is None:
            r = got["r"].combine_chunks().fill_null(np.nan).to_numpy(zero_copy_only=False)
            alarms = by_key(keys[~np.isnan(r)], r[~np.isnan(r)])
            # A word that only toxic texts have is none of the model's.
            keys, values = keys[values != 0], values[values != 0]
        parts.append(by_key(keys, values))
    none = (np.zeros(0, np.uint64), np.zeros(0, np.float32))
    return parts + [none] * (_TRIPLE + 1 - len(parts)), alarms


def train_ngrams(docs: DataFrame, text_col: str = "text") -> Lookup:
    """The model of ``docs`` on the driver, whose memory it must fit."""
    model = ngram_model(docs, text_col)
    return Lookup(*_arrays(model_tables(model, None)), model.unseen)


def training_documents(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The texts of all ``docs`` with an id of even hash among ``ids``."""
    even = broadcast_if_small(ids.where(F.xxhash64("_id") % 2 == 0))
    found = docs.join(even, F.col(id_col) == F.col("_id"), "semi")
    return found.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))


def _together(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The texts of a batch in parts: the first row, all tokens in a row, and the number of each text."""
    texts = batch.column("_text").to_pylist()
    for at in range(0, len(texts), 200):
        tokens = [_tokens(t) for t in texts[at : at + 200]]
        yield at, np.concatenate(tokens), np.array([len(t) for t in tokens])


def _scored_in_scan(source: DataFrame, tables: list[DataFrame], unseen: float, schema: str) -> DataFrame:
    """Scores by looking up the broadcast tables, a place at a time."""
    shared = source.sparkSession.sparkContext.broadcast((*_arrays(tables), unseen))
    return source.drop("_key").mapInArrow(_scorer(lambda: Lookup(*shared.value).score, _verdict_batch), schema)


def _scorer(scores: Callable[[], Callable], result: Callable[..., pa.RecordBatch]) -> Callable:
    """Passes each batch to ``result``, with the number of places, score and alarm of its texts.
    What ``scores`` makes in a worker is like ``Lookup.score``."""

    def rows(batches):
        score_of = scores()
        for batch in batches:
            total, sizes, alarms = [], [], []
            for _, tokens, lengths in _together(batch):
                # One look-up for many texts; places that reach over two of them are left out.
                score, alarm = score_of(tokens)
                ends = np.cumsum(lengths)
                sums = np.concatenate([[0.0], np.cumsum(score, dtype=np.float64)])
                total.append(sums[ends - 2] - sums[ends - lengths])
                sizes.append(lengths - 2)
                # A text ends two places before the next begins; between them nothing counts.
                starts = ends - lengths
                alarm = np.append(alarm, np.full(2, -np.inf, np.float32))
                for shift in (1, 2):
                    alarm[ends - shift] = -np.inf
                alarms.append(np.maximum.reduceat(alarm, starts))
            size = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
            score = np.concatenate(total) if total else np.zeros(0)
            alarm = np.concatenate(alarms) if alarms else np.zeros(0)
            yield result(batch, size, score, alarm)

    return rows


def _verdict_batch(batch, size, score, alarm) -> pa.RecordBatch:
    alarm = alarm.astype(np.float64)
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"),
            batch.column("lang"),
            pa.array(size.astype(np.int64)),
            pa.array(np.exp(-score / np.maximum(size, 1))),
            pa.array(alarm, mask=np.isneginf(alarm)),
        ],
        ["doc_id", "lang", "n_tokens", "perplexity", "alarm"],
    )


# ------------------------------------------------------------------- models beyond a broadcast


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark deletes what a query has shuffled when the query ends, not some time later."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _chunks(batches, most: int = 1 << 20, most_texts: int = 30_000) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The texts of a partition in chunks of ``most`` words, one text at least: their ``_key``, all
    tokens in a row, and the number of each text."""
    names, tokens, size = [], [], 0
    for batch in pieces(batches):
        for name, text in zip(batch.column("_key").to_pylist(), batch.column("_text").to_pylist()):
            names.append(name)
            tokens.append(_tokens(text))
            size += len(tokens[-1])
            if size >= most or len(names) >= most_texts:
                chunk = np.array(names, np.int64), np.concatenate(tokens), np.array([len(t) for t in tokens])
                names, tokens, size = [], [], 0
                yield chunk
    if names:
        yield np.array(names, np.int64), np.concatenate(tokens), np.array([len(t) for t in tokens])


def _places(tokens: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each word and end, the two words before, itself, and the number of its text."""
    of = np.repeat(np.arange(len(lengths), dtype=np.uint16), lengths)
    inside = of[:-2] == of[2:]
    return tokens[:-2][inside], tokens[1:-1][inside], tokens[2:][inside], of[:-2][inside]


@dataclass
class _Deal:
    """How runs of words are dealt to ``shards``, a ``rounds``-th of which are worked on at a time.

    A run of three goes by its middle word, so that it meets the pair it begins with and the pair it
    ends with. The runs around a frequent word (``hot``, sorted) go to as many shards as ``ways``
    says, by their first word. ``places`` is the number of words and ends that the model is fit on.
    """

    rounds: int
    shards: int
    places: int
    hot: np.ndarray
    ways: np.ndarray

    def ways_of(self, b: np.ndarray) -> np.ndarray:
        """0 where the word is not frequent."""
        if not len(self.hot):
            return np.zeros(len(b), np.uint64)
        at = np.minimum(np.searchsorted(self.hot, b), len(self.hot) - 1)
        return np.where(self.hot[at] == b, self.ways[at], np.uint64(0))

    def shard(self, b: np.ndarray, way: np.ndarray | int = 0) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (mixed(b) + np.asarray(way, np.uint64)) % np.uint64(self.shards)

    def middle(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The shard of the runs that have ``b`` between ``a`` and another word."""
        ways = self.ways_of(b)
        return self.shard(b, np.where(ways > 0, mixed(a) % np.maximum(ways, np.uint64(1)), np.uint64(0)))

    def pair(self, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        """The shard, of those of one round, of the runs that end with a pair: none has many."""
        return mixed(mixed(b) ^ c) % np.uint64(self.shards // self.rounds)


def _deal(training: DataFrame, rounds: int) -> _Deal:
    """As many shards a round as Spark is told to shuffle to. Words are frequent that would fill half
    a shard; they are found among those that are frequent in some chunk."""
    spark = training.sparkSession
    shards = rounds * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def rows(batches):
        for _, tokens, lengths in _chunks(batches):
            _, b, _, _ = _places(tokens, lengths)
            words, n = np.unique(b, return_counts=True)
            often = n * 2 * shards > len(b)
            words = [*words[often].view(np.int64).tolist(), None]
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.int64()), pa.array([*n[often].tolist(), len(b)], pa.int64())], ["w", "n"]
            )

    found = _named(training).mapInArrow(rows, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))
    found = written(found, "frequent-words")
    whole = found.where("w IS NULL").first()
    places = whole["n"] if whole else 0
    hot = found.where(F.expr("w IS NOT NULL") & (F.col("n") * 2 * shards > places)).toArrow()
    words, n = hot["w"].to_numpy().view(np.uint64), hot["n"].to_numpy()
    order = np.argsort(words)
    ways = -(-n[order] * 2 * shards // max(1, places))
    return _Deal(rounds, shards, places, words[order], np.minimum(ways, shards).astype(np.uint64))


def _named(training: DataFrame) -> DataFrame:
    return training.select(F.lit(0).cast("long").alias("_key"), F.col("_text").cast("binary").alias("_text"))


def _runs(training: DataFrame, shard_of: Callable, in_round: int | None, rounds: int) -> DataFrame:
    """The runs of three words of a chunk and their counts, a row a shard: ``runs`` are three rows of
    hashes, ``n`` 32-bit counts, ``a`` is 3. Of all shards, or of those of one round."""

    def rows(batches):
        for _, tokens, lengths in _chunks(batches):
            a, b, c, _ = _places(tokens, lengths)
            shard = shard_of(a, b, c)
            if in_round is not None:
                held = shard % np.uint64(rounds) == in_round
                a, b, c, shard = a[held], b[held], c[held], shard[held]
            _, at, n = np.unique(_key(_TRIPLE, a, b, c), return_index=True, return_counts=True)
            order = np.lexsort((b[at], shard[at]))
            at, n = at[order], n[order].astype(np.uint32)
            names, starts = np.unique(shard[at], return_index=True)
            runs, ends = np.stack([a[at], b[at], c[at]]), [*starts[1:], len(at)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names.astype(np.int32)),
                    pa.array([3] * len(names), pa.int32()),
                    pa.array([runs[:, s:e].tobytes() for s, e in zip(starts, ends)], pa.binary()),
                    pa.array([n[s:e].tobytes() for s, e in zip(starts, ends)], pa.binary()),
                ],
                ["shard", "words", "runs", "n"],
            )

    return _named(training).mapInArrow(rows, _RUNS)


_RUNS = "shard int, words int, runs binary, n binary"


def _read_runs(table: pa.Table, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The runs of so many words of a shard, a row a place in them, and their counts."""
    rows = [r for r in table.select(["words", "runs", "n"]).to_pylist() if r["words"] == words]
    runs = [np.frombuffer(r["runs"], np.uint64).reshape(words, -1) for r in rows]
    n = [np.frombuffer(r["n"], np.uint32) for r in rows]
    none = np.zeros((words, 0), np.uint64)
    return np.concatenate([none, *runs], axis=1), np.concatenate([np.zeros(0, np.uint32), *n]).astype(np.int64)


def _sums(of: np.ndarray, n: np.ndarray, size: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """By group, the sum of counts, and how many are 1, 2 and more."""
    kinds = np.minimum(n, 3)
    return np.bincount(of, n, size), [np.bincount(of[kinds == k], minlength=size) for k in (1, 2, 3)]


def _less(n: np.ndarray, d: list[float]) -> np.ndarray:
    return n - np.array([0.0, *d])[np.minimum(n, 3)]


def _distinct(runs: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the distinct runs of three, the runs, and their counts."""
    key, at, of = np.unique(_key(_TRIPLE, *runs), return_index=True, return_inverse=True)
    return key, runs[:, at], np.bincount(of, n, len(key)).astype(np.int64)


def _bits_at(key: np.ndarray, shard: np.ndarray, words: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word and bit of each key in the Bloom filters of the shards, of so many words (a power of two)."""
    last, six, low = np.uint64(words - 1), np.uint64(6), np.uint64(63)
    for shift in (0, 32):
        k = key >> np.uint64(shift)
        yield shard * np.uint64(words) + ((k >> six) & last), np.uint64(1) << (k & low)


def _known(bloom: np.ndarray, words: int, key: np.ndarray, shard: np.ndarray) -> np.ndarray:
    found = np.ones(len(key), bool)
    for at, bit in _bits_at(key, shard, words):
        found &= (bloom[at] & bit) != 0
    return found


# What a row of the counts tells: of a word as the last of a pair, of one as the first, how many runs
# of three and of two have which count, a pair with a frequent first word, the Bloom filter of a shard.
_LAST, _FIRST, _OF_THREE, _OF_TWO, _HOT, _BLOOM = range(6)
_COUNTS = "kind int, w long, x long, n long, k1 long, k2 long, k3 long, bits binary"


def _counts(training: DataFrame, deal: _Deal, bloom_words: int) -> DataFrame:
    """One count of all runs, for what must be known of the whole before a value of one is."""

    def rows(table: pa.Table) -> pa.Table:
        shard = np.uint64(table["shard"][0].as_py())
        _, (_, b, c), n = _distinct(*_read_runs(table, 3))
        pair, at, before = np.unique(_key(_PAIR, b, c), return_index=True, return_counts=True)
        b, c = b[at], c[at]
        last, times = np.unique(c, return_counts=True)
        first, of = np.unique(b, return_inverse=True)
        total, by = _sums(of, before, len(first))
        hot = deal.ways_of(b) > 0
        bloom = np.zeros(bloom_words, np.uint64)
        for at, bit in _bits_at(pair, np.uint64(0), bloom_words):
            np.bitwise_or.at(bloom, at, bit)
        parts = [
            (_LAST, last, None, times, None, None, None, None),
            (_FIRST, first, None, total, *by, None),
            *((kind, np.zeros(1, np.uint64), None, *([np.sum(x == k)] for k in (1, 2, 3, 4)), None) for kind, x in ((_OF_THREE, n), (_OF_TWO, before))),
            (_HOT, b[hot], c[hot].view(np.int64), before[hot], None, None, None, None),
            (_BLOOM, np.array([shard]), None, None, None, None, None, [bloom.tobytes()]),
        ]
        kinds = [pa.int32(), *[pa.int64()] * 6, pa.binary()]
        names = ["kind", "w", "x", "n", "k1", "k2", "k3", "bits"]
        tables = []
        for kind, w, *more in parts:
            columns = [np.full(len(w), kind), w.view(np.int64), *more]
            arrays = [pa.nulls(len(w), t) if x is None else pa.array(x if isinstance(x, list) else x.astype(np.int64), t) for x, t in zip(columns, kinds)]
            tables.append(pa.Table.from_arrays(arrays, names))
        return pa.concat_tables(tables)

    runs = _runs(training, lambda a, b, c: deal.pair(b, c), None, deal.rounds)
    found = runs.groupBy("shard").applyInArrow(rows, _COUNTS)
    # A word is in many shards.
    return written(found.groupBy("kind", "w", "x", "bits").agg(*(F.sum(c).alias(c) for c in ("n", "k1", "k2", "k3"))), "counts")


def _scored_in_shards(source: DataFrame, training: DataFrame, bad: Model | None, deal: _Deal, most_bits: int) -> DataFrame:
    """Scores of a model of any size: documents ask its shards for what their n-grams add.

    One count of all runs gives the discounts, the values of the words, which go to the documents,
    and a Bloom filter of the pairs of bounded size. Then, round by round, a part of the shards
    is counted again, makes the values of its runs and adds them up for the texts that asked, which is
    all that stays of a round. Chunks of texts send a shard each run they may share with it once.
    """
    spark = source.sparkSession
    size = 1
    # About 8 bits a pair.
    while 2 * size * 64 * (deal.shards // deal.rounds) <= min(8 * deal.places, most_bits):
        size *= 2
    counts = _counts(training, deal, size)
    of_orders = counts.where(F.col("kind").isin(_OF_THREE, _OF_TWO)).select("kind", "n", "k1", "k2", "k3")
    of = {kind: numbers for kind, *numbers in of_orders.collect()}
    d3, d2 = _discounts_by(*of[_OF_THREE]), _discounts_by(*of[_OF_TWO])
    n = F.col("n")
    sums = [F.sum(F.when(F.col("kind") == kind, n)).alias(c) for kind, c in ((_LAST, "n"), (_FIRST, "total"))]
    sums += [F.sum(k).alias(k) for k in ("k1", "k2", "k3")]
    words = counts.where(F.col("kind").isin(_LAST, _FIRST)).groupBy("w").agg(*sums).toArrow()
    got = {c: words[c].combine_chunks().fill_null(0).to_numpy() for c in words.column_names}
    order = np.argsort(got["w"].view(np.uint64))
    got = {c: x[order] for c, x in got.items()}
    word, before, total = got["w"].view(np.uint64), got["n"], got["total"]
    d1 = _discounts_by(*(np.sum(before == k) for k in (1, 2, 3, 4)))
    whole = before.sum()
    flat = sum(d * np.sum(np.minimum(before, 3) == k) for k, d in zip((1, 2, 3), d1)) / whole / (np.sum(before > 0) + 1)
    unseen = math.log(flat)
    left = sum(d * got[f"k{k}"] for k, d in zip((1, 2, 3), d2))
    back = np.where(total > 0, left / np.maximum(total, 1), 1.0)

    def p1(before: np.ndarray) -> np.ndarray:
        """Of a word that has so many before it."""
        return _less(before.astype(np.int64), d1) / whole + flat

    alarms = (np.zeros(0, np.uint64), np.zeros(0))
    if bad is not None:
        toxic = bad.words.toArrow()
        key, value = toxic["key"].to_numpy().view(np.uint64), toxic["v"].to_numpy()
        order = np.argsort(key)
        alarms = key[order], value[order] + bad.unseen
    shared = spark.sparkContext.broadcast((word, before.astype(np.uint32), total.astype(np.uint32), back, alarms))

    def scores() -> Callable:
        word, before, _, back, alarms = shared.value

        def score(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Of the words alone: of places and what they add as contexts."""
            here, of = np.unique(tokens, return_inverse=True)
            at = np.minimum(np.searchsorted(word, here), len(word) - 1)
            found = word[at] == here
            value = np.log(p1(np.where(found, before[at], 0)))
            context = np.log(np.where(found, back[at], 1.0))
            alarm, alarming = Lookup.find(alarms, _key(_WORD, here))
            alarm = np.where(alarming, alarm - value, -np.inf)
            return value[of[2:]] + context[of[1:-1]], alarm[of[2:]]

        return score

    kind = source.schema["doc_id"].dataType.simpleString()

    def alone(batch, size, score, alarm) -> pa.RecordBatch:
        alarm = alarm.astype(np.float64)
        values = [pa.array(size.astype(np.int64)), pa.array(score), pa.array(alarm, mask=np.isneginf(alarm))]
        names = ["doc_id", "lang", "_key"]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *values], [*names, "n_tokens", "score", "alarm"])

    schema = f"doc_id {kind}, lang string, _key long, n_tokens long, score double, alarm double"
    rows = written(source.mapInArrow(_scorer(scores, alone), schema), "words-alone")

    # The longer runs.
    blooms = np.zeros((deal.shards // deal.rounds, size), np.uint64)
    for row in counts.where(F.col("kind") == _BLOOM).select("w", "bits").toLocalIterator():
        blooms[row["w"]] = np.frombuffer(row["bits"], np.uint64)
    bloom = spark.sparkContext.broadcast(blooms.reshape(-1))
    answers = []
    for number in range(deal.rounds):
        runs = _runs(training, lambda a, b, c: deal.middle(a, b), number, deal.rounds)
        shard = runs.unionByName(_hot_pairs(counts, deal, number))
        asked = _asked(source.select("_key", "_text"), deal, bloom, size, number)
        told = shard.groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(_teller(shared, p1, deal, d2, d3), _TOLD)
        answers.append(written(told.groupBy("chunk").applyInArrow(_added, "_key long, s double"), "answers"))
    summed = reduce(DataFrame.unionByName, answers).groupBy("_key").agg(F.sum("s").alias("s"))
    # Rows of one id and text have one sum, in which each of them is counted.
    copies = rows.groupBy("_key").agg(F.count("*").alias("copies"))
    by_text = summed.join(copies, "_key").select(F.col("_key").alias("_k"), (F.col("s") / F.col("copies")).alias("s"))
    score = F.col("score") + F.coalesce("s", F.lit(0.0))
    return rows.join(by_text, F.col("_key") == F.col("_k"), "left").select(
        "doc_id", "lang", "n_tokens", F.exp(-score / F.col("n_tokens")).alias("perplexity"), "alarm"
    )


def _hot_pairs(counts: DataFrame, deal: _Deal, in_round: int) -> DataFrame:
    """The pairs that begin with a frequent word, whose counts no shard has in whole, for each of its
    shards of a round."""

    def rows(batches):
        for batch in batches:
            b, c = (batch.column(x).to_numpy().view(np.uint64) for x in ("w", "x"))
            n, ways = batch.column("n").to_numpy().astype(np.uint32), deal.ways_of(b)
            for way in range(int(ways.max(initial=0))):
                shard = deal.shard(b, way)
                held = (ways > way) & (shard % np.uint64(deal.rounds) == in_round)
                for name in np.unique(shard[held]).tolist():
                    at = held & (shard == name)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([name], pa.int32()),
                            pa.array([2], pa.int32()),
                            pa.array([np.stack([b[at], c[at]]).tobytes()], pa.binary()),
                            pa.array([n[at].tobytes()], pa.binary()),
                        ],
                        ["shard", "words", "runs", "n"],
                    )

    return counts.where(F.col("kind") == _HOT).select("w", "x", "n").mapInArrow(rows, _RUNS)


_ASKED = "shard int, chunk long, names binary, keys binary, texts binary"
# Is added to the number of the first text of each key.
_NEXT = np.uint16(1 << 15)


def _short(key: np.ndarray) -> np.ndarray:
    """48 bits of a key, which tell it from the others of a shard."""
    return key >> np.uint64(16)


def _packed(keys: np.ndarray) -> bytes:
    """The last six bytes of sorted keys, the highest of all first: Spark presses those well."""
    return keys.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(data, np.uint8).reshape(6, -1).T
    return out.view(">u8").reshape(-1).astype(np.uint64)


def _asked(source: DataFrame, deal: _Deal, bloom, bloom_words: int, in_round: int) -> DataFrame:
    """What chunks ask the shards of a round: each key once, and the texts that have it, by number.
    One row of a chunk has the ``_key`` of its texts too."""

    def rows(batches):
        for names, tokens, lengths in _chunks(batches):
            a, b, c, of = _places(tokens, lengths)
            shard = deal.middle(a, b)
            held = shard % np.uint64(deal.rounds) == in_round
            a, b, c, of, shard = a[held], b[held], c[held], of[held], shard[held]
            pair, at = _key(_PAIR, b, c), deal.pair(b, c)
            known = _known(bloom.value, bloom_words, pair, at)
            # A pair that was seen is a context too, and where a text begins there is one.
            context = (a == _BEGIN) & (b == _BEGIN)
            context |= _known(bloom.value, bloom_words, _key(_PAIR, a, b), deal.pair(a, b))
            both = known & context
            wanted = [
                (pair[known], known),
                (_key(_PAIR_BACK, a[context], b[context]), context),
                (_key(_TRIPLE, a[both], b[both], c[both]), both),
            ]
            # Sorted by shard of the round, then by key.
            place = shard // np.uint64(deal.rounds) << np.uint64(48)
            key = np.concatenate([place[held] | _short(k) for k, held in wanted])
            order = np.argsort(key)
            key, text = key[order], np.concatenate([of[held] for _, held in wanted])[order]
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            starts = np.flatnonzero(new)
            text[starts] += _NEXT
            key = key[starts]
            chunk = xxhash.xxh3_64_intdigest(names.tobytes())
            carrier = chunk % (deal.shards // deal.rounds) * deal.rounds + in_round
            chunk -= chunk >> 63 << 64
            found, at = np.unique(key >> np.uint64(48), return_index=True)
            at, places = [*at, len(key)], [*starts, len(text)]
            sent = [
                (int(s) * deal.rounds + in_round, None, _packed(key[x:y]), text[places[x] : places[y]].tobytes())
                for s, x, y in zip(found, at, at[1:])
            ]
            sent.append((carrier, names.tobytes(), b"", b""))
            shards, *parts = zip(*sent)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shards, pa.int32()),
                    pa.array([chunk] * len(sent), pa.int64()),
                    *(pa.array(p, pa.binary()) for p in parts),
                ],
                ["shard", "chunk", "names", "keys", "texts"],
            )

    return source.mapInArrow(rows, _ASKED)


_TOLD = "chunk long, names binary, texts binary, sums binary"


def _teller(words, p1: Callable, deal: _Deal, d2: list[float], d3: list[float]) -> Callable:
    """Makes the values of the runs of a shard and adds them up for the texts that asked."""

    def model(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        word, befores, total, back, _ = words.value
        triple, (a, b, c), n = _distinct(*_read_runs(table, 3))
        (hot_b, hot_c), hot_n = _read_runs(table, 2)
        # Pairs: those of a frequent word have been counted before.
        own = np.flatnonzero(deal.ways_of(b) == 0)
        pair, at, before = np.unique(_key(_PAIR, b[own], c[own]), return_index=True, return_counts=True)
        pair, at_hot = np.concatenate([pair, _key(_PAIR, hot_b, hot_c)]), own[at]
        first, last = np.concatenate([b[at_hot], hot_b]), np.concatenate([c[at_hot], hot_c])
        before = np.concatenate([before, hot_n])
        order = np.argsort(pair)
        pair, first, last, before = pair[order], first[order], last[order], before[order]
        # Each of these words is in the table.
        first, last = np.searchsorted(word, first), np.searchsorted(word, last)
        without = back[first] * p1(befores[last])
        p2 = _less(before, d2) / total[first] + without
        # Contexts of two words.
        context, of = np.unique(_key(_PAIR_BACK, a, b), return_inverse=True)
        sums, by = _sums(of, n, len(context))
        left = sum(d * k for d, k in zip(d3, by)) / np.maximum(sums, 1)
        less = left[of] * p2[np.searchsorted(pair, _key(_PAIR, b, c))] if len(n) else np.zeros(0)
        ratio = 1 + _less(n, d3) / np.maximum(sums, 1)[of] / less
        keys = _short(np.concatenate([pair, context, triple]))
        found = np.concatenate([np.log(p2 / without), np.log(left), np.log(ratio)])
        order = np.argsort(keys)
        return keys[order], found[order]

    def rows(shard: pa.Table, asked: pa.Table) -> pa.Table:
        made = model(shard) if asked.num_rows else None
        out = []
        for row in asked.to_pylist():
            value, _ = Lookup.find(made, _unpacked(row["keys"]))
            text = np.frombuffer(row["texts"], np.uint16)
            of_key = np.cumsum(text >= _NEXT) - 1
            names, of = np.unique(text % _NEXT, return_inverse=True)
            sums = np.bincount(of, value[of_key], len(names))
            out.append((row["chunk"], row["names"], names.tobytes(), sums.astype(np.float32).tobytes()))
        chunk, *parts = zip(*out) if out else [()] * 4
        return pa.Table.from_arrays(
            [pa.array(chunk, pa.int64()), *(pa.array(p, pa.binary()) for p in parts)], ["chunk", "names", "texts", "sums"]
        )

    return rows


def _added(table: pa.Table) -> pa.Table:
    """The sums of a chunk by text."""
    rows = table.to_pylist()
    names = np.frombuffer(next(r["names"] for r in rows if r["names"] is not None), np.int64)
    sums = np.zeros(len(names))
    for row in rows:
        sums[np.frombuffer(row["texts"], np.uint16)] += np.frombuffer(row["sums"], np.float32)
    return pa.Table.from_arrays([pa.array(names), pa.array(sums)], ["_key", "s"])


def judge_perplexity(
    docs: DataFrame,
    trusted: DataFrame,
    toxic: DataFrame | None = None,
    quantile: float = 0.995,
    alarm_quantile: float = 0.99,
    most_broadcast: int = 64 << 20,
    most_bits: int = 1 << 28,
    rounds: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """The perplexity of each whole text under a model of trusted ones, a row per row of ``docs``.

    Returns ``doc_id``, ``lang``, ``n_tokens`` (words and the end), ``perplexity``, ``threshold``,
    ``alarm``, ``alarm_threshold`` and ``kept``. ``trusted`` has the ids (``doc_id``) of texts known to
    be good, ``toxic`` those of texts to be kept out. A model is fit on each, on all documents of one
    half of the ids; the other half is for the limits. The alarm of a text is the largest
    log-ratio of the probabilities that the two models give to one of its words, so that a short bad
    passage shows in a long text; without ``toxic``, or a word of it, it is null. The limits of a
    language are the ``quantile`` and the ``alarm_quantile`` of its trusted documents that the model
    has not seen, and a text is kept if neither is exceeded; a language without such documents uses
    all of its own.

    Every document is scored. The model is a table of n-grams whose values add up. If it surely takes
    ``most_broadcast`` bytes or less, it goes to the documents; else it is made and asked shard by
    shard in ``rounds`` (see ``_scored_in_shards``), with the same sums. A null or empty
    text is the end alone, a long one is read whole; rows of one id or text are scored alike or by
    their own text. A null language is one of its own. Other columns are not read.
    """

    def ids_of(rows: DataFrame) -> DataFrame:
        return rows.select(F.col("doc_id").alias("_id")).where("_id IS NOT NULL").distinct()

    good = ids_of(trusted)
    # Ids of a hash that is not even are kept from the models.
    training, bad = training_documents(docs, good, id_col, text_col), None
    id_type = docs.schema[id_col].dataType.simpleString()
    source = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(lang_col).cast("string").alias("lang"),
        F.xxhash64(id_col, text_col).alias("_key"),
        F.col(text_col).cast("binary").alias("_text"),
    )
    schema = f"doc_id {id_type}, lang string, n_tokens long, perplexity double, alarm double"
    with _shuffles_freed(docs.sparkSession):
        if toxic is not None:
            bad = word_model(training_documents(docs, ids_of(toxic), id_col, text_col), "_text")
        deal = _deal(training, rounds)
        # A place makes five keys at most, and a key and a value take 12 bytes.
        if 60 * deal.places + 12 * (bad.rows if bad else 0) <= most_broadcast:
            model = ngram_model(training, "_text")
            scored = _scored_in_scan(source, model_tables(model, bad), model.unseen, schema)
        else:
            scored = _scored_in_shards(source, training, bad, deal, most_bits)
        scored = written(scored, "perplexities")
    fresh = good.where(F.xxhash64("_id") % 2 != 0)
    unseen_good = scored.join(fresh, F.col("doc_id") == F.col("_id"), "semi")
    shares = {"perplexity": quantile, "alarm": alarm_quantile}
    limits = [F.percentile_approx(c, share, 10_000) for c, share in shares.items()]
    of_good = unseen_good.groupBy(F.col("lang").alias("_l")).agg(limits[0].alias("_q"), limits[1].alias("_a"))
    of_all = scored.groupBy(F.col("lang").alias("_lang")).agg(limits[0].alias("_all_q"), limits[1].alias("_all_a"))
    joined = of_all.join(of_good, F.col("_lang").eqNullSafe(F.col("_l")), "left").select(
        "_lang",
        F.coalesce("_q", "_all_q").alias("threshold"),
        F.coalesce("_a", "_all_a").alias("alarm_threshold"),
    )
    # One row a language: the scores of a common one do not meet in a task for it.
    joined = broadcast_if_small(written(joined, "thresholds"))
    quiet = F.coalesce(F.col("alarm") <= F.col("alarm_threshold"), F.lit(True))
    return scored.join(joined, F.col("lang").eqNullSafe(F.col("_lang"))).select(
        "doc_id",
        "lang",
        "n_tokens",
        "perplexity",
        "threshold",
        "alarm",
        "alarm_threshold",
        ((F.col("perplexity") <= F.col("threshold")) & quiet).alias("kept"),
    )
