"""Quality rules by weak supervision: rules vote, expectation-maximisation weighs them.

Built-in functions only; texts are judged in the scan, without a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgrain.llm.common import let, split_words, written

WINDOW = 8

# Words that prose in English, French, German or Spanish can hardly do without.
COMMON = (
    "the of and to in is that for with was on are by this from "
    "le la les de des et un une que en du est dans pour par "
    "der die das und den mit ist von ein zu für nicht "
    "el los las y del se por con una para al"
).split()


def _repeated(words: Column) -> Column:
    """How many words stand in a window of 8 words that occurs twice or more in the text."""

    def places(hashes: Column) -> Column:
        tagged = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return let(F.sort_array(tagged), twice)

    def twice(s: Column) -> Column:
        def seen(p: Column, k: Column) -> Column:
            near = [F.get(s, k + step)["h"] == p["h"] for step in (-1, 1)]
            return F.coalesce(near[0], F.lit(False)) | F.coalesce(near[1], F.lit(False))

        return covered(F.sort_array(F.transform(F.filter(s, seen), lambda p: p["i"])))

    def covered(starts: Column) -> Column:
        def add(done: Column, start: Column) -> Column:
            end = start + WINDOW
            return F.struct(
                (done["n"] + end - F.greatest(start, done["to"])).alias("n"), end.alias("to")
            )

        return F.aggregate(starts, F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")), add)["n"]

    def of(w: Column) -> Column:
        n = F.array_size(w)
        starts = F.sequence(F.lit(1), F.greatest(n - (WINDOW - 1), F.lit(1)))
        windows = F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, WINDOW)))
        any_twice = let(
            windows,
            lambda h: F.when(F.array_size(F.array_distinct(h)) < F.array_size(h), places(h)),
        )
        return F.when(n > WINDOW, F.coalesce(any_twice, F.lit(0))).otherwise(F.lit(0))

    return let(F.transform(words, lambda w: F.xxhash64(w)), of).cast("long")


def text_features(text: Column) -> Column:
    """A struct of the counts that the rules look at."""
    text = F.coalesce(text, F.lit(""))

    def features(w: Column) -> Column:
        lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
        line_counts = let(
            lines,
            lambda x: F.struct(
                F.array_size(x).cast("long").alias("n"),
                (F.array_size(x) - F.array_size(F.array_distinct(x))).cast("long").alias("dup"),
            ),
        )
        return F.struct(
            F.array_size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
            line_counts.alias("lines"),
            _repeated(w).alias("n_repeat_words"),
            F.array_size(F.array_distinct(w)).cast("long").alias("n_distinct"),
            F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
            F.regexp_count(text, F.lit("[!?]{2}")).cast("long").alias("n_shouts"),
            F.length(F.regexp_replace(text, r"[\p{L}\p{N}\s]+", "")).cast("long").alias("n_marks"),
            F.array_size(F.array_intersect(w, F.array(*map(F.lit, COMMON))))
            .cast("long")
            .alias("n_common"),
        )

    return let(split_words(text), features)


@dataclass(frozen=True)
class QualityRule:
    """Votes 1 (good) where ``good`` holds, -1 where ``bad`` does, else 0 (abstains)."""

    name: str
    bad: Callable[[Column], Column]
    good: Callable[[Column], Column]


def _per_word(x: Column, name: str) -> Column:
    return x[name] / F.greatest(x["n_words"], F.lit(1))


RULES = (
    QualityRule("length", lambda x: x["n_words"] < 20, lambda x: x["n_words"] >= 50),
    QualityRule(
        "word_length",
        lambda x: ~_per_word(x, "word_chars").between(2.5, 15),
        lambda x: _per_word(x, "word_chars").between(3.5, 10),
    ),
    QualityRule(
        "symbols",
        lambda x: _per_word(x, "n_symbols") > 0.1,
        lambda x: _per_word(x, "n_symbols") < 0.02,
    ),
    QualityRule(
        "marks",
        lambda x: _per_word(x, "n_marks") > 0.5,
        lambda x: _per_word(x, "n_marks") < 0.35,
    ),
    QualityRule(
        "common_words",
        lambda x: (x["n_words"] >= 50) & (x["n_common"] == 0),
        lambda x: x["n_common"] >= 3,
    ),
    QualityRule(
        "lines",
        lambda x: x["lines"]["dup"] > 0.5 * x["lines"]["n"],
        lambda x: (x["lines"]["n"] >= 3) & (x["lines"]["dup"] == 0),
    ),
    QualityRule(
        "repeats",
        lambda x: _per_word(x, "n_repeat_words") > 0.5,
        lambda x: _per_word(x, "n_repeat_words") < 0.02,
    ),
    QualityRule(
        "capitals",
        lambda x: x["n_upper"] > 0.3 * x["word_chars"],
        lambda x: x["n_upper"] < 0.1 * x["word_chars"],
    ),
    QualityRule(
        "variety",
        lambda x: (x["n_words"] >= 50) & (_per_word(x, "n_distinct") < 0.1),
        lambda x: _per_word(x, "n_distinct") > 0.3,
    ),
    QualityRule(
        "shouts",
        lambda x: _per_word(x, "n_shouts") > 0.1,
        lambda x: _per_word(x, "n_shouts") < 0.01,
    ),
)


def _votes(x: Column, rules: tuple[QualityRule, ...]) -> Column:
    """The votes as an array."""
    return F.array(*(F.when(r.bad(x), -1).when(r.good(x), 1).otherwise(0) for r in rules))


@dataclass(frozen=True)
class VoteModel:
    """The share of good documents, and how often each rule that does not abstain is right.

    ``on_good`` holds, by rule, how often it votes good on good documents, ``on_bad`` how often it
    votes bad on bad ones. A vote that is as common in either class weighs nothing.
    """

    prior: float
    on_good: tuple[float, ...]
    on_bad: tuple[float, ...]

    def weights(self) -> list[tuple[float, float]]:
        """By rule, what a good and what a bad vote add to the log-odds of being good. The first
        is never negative, the second never positive: a rule may be useless, but not reversed."""
        return [
            (
                max(0.0, math.log(g / (1 - b))),
                min(0.0, math.log((1 - g) / b)),
            )
            for g, b in zip(self.on_good, self.on_bad)
        ]

    def log_odds(self) -> float:
        return math.log(self.prior / (1 - self.prior))

    def posterior(self, votes: Column) -> Column:
        """The probability that a document is good, given its array of votes."""
        total = F.lit(self.log_odds())
        for i, (good, bad) in enumerate(self.weights()):
            total = total + F.when(votes[i] > 0, good).when(votes[i] < 0, bad).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def fit_votes(votes: DataFrame, n_rules: int, rounds: int = 200) -> VoteModel:
    """Expectation-maximisation over the column ``votes``, without labels.

    Given the class of a document, its votes are taken as independent; abstaining says nothing.
    All documents enter by the count of each pattern of votes; there are at most 3 ** n_rules
    patterns, which is what reaches the driver. It starts from rules that seldom call a good
    document bad. Without documents the model is the starting one.
    """
    counted = votes.groupBy("votes").agg(F.count("*").alias("n")).collect()
    patterns = sorted((tuple(row["votes"]), row["n"]) for row in counted)
    model = VoteModel(0.7, (0.995,) * n_rules, (0.2,) * n_rules)
    for _ in range(rounds if patterns else 0):
        base, weights = model.log_odds(), model.weights()
        good = total = 0.0
        # Small counts that keep every rate inside (0, 1).
        on_good = [[0.995, 1.0] for _ in range(n_rules)]
        on_bad = [[0.2, 1.0] for _ in range(n_rules)]
        for vote, n in patterns:
            score = base + sum(w[0] if v > 0 else w[1] for v, w in zip(vote, weights) if v)
            p = 1 / (1 + math.exp(-max(-500.0, min(500.0, score))))
            good, total = good + n * p, total + n
            for i, v in enumerate(vote):
                if v:
                    on_good[i][0] += n * p * (v > 0)
                    on_good[i][1] += n * p
                    on_bad[i][0] += n * (1 - p) * (v < 0)
                    on_bad[i][1] += n * (1 - p)
        rates = [tuple(a / b for a, b in found) for found in (on_good, on_bad)]
        fitted = VoteModel(min(0.99, max(0.01, good / total)), *rates)
        before = (model.prior, *model.on_good, *model.on_bad)
        after = (fitted.prior, *fitted.on_good, *fitted.on_bad)
        moved = max(abs(x - y) for x, y in zip(before, after))
        model = fitted
        if moved < 1e-9:
            break
    return model


def base_failed(x: Column) -> Column:
    """Too short, or more than 30 in 100 words in repeated windows."""
    return (x["n_words"] < 20) | (100 * x["n_repeat_words"] > 30 * x["n_words"])


def judge_quality(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: tuple[QualityRule, ...] = RULES,
    threshold: float = 0.5,
) -> DataFrame:
    """Counts, votes and verdict of each document, a row per row of ``docs``.

    Returns ``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, ``kept``, ``posterior`` and ``votes`` (array of -1, 0, 1).
    ``kept`` is whether the posterior reaches ``threshold`` and the base has not failed. A null or
    empty text has zero words and fails the base; a long text is counted whole. Rows that share an id
    or a text are judged each.
    Other columns are not read.
    """
    found = docs.select(F.col(id_col).alias("doc_id"), text_features(F.col(text_col)).alias("x"))
    table = written(found, "quality-counts").withColumn("votes", _votes(F.col("x"), rules))
    model = fit_votes(table, len(rules))
    return _verdict(table, model, threshold).select(
        "doc_id",
        "x.n_words",
        "x.word_chars",
        "x.n_symbols",
        F.col("x.lines.dup").alias("n_dup_lines"),
        "x.n_repeat_words",
        "base_failed",
        "kept",
        "posterior",
        "votes",
    )


def _verdict(table: DataFrame, model: VoteModel, threshold: float) -> DataFrame:
    judged = table.withColumn("posterior", model.posterior(F.col("votes")))
    return judged.withColumn("base_failed", base_failed(F.col("x"))).withColumn(
        "kept", ~F.col("base_failed") & (F.col("posterior") >= threshold)
    )


def keep_good(
    docs: DataFrame,
    text_col: str = "text",
    rules: tuple[QualityRule, ...] = RULES,
    threshold: float = 0.5,
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``judge_quality`` would keep.

    One scan writes each row with its counts; votes and verdicts are then made from the written table,
    so no text is cut into words twice. A null or empty text fails the base and goes, a long text is
    read whole; equal rows stay or go together.
    """
    names = docs.columns
    found = docs.select(F.struct("*").alias("row"), text_features(F.col(text_col)).alias("x"))
    table = written(found, "quality-counts").withColumn("votes", _votes(F.col("x"), rules))
    kept = _verdict(table, fit_votes(table, len(rules)), threshold).where("kept")
    return kept.select(*(F.col("row")[name].alias(name) for name in names))
