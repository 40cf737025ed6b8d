"""Language identification by n-gram filters that answer for all languages at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkgrain.llm.common import mixed

UNKNOWN = "und"
# Texts are worked on together up to this many characters.
_TOGETHER = 1 << 20

_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.array([chr(i).isalpha() for i in range(0x110000)])
    return _letters


def grams_of(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all runs of ``n`` characters of lower-cased texts and the text of each.

    Whatever is not a letter counts as one space, however long; a text begins and ends with one.
    """
    joined = "".join(f" {t} " for t in texts).lower()
    chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    # Lower-casing can change a length, so the texts are measured as they come out of it.
    sizes = [len(t) + 2 if t.isascii() else len(f" {t} ".lower()) for t in texts]
    if sum(sizes) != len(chars):
        lowered = [f" {t} ".lower() for t in texts]
        chars = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = list(map(len, lowered))
    of = np.repeat(np.arange(len(texts)), sizes)
    chars = np.where(_is_letter()[chars], chars, 32)
    keep = np.ones(len(chars), bool)
    keep[1:] = (chars[1:] != 32) | (chars[:-1] != 32) | (of[1:] != of[:-1])
    chars, of = chars[keep].astype(np.uint64), of[keep]
    if len(chars) < n:
        return chars[:0], of[:0]
    m = len(chars) - n + 1
    code = np.zeros(m, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            code = code * np.uint64(0x100000001B3) + chars[i : i + m]
    inside = of[:m] == of[n - 1 :]
    return mixed(code[inside]), of[:m][inside]


def _chunks(*columns: list) -> Iterator[list[tuple]]:
    chunk, size = [], 0
    for row in zip(*columns):
        chunk.append(row)
        size += len(row[-1])
        if size >= _TOGETHER:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


class LanguageFilter:
    """A Bloom filter cut across: each place holds one bit for every language.

    The places of an n-gram, and-ed, are the languages that may contain it. ``slices`` has the
    bits of 64 languages in each column.
    """

    def __init__(self, languages: list[str], hashes: list[np.ndarray], bits: int, probes: int):
        self.languages, self.bits, self.probes = languages, bits, probes
        self.slices = np.zeros((-(-max(1, len(languages)) // 64), bits), np.uint64)
        for i, found in enumerate(hashes):
            for place in self._places(found):
                self.slices[i // 64][place] |= np.uint64(1 << i % 64)
        # How often a language answers for an n-gram that it does not have.
        filled = [self._bit(self.slices, i).mean() for i in range(len(languages))]
        self.false = np.array(filled) ** probes

    @classmethod
    def of(cls, parts: tuple) -> LanguageFilter:
        """The filter of ``parts``."""
        model = cls.__new__(cls)
        model.languages, model.bits, model.probes, model.slices, model.false = parts
        return model

    def parts(self) -> tuple:
        """Plain values, which executors can read without this package."""
        return self.languages, self.bits, self.probes, self.slices, self.false

    def _places(self, hashes: np.ndarray) -> Iterator[np.ndarray]:
        last = np.uint64(self.bits - 1)
        for i in range(self.probes):
            yield ((hashes >> np.uint64(20 * i)) & last).astype(np.int64)

    @staticmethod
    def _bit(slices: np.ndarray, language: int) -> np.ndarray:
        return slices[language // 64] >> np.uint64(language % 64) & np.uint64(1)

    def masks(self, hashes: np.ndarray) -> np.ndarray:
        places = list(self._places(hashes))
        found = self.slices[:, places[0]]
        for place in places[1:]:
            found = found & self.slices[:, place]
        return found

    def counts(self, hashes: np.ndarray, of: np.ndarray, n_texts: int) -> np.ndarray:
        """By text and language, the number of n-grams that are the language's, less those that a
        filter answers for by chance."""
        masks = self.masks(hashes)
        total = np.bincount(of, minlength=n_texts)
        out = np.zeros((n_texts, len(self.languages)))
        for i, false in enumerate(self.false):
            held = self._bit(masks, i).astype(np.float64)
            counted = np.bincount(of, held, n_texts)
            out[:, i] = np.maximum(counted - total * false, 0) / (1 - false)
        return out


def train_languages(
    docs: DataFrame,
    n: int = 3,
    min_share: float = 1e-5,
    min_of_most: float = 0.2,
    bits: int = 1 << 19,
    probes: int = 2,
    lang_col: str = "lang",
    text_col: str = "text",
) -> LanguageFilter | None:
    """Learn the filter from all rows of ``docs`` with a language and a text.

    N-grams are counted by language in a grouped sum, folded in the scan tasks. A language keeps
    those that are ``min_share`` of its own, which are 1 / min_share at most, and ``min_of_most``
    of their share in the language where they are most common: that many hashes reach the driver.
    Languages are ordered by their number of n-grams, then by name. No rows: no filter.
    """

    def rows(batches):
        for batch in batches:
            langs, texts = (batch.column(c).to_pylist() for c in ("_lang", "_text"))
            for chunk in _chunks(langs, texts):
                names = sorted({lang for lang, _ in chunk})
                hashes, of = grams_of([t for _, t in chunk], n)
                which = np.array([names.index(lang) for lang, _ in chunk])[of]
                for i, name in enumerate(names):
                    found, counts = np.unique(hashes[which == i], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([name] * len(found), pa.string()),
                            pa.array(found.view(np.int64)),
                            pa.array(counts.astype(np.int64)),
                        ],
                        ["lang", "gram", "n"],
                    )

    labelled = docs.select(F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text"))
    labelled = labelled.where("_lang IS NOT NULL AND _text IS NOT NULL")
    counted = labelled.mapInArrow(rows, "lang string, gram long, n long")
    counts = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # The sums of a language first fold by part of its n-grams, then meet as a few rows.
    shares = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    totals = {r["lang"]: r["total"] for r in shares.collect()}
    if not totals:
        return None
    total = F.create_map(*(F.lit(x) for pair in totals.items() for x in pair))
    kept = (
        counts.withColumn("share", F.col("n") / total[F.col("lang")])
        .where(F.col("share") >= min_share)
        .withColumn("most", F.max("share").over(Window.partitionBy("gram")))
        .where(F.col("share") >= min_of_most * F.col("most"))
        .select("lang", "gram")
        .toArrow()
    )
    languages = sorted(totals, key=lambda lang: (-totals[lang], lang))
    of, gram = np.array(kept["lang"].to_pylist()), kept["gram"].to_numpy().view(np.uint64)
    return LanguageFilter(languages, [gram[of == lang] for lang in languages], bits, probes)


def predict_languages(
    docs: DataFrame,
    model: LanguageFilter | None,
    n: int = 3,
    text_col: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` added (columns of these names are replaced).

    ``keep`` names the columns of ``docs`` to carry along, all if not given.

    The language with the most n-grams after correction is predicted from the whole text; ties go
    to the language with more n-grams in training. The score is its share of the corrected counts
    of all languages. A null text, one without letters, or no model: ``und``, 0.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model and model.parts())
    others = [c for c in keep or docs.columns if c not in ("lang_pred", "score")]

    def rows(batches):
        letters = _is_letter()
        model = shared.value and LanguageFilter.of(shared.value)
        for batch in batches:
            texts = batch.column("_predict_from").to_pylist()
            names, scores = [], []
            for chunk in _chunks([t or "" for t in texts]):
                part = [t for (t,) in chunk]
                hashes, of = grams_of(part, n)
                known = model is not None and len(model.languages)
                counts = model.counts(hashes, of, len(part)) if known else np.zeros((len(part), 1))
                best = counts.argmax(axis=1)
                total = counts.sum(axis=1)
                score = counts.max(axis=1) / np.where(total > 0, total, 1)
                for text, b, s in zip(part, best.tolist(), score.tolist()):
                    if known and any(map(str.isalpha, text)):
                        names.append(model.languages[b])
                        scores.append(s)
                    else:
                        names.append(UNKNOWN)
                        scores.append(0.0)
            columns = batch.columns[: len(others)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                [*others, "lang_pred", "score"],
            )

    source = docs.select(*others, F.col(text_col).alias("_predict_from"))
    schema = docs.select(*others).schema.add("lang_pred", "string").add("score", "double")
    return source.mapInArrow(rows, schema)


def identify_languages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    folds: int = 3,
    held_out: int = 1,
    n: int = 3,
) -> DataFrame:
    """Train on all folds but one, and predict every row of ``docs``.

    Returns ``doc_id``, ``held_out``, ``lang_pred``, ``score``. The fold of a row is the CRC-32 of
    its id as text, modulo ``folds``; rows without an id are never held out. Only the text of a row
    goes into its prediction, a long one whole. Null languages teach nothing, and rows that share an
    id or a text are predicted each. Other columns are not read.
    """
    fold = F.crc32(F.col(id_col).cast("string").cast("binary")) % folds
    out = F.coalesce(fold == held_out, F.lit(False))
    model = train_languages(docs.where(~out), n, lang_col=lang_col, text_col=text_col)
    source = docs.select(
        F.col(id_col).alias("doc_id"), out.alias("held_out"), F.col(text_col).alias("text")
    )
    return predict_languages(source, model, n, keep=["doc_id", "held_out"])
