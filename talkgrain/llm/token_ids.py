"""Token ids of documents in a binary format, in the order of their ids."""

from __future__ import annotations

import json
import os
import string
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from talkgrain.llm.common import text_key
from talkgrain.llm.simple8b import decode, encode
from talkgrain.sources.scans import broadcast_if_small

# A segment is a row of the file: it ends with the document that brings its text to this length.
SEGMENT_BYTES = 8 << 20
# What a Python worker remembers of words it has encoded, before it starts anew.
MOST_WORDS = 1_200_000

_PARTS = (
    ("part", "int"),
    ("segment", "int"),
    ("first", "long"),
    ("n_ids", "long"),
    ("counts", "binary"),
    ("words", "binary"),
    ("offsets", "binary"),
)


def _schema(id_type: str) -> str:
    return ", ".join(f"{n} {t}" for n, t in (*_PARTS, ("doc_ids", f"array<{id_type}>")))


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` that begin at ``starts``, one after the other."""
    before = np.cumsum(sizes) - sizes
    return flat[np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)]


class WordEncoder:
    """Encodes texts by their distinct words, remembering words.

    A tokenizer that lower-cases, and to which white space is no more than a word boundary, gives
    the same ids for a text and for its words one after the other. Texts are cut, and their words
    numbered, by Arrow kernels; only words not met before go to the library, and ids are then made
    for all words of a segment by array look-ups. Letters and the marks behind them are remembered
    apart, which such a tokenizer cuts anyway.
    """

    def __init__(self, model: str, special_as_text: bool, split_words: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(model)
        self.tokenizer.encode_special_tokens = special_as_text
        self.split_words = split_words
        # Which ids end a word, where the vocabulary marks them.
        self.last: np.ndarray | None = None
        suffix = json.loads(model)["model"].get("end_of_word_suffix")
        if suffix:
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
            self.last = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
            self.last[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        if split_words:
            self._forget()

    def _forget(self) -> None:
        self.known = {"": 0}
        self.flat, self.starts, self.sizes = (np.zeros(n, t) for n, t in ((0, "u4"), (1, int), (1, int)))

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row and the number of each."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        every = found[0] if len(found) == 1 else list(chain.from_iterable(found))
        return np.array(every, "u4"), sizes

    def _learn(self, words: list[str]) -> None:
        parts = [self.flat]
        sizes = [self.sizes]

        def add(chunk: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
            self.known.update(zip(chunk, range(len(self.known), len(self.known) + len(chunk))))
            parts.append(ids)
            sizes.append(counts)

        letters = [w for w in words if w.isalpha()] if self.last is not None else []
        others = [w for w in words if not w.isalpha()] if self.last is not None else words
        for at in range(0, len(letters), 5_000):
            chunk = letters[at : at + 5_000]
            # Letters are one word to the tokenizer or more, so as many ends as words is one each.
            ids, _ = self._encoded([" ".join(chunk)])
            ends = np.flatnonzero(self.last[ids])
            if len(ends) == len(chunk):
                add(chunk, ids, np.diff(ends, prepend=-1))
            else:
                others += chunk
        for at in range(0, len(others), 20_000):
            chunk = others[at : at + 20_000]
            add(chunk, *self._encoded(chunk))
        self.flat, self.sizes = np.concatenate(parts), np.concatenate(sizes)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def _codes(self, words: pa.Array) -> np.ndarray:
        coded = pc.dictionary_encode(words)
        names = coded.dictionary.to_pylist()
        get = self.known.get
        of = np.array([get(w, -1) for w in names], np.int64)
        missing = np.flatnonzero(of < 0)
        if len(missing):
            words = [names[i] for i in missing.tolist()]
            self._learn(words)
            of[missing] = [get(w) for w in words]
        return of[coded.indices.to_numpy()]

    def __call__(self, texts: list[bytes], end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, each text's followed by ``end``, and the number of each."""
        if not self.split_words:
            ids, sizes = self._encoded([t.decode() for t in texts])
            return np.insert(ids, np.cumsum(sizes), end), sizes + 1
        if len(self.known) > MOST_WORDS:
            self._forget()
        whole = pa.array(texts, pa.large_binary()).cast(pa.large_string())
        # A to Z are lower-cased at once; where a special token could be spelt, by the tokenizer.
        lower = pc.if_else(pc.match_substring(whole, "<|"), whole, pc.ascii_lower(whole))
        cut = pc.ascii_split_whitespace(lower)
        coded = pc.dictionary_encode(pc.list_flatten(cut))
        words = coded.dictionary
        body = pc.utf8_rtrim(words, characters=string.punctuation)
        # Letters beyond ASCII may be composed or lower-cased with what is beside them.
        plain = pc.utf8_is_alpha(body)
        codes = np.zeros((len(words) + 1, 2), np.int64)
        codes[:-1, 0] = self._codes(pc.if_else(plain, body, words))
        ended = pc.and_(plain, pc.not_equal(body, words))
        pairs = zip(*(a.filter(ended).to_pylist() for a in (words, body)))
        marks = pa.array([word[len(b) :] for word, b in pairs], pa.large_string())
        codes[:-1, 1][ended.to_numpy(zero_copy_only=False)] = self._codes(marks)
        sizes = self.sizes[codes]
        table = _gather(self.flat, self.starts[codes.ravel()], sizes.ravel())
        # The last word of the table stands for the end of a text.
        sizes = sizes.sum(axis=1)
        sizes[-1] = 1
        table = np.append(table, np.uint32(end))
        n_words = pc.list_value_length(cut).to_numpy()
        places = np.insert(coded.indices.to_numpy(), np.cumsum(n_words), len(words))
        of_place = sizes[places]
        ids = _gather(table, (np.cumsum(sizes) - sizes)[places], of_place)
        ends = np.cumsum(of_place)[np.cumsum(n_words + 1) - 1]
        return ids, np.diff(ends, prepend=0)


def segments(
    batches: Iterator[pa.RecordBatch], encoder: WordEncoder, end: int, names: list[str]
) -> Iterator[tuple[list[list], np.ndarray, np.ndarray]]:
    """Documents in order, by segments: the columns ``names``, the token ids, the count of each.

    A segment ends with the document that brings its ``_text`` to a bounded length.
    """
    rows: list[tuple] = []
    texts: list[bytes] = []
    size = 0
    for batch in batches:
        columns = zip(*(batch.column(c).to_pylist() for c in names))
        for row, text in zip(columns, batch.column("_text").to_pylist()):
            rows.append(row)
            texts.append(text or b"")
            size += len(texts[-1])
            if size >= SEGMENT_BYTES or len(rows) >= 10_000:
                yield list(map(list, zip(*rows))), *encoder(texts, end)
                rows, texts, size = [], [], 0
    if rows:
        yield list(map(list, zip(*rows))), *encoder(texts, end)


def write_token_ids(
    docs: DataFrame,
    tokenizer: str,
    folder: str,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    special_as_text: bool = False,
    split_words: bool = True,
) -> None:
    """Encode every text with a tokenizer file and write the ids to ``folder``, by ascending id.

    Each document is the ids of its whole text (a null one is empty) and ``end_id``. Documents are
    dealt out by ranges of their id and sorted inside them; rows of one id are ordered by a hash of
    the text and then as they were read, and a null id comes first. A file is a range (``part``); its rows are segments of about 8 MB of
    text with the ids in Simple-8b words (``words``, ``offsets`` of the blocks), the number of ids
    by document (``counts``) and of ids before the segment in its part (``first``). ``split_words``
    is for tokenizers to which white space is no more than a word boundary; each word is then
    encoded once a worker, up to a bounded memory. The tokenizer is read by the driver and sent
    along; executors need no copy. Other columns are not read.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        model = spark.sparkContext.broadcast(file.read())
    # Python workers keep a broadcast value from task to task: here, what they remember.
    memory = spark.sparkContext.broadcast({})
    id_type = docs.schema[id_col].dataType
    arrow_id = to_arrow_type(id_type)

    def rows(batches):
        held = memory.value
        if "encoder" not in held:
            held["encoder"] = WordEncoder(model.value, special_as_text, split_words)
        part, first = TaskContext.get().partitionId(), 0
        found = segments(batches, held["encoder"], end_id, ["doc_id"])
        for segment, ((ids,), tokens, counts) in enumerate(found):
            words, offsets = encode(tokens)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([segment], pa.int32()),
                    pa.array([first], pa.int64()),
                    pa.array([len(tokens)], pa.int64()),
                    pa.array([counts.astype("<u4").tobytes()], pa.binary()),
                    pa.array([words.astype("<u8").tobytes()], pa.binary()),
                    pa.array([offsets.astype("<u4").tobytes()], pa.binary()),
                    pa.array([ids], pa.list_(arrow_id)),
                ],
                [*(name for name, _ in _PARTS), "doc_ids"],
            )
            first += len(tokens)

    source = docs.select(
        F.col(id_col).alias("doc_id"),
        text_key(F.col(text_col)).alias("_key"),
        F.monotonically_increasing_id().alias("_row"),
        F.col(text_col).cast("binary").alias("_text"),
    )
    # An id of very many rows is spread over several ranges by what follows it.
    order = ["doc_id", "_key", "_row"]
    ordered = source.repartitionByRange(*order).sortWithinPartitions(*order)
    coded = ordered.mapInArrow(rows, _schema(id_type.simpleString()))
    coded.write.option("compression", "zstd").parquet(folder)


def read_token_ids(spark: SparkSession, folder: str, id_type: str = "bigint") -> DataFrame:
    """The documents of a folder of ``write_token_ids``: ``doc_id``, ``start`` (ids before it in all
    of the folder), ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit integers)."""
    return _documents(spark, folder, id_type, "ids", "binary", lambda data: data)


def token_digest(spark: SparkSession, folder: str, id_type: str = "bigint") -> DataFrame:
    """As ``read_token_ids``, with ``ids_crc32`` in place of the ids."""
    return _documents(spark, folder, id_type, "ids_crc32", "long", zlib.crc32)


def _documents(spark, folder, id_type, name, kind, digest) -> DataFrame:
    table = spark.read.schema(_schema(id_type)).parquet(folder)
    # One row for each written file, so its size is bounded by a setting, not by the data.
    sizes = table.groupBy("part").agg(F.max(F.col("first") + F.col("n_ids")).alias("n"))
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")
    bases = sizes.select(F.col("part").alias("_p"), before.alias("base"))

    def rows(batches):
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in (*(n for n, _ in _PARTS), "doc_ids"))
            for part, _, first, n, counts, words, offsets, ids in zip(*columns):
                tokens = decode(np.frombuffer(words, "<u8"), np.frombuffer(offsets, "<u4"), n)
                data = tokens.astype("<u4").tobytes()
                counts = np.frombuffer(counts, "<u4").astype(np.int64)
                ends = np.cumsum(counts)
                cuts = zip((4 * (ends - counts)).tolist(), (4 * ends).tolist())
                found = [digest(data[start:end]) for start, end in cuts]
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array(np.full(len(ids), part, np.int32)),
                        "doc_id": pa.array(ids, batch.schema.field("doc_ids").type.value_type),
                        "start": pa.array(first + ends - counts),
                        "n_tokens": pa.array(counts),
                        name: pa.array(found, pa.binary() if kind == "binary" else pa.int64()),
                    }
                )

    decoded = table.mapInArrow(
        rows, f"part int, doc_id {id_type}, start long, n_tokens long, {name} {kind}"
    )
    placed = decoded.join(broadcast_if_small(bases), F.col("part") == F.col("_p"))
    return placed.select(
        "doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", name
    )
