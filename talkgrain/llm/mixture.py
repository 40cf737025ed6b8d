"""Packing of documents into windows that all hold their sources in target proportions."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from talkgrain.llm.common import pieces, written
from talkgrain.llm.token_ids import WordEncoder, segments
from talkgrain.sources.scans import broadcast_if_small
from talkgrain.sources.shared import shared_folder

# Windows whose counts by source are worked out together.
_TOGETHER = 2_048


class Rounds:
    """Deficit round-robin over queues of tokens, with any round's state known from its number.

    A round fills one window. Each queue's deficit grows by its share of the window; it is served
    the whole units of ``grain`` tokens that its deficit holds, and the rest is carried on. Shares
    are the weights of the queues that are not empty, so between two queues running empty the
    tokens that are due to a queue grow in a straight line with all tokens. What it has been
    served is that number in units, rounded, and so is within two units of what is due in every
    window: any task can fill any window without going through those before it. What a queue has
    beyond its whole units comes after all windows of units.
    """

    def __init__(self, totals: list[int], weights: list[float], window: int, grain: int):
        if window % grain:
            raise ValueError("the window must hold whole units")
        self.window, self.grain, self.units = window, grain, window // grain
        self.tokens = np.array(totals, np.int64)
        self.whole = self.tokens // grain
        self.all = int(self.whole.sum())
        rests = self.tokens - self.whole * grain
        self.rest_at = self.all * grain + np.cumsum(rests) - rests
        due, done = np.zeros(len(totals)), self.whole == 0
        line, served = [0.0], [due]
        weights = np.array(weights, float)
        while not done.all():
            share = np.where(done, 0.0, weights)
            if not share.any():
                # Only queues without a weight are left: by their size.
                share = np.where(done, 0.0, self.whole)
            running = share > 0
            left = np.where(running, (self.whole - due) / np.where(running, share, 1), np.inf)
            step = left.min()
            empty = running & (left <= step * (1 + 1e-12))
            due = np.where(empty, self.whole, np.minimum(due + share * step, self.whole))
            done = done | empty
            line.append(float(due.sum()))
            served.append(due)
        line[-1] = float(self.all)
        self.line, self.due = np.array(line), np.array(served)

    def _served(self, at: np.ndarray) -> np.ndarray:
        """Units served to each queue when ``at`` units are due to all."""
        at = at.astype(np.float64)
        k = np.clip(np.searchsorted(self.line, at, "right") - 1, 0, len(self.line) - 2)
        low, high = self.due[k], self.due[k + 1]
        gone = (at - self.line[k]) / np.maximum(self.line[k + 1] - self.line[k], 1e-300)
        exact = np.minimum(low + (high - low) * gone[:, None], high)
        return np.floor(exact + 0.5).astype(np.int64)

    def before(self, windows: np.ndarray) -> np.ndarray:
        """By window and queue, the units served before the window begins."""
        wanted = np.minimum(windows * self.units, self.all)
        if not self.all:
            return np.zeros((len(windows), len(self.tokens)), np.int64)
        # Rounding moves the sum of all queues by less than their number: look for the last place
        # where the sum does not exceed what has been served.
        low = np.maximum(wanted - len(self.tokens) - 1, 0)
        high = np.minimum(wanted + len(self.tokens) + 1, self.all)
        while (low < high).any():
            middle = (low + high + 1) // 2
            fits = self._served(middle).sum(axis=1) <= wanted
            low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
        found = self._served(low)
        # The units that come at one place are taken in the order of the queues.
        more = self._served(np.minimum(low + 1, self.all)) - found
        ahead = np.cumsum(more, axis=1) - more
        missing = (wanted - found.sum(axis=1))[:, None]
        return found + np.clip(missing - ahead, 0, more)

    def _windows(self, queue: int, first: int, last: int) -> tuple[int, int]:
        """Windows that surely hold the units ``first`` to ``last`` (exclusive) of a queue."""
        due = self.due[:, queue]
        begin = int(np.flatnonzero(due == 0)[-1])
        end = int(np.flatnonzero(due == self.whole[queue])[0])
        ends = np.clip([first - 3, last + 3], 0, self.whole[queue])
        low, high = np.interp(ends, due[begin : end + 1], self.line[begin : end + 1])
        return max(0, int(low) // self.units - 1), int(high) // self.units + 2

    def places(self, queue: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, ...]:
        """Where stretches of queues lie: the stretch, its first token in the queue, the number of
        tokens and the place in the row of all windows, for each piece in one window."""
        end = start + length
        whole = self.whole[queue] * self.grain
        out: list[tuple[np.ndarray, ...]] = []
        spans = {}
        for q in np.unique(queue):
            of = np.flatnonzero((queue == q) & (start < whole))
            if len(of):
                last = min(int(end[of].max()), int(whole[of[0]]))
                spans[q] = (of, *self._windows(q, int(start[of].min()) // self.grain, -(-last // self.grain)))
        wanted = [np.arange(low, high) for _, low, high in spans.values()]
        windows = np.unique(np.concatenate(wanted)) if wanted else np.zeros(0, np.int64)
        held: dict[int, list[np.ndarray]] = {q: [] for q in spans}
        for at in range(0, len(windows), _TOGETHER):
            part = windows[at : at + _TOGETHER]
            first = self.before(part)
            size = self.before(part + 1) - first
            place = part[:, None] * self.units + np.cumsum(size, axis=1) - size
            for q, (_, low, high) in spans.items():
                mine = (part >= low) & (part < high) & (size[:, q] > 0)
                held[q].append(np.stack([first[mine, q], size[mine, q], place[mine, q]]))
        for q, (of, _, _) in spans.items():
            first, size, place = np.concatenate(held[q], axis=1) * self.grain
            begin, stop = start[of], np.minimum(end[of], whole[of])
            low = np.searchsorted(first + size, begin, "right")
            n = np.searchsorted(first, stop, "left") - low
            row = np.repeat(np.arange(len(of)), n)
            window = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + low[row]
            at = np.maximum(begin[row], first[window])
            until = np.minimum(stop[row], (first + size)[window])
            out.append((of[row], at, until - at, place[window] + at - first[window]))
        for i in np.flatnonzero(end > whole):
            at = max(int(start[i]), int(whole[i]))
            place = int(self.rest_at[queue[i]]) + at - int(whole[i])
            while at < end[i]:
                n = min(int(end[i]) - at, self.window - place % self.window)
                out.append(tuple(np.array([x]) for x in (i, at, n, place)))
                at, place = at + n, place + n
        if not out:
            return tuple(np.zeros(0, np.int64) for _ in range(4))
        found = [np.concatenate(column).astype(np.int64) for column in zip(*out)]
        order = np.lexsort((found[1], found[0]))
        return tuple(column[order] for column in found)


def _encoded(docs: DataFrame, tokenizer: str, end_id: int, id_col, text_col, source_col) -> DataFrame:
    """Each document with its ids and its place in its source's queue, within the task that read it."""
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        model = spark.sparkContext.broadcast(file.read())
    memory = spark.sparkContext.broadcast({})
    id_type = docs.schema[id_col].dataType.simpleString()
    arrow_id = to_arrow_type(docs.schema[id_col].dataType)

    def rows(batches):
        held = memory.value
        if "encoder" not in held:
            held["encoder"] = WordEncoder(model.value, False, True)
        part, queued = TaskContext.get().partitionId(), {}
        names = ["doc_id", "source"]
        for (ids, sources), tokens, counts in segments(batches, held["encoder"], end_id, names):
            data = tokens.astype("<u4").tobytes()
            ends = 4 * np.cumsum(counts)
            before = []
            for source, n in zip(sources, counts.tolist()):
                before.append(queued.get(source, 0))
                queued[source] = before[-1] + n
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, arrow_id),
                    pa.array(sources, pa.string()),
                    pa.array(np.full(len(ids), part, np.int32)),
                    pa.array(before, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([data[e - 4 * n : e] for e, n in zip(ends.tolist(), counts.tolist())], pa.binary()),
                ],
                ["doc_id", "source", "part", "before", "n", "ids"],
            )

    source = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.col(text_col).cast("binary").alias("_text"),
    )
    schema = f"doc_id {id_type}, source string, part int, before long, n long, ids binary"
    coded = source.mapInArrow(rows, schema)
    folder = f"{shared_folder(spark, 'queues')}/{uuid.uuid4().hex}"
    coded.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(coded.schema).parquet(folder)


def pack_mixture(
    docs: DataFrame,
    tokenizer: str,
    targets: Mapping[str, float] | None = None,
    window: int = 2048,
    grain: int = 32,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Pack the token ids of all documents into windows that hold sources in target proportions.

    Returns a row per piece: ``doc_id``, ``start`` (ids of its document before it), ``length``,
    ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset`` (in the window) and ``source``. A
    document is the ids of its whole text and ``end_id``; a null text is that one. Each source is a
    queue of its documents. ``targets`` maps sources to weights; by default the weights are the
    sources' numbers of tokens, so that all windows are alike. A source without a weight is served
    when those with one are empty, and a queue that runs empty leaves its share to the others. Every
    window but the last is full.

    Deficits (see ``Rounds``) are carried in units of ``grain`` tokens, which bounds how small the
    pieces of a source of a small share become. A document's place in its queue is its place in
    the task that encoded it and the sum over earlier tasks; from it the windows follow, so neither
    documents nor ids are shuffled, and a source of a third of all rows is no group of its own. One
    number a source reaches the driver, so sources must be a list that fits there, as ``targets``
    does. A null source is a queue of its own. Null and repeated ids are of no matter: each row is
    packed, and an empty table gives no rows. Long documents are cut like any other. Other columns are not read.
    """
    spark = docs.sparkSession
    coded = _encoded(docs, tokenizer, end_id, id_col, text_col, source_col)
    by_part = written(coded.groupBy("part", "source").agg(F.sum("n").alias("n")), "queue-sizes")
    totals = {row["source"]: row["n"] for row in by_part.groupBy("source").agg(F.sum("n").alias("n")).collect()}
    queues = sorted(totals, key=lambda source: (source is None, source))
    sizes = [totals[q] for q in queues]
    weights = sizes if targets is None else [max(0.0, float(targets.get(q, 0))) for q in queues]
    shared = spark.sparkContext.broadcast((queues, sizes, list(weights)))
    # A row for each task and source.
    earlier = F.sum("n").over(Window.partitionBy("source").orderBy("part")) - F.col("n")
    bases = written(
        by_part.select(F.col("part").alias("_part"), F.col("source").alias("_source"), earlier.alias("base")),
        "queue-places",
    )
    here = (F.col("part") == F.col("_part")) & F.col("source").eqNullSafe(F.col("_source"))
    placed = coded.join(broadcast_if_small(bases), here).select(
        "doc_id", "source", (F.col("base") + F.col("before")).alias("at"), "n", "ids"
    )
    id_type = docs.schema[id_col].dataType.simpleString()

    def rows(batches) -> Iterator[pa.RecordBatch]:
        names, sizes, weights = shared.value
        rounds = Rounds(sizes, weights, window, grain)
        number = {name: i for i, name in enumerate(names)}
        for batch in pieces(batches, 2_000):
            queue = np.array([number[s] for s in batch.column("source").to_pylist()], np.int64)
            start, length = (batch.column(c).to_numpy() for c in ("at", "n"))
            row, at, n, place = rounds.places(queue, start, length)
            inside = at - start[row]
            ids = [memoryview(b) for b in batch.column("ids").to_pylist()]
            crcs = [
                zlib.crc32(ids[i][4 * a : 4 * (a + k)])
                for i, a, k in zip(row.tolist(), inside.tolist(), n.tolist())
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row)),
                    *map(pa.array, (inside, n, np.array(crcs, np.int64), length[row], place // window, place % window)),
                    batch.column("source").take(pa.array(row)),
                ],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"],
            )

    schema = (
        f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long, source string"
    )
    return placed.mapInArrow(rows, schema)
