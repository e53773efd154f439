"""Mixture-controlled packing: deficit round-robin over source queues fills fixed windows to target proportions.

Every source is a queue of tokens. Queues take turns of QUANTUM tokens so that each keeps to its target share: the
queue that is furthest behind its share goes next. A turn's place in the whole order has a closed form (how many turns
of every queue come before it), so the deficits carry across windows and partitions without any sequential pass:
each task places its own documents knowing only the queues' total sizes.

Shares default to the sources' shares of all tokens, so every queue lasts to the end and nothing is left over. With
other ``weights`` the queues that run dry leave their turns to the rest. What is left of a queue after its last whole
turn is placed after all whole turns. Windows are full but for the last one.

Cases: null text is an empty text (its end id only); a null source is a queue of its own; null and repeated ``doc_id``
pack like any other row, each on its own; other columns are not read; an empty table gives no pieces. A queue's state
is one number, kept on the driver: the queue column is meant to name mixture components, not documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerkit.llm.scratch import stored
from ledgerkit.llm.tokens import encoder, slices

WINDOW = 4096
QUANTUM = 512

TOKENS_DDL = "part int, doc_id long, queue string, doc_tokens long, queue_at long, ids binary"
PIECES_DDL = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, queue string"
)
PIECES = pa.schema(
    [(n, pa.string() if t == "string" else pa.int64()) for n, t in (x.split() for x in PIECES_DDL.split(", "))]
)


class Turns:
    """Places of the queues' turns in one order.

    ``sizes``: tokens of each queue. ``weights``: its share of the mixture, up to a factor; by default its size. Turn
    ``c`` of queue ``q`` is due at (2c + 1) / weight, ties to the earlier queue.
    """

    def __init__(self, sizes: list[int], weights: list[int] | None, window: int, quantum: int) -> None:
        if window % quantum:
            raise ValueError("a window must be a whole number of turns")
        self.window, self.quantum = window, quantum
        self.whole = [s // quantum for s in sizes]
        self.weights = [int(w) for w in weights] if weights else [max(1, n) for n in self.whole]
        if min(self.weights, default=1) <= 0:
            raise ValueError("weights must be above zero")
        rest = [s % quantum for s in sizes]
        tail = sum(self.whole) * quantum
        self.tails = [tail + sum(rest[:q]) for q in range(len(rest))]

    def before(self, queue: int, turns: np.ndarray) -> np.ndarray:
        """How many turns of all queues come before each of ``turns`` of ``queue``; exact integers."""
        due, own = 2 * turns + 1, self.weights[queue]
        if len(turns) and int(due.max()) * max(self.weights) >= 1 << 62:
            due = due.astype(object)
        rank = np.zeros(len(turns), np.int64)
        for q, (n, w) in enumerate(zip(self.whole, self.weights, strict=True)):
            if q == queue:
                rank += turns
            elif n:
                # turns c of q with (2c + 1) * own < due * w; with the tie for an earlier queue
                most = due * w + (1 if q < queue else 0)
                rank += np.minimum(((most - 1) // own + 1) // 2, n).astype(np.int64)
        return rank

    def pieces(self, queue: int, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cut the spans ``begin`` to ``end`` of a queue where turns or windows end.

        Returns each piece's span number, start in the queue and place in the packed order, by span and start. Pieces
        that follow each other in the same window are one.
        """
        q, tail = self.quantum, self.whole[queue] * self.quantum
        first, last = begin // q, np.maximum(end - 1, begin) // q
        n = last - first + 1
        span = np.repeat(np.arange(len(begin)), n)
        turn = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start = np.maximum(turn * q, begin[span])
        inner = turn < self.whole[queue]
        place = np.empty(len(span), np.int64)
        place[inner] = self.before(queue, turn[inner]) * q + start[inner] - turn[inner] * q
        place[~inner] = self.tails[queue] + start[~inner] - tail
        # what follows the last whole turn may cross one end of a window
        stop = np.minimum((turn + 1) * q, end[span])
        cut = (place // self.window + 1) * self.window
        cross = place + stop - start > cut
        span, start, place = (
            np.concatenate([span, span[cross]]),
            np.concatenate([start, (start + cut - place)[cross]]),
            np.concatenate([place, cut[cross]]),
        )
        order = np.lexsort((start, span))
        span, start, place = span[order], start[order], place[order]
        new = np.ones(len(span), bool)
        new[1:] = (np.diff(span) != 0) | (np.diff(place) != np.diff(start)) | (np.diff(place // self.window) != 0)
        return span[new], start[new], place[new]


def tokenized(tokenizer: str, keeps_space: bool, end_id: int):
    """A ``mapInArrow`` function: documents in; their ids and places in this partition's part of their queue out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, reached = encoder(tokenizer, keeps_space), TaskContext.get().partitionId(), {}
        for batch in slices(batches, "text"):
            found = enc.encode(batch.column("text"))
            ends = np.cumsum(found.counts)
            ids = np.insert(found.ids.astype(np.uint32), ends, end_id)
            n = found.counts + 1
            queues, at = batch.column("queue").to_pylist(), []
            for queue, k in zip(queues, n.tolist(), strict=True):
                at.append(reached.get(queue, 0))
                reached[queue] = at[-1] + k
            ends, kind = np.cumsum(n), "<u2" if ids.max() < 1 << 16 and enc.dtype == np.uint16 else "<u4"
            data = ids.astype(kind)
            yield pa.RecordBatch.from_pydict(
                {
                    "part": np.full(len(n), part, np.int32), "doc_id": batch.column("doc_id"),
                    "queue": batch.column("queue"), "doc_tokens": n, "queue_at": np.array(at, np.int64),
                    "ids": pa.array([data[a:b].tobytes() for a, b in zip(ends - n, ends, strict=True)], pa.binary()),
                }
            )

    return run


def place(queues: list[str | None], turns: Turns):
    """A ``mapInArrow`` function: documents with ids and queue positions in, pieces out."""
    number = {q: i for i, q in enumerate(queues)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.array([number[q] for q in batch.column("queue").to_pylist()], np.int64)
            tokens = batch.column("doc_tokens").to_numpy()
            begin = batch.column("queue_base").to_numpy() + batch.column("queue_at").to_numpy()
            ids = batch.column("ids")
            for queue in np.unique(names):
                rows = np.flatnonzero(names == queue)
                span, start, at = turns.pieces(int(queue), begin[rows], begin[rows] + tokens[rows])
                row = rows[span]
                start = start - begin[row]
                stop = np.append(start[1:], 0)
                last = np.append(np.diff(span) != 0, True)
                length = np.where(last, tokens[row], stop) - start
                sums, held, data = [], -1, None
                for r, a, k in zip(row.tolist(), start.tolist(), length.tolist(), strict=True):
                    if r != held:
                        raw = ids[r].as_py()
                        held, data = r, np.frombuffer(raw, f"<u{len(raw) // int(tokens[r])}").astype("<u4")
                    sums.append(zlib.crc32(data[a : a + k]))
                at_window = at // turns.window
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id").take(pa.array(row)), "start": start, "length": length,
                        "ids_crc32": pa.array(sums, pa.int64()), "doc_tokens": tokens[row], "sequence_id": at_window,
                        "offset": at - at_window * turns.window, "queue": pa.array([queues[queue]] * len(row), pa.string()),
                    },
                    schema=PIECES,
                )

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    keeps_space: bool = False,
    end_id: int = 2,
    queue: str = "source",
    weights: dict[str | None, Fraction | int] | None = None,
    window: int = WINDOW,
    quantum: int = QUANTUM,
) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text, ``queue``) in windows of ``window`` tokens."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col(queue).cast("string").alias("queue"))
    tokens = stored(rows.mapInArrow(tokenized(tokenizer, keeps_space, end_id), TOKENS_DDL), "tokens")
    parts = tokens.groupBy("queue", "part").agg(F.sum("doc_tokens").alias("n"))
    before = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select(
        F.col("queue").alias("base_queue"),
        F.col("part").alias("base_part"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("queue_base"),
    )
    totals = sorted(
        ((r["queue"], r["n"]) for r in parts.groupBy("queue").agg(F.sum("n").alias("n")).collect()),
        key=lambda x: (x[0] is None, x[0] or ""),
    )  # one row for each queue
    queues = [q for q, _ in totals]
    shares = [Fraction(weights[q]) for q in queues] if weights else None
    if shares:
        scale = np.lcm.reduce([s.denominator for s in shares])
        shares = [int(s * int(scale)) for s in shares]
    turns = Turns([n for _, n in totals], shares, window, quantum)
    placed = tokens.join(
        bases, (F.col("part") == F.col("base_part")) & F.col("queue").eqNullSafe(F.col("base_queue"))
    ).drop("base_part", "base_queue")
    return placed.mapInArrow(place(queues, turns), PIECES_DDL)
