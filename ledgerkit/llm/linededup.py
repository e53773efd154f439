"""Lines that many documents repeat, found by two Bloom filters and dropped after an exact count.

One pass hashes every document's distinct line keys. The hashes fill two filters over the same places: one of keys seen
once, one of keys seen again. A second pass sends on only keys that the second filter knows: those that surely or
possibly occur in two documents. Their 128-bit hashes are counted exactly by document; the filters' errors cost some
shuffle, never a line. Filters have BITS_PER_KEY places for each key, up to ``max_bits``; beyond that the filter lets more
through and the exact count does more of the work.

Cases: null text counts as one empty line and stays null; rows with a null ``doc_id`` are returned as they are and
count nowhere; rows that repeat a ``doc_id`` are one document; other columns are kept, but ``n_lines`` and ``n_dropped``
are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerkit.llm.columns import on_plain_names
from ledgerkit.llm.scratch import stored
from ledgerkit.llm.words import text_slices

SPACE = " \t\n\x0b\x0c\r"
BITS_PER_KEY, MAX_BITS, BLOCK_BITS = 16, 1 << 28, 1 << 20
#: Hashes a task gathers before it hands them on.
FLUSH = 1 << 20


def key(line: str, min_chars: int) -> bytes | None:
    """The 128-bit hash of a line's key, or None for short ones."""
    stripped = line.strip(SPACE)
    if len(stripped) < min_chars:
        return None
    return xxhash.xxh3_128_digest(stripped.encode().lower())  # of bytes: lower-cases A-Z only


def keys_of(texts: pa.Array, min_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of each text as rows of two numbers, and the row number of each one's text."""
    found, rows = [], []
    for i, text in enumerate(texts.to_pylist()):
        own = {k for line in text.split("\n") if (k := key(line, min_chars))} if text else ()
        found += own
        rows += [i] * len(own)
    return np.frombuffer(b"".join(found), np.int64).reshape(-1, 2), np.array(rows, np.int64)


def places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The two places of each hash in a filter of ``bits`` (a power of two), one after the other."""
    h = hashes.view(np.uint64)
    mask = np.uint64(bits - 1)
    return np.concatenate([h & mask, (h >> np.uint64(32)) & mask]).astype(np.int64)


def _hash_lists(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    """Hashes seen in this task, and those of them seen in a second document."""

    def flush() -> pa.RecordBatch:
        once, n = np.unique(np.concatenate(held), return_counts=True)
        row = {"n": [len(once)], "once": [once.tobytes()], "again": [once[n > 1].tobytes()]}
        return pa.RecordBatch.from_pydict(row)

    held, size = [], 0
    for batch in text_slices(batches):
        hashes, _ = keys_of(batch.column("text"), min_chars)
        held.append(hashes[:, 0])
        size += len(hashes)
        if size >= FLUSH:
            yield flush()
            held, size = [], 0
    if size:
        yield flush()


def _by_block(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    size = min(bits, BLOCK_BITS)
    for batch in batches:
        for name in ("once", "again"):
            for x in batch.column(name):
                at = np.sort(places(np.frombuffer(x.as_buffer(), np.int64), bits))
                blocks, first = np.unique(at // size, return_index=True)
                parts = np.split((at % size).astype(np.uint32), first[1:]) if len(at) else []
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": pa.array(blocks, pa.int64()),
                        "places": pa.array([p.tobytes() for p in parts], pa.binary()),
                    }
                )


def _fill(block: tuple, rows: pd.DataFrame, bits: int) -> pd.DataFrame:
    """One block of both filters: a place that is filled while it is already full belongs to the second."""
    once, again = np.zeros(min(bits, BLOCK_BITS), bool), np.zeros(min(bits, BLOCK_BITS), bool)
    for data in rows["places"]:
        at, n = np.unique(np.frombuffer(data, np.uint32), return_counts=True)
        again[at] |= once[at] | (n > 1)
        once[at] = True
    return pd.DataFrame({"block": [block[0]], "again": [np.packbits(again).tobytes()]})


def seen_again(docs: DataFrame, min_chars: int, max_bits: int) -> np.ndarray:
    """The second filter, a bit for each place."""
    lists = stored(
        docs.select("text").mapInArrow(partial(_hash_lists, min_chars=min_chars), "n long, once binary, again binary"),
        "line-hashes",
    )
    total = lists.agg(F.sum("n")).first()[0] or 0
    bits = 1 << 10
    while bits < min(total * BITS_PER_KEY, max_bits):
        bits *= 2
    blocks = lists.mapInArrow(partial(_by_block, bits=bits), "block long, places binary")

    def fill(block: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return _fill(block, rows, bits)

    filled = blocks.groupBy("block").applyInPandas(fill, "block long, again binary").collect()  # max_bits at most
    out, size = np.zeros(bits // 8, np.uint8), min(bits, BLOCK_BITS) // 8
    for block, again in filled:
        out[block * size : (block + 1) * size] = np.frombuffer(again, np.uint8)
    return out


def _suspects(batches: Iterator[pa.RecordBatch], min_chars: int, again) -> Iterator[pa.RecordBatch]:
    known = again.value
    for batch in text_slices(batches):
        hashes, rows = keys_of(batch.column("text"), min_chars)
        at = places(hashes[:, 0], len(known) * 8)
        hit = (known[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
        both = (hit[: len(hashes)] & hit[len(hashes) :]).astype(bool)
        yield pa.RecordBatch.from_pydict(
            {
                "k1": hashes[both, 0], "k2": hashes[both, 1], "doc_id": batch.column("doc_id").take(pa.array(rows[both]))
            }
        )


def _rewrite(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, lines, dropped = [], [], []
        for text, drop in zip(batch.column("text").to_pylist(), batch.column("drop").to_pylist(), strict=True):
            n = text.count("\n") + 1 if text else 1
            lines.append(n)
            if drop:
                gone = {(d["k1"].to_bytes(8, "little", signed=True) + d["k2"].to_bytes(8, "little", signed=True)) for d in drop}
                kept = [x for x in text.split("\n") if key(x, min_chars) not in gone]
                text = "\n".join(kept)
                dropped.append(n - len(kept))
            else:
                dropped.append(0)
            texts.append(text)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(texts, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
            names=["row", "text", "n_lines", "n_dropped"],
        )


def repeated_lines(docs: DataFrame, min_chars: int, min_docs: int, max_bits: int) -> DataFrame:
    """(doc_id, drop): keys of the lines each document loses."""
    texts = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    again = docs.sparkSession.sparkContext.broadcast(seen_again(texts, min_chars, max_bits))
    found = texts.mapInArrow(
        partial(_suspects, min_chars=min_chars, again=again), "k1 long, k2 long, doc_id long"
    ).distinct()
    found = stored(found, "suspects")
    confirmed = found.groupBy("k1", "k2").agg(F.count("*").alias("docs"), F.max("doc_id").alias("keeper"))
    confirmed = stored(confirmed.filter(F.col("docs") >= min_docs).drop("docs"), "repeated")
    lost = found.join(confirmed, ["k1", "k2"]).filter("doc_id <> keeper")
    return lost.groupBy("doc_id").agg(F.collect_list(F.struct("k1", "k2")).alias("drop"))  # a document's own lines


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` (doc_id, text, ...) without lines whose key at least ``min_docs`` documents hold, with counts.

    A key is a line without white space at its ends, A-Z lower-cased, of at least ``min_chars`` code points. The
    document with the largest id keeps its lines. Columns n_lines (before) and n_dropped are added.
    """
    return on_plain_names(
        docs, ["doc_id", "text"], ["n_lines", "n_dropped"], lambda kept: _without_repeats(kept, min_chars, min_docs, max_bits)
    )


def _without_repeats(kept: DataFrame, min_chars: int, min_docs: int, max_bits: int) -> DataFrame:
    others = kept.columns
    drops = repeated_lines(kept, min_chars, min_docs, max_bits).select(F.col("doc_id").alias("drop_id"), "drop")
    rows = kept.select(F.struct(*(F.col(f"`{c}`") for c in others if c != "text")).alias("row"), "text")
    joined = rows.join(drops, F.col("row.doc_id") == F.col("drop_id"), "left").select("row", "text", "drop")
    added = [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
    schema = T.StructType([joined.schema["row"], T.StructField("text", T.StringType()), *added])
    out = joined.mapInArrow(partial(_rewrite, min_chars=min_chars), schema)
    named = [F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in others]
    return out.select(*named, "n_lines", "n_dropped")
