"""Token-id shards as Re-Pair grammars: frequent pairs of ids become nonterminals, with random-access decoding.

A shard is one row: ``ids`` holds its symbols, ``rules`` the two symbols behind each nonterminal, ``lengths`` how many
ids each nonterminal stands for. Shards close at the first document that fills them, so a document lies in one shard.

Cases: null text is an empty text (its end id only); null and repeated ``doc_id`` keep a row each, nulls first, ties in
the order of a hash of their text; other columns of the input are not read; an empty table gives an empty file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerkit.llm.scratch import partitions
from ledgerkit.llm.tokens import encoder, slices

#: Ids after which a shard closes.
SHARD_IDS = 1 << 18
#: Occurrences a pair needs, not counting those that overlap another one of it.
LEAST = 2

SHARD = pa.schema(
    [
        ("part", pa.int32()), ("shard", pa.int32()), ("n_ids", pa.int64()), ("base", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())),
        ("rules", pa.binary()), ("lengths", pa.binary()), ("ids", pa.binary()),
    ]
)
SHARD_DDL = (
    "part int, shard int, n_ids long, base int, doc_ids array<long>, doc_tokens array<long>, "
    "rules binary, lengths binary, ids binary"
)


class Grammar(NamedTuple):
    """``base``: first nonterminal; ``rules``: a row of two symbols for each; ``lengths``: ids each stands for."""

    base: int
    rules: np.ndarray
    lengths: np.ndarray
    symbols: np.ndarray


def apart(at: np.ndarray) -> np.ndarray:
    """Of sorted positions, those kept so that no two are neighbours: every second one of a run."""
    new = np.diff(at, prepend=-2) != 1
    index = np.arange(len(at))
    return (index - np.maximum.accumulate(np.where(new, index, 0))) % 2 == 0


def repeated_pairs(symbols: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the pairs that begin at ``at``, those that occur LEAST times: their positions, which pair each is, and counts."""
    place, width = int(len(symbols)).bit_length(), int(symbols.max()).bit_length()
    if 2 * width + place <= 64:  # a pair and its position fit one number, which sorts faster than an order does
        pairs = symbols[at].astype(np.uint64) << np.uint64(width) | symbols[at + 1]
        keys = np.sort(pairs << np.uint64(place) | at.astype(np.uint64))
        where, pairs = (keys & np.uint64((1 << place) - 1)).astype(np.int64), keys >> np.uint64(place)
    else:
        pairs = symbols[at].astype(np.uint64) << np.uint64(32) | symbols[at + 1]
        order = np.argsort(pairs, kind="stable")
        where, pairs = at[order], pairs[order]
    first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
    counts = np.diff(first, append=len(pairs))
    enough = counts >= LEAST
    kept, counts = np.repeat(enough, counts), counts[enough]
    return where[kept], np.repeat(np.arange(len(counts)), counts), counts


def compress(ids: np.ndarray, base: int) -> Grammar:
    """Replace pairs until none occurs LEAST times; ``base`` is greater than every id.

    A round replaces every occurrence that is more frequent than the ones overlapping it, so all those of the most frequent
    pair. A pair that is rare once stays rare, as new neighbours hold a new symbol: later rounds look at what is left only.
    """
    symbols, rules, lengths = ids.astype(np.uint32), [np.empty((0, 2), np.uint32)], np.ones(0, np.int64)
    at = np.arange(len(symbols) - 1)
    while len(at):
        same = at[symbols[at] == symbols[at + 1]]
        overlapping = same[~apart(same)]
        if len(overlapping):
            single = np.ones(len(symbols), bool)
            single[overlapping] = False
            at = at[single[at]]
        at, pair, counts = repeated_pairs(symbols, at)
        if not len(at):
            break
        rank = np.empty(len(counts), np.int32)
        mixed = np.arange(len(counts)) * 2654435761 & 0xFFFFFFFF  # equal counts in ascending order would yield one a round
        rank[np.argsort(counts << 32 | mixed)] = np.arange(1, len(counts) + 1, dtype=np.int32)
        weight = np.zeros(len(symbols) + 2, np.int32)
        weight[at + 1] = own = rank[pair]
        best = (own > weight[at]) & (own > weight[at + 2])
        uses = np.bincount(pair[best], minlength=len(counts))
        best &= uses[pair] >= LEAST
        begin, pair = at[best], pair[best]
        named = np.cumsum(uses >= LEAST) - 1
        first = np.empty(named[-1] + 1, np.int64)
        first[named[pair]] = begin
        two = np.stack([symbols[first], symbols[first + 1]], axis=1)
        live = np.zeros(len(symbols), bool)
        for left in (at, overlapping, begin, np.maximum(begin - 1, 0)):
            live[left] = True
        symbols[begin] = base + len(lengths) + named[pair]
        kept = np.ones(len(symbols), bool)
        kept[begin + 1] = False
        symbols, live = symbols[kept], live[kept]
        at = np.flatnonzero(live[:-1])
        rules.append(two)
        lengths = np.concatenate([lengths, sizes(base, lengths, two).sum(axis=1)])
    return Grammar(base, np.concatenate(rules), lengths, symbols)


def sizes(base: int, lengths: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """How many ids each of ``symbols`` stands for."""
    return np.where(symbols >= base, np.append(lengths, 1)[np.maximum(symbols.astype(np.int64) - base, -1)], 1)


def expand(g: Grammar, symbols: np.ndarray | None = None) -> np.ndarray:
    """The ids behind ``symbols`` (all of the grammar's by default); each nonterminal on the way is opened once."""
    symbols = g.symbols if symbols is None else symbols
    size = sizes(g.base, g.lengths, symbols)
    at = np.cumsum(size) - size
    out = np.empty(int(size.sum()), np.uint32)
    while len(symbols):
        inner = symbols >= g.base
        out[at[~inner]] = symbols[~inner]
        at, two = at[inner], g.rules[symbols[inner] - g.base]
        at = np.concatenate([at, at + sizes(g.base, g.lengths, two[:, 0])])
        symbols = two.T.ravel()
    return out


def read_range(g: Grammar, start: int, length: int) -> np.ndarray:
    """Ids ``start`` to ``start + length`` of a shard, expanding only the symbols that hold them."""
    ends = np.cumsum(sizes(g.base, g.lengths, g.symbols))
    a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, start + length, "left") + 1
    skipped = int(ends[a - 1]) if a else 0
    return expand(g, g.symbols[a:b])[start - skipped : start - skipped + length]


def _width(g: Grammar) -> type:
    return np.dtype("<u2") if g.base + len(g.rules) <= 1 << 16 else np.dtype("<u4")


def to_row(g: Grammar) -> dict[str, bytes | int]:
    kind = _width(g)
    return {
        "base": g.base, "rules": g.rules.astype(kind).tobytes(), "lengths": g.lengths.astype("<u4").tobytes(),
        "ids": g.symbols.astype(kind).tobytes(),
    }


def from_row(base: int, rules: bytes, lengths: bytes, ids: bytes) -> Grammar:
    lengths = np.frombuffer(lengths, "<u4").astype(np.int64)
    kind = np.dtype("<u2") if base + len(lengths) <= 1 << 16 else np.dtype("<u4")
    pairs = np.frombuffer(rules, kind).astype(np.uint32).reshape(-1, 2)
    return Grammar(base, pairs, lengths, np.frombuffer(ids, kind).astype(np.uint32))


def encode_shards(tokenizer: str, keeps_space: bool, end_id: int, shard_ids: int):
    """A ``mapInArrow`` function: sorted documents in, shards out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, keeps_space)
        base = max(enc.tokenizer.get_vocab_size(), end_id + 1)
        part, shard, held, docs, counts, size = TaskContext.get().partitionId(), 0, [], [], [], 0

        def close() -> pa.RecordBatch:
            row = {"part": part, "shard": shard, "n_ids": size, "doc_ids": docs, "doc_tokens": counts}
            return pa.RecordBatch.from_pylist([row | to_row(compress(np.concatenate(held), base))], schema=SHARD)

        for batch in slices(batches, "text"):
            found = enc.encode(batch.column("text"))
            ends = np.cumsum(found.counts)
            ids = np.insert(found.ids.astype(np.uint32), ends, end_id)
            n = found.counts + 1
            names = batch.column("doc_id").to_pylist()
            at = np.cumsum(n)
            first = 0
            while first < len(n):
                begun = int(at[first - 1]) if first else 0
                last = min(int(np.searchsorted(at, begun + shard_ids - size)), len(n) - 1)
                held.append(ids[begun : at[last]])
                docs += names[first : last + 1]
                counts += n[first : last + 1].tolist()
                size += int(at[last]) - begun
                first = last + 1
                if size >= shard_ids:
                    yield close()
                    shard, held, docs, counts, size = shard + 1, [], [], [], 0
        if docs:
            yield close()

    return run


def write_shards(
    docs: DataFrame, path: str, tokenizer: str, keeps_space: bool = True, end_id: int = 0, shard_ids: int = SHARD_IDS
) -> None:
    """Encode ``docs`` (doc_id, text) in ascending doc_id order into the file format under ``path``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    rows = rows.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
    run = encode_shards(tokenizer, keeps_space, end_id, shard_ids)
    rows.select("doc_id", "text").mapInArrow(run, SHARD_DDL).write.option("compression", "zstd").parquet(path)


def decode_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A ``mapInArrow`` function: shards in; each document's place in its shard, number of ids and checksum out."""
    for batch in batches:
        for row in batch.to_pylist():
            ids = expand(from_row(row["base"], row["rules"], row["lengths"], row["ids"])).astype("<u4")
            n = np.array(row["doc_tokens"], np.int64)
            ends = np.cumsum(n)
            sums = [zlib.crc32(ids[a:b]) for a, b in zip(ends - n, ends, strict=True)]
            yield pa.RecordBatch.from_pydict(
                {
                    "part": np.full(len(n), row["part"], np.int32), "shard": np.full(len(n), row["shard"], np.int32),
                    "doc_id": pa.array(row["doc_ids"], pa.int64()), "at": ends - n, "n_tokens": n,
                    "ids_crc32": pa.array(sums, pa.int64()),
                }
            )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a written file: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    shards = spark.read.schema(SHARD_DDL).parquet(path)
    sizes = shards.select("part", "shard", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    ordered = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each written part
    parts = parts.select("part", F.coalesce(F.sum("n").over(ordered), F.lit(0)).alias("part_start"))
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.join(parts, "part").select(
        "part", "shard", (F.col("part_start") + F.coalesce(F.sum("n_ids").over(within), F.lit(0))).alias("shard_start")
    )
    rows = shards.mapInArrow(
        decode_documents, "part int, shard int, doc_id long, at long, n_tokens long, ids_crc32 long"
    )
    return rows.join(starts, ["part", "shard"]).select(
        "doc_id", (F.col("shard_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )
