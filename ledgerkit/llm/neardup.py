"""Near-duplicate documents by bottom-k sketches from one hash function.

A document's set holds the hashes of its word shingles; its sketch the K smallest. Documents with equal sets are one
class, represented by the smallest id. Inverted lists of retained values bring classes together, the sketch of their
union estimates the similarity, and full sets decide.

Which values are listed: a pair that is similar enough shares at least AGREE of its retained values. Of a sketch, the
values that no other class retains share nothing, so a class with more than 1 - AGREE of those is finished; of the
rest, ordered from rare to frequent, only as many are listed as it takes to meet every partner that agrees enough. A
passage that thousands of documents hold therefore fills no list, unless it is most of their text.

Which pairs are compared: members of a list with the list's pivot first. Links make components; then members of one
pivot that are still in different components are compared with each other, block by block, inside the tasks. Groups
that are one component after the first step need no more, so a group of copies costs about one comparison for each,
no pairs are sent out, and no link that joins two components is lost.

Cases: a text without words, or null, has an empty set, is linked with nothing and kept; null ``doc_id`` likewise, with
null component; rows that repeat a ``doc_id`` are judged each by its own text; other columns are not read; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerkit.llm.components import components
from ledgerkit.llm.scratch import stored
from ledgerkit.llm.words import buffers, mix, shingles, text_slices, words

#: Retained values, and the share of them on which a pair at the threshold of 0.8 agrees but for 1 in 30,000.
K, AGREE = 64, 0.6
#: A block's bytes and sets; values in at most RARE sets of a block are counted pair by pair.
BLOCK_BYTES, BLOCK_ROWS, RARE = 4_000_000, 512, 6

SKETCH_DDL = "doc_id long, n long, f1 long, f2 long, sketch array<long>"
SET_DDL = "node long, f1 long, n long, items binary"


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[np.ndarray]:
    hashes, bounds = shingles(words(*buffers(batch.column("text"))), size)
    return (np.unique(hashes[a:b].view(np.int64)) for a, b in zip(bounds[:-1], bounds[1:], strict=True))


def _sketch(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        n, f1, f2, kept = [], [], [], []
        for items in _sets(batch, size):
            n.append(len(items))
            f1.append(np.add.reduce(items))
            f2.append(np.add.reduce(mix(items.view(np.uint64) ^ np.uint64(0x5851F42D4C957F2D))))
            kept.append(items[:K])
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in kept])]).astype(np.int32)
        sketch = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(kept), pa.int64()))
        sums = np.array(f1, np.int64), np.array(f2, np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(sums[0]), pa.array(sums[1]), sketch],
            names=["doc_id", "n", "f1", "f2", "sketch"],
        )


def _full(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        sets = list(_sets(batch, size))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(np.array([np.add.reduce(x) for x in sets], np.int64)),
                pa.array([len(x) for x in sets], pa.int64()),
                pa.array([x.tobytes() for x in sets], pa.binary()),
            ],
            names=["node", "f1", "n", "items"],
        )


def _confirm(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        linked = []
        for x, y in zip(batch.column("items_a"), batch.column("items_b"), strict=True):
            x, y = np.frombuffer(x.as_buffer(), np.int64), np.frombuffer(y.as_buffer(), np.int64)
            at = np.searchsorted(y, x)
            both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
            linked.append(100 * both >= percent * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked)], names=["a", "b", "linked"])


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n, f1, f2, sketch): size of the set, two sums that tell sets apart, and its K smallest hashes."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(rows.mapInArrow(partial(_sketch, size=size), SKETCH_DDL), "sketches")


def listed_values(nodes: DataFrame) -> DataFrame:
    """(value, node, n) of the inverted lists, from (node, n, sketch)."""
    entries = nodes.select("node", "n", F.size("sketch").alias("k"), F.explode("sketch").alias("value"))
    shared = entries.groupBy("value").agg(F.count("*").alias("often")).filter("often > 1")
    by_node = Window.partitionBy("node", "n", "k")
    ranked = entries.join(shared, "value").select(
        "node", "n", "k", "value",
        F.row_number().over(by_node.orderBy("often", "value")).alias("rank"),
        F.count("*").over(by_node).alias("known"),
    )
    reach = F.col("k") - F.ceil(F.col("k") * AGREE) + 1 - (F.col("k") - F.col("known"))
    return ranked.filter(F.col("rank") <= reach).select("value", "node", "n")


def similar(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of ``pairs`` (a, b), those whose full sets are similar; size and the sketch of their union filter before."""

    def side(x: str, frame: DataFrame, *names: str) -> DataFrame:
        return frame.select(F.col("node").alias(x), *(F.col(n).alias(f"{n}_{x}") for n in names))

    both = pairs.join(side("a", nodes, "n", "sketch"), "a").join(side("b", nodes, "n", "sketch"), "b")
    union = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, K)
    agree = F.size(F.array_intersect(union, F.array_intersect("sketch_a", "sketch_b"))) >= F.size(union) * AGREE
    near = both.filter(_sizes_allow(percent, "n_a", "n_b")).filter(agree).select("a", "b")
    full = near.join(side("a", sets, "items"), "a").join(side("b", sets, "items"), "b")
    confirmed = full.mapInArrow(partial(_confirm, percent=percent), "a long, b long, linked boolean")
    return confirmed.filter("linked").select("a", "b")


def _sizes_allow(percent: int, x: str, y: str) -> Column:
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def links(docs: DataFrame, nodes: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes that are similar: enough of them to connect all that the others would."""
    listed = stored(listed_values(nodes), "lists")
    chosen = nodes.join(listed.select("node").distinct(), "node", "left_semi").select(F.col("node").alias("doc_id"), "f1", "n")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.join(chosen.select("doc_id").distinct(), "doc_id", "left_semi")
    sets = texts.mapInArrow(partial(_full, size=size), SET_DDL)
    sets = stored(sets.join(chosen.withColumnRenamed("doc_id", "node"), ["node", "f1", "n"], "left_semi"), "sets")

    pivots = listed.groupBy("value").agg(F.min("node").alias("a"), F.max("node").alias("most")).filter("a <> most")
    tried = stored(
        listed.join(pivots.drop("most"), "value").filter("node <> a").select("a", F.col("node").alias("b")).distinct(), "pairs"
    )
    found = stored(similar(tried, nodes, sets, percent), "links")

    # what a list holds beside its pivot was tried with that pivot: unlinked members of a list share a pivot's members
    labels = components(found)
    pivot = F.explode(F.array("a", "b")).alias("node")
    member = tried.select(F.col("a").alias("pivot"), pivot).distinct().join(labels, "node", "left")
    member = member.select("pivot", "node", F.coalesce("component", "node").alias("component"))
    mixed = member.groupBy("pivot").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y")
    member = member.join(mixed.select("pivot"), "pivot", "left_semi")
    return found.unionByName(stored(compared(member, sets, percent), "links"))


def compared(member: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between members (pivot, node, component) of a pivot that are in different components.

    A pivot's members are dealt into blocks of bounded size, and every two blocks meet in one task, which sends out no
    more links than it takes to join their components.
    """
    size = F.ceil(F.greatest(F.sum("bytes") / BLOCK_BYTES, F.count("*") / BLOCK_ROWS)).cast("int")
    rows = member.join(sets.select("node", F.col("n").alias("bytes")), "node").withColumn("bytes", F.col("bytes") * 8)
    blocks = rows.groupBy("pivot").agg(size.alias("blocks"))
    rows = rows.join(blocks, "pivot").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    rows = rows.select("pivot", "node", "component", "block", other)
    rows = rows.select(
        "pivot", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "component"
    ).join(sets.select("node", "items"), "node")

    def links_of(key: tuple, table: pa.Table) -> pa.Table:
        return _links_between(table, percent)

    return rows.groupBy("pivot", "i", "j").applyInArrow(links_of, "a long, b long")


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of a block's sets."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    every = np.concatenate(sets)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    first = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
    often = np.diff(np.append(first, len(every)))
    total = np.zeros((len(sets), len(sets)), np.float32)
    rare = (often > 1) & (often <= RARE)
    for r in range(2, RARE + 1):  # of values that few sets have, their pairs one by one
        at = first[rare & (often == r)]
        for x in range(r):
            for y in range(x):
                np.add.at(total, (owner[at + x], owner[at + y]), 1)
                np.add.at(total, (owner[at + y], owner[at + x]), 1)
    frequent = np.flatnonzero(often > RARE)
    for c in range(0, len(frequent), 4096):  # of the others, as products of matrices
        part = frequent[c : c + 4096]
        column = np.repeat(np.arange(len(part)), often[part])
        at = np.arange(len(column)) - np.repeat(np.cumsum(often[part]) - often[part], often[part]) + first[part][column]
        held = np.zeros((len(sets), len(part)), np.float32)
        held[owner[at], column] = 1
        total += held @ held.T
    return total


def _links_between(table: pa.Table, percent: int) -> pa.Table:
    node, of = table.column("node").to_numpy(), table.column("component").to_numpy()
    sets = [np.frombuffer(x.as_buffer(), np.int64) for x in table.column("items")]
    size = np.array([len(x) for x in sets])
    both = overlaps(sets).astype(np.int64)
    linked = np.triu(100 * both >= percent * (size[:, None] + size - both), 1) & (of[:, None] != of)
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.get(x, x)) != x:
            x = up
        return x

    kept = []
    for i, j in np.argwhere(linked):
        x, y = find(int(of[i])), find(int(of[j]))
        if x != y:
            root[max(x, y)] = min(x, y)
            kept.append((i, j))
    at = np.array(kept, np.int64).reshape(-1, 2)
    return pa.table({"a": pa.array(node[at[:, 0]], pa.int64()), "b": pa.array(node[at[:, 1]], pa.int64())})


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs`` (doc_id, text).

    Documents are linked when 100 * intersection >= percent * union of their sets of ``size``-word shingles.
    """
    rows = sketches(docs, size)
    named = rows.filter("n > 0 and doc_id is not null")
    classes = stored(named.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("rep")), "classes")
    first = classes.select(F.col("rep").alias("doc_id"), "n", "f1", "f2")
    nodes = named.join(first, ["doc_id", "n", "f1", "f2"], "left_semi").dropDuplicates(["doc_id", "f1"])
    nodes = stored(nodes.withColumnRenamed("doc_id", "node"), "nodes")
    labels = components(links(docs, nodes, size, percent))
    of_class = classes.join(labels, classes.rep == labels.node, "left").select(
        "n", "f1", "f2", F.coalesce("component", "rep").alias("component_id")
    )
    judged = named.drop("sketch").join(of_class, ["n", "f1", "f2"]).select("doc_id", "n", "component_id")
    alone = rows.filter("n = 0 or doc_id is null").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return judged.unionByName(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )
