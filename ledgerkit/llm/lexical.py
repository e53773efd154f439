"""Ranked lexical search: the best documents for each item, by branch and bound over tries of documents.

A document is a vector of term counts, restricted to the terms that items ask for. Each task takes documents block by
block and builds a document FP-tree: a document's terms in descending frequency form its path, documents with the same
beginning share it, and a branch of LEAF documents or fewer is not split further. Every node holds, for its whole
subtree, the largest count of each term and the smallest length factor. These bound what any document below can score
for an item: a depth-first search takes the better branch first, leaves a branch whose bound lies below the item's
worst kept score, and scores documents exactly at the leaves. Kept scores carry over from block to block; the tasks'
best documents meet in two steps, so that no task gets an item's rows of all tasks.

Items come in blocks of ITEM_TERMS terms at most, so what travels with a task has a bound; each block reads the
documents once.

Cases: null and empty texts have no terms and are never found; an item without terms finds nothing; items of any
length, long texts and repeated rows count whole; rows with the same ``doc_id`` are ranked each for itself; null ids
sort first among equals; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerkit.llm.columns import settle
from ledgerkit.llm.pieces import ranges
from ledgerkit.llm.scratch import stored
from ledgerkit.llm.words import IS_MARK, buffers, text_slices, words

#: Terms, repeats included, of a block of items: 8 bytes each.
ITEM_TERMS = 1 << 20
#: Counts of terms (postings) of a block of documents, and the documents of a branch that is not split further.
BLOCK_POSTINGS, LEAF = 1 << 19, 32
#: Groups in which the tasks' results meet first.
MEETINGS = 64

VECTORS_DDL = "doc_id long, n long, terms array<int>, counts array<int>"
HITS_DDL = "item int, doc_id long, score long, part int"


class Scoring(NamedTuple):
    """Everything a score needs beside the document: term weights, and the corpus's counts."""

    weights: np.ndarray
    n_docs: int
    n_terms: int

    def length_factor(self, n: np.ndarray) -> np.ndarray:
        return 75 + (25 * n * self.n_docs) // self.n_terms


def gain(count: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """What a term adds for each unit of its weight."""
    return (1_000_000_000 * count) // (1000 * count + 12 * factor)


def terms_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    found = words(*buffers(texts), IS_MARK)
    return found.hashes, found.bounds


def restricted_vectors(vocabulary: np.ndarray):
    """A ``mapInArrow`` function: documents in; their number of terms and the counts of ``vocabulary``'s terms out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            hashes, bounds = terms_of(batch.column("text"))
            place = np.minimum(np.searchsorted(vocabulary, hashes), max(len(vocabulary) - 1, 0))
            known = np.flatnonzero(vocabulary[place] == hashes) if len(vocabulary) else np.empty(0, np.int64)
            doc = np.searchsorted(bounds, known, "right") - 1
            both, counts = np.unique(doc * max(len(vocabulary), 1) + place[known], return_counts=True)
            doc, term = np.divmod(both, max(len(vocabulary), 1))
            at = pa.array(np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(np.diff(bounds).astype(np.int64)),
                    pa.ListArray.from_arrays(at, pa.array(term.astype(np.int32))),
                    pa.ListArray.from_arrays(at, pa.array(counts.astype(np.int32))),
                ],
                ["doc_id", "n", "terms", "counts"],
            )

    return run


class DocumentTree:
    """The FP-tree of a block of documents, its nodes in preorder.

    ``terms`` are numbered by descending frequency, so a sorted vector is a path. A node's documents lie side by side.
    """

    def __init__(self, ids: np.ndarray, factor: np.ndarray, bounds: np.ndarray, terms: np.ndarray, counts: np.ndarray):
        size = np.diff(bounds)
        paths = terms.astype(">u4").tobytes()
        order = np.array(sorted(range(len(ids)), key=lambda d: paths[4 * bounds[d] : 4 * bounds[d + 1]]), np.int64)
        at = ranges(bounds[order], size[order])
        self.ids, self.factor = ids[order], factor[order]
        self.terms, self.counts = terms[at].astype(np.int32), counts[at]
        self.gains = gain(self.counts, np.repeat(self.factor, size[order])).astype(np.int32)  # a million at most
        self.bounds = np.concatenate([[0], np.cumsum(size[order])])
        self._grow()
        self._summarise()

    def _grow(self) -> None:
        """Nodes as ranges of documents: a node with more than LEAF documents is split by its documents' next term."""
        first, last, children = [], [], []
        ends = self.bounds[1:] - self.bounds[:-1]

        def node(a: int, b: int) -> int:
            first.append(a)
            last.append(b)
            children.append([])
            return len(first) - 1

        todo = [(node(0, len(self.ids)), 0)]
        while todo:
            me, depth = todo.pop()
            a, b = first[me], last[me]
            if b - a <= LEAF:
                continue
            here = self.bounds[a:b] + depth
            # a document whose path ends here comes first, with no next term
            more = ends[a:b] > depth
            term = np.where(more, self.terms[np.minimum(here, len(self.terms) - 1)], -1)
            cuts = a + np.flatnonzero(np.diff(term)) + 1
            edges = [a, *cuts.tolist(), b]
            if len(edges) == 2 and not more.any():
                # equal vectors throughout: leaves of bounded size
                edges = [*range(a, b, LEAF), b]
                children[me] = [node(x, y) for x, y in zip(edges, edges[1:], strict=False)]
                continue
            for x, y in self._joined(edges, term[0] < 0):
                child = node(x, y)
                children[me].append(child)
                todo.append((child, depth + 1 if y - x > LEAF else depth))
        self.first, self.last, self.children = np.array(first), np.array(last), children

    @staticmethod
    def _joined(edges: list[int], ended: bool) -> Iterator[tuple[int, int]]:
        """Neighbouring branches of few documents as one leaf; paths that end here stay apart from the rest."""
        a = edges[0]
        for i, (x, y) in enumerate(zip(edges, edges[1:], strict=False)):
            if y - a > LEAF or (i == 1 and ended):
                if x > a:
                    yield a, x
                a = x
        yield a, edges[-1]

    def _summarise(self) -> None:
        """What each term adds at most below each node: by its largest count and the smallest factor of the subtree."""
        leaf = np.array([not c for c in self.children])
        order = np.flatnonzero(leaf)
        order = order[np.argsort(self.first[order], kind="stable")]
        number = np.repeat(order, self.last[order] - self.first[order])  # each document's leaf
        node = np.repeat(number, np.diff(self.bounds))
        parent = np.full(len(self.first), -1)
        for me, own in enumerate(self.children):
            parent[own] = me
        self.lowest = np.full(len(self.first), np.iinfo(np.int64).max)
        np.minimum.at(self.lowest, number, self.factor)
        for me in range(len(parent) - 1, 0, -1):  # children come after their parents
            self.lowest[parent[me]] = min(self.lowest[parent[me]], self.lowest[me])
        width = len(self.first)
        keys, most = self._largest(self.terms.astype(np.int64) * width + node, self.counts)
        del node, self.counts
        levels, k, m = [(keys, most)], keys, most
        while len(k):
            term, at = np.divmod(k, width)
            up = parent[at]
            k, m = self._largest((term * width + up)[up >= 0], m[up >= 0])
            levels.append((k, m))
        keys, most = self._largest(*(np.concatenate(x) for x in zip(*levels, strict=True)))
        self.by_term, self.at_node = np.divmod(keys, width)
        self.most = gain(most, self.lowest[self.at_node]).astype(np.int32)

    @staticmethod
    def _largest(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return keys, values
        order = np.argsort(keys, kind="stable")
        keys, values = keys[order], values[order]
        begin = np.flatnonzero(np.diff(keys, prepend=-1))
        return keys[begin], np.maximum.reduceat(values, begin)

    def bounds_for(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """For every node, what no document below it can exceed."""
        out = np.zeros(len(self.first), np.int64)
        begin, end = np.searchsorted(self.by_term, terms), np.searchsorted(self.by_term, terms, "right")
        for a, b, weight in zip(begin.tolist(), end.tolist(), weights, strict=True):
            out[self.at_node[a:b]] += weight * self.most[a:b]  # a term comes once for each node
        return out

    def scores(self, first: int, last: int, weight_of: np.ndarray) -> np.ndarray:
        """Exact scores of the documents from ``first`` to ``last``; ``weight_of``: an item's weight of every term."""
        a, b = self.bounds[first], self.bounds[last]
        each = weight_of[self.terms[a:b]] * self.gains[a:b]
        return np.diff(np.concatenate([[0], np.cumsum(each)])[self.bounds[first : last + 1] - a])

    def search(self, terms: np.ndarray, weights: np.ndarray, weight_of: np.ndarray, best: Best) -> None:
        bound = self.bounds_for(terms, weights)
        todo = [0]
        while todo:
            me = todo.pop()
            if bound[me] < best.floor or bound[me] <= 0:
                continue
            if self.children[me]:
                own = self.children[me]
                todo.extend(own[i] for i in np.argsort(bound[own], kind="stable").tolist())  # the best on top
            else:
                a, b = int(self.first[me]), int(self.last[me])
                best.offer(self.ids[a:b], self.scores(a, b, weight_of))


class Best:
    """The ``k`` best documents so far: score first, then the smaller id. ``floor``: a score that may still enter."""

    def __init__(self, k: int) -> None:
        self.k, self.floor = k, 1
        self.ids, self.scores = np.empty(0, np.int64), np.empty(0, np.int64)

    def offer(self, ids: np.ndarray, scores: np.ndarray) -> None:
        good = scores >= self.floor
        if not good.any():
            return
        ids, scores = np.concatenate([self.ids, ids[good]]), np.concatenate([self.scores, scores[good]])
        order = np.lexsort((ids, -scores))[: self.k]
        self.ids, self.scores = ids[order], scores[order]
        if len(order) == self.k:
            self.floor = int(self.scores[-1])


#: A null id, which sorts first.
NO_ID = np.iinfo(np.int64).min


def search_blocks(items: list[tuple[int, np.ndarray, np.ndarray]], scoring: Scoring, k: int):
    """A ``mapInArrow`` function: restricted vectors in, each item's ``k`` best documents of this task out.

    ``items``: number, distinct terms and their weights times repeats.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in items]
        held: list[tuple[np.ndarray, ...]] = []
        n_held = 0

        def search() -> None:
            ids, n, size, terms, counts = (np.concatenate(x) for x in zip(*held, strict=True))
            bounds = np.concatenate([[0], np.cumsum(size)])
            tree = DocumentTree(ids, scoring.length_factor(n), bounds, terms, counts)
            weight_of = np.zeros(len(scoring.weights), np.int64)
            for (_, own, weights), kept in zip(items, best, strict=True):
                weight_of[own] = weights
                tree.search(own, weights, weight_of, kept)
                weight_of[own] = 0

        for batch in batches:
            size = np.diff(np.asarray(batch.column("terms").offsets)).astype(np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(size) // BLOCK_POSTINGS)) + 1), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                held.append(
                    (
                        part.column("doc_id").fill_null(NO_ID).to_numpy(), part.column("n").to_numpy(), size[a:b],
                        part.column("terms").flatten().to_numpy().astype(np.int64),
                        part.column("counts").flatten().to_numpy().astype(np.int64),
                    )
                )
                n_held += int(size[a:b].sum())
                if n_held >= BLOCK_POSTINGS:
                    search()
                    held, n_held = [], 0
        if held:
            search()
        number = np.repeat(np.array([x[0] for x in items], np.int32), [len(b.ids) for b in best])
        ids = np.concatenate([b.ids for b in best]) if best else np.empty(0, np.int64)
        scores = np.concatenate([b.scores for b in best]) if best else ids
        part = np.full(len(ids), TaskContext.get().partitionId(), np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(number), pa.array(ids, mask=ids == NO_ID), pa.array(scores), pa.array(part)],
            ["item", "doc_id", "score", "part"],
        )

    return run


def best_of(hits: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each item, met in groups of tasks first."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first()]
    some = Window.partitionBy("item", F.col("part") % MEETINGS).orderBy(*order)
    hits = hits.withColumn("place", F.row_number().over(some)).filter(F.col("place") <= k)
    ranked = hits.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return ranked.filter(F.col("rank") <= k).select("item", "rank", "doc_id", "score")


def search_block(docs: DataFrame, texts: list[str | None], k: int) -> DataFrame:
    """(item, rank, doc_id, score) for the items ``texts``, numbered by their places."""
    spark = docs.sparkSession
    hashes, bounds = terms_of(pa.array(texts, pa.string()))
    vocabulary, asked = np.unique(hashes, return_inverse=True)
    vectors = stored(docs.mapInArrow(restricted_vectors(vocabulary), VECTORS_DDL), "vectors")
    totals = vectors.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    # a row for each of the block's terms
    for term, n in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[term] = n
    # terms by descending frequency from here on
    place = np.empty(len(df), np.int64)
    place[np.argsort(-df, kind="stable")] = np.arange(len(df))
    weights = np.zeros(len(df), np.int64)
    weights[place] = [math.floor(1000 * math.log((2 * totals[0] + 2) / (2 * n + 1))) for n in df.tolist()]
    scoring = Scoring(weights, totals[0], max(1, totals[1]))
    items = []
    for i, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
        own, times = np.unique(place[asked[a:b]], return_counts=True)
        items.append((i, own, weights[own] * times))
    run = search_blocks(items, scoring, k)

    def by_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(map(lambda batch: renumbered(batch, place), batches))

    return best_of(vectors.filter(F.size("terms") > 0).mapInArrow(by_frequency, HITS_DDL), k)


def renumbered(batch: pa.RecordBatch, place: np.ndarray) -> pa.RecordBatch:
    """``batch`` with its terms numbered by ``place`` and each vector in ascending order of them."""
    at = np.asarray(batch.column("terms").offsets).astype(np.int64)
    term = place[batch.column("terms").flatten().to_numpy()]
    count = batch.column("counts").flatten().to_numpy()
    doc = np.repeat(np.arange(batch.num_rows), np.diff(at))
    order = np.lexsort((term, doc))
    at = pa.array((at - at[0]).astype(np.int32))
    lists = [pa.ListArray.from_arrays(at, pa.array(x[order].astype(np.int32))) for x in (term, count)]
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n"), *lists], batch.schema.names)


def item_blocks(items: DataFrame) -> Iterator[list[tuple[int, str | None]]]:
    """Items in blocks of about ITEM_TERMS terms: a term takes two characters of a text at least, or is the last."""
    block: list[tuple[int, str | None]] = []
    held = 0
    for row in items.select("item_id", "text").toLocalIterator():
        block.append((row["item_id"], row["text"]))
        held += len(row["text"] or "") // 2 + 1
        if held >= ITEM_TERMS:
            yield block
            block, held = [], 0
    if block:
        yield block


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of ``docs`` (doc_id, text) for each of ``items``."""
    spark = docs.sparkSession
    rows = settle(docs, ["doc_id", "text"]).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = settle(items, ["item_id", "text"]).select(F.col("item_id").cast("long").alias("item_id"), "text")
    found = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in item_blocks(items):
        numbers = spark.createDataFrame([(i, n) for i, (n, _) in enumerate(block)], "item int, item_id long")
        hits = search_block(rows, [t for _, t in block], k).join(numbers, "item")
        found = found.unionByName(hits.select("item_id", "rank", "doc_id", "score"))
    return found
