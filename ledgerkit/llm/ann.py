"""Approximate nearest neighbours by inner product: cross-polytope hashing with multiprobe tables.

A pseudo-rotation (three rounds of random signs and a fast Hadamard transform) turns a unit vector; its bucket is the
signed axis it is nearest to. A query probes the axes in the order of its own coordinates, PROBES of every table and
more until LEAST rows are met. Rows of the probed buckets are compared exactly, in double precision.

Inner products of vectors of different length reduce to angles within bands of similar length: a row is divided by its
band's longest and gets one more coordinate that makes it a unit vector; queries have zero there.

Equal vectors are one class, searched once: only its 21 smallest ids can ever be needed (20 and the query's own).
Buckets are cut into blocks of rows and of probes, so that no task holds a whole bucket, however hot, and only the best
of each block and query moves on.

Cases: vectors that are null, empty or zero, or hold null or non-finite components, and rows with a null id, take no
part; rows repeating an id with the same vector count once; an id with several vectors is searched with each of them,
the best ones counting; vectors of different dimension never meet; other columns are not read; an empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerkit.llm.scratch import partitions, stored

TABLES, PROBES, LEAST = 12, 8, 512
#: Rows and probes that meet in one task.
ROWS, QUERIES = 4096, 2048
#: Bands of length for each doubling; lengths closer than this are equal.
BANDS, EQUAL = 8, 1e-6
PLACED_DDL = "kind int, cell int, block int, id long, v array<double>"
FOUND_DDL = "id long, near long, score double"
FOUND = pa.schema([("id", pa.int64()), ("near", pa.int64()), ("score", pa.float64())])


def hadamard(x: np.ndarray) -> np.ndarray:
    """The orthonormal Walsh-Hadamard transform of each row; the width is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def rotate(x: np.ndarray, table: int) -> np.ndarray:
    signs = np.random.default_rng([7, table]).choice([-1.0, 1.0], (3, x.shape[1]))
    for s in signs:
        x = hadamard(x * s)
    return x


class Band(NamedTuple):
    """Vectors of one dimension and of similar length. ``width``: coordinates after padding; ``first``: its first cell."""

    dim: int
    band: int
    longest: float
    width: int
    first: int


class Index(NamedTuple):
    bands: list[Band]
    rows: np.ndarray  # of each cell
    probes: np.ndarray  # of each cell

    def row_blocks(self, cell: np.ndarray) -> np.ndarray:
        return np.maximum(-(-self.rows[cell] // ROWS), 1)

    def probe_blocks(self, cell: np.ndarray) -> np.ndarray:
        return np.maximum(-(-self.probes[cell] // QUERIES), 1)


def _lengths(x: np.ndarray) -> np.ndarray:
    """Of the rows, none of them zero; squares of very small or large values are never taken."""
    most = np.abs(x).max(axis=1)
    return most * np.linalg.norm(x / most[:, None], axis=1)


def _band(length: np.ndarray) -> np.ndarray:
    return np.floor(BANDS * np.log2(length) + 0.5).astype(np.int64)


def _padded(x: np.ndarray, b: Band, last: np.ndarray | None) -> np.ndarray:
    out = np.zeros((len(x), b.width))
    out[:, : b.dim] = x
    if last is not None and b.width > b.dim:
        out[:, b.dim] = last
    return out


def cells_of(x: np.ndarray, b: Band) -> np.ndarray:
    """The cell of each row of ``x`` in each table."""
    x = x / b.longest
    x = _padded(x, b, np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1))))
    out = []
    for t in range(TABLES):
        r = rotate(x, t)
        axis = np.abs(r).argmax(axis=1)
        out.append(b.first + 2 * b.width * t + 2 * axis + (r[np.arange(len(r)), axis] < 0))
    return np.stack(out, axis=1)


def probes_of(x: np.ndarray, b: Band, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Query numbers and the cells they probe, cells without rows left out."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    x = _padded(x / np.linalg.norm(x, axis=1, keepdims=True), b, None)
    query, cell = [], []
    for t in range(TABLES):
        r = rotate(x, t)
        order = np.argsort(-np.stack([r, -r], axis=2).reshape(len(r), -1), axis=1, kind="stable")
        order += b.first + 2 * b.width * t
        met = np.cumsum(rows[order], axis=1) - rows[order]
        use = ((np.arange(order.shape[1]) < PROBES) | (met < LEAST)) & (rows[order] > 0)
        query.append(np.nonzero(use)[0])
        cell.append(order[use])
    return np.concatenate(query), np.concatenate(cell)


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) of the vectors of each dimension in a batch."""
    v = batch.column("v")
    offsets = np.asarray(v.offsets)
    values = np.asarray(v.values)
    dims = np.diff(offsets)
    for d in np.unique(dims):
        rows = np.flatnonzero(dims == d)
        yield rows, values[offsets[rows][:, None] + np.arange(d)].astype(float)


def _place(bands: list[Band], index: Index | None, is_query: bool, rows_in: np.ndarray | None):
    """A ``mapInArrow`` function. Without an index: how many rows or probes each cell gets from this task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(bands[-1].first + 2 * bands[-1].width * TABLES, np.int64)
        for batch in batches:
            for rows, x in _vectors(batch):
                own = _band(_lengths(x))
                for b in (b for b in bands if b.dim == x.shape[1]):
                    if is_query:
                        at, cell = probes_of(x, b, rows_in)
                    else:
                        at = np.flatnonzero(own == b.band)
                        cell = cells_of(x[at], b).ravel()
                        at = np.repeat(at, TABLES)
                    if index is None:
                        total += np.bincount(cell, minlength=len(total))
                        continue
                    # own block of its kind, every block of the other
                    ids = batch.column("id").to_numpy()[rows][at]
                    mine, theirs = index.row_blocks(cell), index.probe_blocks(cell)
                    if is_query:
                        mine, theirs = theirs, mine
                    draw = (ids * 2654435761 >> 7) % mine
                    copy = np.repeat(np.arange(len(at)), theirs)
                    other = np.arange(len(copy)) - np.repeat(np.cumsum(theirs) - theirs, theirs)
                    block = other * mine[copy] + draw[copy] if is_query else draw[copy] * theirs[copy] + other
                    for c in range(0, len(copy), 10_000):
                        part = copy[c : c + 10_000]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(part), int(is_query), np.int32)), pa.array(cell[part].astype(np.int32)),
                                pa.array(block[c : c + 10_000].astype(np.int32)), pa.array(ids[part]),
                                batch.column("v").take(pa.array(rows[at[part]])),
                            ],
                            names=["kind", "cell", "block", "id", "v"],
                        )
        if index is None:
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"cell": used.astype(np.int32), "n": total[used]})

    return run


def _best(query: np.ndarray, near: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Rows of each query's ``k`` best different neighbours, best first, ties to the smaller id."""
    order = np.lexsort((near, -score, query))
    q, n = query[order], near[order]
    pair = np.lexsort((np.arange(len(q)), n, q))
    again = np.zeros(len(q), bool)
    again[pair[1:]] = (q[pair[1:]] == q[pair[:-1]]) & (n[pair[1:]] == n[pair[:-1]])
    order, q = order[~again], q[~again]
    first = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.empty(0, np.int64)
    rank = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
    return order[rank < k]


def _compare(k: int):
    def run(table: pa.Table) -> pa.Table:
        batch = table.combine_chunks().to_batches()[0]
        kind, ids = batch.column("kind").to_numpy(), batch.column("id").to_numpy()
        _, x = next(_vectors(batch))
        rows, queries = np.flatnonzero(kind == 0), np.flatnonzero(kind == 1)
        parts = [np.empty((3, 0))]
        rows = rows[np.argsort(ids[rows], kind="stable")]
        for c in range(0, len(queries) if len(rows) else 0, 256):
            own = queries[c : c + 256]
            score = x[own] @ x[rows].T
            least = np.partition(score, -k, axis=1)[:, -k] if len(rows) > k else np.full(len(own), -np.inf)
            at, near = np.nonzero(score >= least[:, None])  # more than k only where they tie
            kept = _best(at, ids[rows[near]], score[at, near], k)
            parts.append(np.stack([own[at[kept]], rows[near[kept]], score[at[kept], near[kept]]]))
        at, near, score = np.concatenate(parts, axis=1)
        return pa.table([ids[at.astype(np.int64)], ids[near.astype(np.int64)], score], schema=FOUND)

    return run


def _merge(k: int):
    def run(table: pa.Table) -> pa.Table:
        columns = [table.column(n).to_numpy() for n in ("id", "near", "score")]
        kept = _best(*columns, k)
        return pa.table([c[kept] for c in columns], schema=FOUND)

    return run


def _usable(v: Column) -> Column:
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)


def build_bands(classes: DataFrame) -> list[Band]:
    """Of the lengths in (v): one row for each dimension and band comes to the driver."""
    most = F.array_max(F.transform("v", F.abs))
    scaled = classes.select("v", most.alias("most"))
    length = F.col("most") * F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x / F.col("most") * (x / F.col("most"))))
    sizes = scaled.select(F.size("v").alias("dim"), length.alias("length"))
    band = F.floor(BANDS * F.log2("length") + 0.5).alias("band")
    found = sizes.groupBy("dim", band).agg(F.min("length").alias("shortest"), F.max("length").alias("longest")).collect()
    out, first = [], 0
    for r in sorted(found):
        level = r.shortest >= r.longest * (1 - EQUAL)
        width = 1 << max(1, (r.dim - 1 + (not level)).bit_length())
        out.append(Band(r.dim, r.band, r.longest, width, first))
        first += 2 * width * TABLES
    return out


def nearest(rows: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows with the largest inner product found for each query row."""
    v = F.col(vector).cast("array<double>")
    kept = rows.select(F.col(vec_id).cast("long").alias("id"), v.alias("v"), is_query.alias("asks"))
    kept = kept.filter(F.col("id").isNotNull() & _usable(F.col("v")))
    kept = kept.withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(1), "v")}).dropDuplicates(["id", "h1", "h2"])
    kept = stored(kept, "vectors")
    ordered = Window.partitionBy("h1", "h2").orderBy("id")
    few = kept.select("id", "h1", "h2").withColumn("n", F.row_number().over(ordered)).filter(F.col("n") <= k + 1)
    few = stored(few, "members")
    rep = few.filter("n = 1").select("id", "h1", "h2")
    asking = kept.filter("asks").select("h1", "h2").distinct()
    classes = stored(kept.drop("asks").join(rep, ["id", "h1", "h2"], "left_semi"), "classes")
    asked = classes.join(asking, ["h1", "h2"], "left_semi")

    bands = build_bands(classes)
    if not bands:
        return classes.select(
            F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")
        ).limit(0)
    sides = classes.select("id", "v"), asked.select("id", "v")
    size = bands[-1].first + 2 * bands[-1].width * TABLES

    def counted(frame: DataFrame, is_query: bool, rows_in: np.ndarray | None) -> np.ndarray:
        out = np.zeros(size, np.int64)
        found = frame.mapInArrow(_place(bands, None, is_query, rows_in), "cell int, n long")
        for cell, n in found.groupBy("cell").agg(F.sum("n")).collect():  # a row for each cell
            out[cell] = n
        return out

    in_cells = counted(sides[0], False, None)
    index = Index(bands, in_cells, counted(sides[1], True, in_cells))
    placed = [f.mapInArrow(_place(bands, index, q, in_cells), PLACED_DDL) for q, f in enumerate(sides)]
    found = placed[0].unionByName(placed[1]).groupBy("cell", "block").applyInArrow(_compare(k + 1), FOUND_DDL)
    parts = F.pmod(F.xxhash64("id"), F.lit(16 * partitions(rows.sparkSession)))
    best = stored(found.groupBy(parts.alias("part")).applyInArrow(_merge(k + 1), FOUND_DDL), "nearest")

    # classes back to rows: the first k + 1 of each asking class, then every query without itself
    reps = rep.select(F.col("id").alias("rep"), "h1", "h2")
    members = few.join(reps, ["h1", "h2"]).select(F.col("rep").alias("near"), F.col("id").alias("vec_id"))
    by_class = Window.partitionBy("class").orderBy(F.desc("score"), "vec_id")
    listed = best.withColumnRenamed("id", "class").join(members, "near").select("class", "vec_id", "score")
    listed = listed.withColumn("n", F.row_number().over(by_class)).filter(F.col("n") <= k + 1)
    queries = kept.filter("asks").select(F.col("id").alias("query_id"), "h1", "h2").join(reps, ["h1", "h2"])
    answers = queries.select("query_id", F.col("rep").alias("class")).join(listed, "class").filter("query_id <> vec_id")
    answers = answers.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = answers.withColumn("rank", F.row_number().over(by_query)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
