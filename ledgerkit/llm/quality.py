"""Document quality by a generalised additive model with pairwise interactions.

Features of the whole text are cut into bins. Cyclic boosting visits one feature after another, fits a shallow tree to
the current errors and adds it to that feature's lookup table; then the pairs of features with most left to explain get
tables of their own in the same way. A score is a sum of looked-up values, read for a whole batch at once.

Fitting uses a bounded sample: ``max_rows`` labelled rows, chosen by a hash of their id. Everything else is distributed.

Cases: empty and null texts are scored like any other, with all features zero; labels that are null, other than 0 and 1,
or contradict each other for one ``doc_id`` are not used; without usable labels every score is 0.5; rows that repeat a
``doc_id`` are scored each by its own text; a null ``doc_id`` is scored and counts as not held out; other columns of the
input are kept, those named like the result's are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerkit.llm.columns import on_plain_names, settle
from ledgerkit.llm.words import IS_SPACE, buffers, shingles, text_slices, words

FEATURES = (
    "log_bytes", "log_words", "word_length", "upper", "digits", "marks", "non_ascii", "exclamations", "bars", "commas",
    "stops", "other_marks", "capital_words", "shouted_words", "short_words", "long_words", "distinct_words",
    "distinct_trigrams", "top_word", "log_lines", "line_length", "distinct_lines", "marks_at_line_end", "spaces",
    "slashes",
)
MAX_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 8
ROUNDS, PAIR_ROUNDS, RATE, LEAVES, RIDGE = 150, 60, 0.15, 4, 5.0

_code = np.arange(256)
UPPER = (_code >= 0x41) & (_code <= 0x5A)
DIGIT = (_code >= 0x30) & (_code <= 0x39)
LETTER = UPPER | ((_code >= 0x61) & (_code <= 0x7A)) | (_code >= 0x80)
MARK = ~(LETTER | DIGIT | IS_SPACE)
START = (_code < 0x80) | (_code >= 0xC0)


def _per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(mask)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _distinct(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many different values each text has, and how often its most frequent one occurs."""
    different, top = np.zeros(len(bounds) - 1), np.zeros(len(bounds) - 1)
    for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        if b > a:
            own = np.sort(values[a:b])
            new = np.flatnonzero(own[1:] != own[:-1]) + 1
            runs = np.diff(np.concatenate([[0], new, [b - a]]))
            different[i], top[i] = len(runs), runs.max()
    return different, top


def features(texts: pa.Array) -> np.ndarray:
    """A row of FEATURES for each text."""
    data, offsets = buffers(texts)
    found = words(data, offsets)
    size = np.diff(offsets).astype(float)
    n = np.diff(found.bounds).astype(float)
    per = lambda table: _per_text(table[data], offsets)
    of = lambda code: _per_text(data == code, offsets)
    share = lambda x, y: np.divide(x, y, out=np.zeros(len(size)), where=y > 0)
    letters, upper, spaces = per(LETTER), per(UPPER), per(IS_SPACE)
    marks, exclamations, bars, commas, stops, slashes = per(MARK), of(0x21), of(0x7C), of(0x2C), of(0x2E), of(0x2F)
    chars = per(START)

    ends = np.append(found.at[1:], len(data)) if len(found.at) else found.at
    solid = np.concatenate([[0], np.cumsum(~IS_SPACE[data])])
    capitals = np.concatenate([[0], np.cumsum(UPPER[data])])
    length = solid[ends] - solid[found.at]
    caps = capitals[ends] - capitals[found.at]
    by_word = lambda mask: _per_text(mask, found.bounds)
    first = UPPER[data[found.at]] if len(data) else np.empty(0, bool)
    word_kinds, top = _distinct(found.hashes, found.bounds)
    grams, gram_bounds = shingles(found, 3)
    gram_kinds, _ = _distinct(grams, gram_bounds)

    # lines: words between line ends, as one hash each
    new_line = np.concatenate([[0], np.cumsum(data == 0x0A)])
    line_of = new_line[found.at]
    text_of = np.repeat(np.arange(len(n)), n.astype(np.int64))
    begins = np.ones(len(found.at), bool)
    begins[1:] = (np.diff(line_of) != 0) | (np.diff(text_of) != 0)
    at = np.flatnonzero(begins)
    place = np.arange(len(found.at)) - np.repeat(at, np.diff(np.append(at, len(found.at)))) if len(at) else at
    weighted = found.hashes * (place.astype(np.uint64) * np.uint64(2) + np.uint64(1))
    lines = np.add.reduceat(weighted, at) if len(at) else np.empty(0, np.uint64)
    line_bounds = np.searchsorted(at, found.bounds)
    n_lines = np.diff(line_bounds).astype(float)
    line_kinds, _ = _distinct(lines, line_bounds)
    closing = MARK[data[np.maximum(found.at + length - 1, 0)]] if len(data) else np.empty(0, bool)
    last = np.append(begins[1:], True) if len(begins) else begins

    columns = (
        np.log1p(size), np.log1p(n), share(chars - spaces, n), share(upper, letters), share(per(DIGIT), chars),
        share(marks, chars), share(size - chars, size), share(exclamations, n), share(bars, n), share(commas, n),
        share(stops, n), share(marks - exclamations - bars - commas - stops, n), share(by_word(first), n),
        share(by_word((caps >= 2) & (2 * caps >= length)), n), share(by_word(length <= 2), n),
        share(by_word(length >= 12), n), share(word_kinds, n), share(gram_kinds, np.diff(gram_bounds).astype(float)),
        share(top, n), np.log1p(n_lines), share(n, n_lines), share(line_kinds, n_lines),
        share(_per_text(last & closing, found.bounds), n_lines), share(spaces, size), share(slashes, n),
    )
    return np.stack(columns, axis=1)


class Model(NamedTuple):
    """``edges[f]`` cut feature f into the bins of ``tables[f]``; ``pairs`` (f, g, table) use every fourth edge."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]


def _bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, f], "right") for f, e in enumerate(edges)], axis=1)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """A shallow regression tree over ordered bins from their gradients and weights: a value for each bin."""
    gain = lambda a, b: g[a:b].sum() ** 2 / (h[a:b].sum() + RIDGE)
    spans = [(0, len(g))]
    while len(spans) < leaves:
        best = (1e-9, None, None)
        for a, b in spans:
            gs, hs = np.cumsum(g[a:b]), np.cumsum(h[a:b])
            left = gs[:-1] ** 2 / (hs[:-1] + RIDGE) + (gs[-1] - gs[:-1]) ** 2 / (hs[-1] - hs[:-1] + RIDGE)
            if len(left) and (most := left.max() - gain(a, b)) > best[0]:
                best = (most, (a, b), a + 1 + int(left.argmax()))
        if best[1] is None:
            break
        spans.remove(best[1])
        spans += [(best[1][0], best[2]), (best[2], best[1][1])]
    out = np.zeros(len(g))
    for a, b in spans:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """A tree of depth two over a grid: one cut of each axis, chosen together; its values and its gain."""
    gs, hs = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (g, h))
    i, j = np.meshgrid(np.arange(1, len(g)), np.arange(1, len(g)), indexing="ij")
    corner = lambda s: (s[i, j], s[i, -1] - s[i, j], s[-1, j] - s[i, j], s[-1, -1] - s[i, -1] - s[-1, j] + s[i, j])
    gq, hq = corner(gs), corner(hs)
    gain = sum(a**2 / (b + RIDGE) for a, b in zip(gq, hq, strict=True))
    a, b = np.unravel_index(int(gain.argmax()), gain.shape)
    value = [(x / (y + RIDGE))[a, b] for x, y in zip(gq, hq, strict=True)]
    out = np.empty_like(g)
    out[: a + 1, : b + 1], out[: a + 1, b + 1 :], out[a + 1 :, : b + 1], out[a + 1 :, b + 1 :] = value
    return out, float(gain.max())


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """``x``: rows of features; ``y``: 0 or 1."""
    prior = np.clip(y.mean(), 1e-3, 1 - 1e-3) if len(y) else 0.5
    intercept = float(np.log(prior / (1 - prior)))
    if not 0 < (y.mean() if len(y) else 0) < 1:
        return Model(intercept, [np.empty(0)] * x.shape[1], [np.zeros(1)] * x.shape[1], [])
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    bins = _bins(x, edges)
    tables = [np.zeros(len(e) + 1) for e in edges]
    score = np.full(len(y), intercept)

    def errors() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-score))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f, table in enumerate(tables):
            if len(table) == 1:
                continue
            g, h = errors()
            step = RATE * _tree(
                np.bincount(bins[:, f], g, len(table)), np.bincount(bins[:, f], h, len(table)), LEAVES
            )
            table += step
            score += step[bins[:, f]]

    coarse = bins // (BINS // PAIR_BINS)
    cells = {(f, k): coarse[:, f] * PAIR_BINS + coarse[:, k] for f in range(x.shape[1]) for k in range(f)}

    def grid(cell: np.ndarray) -> tuple[np.ndarray, float]:
        g, h = errors()
        return _pair_tree(*(np.bincount(cell, v, PAIR_BINS**2).reshape(PAIR_BINS, -1) for v in (g, h)))

    chosen = sorted(cells, key=lambda p: -grid(cells[p])[1])[:PAIRS]
    pairs = [(f, k, np.zeros((PAIR_BINS, PAIR_BINS))) for f, k in chosen]
    for _ in range(PAIR_ROUNDS):
        for f, k, table in pairs:
            step = RATE * grid(cells[f, k])[0]
            table += step
            score += step.ravel()[cells[f, k]]
    return Model(intercept, edges, tables, pairs)


def score(model: Model, x: np.ndarray) -> np.ndarray:
    bins = _bins(x, model.edges)
    total = np.full(len(x), model.intercept)
    for f, table in enumerate(model.tables):
        total += table[bins[:, f]]
    for f, k, table in model.pairs:
        total += table[bins[:, f] // (BINS // PAIR_BINS), bins[:, k] // (BINS // PAIR_BINS)]
    return 1 / (1 + np.exp(-total))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        x = features(batch.column("text"))
        values = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([batch.column("label"), values], names=["label", "x"])


def _score_rows(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        s = score(model, features(batch.column("text")))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s)], names=[*batch.schema.names, "score"])


def held_out(doc_id: Column | str) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS) -> Model:
    """Fit on the ``labels`` (doc_id, ``label``) that are not held out and whose texts are in ``docs``."""
    labels = settle(labels, ["doc_id", label])
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.filter("label in (0, 1) and doc_id is not null").filter(~held_out("doc_id"))
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
    known = known.filter("label = other").select(F.col("doc_id").alias("known_id"), "label")
    chosen = known.orderBy(F.xxhash64("known_id"), "known_id").limit(max_rows)  # max_rows narrow rows: may be broadcast
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("known_id")).select("doc_id", "label", "text")
    found = rows.mapInArrow(_feature_rows, "label int, x array<double>").orderBy("label", "x").toPandas()
    x = np.array(found["x"].tolist(), float).reshape(-1, len(FEATURES))
    return fit(x, found["label"].to_numpy(float))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with a column ``score``: how likely each text is good, 0 to 1."""

    def run(kept: DataFrame) -> DataFrame:
        schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType())])
        return kept.mapInArrow(partial(_score_rows, model=model), schema)

    return on_plain_names(docs, ["text"], ["score"], run)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_rows: int = MAX_ROWS) -> DataFrame:
    """``docs`` with held_out, score and predicted (1: good), instead of columns of these names in any case."""

    def run(rows: DataFrame) -> DataFrame:
        scored = score_documents(rows, train(rows, labels, max_rows=max_rows))
        return scored.withColumns(
            {"held_out": held_out("doc_id"), "predicted": (F.col("score") >= threshold).cast("int")}
        )

    return on_plain_names(docs, ["doc_id", "text"], ["score", "held_out", "predicted"], run)
