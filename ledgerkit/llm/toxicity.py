"""Toxicity by a classifier chain: linear models of the categories in turn, each seeing the earlier ones' probabilities.

Fitting uses a bounded sample: ``max_rows`` labelled rows, chosen by a hash of their id. Features are counts of telling
words: words are first counted in shared counters, by label; words of the promising counters are then counted one by
one, and the TERMS that tell the first category best stay. While the models train, a later category sees earlier
probabilities from models that have not seen the row (FOLDS folds), as it will when scoring.

The labels know one flag. The second category, ``severe``, is derived from it on training rows: toxic rows with at
least SEVERE_HITS uses of words found mostly in toxic rows. Any other 0/1 columns may be given as categories instead.

Cases: empty and null texts are scored with no words; labels that are null, not 0 or 1, or contradict each other for
one ``doc_id`` are not used; with no usable label of one kind the probability is that label's share (0.5 without any);
rows that repeat a ``doc_id`` are scored each by its own text; other columns are kept, those named like a category's
probability are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerkit.llm.columns import on_plain_names, settle
from ledgerkit.llm.quality import held_out
from ledgerkit.llm.scratch import stored
from ledgerkit.llm.words import IS_MARK, Words, buffers, text_slices, words

MAX_ROWS, TERMS, LEAST_ROWS = 40_000, 128, 5
#: Squared deviations by which a word must differ from the labels' shares: rarer words pass it by chance otherwise.
LEAST_TELLING = 45
COUNTERS, PROMISING, CHUNK = 1 << 18, 4096, 1 << 14
FOLDS, STEPS, RIDGE = 5, 300, 1e-3
SEVERE_HITS, MOSTLY = 3, 0.8


class Linear(NamedTuple):
    weights: np.ndarray
    bias: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -40, 40)))


class Chain(NamedTuple):
    """``terms``: sorted word hashes; ``links``: a model for each category, in the order they are predicted."""

    categories: tuple[str, ...]
    terms: np.ndarray
    links: list[Linear]

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        x = inputs(counts)
        for link in self.links:
            x = np.column_stack([x, link(x)])
        return x[:, x.shape[1] - len(self.links) :]


def inputs(counts: np.ndarray) -> np.ndarray:
    return np.log1p(counts)


def fit_linear(x: np.ndarray, y: np.ndarray) -> Linear:
    """Ridge logistic regression by accelerated gradient steps."""
    share = y.mean() if len(y) else 0.5
    if not 0 < share < 1 or not x.size:
        edge = min(max(share, 1e-6), 1 - 1e-6)
        return Linear(np.zeros(x.shape[1]), float(np.log(edge / (1 - edge))))
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale == 0] = 1
    z, y = ((x - mean) / scale).astype(np.float32), y.astype(np.float32)
    step = float(1 / (0.25 * (np.linalg.eigvalsh(z.T @ z / len(z))[-1] + 1) + RIDGE))
    w, b = np.zeros(x.shape[1], np.float32), float(np.log(share / (1 - share)))
    before, at_w, at_b, t = (w, b), w, b, 1.0
    for _ in range(STEPS):
        error = 1 / (1 + np.exp(-np.clip(z @ at_w + at_b, -40, 40))) - y
        w, b = at_w - step * (z.T @ error / len(z) + RIDGE * at_w), at_b - step * float(error.mean())
        w = w.astype(np.float32)
        later = float((1 + np.sqrt(1 + 4 * t * t)) / 2)
        at_w, at_b = w + (t - 1) / later * (w - before[0]), b + (t - 1) / later * (b - before[1])
        before, t = (w, b), later
    return Linear(w / scale, float(b - (w * mean / scale).sum()))


def fit_chain(categories: tuple[str, ...], terms: np.ndarray, counts: np.ndarray, y: np.ndarray) -> Chain:
    """``counts``: uses of each term; ``y``: 0 or 1 for each category."""
    x, links = inputs(counts), []
    fold = np.arange(len(x)) % FOLDS
    for c in range(len(categories)):
        links.append(fit_linear(x, y[:, c]))
        unseen = np.zeros(len(x))
        for f in range(FOLDS):
            out = fold == f
            unseen[out] = fit_linear(x[~out], y[~out, c])(x[out])
        x = np.column_stack([x, unseen])
    return Chain(categories, terms, links)


def _read(batch: pa.RecordBatch) -> Words:
    return words(*buffers(batch.column("text")), ends=IS_MARK)


def _own_terms(found: Words) -> tuple[np.ndarray, np.ndarray]:
    """Every text's distinct words: the hash and the number of the text."""
    text = np.repeat(np.arange(len(found.bounds) - 1), np.diff(found.bounds))
    order = np.lexsort((found.hashes, text))
    h, t = found.hashes[order], text[order]
    new = np.append(True, (h[1:] != h[:-1]) | (t[1:] != t[:-1]))[: len(h)]
    return h[new], t[new]


def _counter(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(17)).astype(np.int64) % COUNTERS


def _count_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((COUNTERS, 2))
    for batch in text_slices(batches):
        h, text = _own_terms(_read(batch))
        label = batch.column("label").to_numpy()[text]
        for k in (0, 1):
            total[:, k] += np.bincount(_counter(h[label == k]), minlength=COUNTERS)
    parts = total.astype(np.float32).reshape(COUNTERS // CHUNK, -1)
    yield pa.RecordBatch.from_pydict({"chunk": np.arange(len(parts), dtype=np.int32), "part": [p.tobytes() for p in parts]})


def _add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(x, np.float32).astype(float) for x in rows["part"])
    return pd.DataFrame({"chunk": [key[0]], "total": [total.tobytes()]})


def _count_terms(batches: Iterator[pa.RecordBatch], promising: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        h, text = _own_terms(_read(batch))
        use = promising[_counter(h)]
        h, label = h[use], batch.column("label").to_numpy()[text[use]]
        term, which = np.unique(h, return_inverse=True)
        yield pa.RecordBatch.from_pydict(
            {
                "term": term.view(np.int64), "clean": np.bincount(which[label == 0], minlength=len(term)),
                "toxic": np.bincount(which[label == 1], minlength=len(term)),
            }
        )


def telling(clean: np.ndarray, toxic: np.ndarray, n_clean: float, n_toxic: float) -> np.ndarray:
    """How far the rows with a word are from the labels' shares, in squared deviations."""
    n, share = clean + toxic, n_toxic / max(n_clean + n_toxic, 1)
    spread = n * share * (1 - share)
    return np.divide((toxic - n * share) ** 2, spread, out=np.zeros(len(n)), where=spread > 0)


def choose_terms(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the words that tell best, from (label, text) rows; which are found mostly in toxic rows."""
    sizes = dict(rows.groupBy("label").count().collect())
    n_clean, n_toxic = float(sizes.get(0, 0)), float(sizes.get(1, 0))
    tasks = 2 * rows.sparkSession.sparkContext.defaultParallelism
    parts = rows.coalesce(tasks).mapInArrow(_count_shared, "chunk int, part binary")
    total = np.zeros((COUNTERS // CHUNK, 2 * CHUNK))
    for chunk, data in parts.groupBy("chunk").applyInPandas(_add, "chunk int, total binary").collect():  # COUNTERS numbers
        total[chunk] = np.frombuffer(data)
    total = total.reshape(COUNTERS, 2)
    score = telling(total[:, 0], total[:, 1], n_clean, n_toxic)
    promising = np.zeros(COUNTERS, bool)
    promising[np.argsort(-score, kind="stable")[:PROMISING]] = True
    each = rows.mapInArrow(partial(_count_terms, promising=promising), "term long, clean long, toxic long")
    each = each.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    n, share = F.col("clean") + F.col("toxic"), n_toxic / max(n_clean + n_toxic, 1)
    spread = n * max(share * (1 - share), 1e-9)
    each = each.filter(n >= LEAST_ROWS).withColumn("score", F.pow(F.col("toxic") - n * share, F.lit(2)) / spread)
    best = each.filter(F.col("score") >= LEAST_TELLING).orderBy(F.desc("score"), "term").limit(TERMS).toPandas()
    terms = best["term"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(terms)
    odds = best["toxic"].to_numpy(float) / max(n_toxic, 1)
    mostly = odds > MOSTLY * (odds + best["clean"].to_numpy(float) / max(n_clean, 1))
    return terms[order], mostly[order]


def term_counts(batch: pa.RecordBatch, terms: np.ndarray) -> np.ndarray:
    """Uses of each term in each text."""
    found = _read(batch)
    if not len(terms):
        return np.zeros((batch.num_rows, 0))
    place = np.minimum(np.searchsorted(terms, found.hashes), len(terms) - 1)
    hit = np.flatnonzero(terms[place] == found.hashes)
    text = np.searchsorted(found.bounds, hit, "right") - 1
    return np.bincount(text * len(terms) + place[hit], minlength=batch.num_rows * len(terms)).reshape(-1, len(terms))


def _training_rows(batches: Iterator[pa.RecordBatch], terms: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        counts = term_counts(batch, terms).astype(np.float32)
        rows = [r.tobytes() for r in counts]
        yield pa.RecordBatch.from_pydict({"known_id": batch.column("known_id"), "y": batch.column("y"), "x": rows})


def _score(batches: Iterator[pa.RecordBatch], chain: Chain) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        p = chain(term_counts(batch, chain.terms))
        names = [*batch.schema.names, *(f"p_{c}" for c in chain.categories)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c) for c in p.T)], names=names)


def train(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...] = ("toxic",), severe: bool = True,
          max_rows: int = MAX_ROWS) -> Chain:
    """A chain over 0/1 columns of ``labels`` (doc_id, ...), and ``severe`` after them; held-out ids are left out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), *(F.col(c).cast("int").alias(c) for c in categories))
    usable = F.lit(True)
    for c in categories:
        usable &= F.col(c).isin(0, 1)
    known = known.filter(usable & F.col("doc_id").isNotNull()).filter(~held_out("doc_id"))
    y = F.struct(*categories)
    known = known.groupBy("doc_id").agg(F.min(y).alias("y"), F.max(y).alias("other")).filter("y = other")
    known = known.select(F.col("doc_id").alias("known_id"), F.array(*(f"y.{c}" for c in categories)).alias("y"))
    known = F.broadcast(known.orderBy(F.xxhash64("known_id"), "known_id").limit(max_rows))  # max_rows narrow rows
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stored(texts.join(known, F.col("doc_id") == F.col("known_id")).select("known_id", "y", "text"), "labelled")
    terms, mostly = choose_terms(rows.select(F.col("y")[0].alias("label"), "text"))

    found = rows.mapInArrow(partial(_training_rows, terms=terms), "known_id long, y array<int>, x binary").toPandas()
    found = found.sort_values(["known_id", "x"], kind="stable")
    counts = np.array([np.frombuffer(x, np.float32) for x in found["x"]], float).reshape(len(found), len(terms))
    target = np.array(found["y"].tolist(), float).reshape(len(found), len(categories))
    if severe:
        hits = counts[:, mostly].sum(axis=1)
        target = np.column_stack([target, target[:, 0] * (hits >= SEVERE_HITS)])
        categories = (*categories, "severe")
    return fit_chain(tuple(categories), terms, counts, target)


def toxic_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.2) -> DataFrame:
    """The ``docs`` whose probability of being toxic reaches ``threshold``, with the probabilities of all categories.

    Toxic rows are rare and told by few words: clean ones come out far below this threshold.
    """
    rows = settle(docs, ["doc_id", "text"])
    return score_toxicity(rows, train(rows, settle(labels, ["doc_id", "toxic"]))).filter(F.col("p_toxic") >= threshold)


def score_toxicity(docs: DataFrame, chain: Chain) -> DataFrame:
    """``docs`` with a probability ``p_<category>`` for each category of the chain."""
    names = [f"p_{c}" for c in chain.categories]

    def run(kept: DataFrame) -> DataFrame:
        schema = T.StructType([*kept.schema.fields, *(T.StructField(n, T.DoubleType()) for n in names)])
        return kept.mapInArrow(partial(_score, chain=chain), schema)

    return on_plain_names(docs, ["text"], names, run)
