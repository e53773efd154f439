"""Benchmark passages in documents, also paraphrased ones, by latent semantic retrieval.

Documents are cut into blocks of BLOCK words; two neighbouring blocks are a passage, so every span of BLOCK words lies
whole in one. Terms are hashed words weighted by TF-IDF over all blocks of the corpus. One distributed pass counts the
blocks of each term and sketches the block matrix A for a randomised SVD: every task adds up its rows' share of A'(A W)
for a random W, and the decomposition of that small sum gives the right singular vectors. (The pass knows no IDF yet:
D A'A W, with the weights D, is the sketch of the weighted matrix A D by the random matrix W over D.) Passages and
items are folded into the space; their cosine is reported and chooses between passages that match equally well. It
drops no pair: in so few dimensions even some verbatim copies lie below any useful threshold.

All passages are candidates whose surroundings hold as many words of the item and its answer, in any order, as a match
has; no match fails that. Of these, the longest common subsequence of the item's words and the passage with its
surroundings decides, together with the item's answer: its last sentence.

An item matches if SURE of its words occur in order, or LIKELY of them with ANSWER of its answer. Items longer than
SEGMENT words are searched in segments that overlap by half. Words are compared without ASCII marks, A-Z lower-cased.

Cases: empty and null texts match nothing, as documents and as items; a null ``item_id`` is kept in the matches; rows
that repeat a ``doc_id`` are searched each by its own text; other columns are kept, one named ``matches`` is replaced;
empty documents or an empty benchmark give no matches. The benchmark is collected: it is a test set, not a corpus.
"""

from __future__ import annotations

import re
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
from ledgerkit.llm.words import IS_MARK, Words, buffers, text_slices, words

BLOCK, SEGMENT = 32, 64
TERMS, RANK = 1 << 13, 64
SURE, LIKELY, ANSWER, LEAST_ANSWER = 0.65, 0.55, 0.8, 4
#: Words in more than this share of the blocks of the most frequent term are common: counted later than the rarer ones.
COMMON = 0.06
#: Items and passages compared at once, and terms summed by one task.
ITEMS_AT_ONCE, PASSAGES_AT_ONCE, CHUNK = 256, 16_000, 128

MATCH_DDL = "array<struct<item_id:long,words:int,common:int,answer_common:int,cosine:double>>"
MATCH = pa.list_(
    pa.struct(
        [("item_id", pa.int64()), ("words", pa.int32()), ("common", pa.int32()), ("answer_common", pa.int32()),
         ("cosine", pa.float64())]
    )
)


class Blocks(NamedTuple):
    """Where each block's words begin, the bounds of each text's blocks, and every word's term."""

    at: np.ndarray
    bounds: np.ndarray
    terms: np.ndarray


def blocks_of(found: Words) -> Blocks:
    n = np.diff(found.bounds)
    counts = -(-n // BLOCK)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    index = np.arange(bounds[-1]) - np.repeat(bounds[:-1], counts)
    at = np.repeat(found.bounds[:-1], counts) + BLOCK * index
    return Blocks(at, bounds, (found.hashes >> np.uint64(20)).astype(np.int64) % TERMS)


def _read(texts: pa.Array) -> Words:
    return words(*buffers(texts), ends=IS_MARK)


def _fold(b: Blocks, space: np.ndarray) -> np.ndarray:
    """The sum of each block's rows of ``space``."""
    padded = np.concatenate([space, np.zeros((1, space.shape[1]), np.float32)])
    place = b.at[:, None] + np.arange(BLOCK)
    ends = np.append(b.at[1:], len(b.terms))[:, None]
    index = np.where(place < ends, np.append(b.terms, 0)[np.minimum(place, len(b.terms))], len(space))
    out = np.zeros((len(b.at), space.shape[1]), np.float32)
    for column in index.T:
        out += padded[column]
    return out


def _random() -> np.ndarray:
    return np.random.default_rng(20).standard_normal((TERMS, RANK)).astype(np.float32)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """This task's share of A'(A W), and in the last column in how many blocks each term occurs; in rows of CHUNK terms."""
    random, total = _random(), np.zeros((RANK + 1, TERMS))
    for batch in text_slices(batches):
        b = blocks_of(_read(batch.column("text")))
        block = np.repeat(np.arange(len(b.at)), np.diff(np.append(b.at, len(b.terms))))
        rows = np.ascontiguousarray(_fold(b, random).T)
        for i, row in enumerate(rows):
            total[i] += np.bincount(b.terms, row[block], TERMS)
        own = np.sort(block * TERMS + b.terms)
        total[-1] += np.bincount(own[np.append(True, own[1:] != own[:-1])[: len(own)]] % TERMS, minlength=TERMS)
    parts = total.T.astype(np.float32).reshape(TERMS // CHUNK, -1)
    yield pa.RecordBatch.from_pydict({"chunk": np.arange(len(parts), dtype=np.int32), "part": [r.tobytes() for r in parts]})


def _add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(CHUNK * (RANK + 1))
    for data in rows["part"]:
        total += np.frombuffer(data, np.float32)
    return pd.DataFrame({"chunk": [key[0]], "total": [total.tobytes()]})


class Space(NamedTuple):
    """``fold``: a row for each term, weighted; blocks' sums of rows lie in the latent space. ``common``: by term."""

    fold: np.ndarray
    common: np.ndarray


def latent_space(docs: DataFrame) -> Space:
    """Weights and right singular vectors (over their singular values) of the corpus."""
    tasks = 2 * docs.sparkSession.sparkContext.defaultParallelism  # partial sums for each core, not for each file
    parts = docs.select("text").coalesce(tasks).mapInArrow(_sketch, "chunk int, part binary")
    out = np.zeros((TERMS // CHUNK, CHUNK * (RANK + 1)))
    for chunk, total in parts.groupBy("chunk").applyInPandas(_add, "chunk int, total binary").collect():  # TERMS rows
        out[chunk] = np.frombuffer(total)
    return decompose(out.reshape(TERMS, -1))


def decompose(sums: np.ndarray) -> Space:
    sketch, often = sums[:, :-1], sums[:, -1]
    weight = np.log((1 + often.max(initial=0)) / (1 + often)) + 0.1
    common = often > COMMON * often.max(initial=0)
    core = _random().astype(float).T @ sketch
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    kept = values > max(values.max(initial=0), 0) * 1e-9
    if not kept.any():
        return Space(np.zeros((TERMS, RANK), np.float32), common)
    half = weight[:, None] * sketch @ (vectors[:, kept] / np.sqrt(values[kept]))  # half @ half.T is nearly D A'A D
    right, singular, _ = np.linalg.svd(half, full_matrices=False)
    strong = singular > singular[0] * 1e-6
    return Space((weight[:, None] * right[:, strong] / singular[strong]).astype(np.float32), common)


class Items(NamedTuple):
    """Segments of the benchmark: ids, word hashes, and how many of their words come before the answer."""

    ids: list[int | None]
    hashes: list[np.ndarray]
    stems: list[int]


def read_items(benchmark: DataFrame) -> Items:
    out = Items([], [], [])
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).collect()
    for item_id, text in rows:
        if not text:
            continue
        found = _read(pa.array([text])).hashes
        sentences = [x for x in re.split(r"[.!?\n]+", text) if len(_read(pa.array([x])).hashes)]
        answer = len(_read(pa.array(sentences[-1:])).hashes) if len(sentences) > 1 else 0
        end = max(0, len(found) - SEGMENT)  # the last segment ends at the item's end
        for a in [*range(0, end, SEGMENT // 2), end] if len(found) else []:
            part = found[a : a + SEGMENT]
            out.ids.append(item_id)
            out.hashes.append(part)
            out.stems.append(int(np.clip(len(found) - answer - a, 0, len(part))))
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, size, out=np.zeros_like(x), where=size > 0)


def _enough(common: np.ndarray, answer: np.ndarray, n: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Whether ``common`` of ``n`` words, ``answer`` of them among the ``wanted`` ones of the answer, make a match."""
    return (common >= SURE * n) | ((common >= LIKELY * n) & (wanted >= LEAST_ANSWER) & (answer >= ANSWER * wanted))


class Search:
    """The benchmark folded into the latent space, ready to meet passages."""

    def __init__(self, items: Items, space: Space) -> None:
        self.items, self.space = items, space
        n = np.array([len(h) for h in items.hashes])
        self.n, self.wanted = n, n - np.array(items.stems)
        self.answers = np.array([(1 << int(k)) - (1 << stem) for k, stem in zip(n, items.stems, strict=True)], np.uint64)
        vectors, self.groups = [], []
        for a in range(0, len(n), ITEMS_AT_ONCE):
            of = items.hashes[a : a + ITEMS_AT_ONCE]
            size = np.concatenate([[0], np.cumsum([len(h) for h in of])])
            b = blocks_of(Words(np.concatenate(of), size, size[:-1]))
            rows = np.concatenate([[np.zeros(space.fold.shape[1])], np.cumsum(_fold(b, space.fold), axis=0, dtype=float)])
            vectors.append(rows[b.bounds[1:]] - rows[b.bounds[:-1]])
            known = np.unique(np.concatenate(of))
            rare = ~space.common[(known >> np.uint64(20)).astype(np.int64) % TERMS]
            bits = np.zeros((len(of), len(known) + 1), np.uint64)  # where an item has a word; the last: unknown words
            for i, h in enumerate(of):
                np.bitwise_or.at(bits[i], np.searchsorted(known, h), np.uint64(1) << np.arange(len(h), dtype=np.uint64))
            if_rare = np.bitwise_count(np.bitwise_or.reduce(np.where(rare, bits[:, :-1], 0), axis=1))
            rare_needed = LIKELY * n[a : a + len(of)] - (n[a : a + len(of)] - if_rare)  # if all its common words are there
            word, item = np.nonzero(bits.T)
            owners = item, np.searchsorted(word, np.arange(len(known) + 2))
            self.groups.append((a, a + len(of), known, bits, rare, rare_needed, owners))
        self.vectors = _unit(np.concatenate(vectors)).astype(np.float32)

    def passages(self, found: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unit vectors of the passages, their texts, and where their words begin."""
        b = blocks_of(found)
        rows = _fold(b, self.space.fold)
        text = np.repeat(np.arange(len(b.bounds) - 1), np.diff(b.bounds))
        more = np.zeros(len(text), bool)
        more[:-1] = text[1:] == text[:-1]
        only = np.diff(b.bounds)[text] == 1
        whole = np.flatnonzero(more | only)
        both = rows[whole] + np.where(more[whole, None], rows[np.minimum(whole + 1, max(len(rows) - 1, 0))], 0)
        return _unit(both), text[whole], b.at[whole]

    def run(self, texts: pa.Array) -> list[list[dict]]:
        found = _read(texts)
        vectors, text, begin = self.passages(found)
        best: list[dict] = [{} for _ in range(len(texts))]
        lo = np.maximum(begin - BLOCK, found.bounds[text])
        hi = np.minimum(begin + 3 * BLOCK, found.bounds[text + 1])
        for a, b, known, bits, rare, rare_needed, of in self.groups:
            place = np.minimum(np.searchsorted(known, found.hashes), len(known) - 1)
            word = np.where(known[place] == found.hashes, place, len(known))
            telling = np.flatnonzero(np.append(rare, False)[word])  # places of the items' rarer words
            for c in range(0, len(begin), PASSAGES_AT_ONCE):
                shape = min(PASSAGES_AT_ONCE, len(begin) - c), b - a
                passage, item = np.nonzero(self._in_common(lo[c:], hi[c:], telling, word, of, shape) >= rare_needed)
                enough = self._may_match(lo[c + passage], hi[c + passage], word, bits, item, a)
                p, i = passage[enough], item[enough]
                around = begin[c + p][:, None] + np.arange(-BLOCK, 3 * BLOCK)
                inside = (around >= lo[c + p][:, None]) & (around < hi[c + p][:, None])
                seen = np.where(inside, word[np.where(inside, around, 0)], len(known))
                cosine = (vectors[c + p] * self.vectors[a + i]).sum(axis=1)
                self._decide(best, text[c + p], i + a, bits[i[:, None], seen], cosine)
        return [sorted(x.values(), key=lambda m: (m["item_id"] is None, m["item_id"])) for x in best]

    @staticmethod
    def _in_common(lo: np.ndarray, hi: np.ndarray, telling: np.ndarray, word: np.ndarray, of: tuple, shape: tuple) -> np.ndarray:
        """By passage and item: how many places around the passage have one of the item's rarer words."""
        lo, hi = lo[: shape[0]], hi[: shape[0]]
        if not len(lo):
            return np.zeros(shape, np.int64)
        items, begin = of
        place = telling[np.searchsorted(telling, lo[0]) : np.searchsorted(telling, hi[-1])]
        first, last = np.searchsorted(hi, place, "right"), np.searchsorted(lo, place, "right")
        n = begin[word[place] + 1] - begin[word[place]]
        event = np.repeat(np.arange(len(place)), n)
        item = items[np.arange(len(event)) - np.repeat(np.cumsum(n) - n, n) + begin[word[place]][event]]
        total = np.zeros(shape[0] * shape[1], np.int64)
        for k in range(int((last - first).max(initial=0))):
            held = (first + k < last)[event]
            total += np.bincount((first[event] + k)[held] * shape[1] + item[held], minlength=len(total))
        return total.reshape(shape)

    def _may_match(self, lo: np.ndarray, hi: np.ndarray, word: np.ndarray, bits: np.ndarray, item: np.ndarray, a: int) -> np.ndarray:
        """Whether the words from ``lo`` to ``hi``, in any order, are enough: those in order are never more."""
        out = np.zeros(len(item), bool)
        for k in range(0, len(item), PASSAGES_AT_ONCE):
            of, first, last = item[k : k + PASSAGES_AT_ONCE], lo[k : k + PASSAGES_AT_ONCE], hi[k : k + PASSAGES_AT_ONCE]
            covered = np.zeros(len(of), np.uint64)
            for step in range(int((last - first).max())):
                covered |= bits[of, word[np.minimum(first + step, last - 1)]]
            common, answer = np.bitwise_count(covered), np.bitwise_count(covered & self.answers[a + of])
            out[k : k + len(of)] = _enough(common, answer, self.n[a + of], self.wanted[a + of])
        return out

    def _decide(self, best: list[dict], text: np.ndarray, item: np.ndarray, hits: np.ndarray, cosine: np.ndarray) -> None:
        v = np.full(len(text), ~np.uint64(0))
        for step in hits.T:  # a zero bit: one more word in common up to that word of the item
            u = v & step
            v = (v + u) | (v - u)
        n = self.n[item].astype(np.uint64)
        stem = np.array([self.items.stems[i] for i in item], np.uint64)
        low = lambda k: np.where(k >= 64, ~np.uint64(0), (np.uint64(1) << np.minimum(k, np.uint64(63))) - np.uint64(1))
        common = np.bitwise_count(~v & low(n)).astype(np.int64)
        answer = common - np.bitwise_count(~v & low(stem)).astype(np.int64)
        wanted = (n - stem).astype(np.int64)
        for k in np.flatnonzero(_enough(common, answer, n.astype(np.int64), wanted)):
            item_id = self.items.ids[item[k]]
            new = {"item_id": item_id, "words": int(n[k]), "common": int(common[k]), "answer_common": int(answer[k]),
                   "cosine": float(cosine[k])}
            old = best[text[k]].get(item_id)
            if old is None or (new["common"] / new["words"], new["cosine"]) > (old["common"] / old["words"], old["cosine"]):
                best[text[k]][item_id] = new


def _search(batches: Iterator[pa.RecordBatch], search) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        found = search.value.run(batch.column("text")) if search else [[]] * batch.num_rows
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, MATCH)], names=[*batch.schema.names, "matches"])


def find_matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with ``matches``: for each benchmark item that a text holds, its words and how many are in common."""
    spark = docs.sparkSession

    def run(kept: DataFrame) -> DataFrame:
        items, search = read_items(settle(benchmark, ["item_id", "text"])), None
        if items.ids:
            search = spark.sparkContext.broadcast(Search(items, latent_space(kept)))
        schema = T.StructType([*kept.schema.fields, T.StructField("matches", T._parse_datatype_string(MATCH_DDL))])
        return kept.mapInArrow(partial(_search, search=search), schema)

    return on_plain_names(docs, ["text"], ["matches"], run)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without those that hold a benchmark item."""
    return find_matches(docs, benchmark).filter(F.size("matches") == 0).drop("matches")
