"""Spelling variants of a corpus's words: words one edit apart, by partition-and-enumerate signatures.

A word's letters are a binary vector: one dimension for every letter and how often it has occurred before in the word
(all of a letter's dimensions lie in one part).
One inserted, deleted or replaced code point changes at most two dimensions. The dimensions are dealt over PARTS parts,
so two near words agree on all parts but two at most: each word sends a signature for every choice of PARTS - 2 parts.
Anagrams share every signature, so a signature also names half of the word: with one edit, the first half of the shorter
word or the rest of it stays as it is. Signatures are equi-joined and the pairs verified inside the join, by their
whole words.

Cases: a null text has no words; a null ``doc_id`` reads as an empty name in the checksum; long texts and words are
taken whole; repeated rows count each; an empty table gives no words; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerkit.llm.columns import settle
from ledgerkit.llm.pieces import ranges
from ledgerkit.llm.scratch import partitions, stored
from ledgerkit.llm.words import LOWER, buffers, text_slices

#: Parts of a word's letters. More parts give fewer false pairs and more rows: n (n - 1) / 2 signatures.
PARTS = 4
#: Bytes of a run beyond which its checksum is taken by itself.
LONG_RUN = 64
#: Fixed value: one in so many runs loses a code point.
ALTERED = 31

LETTER = np.array([chr(c).isascii() and chr(c).isalpha() for c in range(256)])
LEAD = 0xC3  # its two-byte characters are U+00C0 to U+00FF


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


CRC = _crc_table()


def checksums(data: np.ndarray, at: np.ndarray, size: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """CRC-32 of each run of bytes, continuing the checksum ``seed``."""
    out = np.empty(len(at), np.uint32)
    long = np.flatnonzero(size > LONG_RUN)
    out[long] = [zlib.crc32(data[at[i] : at[i] + size[i]], int(seed[i])) for i in long.tolist()]
    order = np.argsort(-size, kind="stable")[len(long) :]
    first, state = at[order], ~seed[order]
    active = np.searchsorted(-size[order], -np.arange(LONG_RUN + 1), "left")  # runs longer than j come first
    for n, j in zip(active.tolist(), range(LONG_RUN), strict=False):
        if not n:
            break
        s = state[:n]
        state[:n] = CRC[(s ^ data[first[:n] + j]) & np.uint32(0xFF)] ^ (s >> np.uint32(8))
    out[order] = ~state
    return out


def runs_of(texts: pa.Array, names: list[str], min_chars: int) -> pa.Array:
    """The words of whole texts, with at least ``min_chars`` code points; altered where the checksum says so."""
    data, offsets = buffers(texts)
    lead = data == LEAD
    inside = LETTER[data] | lead
    inside[1:] |= lead[:-1]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = inside & ~(np.concatenate([[False], inside[:-1]]) & ~edge[:-1])
    stops = inside & ~(np.concatenate([inside[1:], [False]]) & ~edge[1:])
    at, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    n_chars = chars[end] - chars[at]
    enough = n_chars >= min_chars
    at, end, n_chars = at[enough], end[enough], n_chars[enough]
    low, size = LOWER[data], end - at
    seeds = np.array([zlib.crc32(f"{name}:".encode()) for name in names], np.uint32)
    crc = checksums(low, at, size, seeds[np.searchsorted(offsets, at, "right") - 1])
    struck = crc % ALTERED == 0
    rest = ~struck
    bounds = np.concatenate([[0], np.cumsum(size[rest])])
    whole = low[ranges(at[rest], size[rest])].tobytes()
    words = pa.Array.from_buffers(
        pa.large_string(), int(rest.sum()), [None, pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(whole)]
    )
    altered = []
    for i in np.flatnonzero(struck & (n_chars > min_chars)).tolist():
        word, gone = low[at[i] : end[i]].tobytes().decode(), int(crc[i]) % int(n_chars[i])
        altered.append(word[:gone] + word[gone + 1 :])
    return pa.concat_arrays([words, pa.array(altered, pa.large_string())])


def count_words(docs: DataFrame, min_chars: int = 7, min_count: int = 2) -> DataFrame:
    """(word, n) of all whole texts of ``docs`` (doc_id, text). Counts are combined before they move."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            names = ["" if x is None else x for x in batch.column("doc_id").to_pylist()]
            found = pc.value_counts(runs_of(batch.column("text"), names, min_chars))
            yield pa.RecordBatch.from_arrays([found.field("values").cast(pa.string()), found.field("counts")], ["word", "n"])

    rows = settle(docs, ["doc_id", "text"]).select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    counted = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= min_count)


def signatures(words: DataFrame) -> DataFrame:
    """(word, n, key, longer): a row for each way in which a near word may agree.

    The letters lie in PARTS parts, by code point. A near word differs in two of them at most, so the other parts are
    equal for some choice of two; and it keeps the first half of the shorter word, or the rest. A word's row is for near
    words that are as long or longer, or, if ``longer``, for those that are shorter by one.
    """
    chars, size = F.array_sort(F.split("word", "")), F.char_length("word")

    def part(number: int) -> Column:
        return F.array_join(F.filter("chars", lambda c: F.ascii(c) % PARTS == number), "")

    split_up = words.select("word", "n", chars.alias("chars"), size.alias("size")).select(
        "word", "n", "size", *[part(i).alias(f"part{i}") for i in range(PARTS)]
    )
    rows = []
    for gone in combinations(range(PARTS), 2):
        kept = [F.col(f"part{i}") for i in range(PARTS) if i not in gone]
        for longer in (0, 1):
            shorter = F.col("size") - longer
            half = F.floor(shorter / 2).cast("int")
            for side, text in enumerate((F.left("word", half), F.right("word", shorter - half))):
                key = F.xxhash64(F.lit(f"{gone} {side}"), shorter, *kept, text)
                rows.append(F.struct(key.alias("key"), F.lit(bool(longer)).alias("longer")))
    return split_up.select("word", "n", F.inline(F.array(*rows)))


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best): how many of ``words`` (word, n) are one edit from a word, and the most frequent of them.

    ``best`` is (minus its n, the word), so that the smallest of them is the most frequent, ties to the smaller word.
    """
    # counted words are few and lie in few files; a row for each of their signatures is work for all tasks
    rows = signatures(words.select("word", "n").repartition(partitions(words.sparkSession), "word"))
    a, b = rows.alias("a"), rows.alias("b")
    meets = (F.col("a.key") == F.col("b.key")) & ~F.col("a.longer") & (F.col("b.longer") | (F.col("a.word") < F.col("b.word")))
    pairs = a.join(b, meets & (F.levenshtein("a.word", "b.word", 1) == 1)).select(
        F.inline(
            F.array(
                F.struct(F.col("a.word").alias("word"), F.col("b.word").alias("other"), F.col("b.n").alias("other_n")),
                F.struct(F.col("b.word").alias("word"), F.col("a.word").alias("other"), F.col("a.n").alias("other_n")),
            )
        )
    )  # a pair that shares several keys comes several times
    best = F.struct((-F.col("other_n")).alias("minus_n"), "other")
    return pairs.groupBy("word").agg(F.count_distinct("other").alias("n_near"), F.min(best).alias("best"))


def last_forms(forms: DataFrame, hops: int) -> DataFrame:
    """(word, root) from (word, form): forms followed to the last by pointer doubling, ``hops`` steps at most."""
    roots = forms.select("word", F.col("form").alias("root"))
    reached = 1
    while reached < hops:
        roots = stored(roots, "roots")
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        roots = roots.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root"))
        reached *= 2
    return roots


def spelling_variants(docs: DataFrame, min_chars: int = 7, min_count: int = 2, times: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``docs`` (doc_id, text).

    ``form``: the near word of largest n if that is ``times`` the word's own or more. A form is so much more frequent
    than its word that a chain of forms is no longer than the logarithm of the largest count.
    """
    if times < 2:
        raise ValueError("a form must be at least twice as frequent as its word")
    words = stored(count_words(docs, min_chars, min_count), "words")
    near, n = near_words(words), F.col("n")
    chosen = -F.col("best.minus_n") >= n * times
    judged = words.join(near, "word", "left").select(
        "word", n, F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(chosen, F.col("best.other")).alias("form"), F.when(chosen, -F.col("best.minus_n")).alias("form_n"),
    )
    judged = stored(judged, "variants")
    most, hops = judged.agg(F.max("n")).first()[0] or 0, 0
    while min_count * times ** (hops + 1) <= most:
        hops += 1
    roots = last_forms(judged.filter(F.col("form").isNotNull()), hops)
    found = judged.join(roots, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
