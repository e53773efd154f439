"""Rows whose key another table surely lacks, told by a Bloom filter without moving them.

The filter is a Spark aggregate: every key sets a few bits of one 64-bit word, words are combined before they move, and the
whole filter is one row, read as a scalar. It is used only while its size, which follows from the number of keys, stays
below a limit; beyond it the rows take the join alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerkit.operators.project import quoted

#: Bits for each key and bits it sets in its word: some two in a hundred absent keys are taken for present.
BITS_PER_KEY, BITS_SET = 16, 4
#: Largest filter, in bytes: what Spark broadcasts by default.
FILTER_BYTES = 10 << 20


def filter_words(keys: int) -> int:
    """The size of a filter for so many keys: a power of two."""
    return max(1 << 6, 1 << (keys * BITS_PER_KEY // 64).bit_length())


def _word_and_bits(key: Column, words: int) -> tuple[Column, Column]:
    drawn = F.xxhash64(key, F.lit(1))
    one = F.lit(1).cast("bigint")
    bits = [
        F.call_function("shiftleft", one, F.shiftright(drawn, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
        for i in range(BITS_SET)
    ]
    return F.pmod(F.xxhash64(key), F.lit(words)), reduce(Column.bitwiseOR, bits)


def key_filter(keys: DataFrame, key: str, words: int) -> DataFrame:
    """One row: the filter's words, in order, for the keys of ``keys``."""
    word, bits = _word_and_bits(quoted(key), words)
    set_bits = keys.filter(quoted(key).isNotNull()).select(word.alias("word"), bits.alias("bits"))
    empty = keys.sparkSession.range(words).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    combined = set_bits.unionAll(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    ordered = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return combined.agg(F.transform(ordered, lambda w: w["bits"]).alias("words"))


def might_hold(held: Column, key: Column, words: int) -> Column:
    """Whether the filter ``held`` may have ``key``; false is certain."""
    word, bits = _word_and_bits(key, words)
    return F.get(held, word.cast("int")).bitwiseAND(bits) == bits


def split_by_filter(
    rows: DataFrame, others: DataFrame, key: str, filter_bytes: int = FILTER_BYTES
) -> tuple[DataFrame, DataFrame] | None:
    """``rows`` that may have their key in ``others``, and those that surely have not (null keys among them).

    None where a filter of the other keys would be larger than ``filter_bytes``: their number is estimated by one narrow
    pass. The two parts read ``rows`` once each.
    """
    keys = others.agg(F.approx_count_distinct(quoted(key), 0.02)).first()[0]
    words = filter_words(max(1, keys))
    if words * 8 > filter_bytes:
        return None
    held = key_filter(others, key, words).scalar()
    present = F.coalesce(might_hold(held, quoted(key), words) & quoted(key).isNotNull(), F.lit(False))
    return rows.filter(present), rows.filter(~present)
