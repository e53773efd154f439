"""Column profiles. Each is one aggregation pass over the columns it names."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerkit.functions.text import is_blank, strip_time
from ledgerkit.operators.project import quoted, stitch_single_rows

# The date layouts tried side by side.
TWO_DIGIT_HOUR = "d/MM/yyyy HH:mm:ss"
ANY_HOUR = "d/MM/yyyy H:mm:ss"
DAY_ONLY = "d/MM/yyyy"
MIDNIGHT = " 0:00:00"


def _count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def _as_rows(wide: DataFrame, name: str, value: str) -> DataFrame:
    return wide.unpivot([], [quoted(c) for c in wide.columns], name, value)


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column that has nulls, with their number."""
    wide = df.agg(*[_count_if(quoted(c).isNull()).alias(c) for c in df.columns])
    return _as_rows(wide, "column_name", "null_count").filter(F.col("null_count") > 0)


def key_null_profile(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Nulls in each key column of a typed table; absent columns are left out."""
    present = [c for c in keys if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], "column_name string, null_count bigint")
    wide = df.agg(*[_count_if(quoted(c).isNull()).alias(c) for c in present])
    return _as_rows(wide, "column_name", "null_count")


def blank_key_profile(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Null or blank values in each key column of a text table; absent columns are left out."""
    present = [c for c in keys if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], "column_name string, blank_count bigint")
    wide = df.agg(*[_count_if(is_blank(quoted(c))).alias(c) for c in present])
    return _as_rows(wide, "column_name", "blank_count")


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(quoted(column).isNull())


def value_range(df: DataFrame, column: str) -> DataFrame:
    """Smallest and largest value; text columns compare as text."""
    return df.agg(F.min(quoted(column)).alias("min_value"), F.max(quoted(column)).alias("max_value"))


def distinct_counts(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Exact distinct non-null values (output name to column), as one row.

    Several distinct counts in one aggregation would copy every row once per column and shuffle the
    copies at full width. One narrow aggregation per column reads and moves that column alone, which
    suits columnar tables; its parts run side by side.
    """
    return stitch_single_rows(*[df.agg(F.countDistinct(quoted(c)).alias(name)) for name, c in columns.items()])


#: Fixed value: keys of one bitmap.
BITMAP_KEYS = 32_768
#: Bytes a bitmap may cost for each row before plain distinct counting moves less.
BITMAP_BYTES_PER_ROW = 16


def key_bitmaps(df: DataFrame, columns: Iterable[str], group: Mapping[str, Column] | None = None) -> DataFrame:
    """Integer keys as bitmaps: one row for each column, group and bucket of BITMAP_KEYS keys, from one scan.

    Rows of tasks are merged by bucket, so what moves is bounded by the buckets in use, not by the rows. The frame may
    be stored and merged with that of a later load (``merge_bitmaps``).
    """
    group, columns = dict(group or {}), list(columns)
    values = F.array(*[F.struct(F.lit(c).alias("column_name"), quoted(c).cast("bigint").alias("key")) for c in columns])
    keys = df.select(*[c.alias(n) for n, c in group.items()], F.inline(values)).filter(F.col("key").isNotNull())
    place = [F.bitmap_bucket_number("key").alias("bucket"), F.bitmap_bit_position("key").alias("place")]
    placed = keys.select(*group, "column_name", *place)
    return placed.groupBy(*group, "column_name", "bucket").agg(F.bitmap_construct_agg("place").alias("bitmap"))


def merge_bitmaps(*loads: DataFrame) -> DataFrame:
    """The bitmaps of several loads as those of all their rows."""
    merged = reduce(DataFrame.unionByName, loads)
    return merged.groupBy(*[c for c in merged.columns if c != "bitmap"]).agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def count_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """Distinct keys for each column and group."""
    names = [c for c in bitmaps.columns if c not in ("bitmap", "bucket")]
    return bitmaps.groupBy(*names).agg(F.sum(F.bitmap_count("bitmap")).alias("distinct_count"))


def dense_columns(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """The integer columns whose bitmaps are worth their bytes, by range and rows: one narrow pass."""
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    columns = [c for c in columns if isinstance(df.schema[c].dataType, whole)]
    if not columns:
        return []
    facts = [f(quoted(c).cast("bigint")).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("a", F.min), ("b", F.max))]
    row = df.agg(F.count("*").alias("n"), *facts).first()
    allowed = row["n"] * BITMAP_BYTES_PER_ROW + BITMAP_KEYS
    spans = {c: row[f"b{i}"] - row[f"a{i}"] for i, c in enumerate(columns) if row[f"a{i}"] is not None}
    return [c for c, span in spans.items() if span // 8 <= allowed]


def distinct_counts_dense(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """``distinct_counts`` with all dense integer columns in one scan by bitmaps; the rest as there."""
    dense = set(dense_columns(df, dict.fromkeys(columns.values())))
    frames = []
    if dense:
        counts = count_bitmaps(key_bitmaps(df, sorted(dense)))
        of = {n: F.max(F.when(F.col("column_name") == c, F.col("distinct_count"))) for n, c in columns.items() if c in dense}
        frames.append(counts.agg(*[F.coalesce(v, F.lit(0)).cast("bigint").alias(n) for n, v in of.items()]))
    if rest := {n: c for n, c in columns.items() if c not in dense}:
        frames.append(distinct_counts(df, rest))
    return stitch_single_rows(*frames).select(*[quoted(n) for n in columns])


def parse_failures(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Values lost in parsing or linking, one row per watched column, with a verdict."""
    counts = key_null_profile(df, columns)
    verdict = F.when(F.col("null_count") > 0, F.lit("WARNING")).otherwise(F.lit("OK"))
    return counts.withColumn("status", verdict)


def date_trial(value: Column) -> Mapping[str, Column]:
    """The ways a date text could be read, by name."""
    return {
        "two_digit_hour": F.try_to_date(value, TWO_DIGIT_HOUR),
        "any_hour": F.try_to_date(value, ANY_HOUR),
        "timestamp_any_hour": F.try_to_timestamp(value, F.lit(ANY_HOUR)).cast("date"),
        "strip_then_day": F.try_to_date(strip_time(value), DAY_ONLY),
        "strip_midnight_then_day": F.try_to_date(F.replace(value, F.lit(MIDNIGHT), F.lit("")), DAY_ONLY),
    }


def date_trial_columns(df: DataFrame, column: str) -> DataFrame:
    """The original text next to each reading of it."""
    value = quoted(column)
    return df.select(value.alias("original"), *[c.alias(name) for name, c in date_trial(value).items()])


def date_format_trial(df: DataFrame, column: str) -> DataFrame:
    """How many values each reading parses, over the whole column."""
    parsed = date_trial_columns(df, column)
    methods = [c for c in parsed.columns if c != "original"]
    return _as_rows(parsed.agg(*[F.count(m).alias(m) for m in methods]), "method", "parsed")


def raw_length_profile(df: DataFrame, column: str) -> DataFrame:
    """How long the raw values are: one row per length, with an example value."""
    each = df.groupBy(quoted(column).alias("value")).agg(F.count("*").alias("rows"))  # hashed: no row is sorted
    by_length = each.groupBy(F.length("value").cast("bigint").alias("length"))
    return by_length.agg(F.sum("rows").alias("row_count"), F.min("value").alias("example"))
