"""Delimited files as all-text DataFrames, and repair of a damaged first header name."""

from __future__ import annotations

import unicodedata
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerkit.functions.text import quoted
from ledgerkit.sources.split_scan import read_split
from ledgerkit.spec import Dialect

# Characters a misread byte-order mark or encoding leaves around a name.
DAMAGE = "\ufeff\ufffd\u00ef\u00bb\u00bf\u00fe\u00ff"
# Rows of whole files are spread where one file holds more than this part of the bytes, or than the shares of so many
# cores: with less, moving all rows takes longer than the task that reads the largest file.
SPREAD_PART, SPREAD_CORES = 0.5, 4
# Rows that stay together when they are spread, as a power of two.
RUN_BITS = 10


def header_names(spark: SparkSession, path: str | list[str], dialect: Dialect) -> list[str]:
    """The column names of the header record, as written.

    Spark renames repeated names (``Id`` becomes ``Id0`` and ``Id2``), which hides a real defect, so
    the record is read as data and repetitions raise. One record reaches the driver.
    """
    options = dialect.read_options() | {"header": "false"}
    record = spark.read.options(**options).csv(path).first()
    if record is None:
        raise ValueError(f"no header record in {path}")
    names = [name if name else f"_c{i}" for i, name in enumerate(record)]
    repeated = [name for name, n in Counter(names).items() if n > 1]
    if repeated:
        raise ValueError(f"repeated column names {repeated} in the header of {path}")
    return names


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    dialect: Dialect | None = None,
    *,
    columns: list[str] | None = None,
    reject_column: str | None = None,
    rebalance: bool = False,
) -> DataFrame:
    """Read files as text columns named by ``columns`` or by their header.

    Short rows are padded with nulls and long rows cut; ``reject_column`` receives the text of every
    such row and is null elsewhere. Columns go by position, so all files of one load must carry the same
    header; this is checked unless a name is empty.

    A multi-line file is one task unless ``dialect.split`` is set. ``rebalance`` spreads the rows right
    after the scan, before any parsing, where such files are too few or too uneven to keep all cores busy; the
    files' lengths tell (``uneven_files``).
    """
    dialect = dialect or Dialect()
    names = columns or header_names(spark, path, dialect)
    same_header = dialect.header and not columns and not any(n == f"_c{i}" for i, n in enumerate(names))
    if dialect.split:
        return read_split(spark, path, dialect, names, reject_column, same_header)
    fields = [*names, reject_column] if reject_column else names
    reader = (
        spark.read.options(**dialect.read_options())
        .option("enforceSchema", str(not same_header).lower())
        .schema(T.StructType([T.StructField(name, T.StringType()) for name in fields]))
    )
    if reject_column:
        reader = reader.option("columnNameOfCorruptRecord", reject_column)
    df = reader.csv(path)
    return spread(df) if rebalance and (not dialect.multiline or uneven_files(spark, path)) else df


def uneven_files(spark: SparkSession, path: str | list[str]) -> bool:
    """Whether one file holds so much that its task would keep the others waiting. No file is opened."""
    length = F.col("length")
    sizes = spark.read.format("binaryFile").load(path).agg(F.max(length).alias("largest"), F.sum(length).alias("total"))
    row, cores = sizes.first(), spark.sparkContext.defaultParallelism
    return (row["largest"] or 0) > (row["total"] or 0) * min(SPREAD_PART, SPREAD_CORES / cores)


def spread(df: DataFrame) -> DataFrame:
    """The rows of a scan dealt to all tasks, in runs that stay together.

    Runs are dealt by their number, which a task that is run again gives them again. Round robin would sort each task's
    rows for that, and a whole file seldom fits the memory: its rows would go to disk once more.
    """
    run = "__run" + "_" * max(map(len, df.columns))  # longer than any name of the file
    dealt = df.withColumn(run, F.shiftright(F.monotonically_increasing_id(), RUN_BITS))
    return dealt.hint("rebalance", run).drop(run)


def _undamaged(name: str) -> str:
    kept = "".join(c for c in name if c not in DAMAGE and unicodedata.category(c) != "Cc")
    return kept.strip()


def repair_header(df: DataFrame, key: str, mode: str = "strict") -> DataFrame:
    """Give the first column its name back when an encoding defect damaged it.

    ``strict`` acts only on a name that reads ``key`` once stray marks and spaces are taken off: it is
    renamed, or dropped when an intact ``key`` exists as well. Nulls inside names mean the file was
    read with the wrong encoding and raise. ``legacy`` treats any other first name as a damaged key.
    """
    if mode not in ("strict", "legacy"):
        raise ValueError(f"unknown repair mode {mode!r}")
    first, rest = df.columns[0], df.columns[1:]
    if mode == "strict":
        garbled = [name for name in df.columns if "\x00" in name]
        if garbled:
            raise ValueError(f"NUL characters in column names {garbled}: set Dialect.encoding, e.g. UTF-16")
        damaged = first != key and _undamaged(first) == key
    else:
        damaged = first.strip() != key
    if not damaged:
        return df
    return df.drop(quoted(first)) if key in rest else df.withColumnRenamed(first, key)
