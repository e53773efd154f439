"""Row counts and value ranges of Parquet files from their footers: no column is read."""

from __future__ import annotations

from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerkit.functions.text import quoted

#: Types whose footer statistics are the values themselves: text is cut short there, and floats leave NaN out.
EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)


def _footer_session(spark: SparkSession) -> SparkSession:
    """A session of its own whose Parquet scans answer aggregates from statistics; the caller's stays as it is."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


def _facts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    ranges = [f(quoted(c)).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    return df.agg(F.count("*").alias("row_count"), *ranges)


def footer_plan(spark: SparkSession, path: str, columns: Iterable[str]) -> DataFrame:
    """The aggregation that the footers answer, in a session of its own."""
    return _facts(_footer_session(spark).read.parquet(path), columns)


def footer_facts(spark: SparkSession, path: str, columns: Iterable[str] = ()) -> DataFrame:
    """One row: ``row_count``, and ``min_`` and ``max_`` of each column.

    Columns of other types, and files without statistics, are read; all else comes from the footers.
    """
    table, columns = spark.read.parquet(path), list(columns)
    exact = [c for c in columns if isinstance(table.schema[c].dataType, EXACT)]
    read = [c for c in columns if c not in exact]
    wanted = _facts(table, columns)
    try:
        row = footer_plan(spark, path, exact).first().asDict()
    except (PySparkException, Py4JJavaError):  # a file without statistics
        row = _facts(table, exact).first().asDict()
    if read:
        row |= _facts(table, read).first().asDict()
    return spark.createDataFrame([tuple(row[c] for c in wanted.columns)], wanted.schema)
