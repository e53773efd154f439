"""Distribution reports, samples and table summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerkit.operators.profile import distinct_counts
from ledgerkit.operators.project import quoted, stitch_single_rows


def _year(date_column: str) -> Column:
    return F.year(quoted(date_column)).cast("bigint").alias("year")


def count_by_year(df: DataFrame, date_column: str) -> DataFrame:
    dated = df.filter(quoted(date_column).isNotNull())
    return dated.groupBy(_year(date_column)).agg(F.count("*").alias("row_count")).orderBy("year")


def agg_by_year(df: DataFrame, date_column: str, distinct_column: str) -> DataFrame:
    """Rows and distinct values per year.

    Spark first reduces to (year, value) pairs, so a year holding most rows is spread by value.
    """
    dated = df.filter(quoted(date_column).isNotNull())
    return (
        dated.groupBy(_year(date_column))
        .agg(F.count("*").alias("row_count"), F.countDistinct(quoted(distinct_column)).alias("distinct_count"))
        .orderBy("year")
    )


def count_by_category(df: DataFrame, column: str) -> DataFrame:
    return df.filter(quoted(column).isNotNull()).groupBy(quoted(column)).agg(F.count("*").alias("row_count"))


def top_categories(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The ``k`` most frequent values; equal counts are ordered by value."""
    return count_by_category(df, column).orderBy(F.desc("row_count"), quoted(column)).limit(k)


def sample_rows(df: DataFrame, n: int = 5, order_by: list[str] | None = None) -> DataFrame:
    """``n`` rows: the first ones found, or with ``order_by`` always the same ones."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def parent_summary(df: DataFrame, date_column: str, distinct: dict[str, str]) -> DataFrame:
    """Row count, date range and distinct counts (output name to column), as one row."""
    totals = df.agg(
        F.count("*").alias("total_parents"),
        F.min(quoted(date_column)).alias("min_date"),
        F.max(quoted(date_column)).alias("max_date"),
    )
    return stitch_single_rows(totals, distinct_counts(df, distinct))


def child_stats(df: DataFrame, key: str, quantity: str, tax: str, start: str, end: str) -> DataFrame:
    """Row count, distinct parents, quantity total, mean tax rate and date span, as one row."""
    totals = df.agg(
        F.count("*").alias("total_children"),
        F.sum(quoted(quantity)).alias("total_quantity"),
        F.avg(quoted(tax)).alias("avg_tax"),
        F.min(quoted(start)).alias("min_start"),
        F.max(quoted(end)).alias("max_end"),
    )
    return stitch_single_rows(totals, distinct_counts(df, {"distinct_parents": key}))
