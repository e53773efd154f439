"""Referential integrity between a parent and a child table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerkit.operators.membership import split_by_filter
from ledgerkit.operators.project import quoted


def _unmatched(rows: DataFrame, others: DataFrame, key: str) -> DataFrame:
    """Rows whose key the other side lacks. Its keys are made distinct before they move, on the same
    column the join uses, so one shuffle serves both. Rows without a key match nothing: they go round the
    join, and never meet in one task. Every column of ``rows`` is read: select those wanted beforehand."""
    keys = others.filter(quoted(key).isNotNull()).select(quoted(key)).distinct()
    keyed = rows.filter(quoted(key).isNotNull()).join(keys, key, "left_anti").select(*map(quoted, rows.columns))
    return keyed.unionAll(rows.filter(quoted(key).isNull()))


def _unmatched_by_filter(rows: DataFrame, others: DataFrame, key: str, filter_bytes: int) -> DataFrame:
    """The same with a Bloom filter of the other keys first: only rows that may have a match move to the join."""
    parts = split_by_filter(rows, others, key, filter_bytes)
    if parts is None:
        return _unmatched(rows, others, key)
    suspects, missing = parts
    keys = others.filter(quoted(key).isNotNull()).select(quoted(key)).distinct()
    return missing.unionAll(suspects.join(keys, key, "left_anti").select(*map(quoted, rows.columns)))


def anti_parents(parents: DataFrame, children: DataFrame, key: str, filter_bytes: int = 0) -> DataFrame:
    """Parent rows no child refers to. With ``filter_bytes``, a filter up to that size keeps certain rows from moving."""
    return _unmatched_by_filter(parents, children, key, filter_bytes) if filter_bytes else _unmatched(parents, children, key)


def anti_orphans(children: DataFrame, parents: DataFrame, key: str, filter_bytes: int = 0) -> DataFrame:
    """Child rows whose parent does not exist; a null key is an orphan. ``filter_bytes`` as in ``anti_parents``."""
    return _unmatched_by_filter(children, parents, key, filter_bytes) if filter_bytes else _unmatched(children, parents, key)


def key_balance(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """One row: rows and distinct keys on both sides, orphaned children, childless parents.

    Both anti joins come out of one grouping of the keys of both tables: counts per key are combined
    before the only shuffle, so a key that holds a large share of the rows travels as a few counters.
    Null keys match nothing on either side.
    """
    sides = parents.select(quoted(key).alias("key"), F.lit(1).alias("p"), F.lit(0).alias("c")).unionAll(
        children.select(quoted(key).alias("key"), F.lit(0).alias("p"), F.lit(1).alias("c"))
    )
    return _balance_of(sides.groupBy("key").agg(F.sum("p").alias("p"), F.sum("c").alias("c")))


def key_balance_in_place(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """``key_balance`` of two tables that are bucketed alike by ``key``: counted and joined where the rows lie."""
    p = parents.groupBy(quoted(key).alias("key")).agg(F.count("*").alias("p"))
    c = children.groupBy(quoted(key).alias("key")).agg(F.count("*").alias("c"))
    both = p.join(c.withColumnRenamed("key", "child_key"), F.col("key") == F.col("child_key"), "full_outer")
    return _balance_of(
        both.select(
            F.coalesce("key", "child_key").alias("key"),
            F.coalesce("p", F.lit(0)).alias("p"),
            F.coalesce("c", F.lit(0)).alias("c"),
        )
    )


def _balance_of(per_key: DataFrame) -> DataFrame:
    """One row from rows on both sides per key; null keys match nothing."""
    known = F.col("key").isNotNull()

    def total(column: str, condition=None):
        value = F.col(column) if condition is None else F.when(condition, F.col(column))
        return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")

    return per_key.agg(
        total("p").alias("total_parents"),
        total("c").alias("total_children"),
        F.count(F.when(known & (F.col("p") > 0), F.lit(1))).alias("parent_keys"),
        F.count(F.when(known & (F.col("c") > 0), F.lit(1))).alias("child_keys"),
        total("c", ~known | (F.col("p") == 0)).alias("orphans"),
        total("p", ~known | (F.col("c") == 0)).alias("childless"),
    )


def with_match_rates(balance: DataFrame) -> DataFrame:
    """Matched rows and their share in percent on both sides; an empty side counts as 0."""
    parents, children = F.col("total_parents"), F.col("total_children")
    matched_parents, matched_children = parents - F.col("childless"), children - F.col("orphans")

    def rate(matched, all_rows):
        return F.when(all_rows > 0, matched / all_rows * 100).otherwise(F.lit(0.0))

    return balance.withColumns(
        {
            "matched_parents": matched_parents,
            "matched_children": matched_children,
            "parent_match_pct": rate(matched_parents, parents),
            "child_match_pct": rate(matched_children, children),
        }
    )


def with_integrity_status(balance: DataFrame) -> DataFrame:
    """PASS: everything matches. WARNING: only childless parents. FAIL: orphaned children."""
    status = (
        F.when(F.col("orphans") > 0, F.lit("FAIL"))
        .when(F.col("childless") > 0, F.lit("WARNING"))
        .otherwise(F.lit("PASS"))
    )
    return balance.withColumn("integrity_status", status)


def with_count_parity(balance: DataFrame) -> DataFrame:
    """PASS when both tables have the same number of rows. It says nothing about the keys."""
    same = F.col("total_parents") == F.col("total_children")
    return balance.withColumn("count_parity", F.when(same, F.lit("PASS")).otherwise(F.lit("FAIL")))


def count_parity(parents: DataFrame, children: DataFrame) -> DataFrame:
    """Row counts of both tables and the parity verdict; no column is read."""
    sides = parents.select(F.lit(1).alias("p"), F.lit(0).alias("c")).unionAll(
        children.select(F.lit(0).alias("p"), F.lit(1).alias("c"))
    )
    totals = sides.agg(
        F.coalesce(F.sum("p"), F.lit(0)).cast("bigint").alias("total_parents"),
        F.coalesce(F.sum("c"), F.lit(0)).cast("bigint").alias("total_children"),
    )
    return with_count_parity(totals)
