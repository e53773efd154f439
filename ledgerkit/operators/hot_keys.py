"""Join keys that hold a large share of the rows: found by a mergeable sketch, spread over several tasks."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerkit.functions.text import quoted

#: Keys a sketch reports, and keys it tracks: one that holds more than 1/TRACKED of the rows is never missed.
REPORTED, TRACKED = 64, 4096
#: Rows a task may get of one key before it is worth spreading.
FEW_ROWS = 100_000
#: Pieces cut of a key for each task's fair share: the more, the evener they fall.
PIECES = 4

Hot = Mapping[Any, int]


def frequent_values(column: Column) -> Column:
    """An aggregate: the most frequent values with their counts, roughly. Sketches of tasks are merged."""
    return F.call_function("approx_top_k", column, F.lit(REPORTED), F.lit(TRACKED))


def spread_over(frequent: Iterable[tuple[Any, int]], rows: int, tasks: int, few_rows: int = FEW_ROWS) -> Hot:
    """The keys with more rows than a task's fair share, and in how many pieces to cut each."""
    fair = max(rows / max(tasks, 1), few_rows)
    return {v: min(math.ceil(PIECES * n / fair), PIECES * tasks) for v, n in frequent if v is not None and n > fair}


def join_tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def find_hot(df: DataFrame, column: str, few_rows: int = FEW_ROWS) -> Hot:
    """One narrow pass over ``column``; a few rows reach the driver."""
    known = df.select(quoted(column).alias("value")).filter(F.col("value").isNotNull())
    row = known.agg(F.count("*").alias("n"), frequent_values(F.col("value")).alias("top")).first()
    return spread_over([(x["item"], x["count"]) for x in row["top"] or []], row["n"], join_tasks(df), few_rows)


def _copies(key: Column, hot: Hot) -> Column:
    if not hot:
        return F.lit(1)
    table = F.create_map(*[F.lit(x) for pair in hot.items() for x in pair])
    return F.coalesce(F.try_element_at(table, key), F.lit(1))


def salted(df: DataFrame, key: str, hot: Hot, salt: str) -> DataFrame:
    """``df`` with a column that spreads the rows of each hot key, and those without a key, which match nothing.

    The salt comes of the row and the task that reads it, so a task that is run again gives the same one.
    """
    each = F.abs(F.xxhash64(F.spark_partition_id(), *[quoted(c) for c in df.columns]) % F.lit(1 << 31))
    tasks = F.lit(join_tasks(df))
    value = F.when(quoted(key).isNull(), each % tasks)
    if hot:
        value = value.when(quoted(key).isin(list(hot)), each % _copies(quoted(key), hot))
    return df.withColumn(salt, value.otherwise(F.lit(0)).cast("int"))


def copied(df: DataFrame, key: str, hot: Hot, salt: str) -> DataFrame:
    """``df`` with the rows of each hot key once for every salt they may meet; all others stay single."""
    if not hot:
        # always 0; a plain constant would leave the join's keys, and rows without a key would meet in one task again
        return df.withColumn(salt, (F.xxhash64(quoted(key)) % F.lit(1)).cast("int"))
    return df.withColumn(salt, F.explode(F.sequence(F.lit(0), _copies(quoted(key), hot) - 1)))
