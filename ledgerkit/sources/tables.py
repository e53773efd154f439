"""Catalog tables: scan, description, overwrite with bounded files, and what was written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerkit.operators.project import quoted
from ledgerkit.sources.versions import Layout, publish, stage
from ledgerkit.spec import MAX_RECORDS_PER_FILE


def table_scan(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def describe(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, and how many of its values are filled (one pass)."""
    fields = df.schema.fields
    filled = df.agg(*[F.count(quoted(f.name)).alias(f.name) for f in fields])
    names = [quoted(f.name) for f in fields]
    counts = filled.unpivot([], names, "column_name", "filled")
    facts = F.create_map(
        *[
            part
            for i, f in enumerate(fields)
            for part in (
                F.lit(f.name),
                F.struct(F.lit(i + 1).cast("bigint").alias("position"), F.lit(f.dataType.simpleString()).alias("type")),
            )
        ]
    )
    found = facts[F.col("column_name")]
    return counts.select(
        found["position"].alias("position"), "column_name", found["type"].alias("data_type"), "filled"
    )


#: Formats that replace a table's rows and schema in one step by themselves.
SELF_VERSIONED = ("delta",)


def overwrite_table(
    df: DataFrame,
    name: str,
    *,
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
    max_bytes_per_file: int | None = None,
    table_format: str = "parquet",
    path: str | None = None,
    rebalance: bool = False,
    buckets: tuple[int, tuple[str, ...]] | None = None,
) -> DataFrame:
    """Replace table ``name``, schema included, and return a scan of it.

    The rows are written completely before the table points to them (``sources.versions``): a failed write leaves the
    old rows, and ``df`` may read the table itself. No file holds more than ``max_records_per_file`` rows, nor more than
    ``max_bytes_per_file`` bytes. ``rebalance`` costs a shuffle: adaptive execution then splits large and merges small
    partitions by the bytes that arrive, where a fixed partition count would give many tiny files or a few huge ones.
    ``buckets`` (number, columns) deals the rows by key, so that joins and counts by it need no shuffle.
    """
    if rebalance:
        df = df.hint("rebalance")
    spark = df.sparkSession
    if table_format in SELF_VERSIONED:
        writer = df.write.format(table_format).mode("overwrite").option("overwriteSchema", "true")
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
        (writer.option("path", path) if path else writer).saveAsTable(name)
    else:
        layout = Layout(max_records_per_file, max_bytes_per_file, table_format, buckets)
        publish(spark, [stage(df, name, layout, path)])
    return spark.table(name)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


def file_sizes(table: DataFrame) -> DataFrame:
    """Rows and bytes per data file of a written table."""
    return table.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("rows"), F.max("_metadata.file_size").alias("bytes")
    )


def oversized_files(table: DataFrame, limit: int, byte_limit: int | None = None) -> DataFrame:
    """Total rows, and how many files hold more than ``limit`` of them or more than ``byte_limit`` bytes."""
    too_large = F.col("rows") > limit
    if byte_limit is not None:
        too_large |= F.col("bytes") > byte_limit
    return file_sizes(table).agg(
        F.sum("rows").alias("total_rows"), F.count(F.when(too_large, F.lit(1))).alias("oversized_files")
    )
