"""Tables replaced in one step: a write goes to a version folder of its own, and the table then points to it.

Until the swap nothing of the table changes, so a write that fails leaves the old rows, and a table may be written from
itself. The swap touches the catalog only: a new location where schema and layout stay as they are, else two renames,
which ``recover`` undoes if the second one never came. The version before stays for queries that still read it.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerkit.sources.folders import delete_folder, file_lengths, subfolders

#: Versions of a table that stay on disk: the one in use and the one before.
KEPT_VERSIONS = 2
STAGED, REPLACED = "__staged", "__replaced"


@dataclass(frozen=True)
class Layout:
    """How a table's files are cut. ``buckets``: number and columns; rows are sorted by them within each file."""

    max_records_per_file: int
    max_bytes_per_file: int | None = None
    table_format: str = "parquet"
    buckets: tuple[int, tuple[str, ...]] | None = None


@dataclass(frozen=True)
class Staged:
    """A complete new version of table ``name`` under a name of its own; ``counts`` were taken while writing it."""

    name: str
    staged_as: str
    root: str
    folder: str
    counts: Mapping[str, int]


def _beside(name: str, suffix: str) -> str:
    database, dot, table = name.rpartition(".")
    return f"{database}{dot}{table}{suffix}"


def default_root(spark: SparkSession, name: str) -> str:
    """Where the versions of a table without a path of its own lie: beside its database's tables."""
    database, _, table = name.rpartition(".")
    home = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{home.rstrip('/')}/{table}.versions"


def recover(spark: SparkSession, name: str) -> None:
    """Give a table its name back if a swap ended between its two renames."""
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(_beside(name, REPLACED)):
        spark.sql(f"ALTER TABLE {_beside(name, REPLACED)} RENAME TO {name}")


def table_facts(spark: SparkSession, name: str) -> dict[str, str]:
    """What the catalog knows of a table, by the names ``DESCRIBE EXTENDED`` gives."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    names = [r["col_name"] for r in rows]
    begin = names.index("# Detailed Table Information") if "# Detailed Table Information" in names else len(rows)
    return {r["col_name"]: r["data_type"] for r in rows[begin + 1 :]}


def stage(
    df: DataFrame, name: str, layout: Layout, path: str | None = None, counts: Mapping[str, Column] | None = None
) -> Staged:
    """Write ``df`` completely, as the next version of ``name``; a failure leaves nothing behind.

    ``counts`` are aggregates over the written rows, taken by the writing tasks themselves: each task counts once, also
    when an executor is lost. ``rows`` is always among them.
    """
    spark = df.sparkSession
    recover(spark, name)
    root = (path or default_root(spark, name)).rstrip("/")
    staged_as = _beside(name, STAGED)
    observed = Observation()
    df = df.observe(observed, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (counts or {}).items()])
    folder = _write(df, staged_as, root, layout)
    limit = layout.max_bytes_per_file
    while limit and (largest := _largest(spark, folder)) > limit:
        # the rows are typed by now: what is cut anew is the columnar version, as often as its files are too large
        records = max(1, min(layout.max_records_per_file, _most_rows(spark, staged_as)) * limit // largest)
        if records >= layout.max_records_per_file:
            break
        layout = replace(layout, max_records_per_file=records)
        whole = spark.read.format(layout.table_format).load(folder)
        spark.sql(f"DROP TABLE {staged_as}")
        larger, folder = folder, _write(whole, staged_as, root, layout)
        delete_folder(spark, larger)
    return Staged(name, staged_as, root, folder, dict(observed.get))


def _write(df: DataFrame, staged_as: str, root: str, layout: Layout) -> str:
    spark, folder = df.sparkSession, f"{root}/v{time.time_ns():020d}"
    writer = (
        df.write.format(layout.table_format)
        .option("maxRecordsPerFile", layout.max_records_per_file)
        .option("path", folder)
    )
    if layout.buckets:
        n, columns = layout.buckets
        writer = writer.bucketBy(n, *columns).sortBy(*columns)
    spark.sql(f"DROP TABLE IF EXISTS {staged_as}")
    try:
        writer.saveAsTable(staged_as)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {staged_as}")
        delete_folder(spark, folder)
        raise
    return folder


def _largest(spark: SparkSession, folder: str) -> int:
    return max(file_lengths(spark, folder), default=0)


def _most_rows(spark: SparkSession, name: str) -> int:
    """Rows of the fullest file; no column is read."""
    by_file = spark.table(name).groupBy("_metadata.file_path").count()
    return by_file.agg(F.max("count")).first()[0] or 0


def discard(spark: SparkSession, staged: Staged) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {staged.staged_as}")
    delete_folder(spark, staged.folder)


def _stays_in_place(spark: SparkSession, staged: Staged) -> bool:
    """Whether only the location differs: statistics belong to their rows, so a table with some is renamed."""
    if spark.table(staged.name).schema != spark.table(staged.staged_as).schema:
        return False
    old, new = table_facts(spark, staged.name), table_facts(spark, staged.staged_as)
    same = ("Provider", "Num Buckets", "Bucket Columns", "Sort Columns")
    return "Statistics" not in {**old, **new} and old.get("Type") == "EXTERNAL" and all(old.get(k) == new.get(k) for k in same)


def _swap(spark: SparkSession, staged: Staged) -> None:
    name, replaced = staged.name, _beside(staged.name, REPLACED)
    if not spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {staged.staged_as} RENAME TO {name}")
    elif _stays_in_place(spark, staged):
        location = staged.folder.replace("'", r"\'")
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
        spark.sql(f"DROP TABLE {staged.staged_as}")  # its files are the table's now
    else:
        spark.sql(f"DROP TABLE IF EXISTS {replaced}")
        spark.sql(f"ALTER TABLE {name} RENAME TO {replaced}")
        try:
            spark.sql(f"ALTER TABLE {staged.staged_as} RENAME TO {name}")
        except BaseException:
            recover(spark, name)
            raise
        spark.sql(f"DROP TABLE {replaced}")
    spark.catalog.refreshTable(name)


def publish(spark: SparkSession, staged: Sequence[Staged]) -> None:
    """Swap in complete versions, one right after the other; no data moves."""
    for one in staged:
        _swap(spark, one)
    for one in staged:
        old = [v for v in subfolders(spark, one.root) if v.startswith("v") and f"{one.root}/{v}" <= one.folder]
        for version in old[:-KEPT_VERSIONS]:
            delete_folder(spark, f"{one.root}/{version}")
