"""Folders on whatever file system a path names, and Parquet scratch that outlives an executor but not its use."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

from ledgerkit.session import shared_folder

#: Bytes of a row group in scratch: a file that one task wrote is read by several.
ROW_GROUP_BYTES = 16 << 20


def _path(spark: SparkSession, folder: str) -> tuple[JavaObject, JavaObject]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, folder: str) -> None:
    path, files = _path(spark, folder)
    files.delete(path, True)


def subfolders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders in ``folder``, sorted; none where it does not exist."""
    path, files = _path(spark, folder)
    if not files.exists(path):
        return []
    return sorted(f.getPath().getName() for f in files.listStatus(path) if f.isDirectory())


def file_lengths(spark: SparkSession, folder: str) -> list[int]:
    """Bytes of the data files directly in ``folder``."""
    path, files = _path(spark, folder)
    names = [(f.getPath().getName(), f.getLen()) for f in files.listStatus(path) if not f.isDirectory()]
    return [size for name, size in names if not name.startswith(("_", "."))]


@contextmanager
def kept(df: DataFrame, label: str = "kept", buckets: tuple[int, tuple[str, ...]] | None = None) -> Iterator[DataFrame]:
    """``df`` for several reads: written once as Parquet to the shared folder, deleted afterwards.

    Unlike executor caching it needs no memory, reads the wanted columns only, and survives a lost executor. With
    ``buckets`` (number, columns) each task deals its rows to the buckets' files, without a shuffle; joins by these columns
    then read the rows where they lie. Buckets are known to the catalog only: a table of a name of its own stands for them.
    """
    spark, unique = df.sparkSession, uuid.uuid4().hex
    folder, table = f"{shared_folder(spark)}/scratch/{label}-{unique}", f"lk_scratch_{unique}"
    writer = df.write.option("compression", "zstd").option("parquet.block.size", ROW_GROUP_BYTES)
    try:
        if buckets:
            n, columns = buckets
            writer.format("parquet").bucketBy(n, *columns).option("path", folder).saveAsTable(table)
            yield spark.table(table)
        else:
            writer.parquet(folder)
            yield spark.read.schema(df.schema).parquet(folder)
    finally:
        if buckets:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        delete_folder(spark, folder)
