"""Intermediate tables: written once to the folder all executors share, then read back."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from functools import lru_cache

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

from ledgerkit.session import shared_folder
from ledgerkit.sources.folders import delete_folder

PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@lru_cache(maxsize=None)
def _archive(app_id: str) -> str:
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerkit-code-"), "ledgerkit.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(PACKAGE):
            for name in (n for n in names if n.endswith(".py")):
                file = os.path.join(folder, name)
                out.write(file, os.path.relpath(file, os.path.dirname(PACKAGE)))
    return path


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the executors, once for each application: their Python need not have it installed."""
    _ship(spark.sparkContext.applicationId)


@lru_cache(maxsize=None)
def _ship(app_id: str) -> None:
    SparkContext.getOrCreate().addPyFile(_archive(app_id))


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/llm/{label}-{uuid.uuid4().hex}"


#: Tables written by ``stored`` and not discarded yet, oldest first.
_made: list[str] = []


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet under the shared folder and read back: its lineage ends there."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    _made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def mark() -> int:
    """Where the tables made from now on begin."""
    return len(_made)


def discard_since(spark: SparkSession, since: int) -> None:
    """Delete the tables made since ``mark`` but for the last one, which needs none of them."""
    for path in _made[since:-1]:
        delete_folder(spark, path)
    del _made[since:-1]


def discard_all(spark: SparkSession) -> None:
    """Delete every intermediate table of this application; call it when no result needs them any more."""
    delete_folder(spark, f"{shared_folder(spark)}/llm")
    _made.clear()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
