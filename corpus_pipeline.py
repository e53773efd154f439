"""From raw documents to packed training windows: quality, repeated lines, near duplicates, contamination, packing.

Every stage calls one operator on all that the stage before kept, is written as Parquet and read again. All but the
last return the columns of ``documents``.

Cases (null and empty texts, repeated rows, empty tables, extra columns) are those of the operators: null and empty
texts are scored, have no line to lose and no duplicates, and pack as their end id; a row is kept or dropped whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerkit.llm import decontaminate, linededup, neardup, packing, quality
from ledgerkit.llm.scratch import discard_since, mark, ship_package, stored

#: SQL has no counterpart of the models; tests hold every stage against a plain version.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality model rejects."""
    labels = _table(spark, sf_dir, "labels")
    own = docs.select("doc_id", "text", F.struct("*").alias("document"))
    found = quality.classify(own, labels, threshold=0.3)
    return found.filter("predicted = 1").select("document.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines of 40 characters or more that five documents hold; ``n_chars`` follows the text."""
    ship_package(spark)
    own = docs.select("doc_id", "text", F.struct("*").alias("document"))
    found = linededup.dedup_lines(own, min_chars=40, min_docs=5)
    lost = F.col("n_dropped") > 0
    columns = []
    for c in docs.columns:
        value = F.col(f"document.`{c}`")
        if c == "text":
            value = F.col("text")
        elif c == "n_chars":
            value = F.when(lost, F.length("text").cast(docs.schema[c].dataType)).otherwise(value)
        columns.append(value.alias(c))
    return found.select(*columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near duplicates: five words, 0.8."""
    ship_package(spark)
    found = neardup.near_duplicates(docs, size=5, percent=80)
    gone = found.filter(~F.col("kept")).select(F.col("doc_id").alias("gone_id")).distinct()
    own = docs.select(F.struct("*").alias("document"), F.col("doc_id").cast("long").alias("own_id"))
    return own.join(gone, F.col("own_id") == F.col("gone_id"), "left_anti").select("document.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a benchmark item."""
    benchmark = _table(spark, sf_dir, "benchmark")
    own = docs.select("doc_id", "text", F.struct("*").alias("document"))
    return decontaminate.decontaminate(own, benchmark).select("document.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 4096 tokens in which every source keeps its share of the tokens."""
    ship_package(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), keeps_space=False, end_id=2, queue="source")


STAGES = [
    ("quality", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, begun = _table(spark, sf_dir, "documents"), mark()
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
        discard_since(spark, begun)  # what the stage needed, the table before it included
    return docs
