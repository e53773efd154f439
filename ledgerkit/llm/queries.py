"""The registered queries: each operator on its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerkit.llm import (
    ann,
    decontaminate,
    grammar,
    lexical,
    licenses,
    linededup,
    neardup,
    packing,
    pieces,
    quality,
    toxicity,
    urlrules,
    variants,
)
from ledgerkit.llm.scratch import scratch_path, ship_package

#: The rules of the URL query.
URL_RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    QUERIES[query.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality.classify(docs, table(spark, sf_dir, "labels"), threshold=0.3)
    return found.select("doc_id", "held_out", "score", "predicted")


@register
def op2_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@register
def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80)


@register
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contaminated documents: a row for each benchmark item a document holds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_matches(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.inline("matches"))


@register
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents found toxic."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity.toxic_documents(docs, table(spark, sf_dir, "labels"))
    return found.select("doc_id", "p_toxic", "p_severe", (F.col("p_severe") >= 0.5).cast("int").alias("severe"))


@register
def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urlrules.judge_urls(pages, urlrules.rules_frame(spark, URL_RULES)).drop("url")


@register
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_chars=40, min_docs=5)
    return docs.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@register
def op8_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "shards")
    grammar.write_shards(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return grammar.read_documents(spark, path)


@register
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents have no file names: their source and language stand for the directories they lie in."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.concat_ws("/", "source", "lang", "doc_id").alias("path"))
    return licenses.scan_licenses(docs)


@register
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), keeps_space=False, end_id=2)


@register
def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, model = table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model")
    coded = pieces.decode_pieces(pieces.encode_pieces(docs, model).select("doc_id", "ids"), model)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@register
def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"), min_chars=7, min_count=2, times=10)


@register
def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)
