"""Projections: cleaning every text column, applying a table spec, picking columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerkit.functions.text import clean_text, quoted, typed
from ledgerkit.spec import TableSpec


def clean_columns(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Clean the text columns (all of them by default) in one projection."""
    wanted = set(columns if columns is not None else df.columns)
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)} & wanted
    return df.select(*[clean_text(quoted(c)).alias(c) if c in text else quoted(c) for c in df.columns])


def apply_spec(df: DataFrame, spec: TableSpec, keep: Iterable[str] = ()) -> DataFrame:
    """Text columns to the typed columns of ``spec``, in its order; those to ``keep`` follow as they are."""
    missing = [c.source_name for c in spec.columns if c.source_name not in df.columns]
    if missing:
        raise ValueError(f"{spec.name}: missing columns {missing}; found {df.columns}")
    return df.select(*[typed(c) for c in spec.columns], *[quoted(c) for c in keep])


def project_existing(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Those of the wanted columns that the frame has, in the order asked for."""
    return df.select(*[quoted(c) for c in wanted if c in df.columns])


def project_subset(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.select(*[quoted(c) for c in columns])


def stitch_single_rows(*frames: DataFrame) -> DataFrame:
    """One-row frames side by side as one row, without a join: union, then the filled value of each."""
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged.agg(*[F.first(quoted(c), ignorenulls=True).alias(c) for c in merged.columns])
