"""Columns of any input: by position, so that names which differ in case only, or hold backticks, never clash."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def place_of(df: DataFrame, name: str) -> int:
    """Where the column ``name`` stands: the exact name first, else the only one that differs in case."""
    if name in df.columns:
        return df.columns.index(name)
    found = [i for i, c in enumerate(df.columns) if c.lower() == name.lower()]
    if len(found) != 1:
        raise ValueError(f"no single column {name!r} among {df.columns}")
    return found[0]


def settle(df: DataFrame, wanted: Iterable[str], added: Iterable[str] = ()) -> DataFrame:
    """``df`` with the columns ``wanted`` and all others whose names, in any case, neither ``wanted`` nor ``added`` has.

    Of other columns that differ in case only the first stays.
    """
    wanted = list(wanted)
    places = {place_of(df, w): w for w in wanted}
    taken = {n.lower() for n in [*wanted, *added]}
    kept: list[tuple[int, str]] = []
    for i, name in enumerate(df.columns):
        if i in places:
            kept.append((i, places[i]))
        elif name.lower() not in taken:
            taken.add(name.lower())
            kept.append((i, name))
    flat = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return flat.select(*[F.col(f"c{i}").alias(name) for i, name in kept])


def map_rows(
    df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], added: list[T.StructField]
) -> DataFrame:
    """``df`` with the columns ``added`` that ``run`` appends to each of its batches, whatever its names are."""
    names, schema = df.columns, T.StructType([*df.schema.fields, *added])
    flat = T.StructType([T.StructField(f"c{i}", f.dataType, f.nullable) for i, f in enumerate(schema.fields)])

    def positional(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(b.rename_columns(names) for b in batches):
            yield batch.rename_columns(flat.names)

    return df.toDF(*flat.names[: len(names)]).mapInArrow(positional, flat).toDF(*schema.names)


def on_plain_names(
    df: DataFrame, wanted: Iterable[str], added: Iterable[str], run: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``run`` on ``df`` settled and with its other columns under names that clash with nothing; named back afterwards.

    ``run`` keeps the columns it gets and adds those in ``added``.
    """
    wanted, added = list(wanted), list(added)
    df = settle(df, wanted, added)
    plain = [c if c in wanted else f"_other{i}" for i, c in enumerate(df.columns)]
    return run(df.toDF(*plain)).select(*plain, *added).toDF(*df.columns, *added)
