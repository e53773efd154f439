"""Linking child rows to their parent, directly or through an alternate key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerkit.functions.text import clean_text, to_long
from ledgerkit.operators.hot_keys import Hot, copied, salted
from ledgerkit.operators.project import quoted
from ledgerkit.spec import ColumnSpec, ParentLink, TableSpec


def choose_link(columns: list[str], link: ParentLink) -> str:
    """``direct`` when the key is there, ``lookup`` when only the alternate key is."""
    if link.key in columns:
        return "direct"
    if link.alternate in columns:
        return "lookup"
    raise ValueError(f"neither {link.key} nor {link.alternate} among the columns {columns}")


def spec_for(columns: list[str], spec: TableSpec, link: ParentLink) -> TableSpec:
    """The child spec to parse with: its own, or with the alternate key in place of the key."""
    if choose_link(columns, link) == "direct":
        return spec
    return spec.replacing(link.key, ColumnSpec(link.alternate, "long"))


def parent_lookup(parents: DataFrame, link: ParentLink, on_duplicate: str = "fan_out") -> DataFrame:
    """Alternate key to key. Repeated alternate keys multiply the child rows (``fan_out``), are
    settled on the smallest key (``min``), or fail the query (``error``)."""
    number = quoted(link.alternate)
    pairs = parents.filter(number.isNotNull()).select(quoted(link.key), number)
    if on_duplicate == "fan_out":
        return pairs
    smallest = F.min(link.key)
    if on_duplicate == "error":
        clash = F.concat(F.lit(f"{link.alternate} is not unique: "), quoted(link.alternate).cast("string"))
        smallest = F.when(F.count("*") > 1, F.raise_error(clash)).otherwise(smallest)
    elif on_duplicate != "min":
        raise ValueError(f"unknown duplicate rule {on_duplicate!r}")
    return pairs.groupBy(link.alternate).agg(smallest.alias(link.key))


SALT = "__salt"
#: The alternate key as it is looked up, beside its raw text.
NUMBER = "__number"
LOOKUP_COLUMNS = (NUMBER, SALT)


def lookup_left(
    children: DataFrame,
    parents: DataFrame,
    link: ParentLink,
    on_duplicate: str = "fan_out",
    hot: Hot | None = None,
) -> DataFrame:
    """Left join that fills the key from the alternate key; unmatched children keep a null key.

    The children are read once. Rows without an alternate key match nothing and are spread over all tasks, and so are
    the rows of the ``hot`` numbers (``hot_keys.find_hot``), whose parents are copied to each of their tasks.
    """
    lookup = parent_lookup(parents, link, on_duplicate)
    columns = [quoted(c) for c in children.columns]
    left = salted(children, link.alternate, hot or {}, SALT)
    right = copied(lookup, link.alternate, hot or {}, SALT)
    return left.join(right, [link.alternate, SALT], "left").select(quoted(link.key), *columns)


def numbered(raw: DataFrame, link: ParentLink) -> DataFrame:
    """Raw child text with the columns its buckets are made of: the number, and a salt that spreads rows without one."""
    number = to_long(clean_text(quoted(link.alternate)))
    return salted(raw.withColumn(NUMBER, number), NUMBER, {}, SALT)


def lookup_in_buckets(
    children: DataFrame, parents: DataFrame, link: ParentLink, on_duplicate: str = "fan_out"
) -> DataFrame:
    """``lookup_left`` of children that lie in buckets of ``LOOKUP_COLUMNS``: only the parents' keys and numbers move.

    Each task holds the parents of its bucket in memory and reads the children past them, unsorted: for numbers that no
    side holds on very many rows.
    """
    lookup = parent_lookup(parents, link, on_duplicate).select(quoted(link.key), quoted(link.alternate).alias(NUMBER))
    right = copied(lookup, NUMBER, {}, SALT).hint("shuffle_hash")
    columns = [quoted(c) for c in children.columns if c not in LOOKUP_COLUMNS]
    return children.join(right, list(LOOKUP_COLUMNS), "left").select(quoted(link.key), *columns)


def lookup_fan_out(children: DataFrame, parents: DataFrame, link: ParentLink) -> DataFrame:
    """One row: how many alternate keys repeat among the parents, and how many rows ``fan_out`` adds for them.

    Both tables' numbers are counted in one grouping: a hot number travels as a few counters.
    """
    number = quoted(link.alternate)
    sides = parents.filter(number.isNotNull()).select(number.alias("number"), F.lit(1).alias("p"), F.lit(0).alias("c")).unionAll(
        children.filter(number.isNotNull()).select(number.alias("number"), F.lit(0).alias("p"), F.lit(1).alias("c"))
    )
    per_number = sides.groupBy("number").agg(F.sum("p").alias("p"), F.sum("c").alias("c"))
    added = F.when(F.col("p") > 1, (F.col("p") - 1) * F.col("c"))
    return per_number.agg(
        F.count(F.when(F.col("p") > 1, F.lit(1))).alias("repeated_numbers"),
        F.coalesce(F.sum(added), F.lit(0)).cast("bigint").alias("rows_added"),
    )


def link_to_parent(
    typed_children: DataFrame,
    parents: DataFrame,
    spec: TableSpec,
    link: ParentLink,
    on_duplicate: str = "fan_out",
    hot: Hot | None = None,
) -> DataFrame:
    """Typed child rows with the parent key present, in the column order of ``spec``."""
    if choose_link(typed_children.columns, link) == "lookup":
        if NUMBER in typed_children.columns:
            typed_children = lookup_in_buckets(typed_children, parents, link, on_duplicate)
        else:
            typed_children = lookup_left(typed_children, parents, link, on_duplicate, hot)
    return typed_children.select(*[quoted(c) for c in spec.column_names])
