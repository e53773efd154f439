"""Lenient text-to-value expressions. All are built-in column expressions, null on bad input, and give
the same result whether or not the session runs in ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerkit.spec import DATE_FORMAT, TIME_SUFFIX, ColumnSpec

# Decimal text with at least a dot: the part before it is the truncated integer.
_DOTTED = r"^\s*[+-]?[0-9]*[.][0-9]*\s*$"
_BARE_DOT = r"^\s*[+-]?[.]"
# All that a cast to an integer takes; the cast of anything else raises inside, at some twenty times the cost of this match.
_INTEGER = r"\A[\x00-\x20\x7f]*[+-]?[0-9]+[\x00-\x20\x7f]*\z"


def _remove(value: Column, what: str) -> Column:
    return F.replace(value, F.lit(what), F.lit(""))


def clean_text(value: Column) -> Column:
    """Drop every double quote and line feed, then trim spaces at both ends."""
    return F.trim(_remove(_remove(value, '"'), "\n"))


def is_blank(value: Column) -> Column:
    return value.isNull() | (F.trim(value) == "")


def decimal_point(value: Column, grouping: str | None = None) -> Column:
    """Comma decimals to dot decimals; every comma is replaced. ``grouping`` is removed first."""
    if grouping:
        value = _remove(value, grouping)
    return F.replace(value, F.lit(","), F.lit("."))


def to_long(value: Column) -> Column:
    """Text to bigint, fractions cut off toward zero, anything else null.

    ``try_cast`` alone would reject ``21.50``, and takes long to reject.
    """
    before_dot = F.substring_index(value, ".", 1).try_cast("bigint")
    fraction = F.when(value.rlike(_DOTTED), F.when(value.rlike(_BARE_DOT), F.lit(0)).otherwise(before_dot))
    whole = F.when(value.rlike(_INTEGER), value.try_cast("bigint"))
    return F.when(F.contains(value, F.lit(".")), fraction).otherwise(whole)


def to_double(value: Column) -> Column:
    return value.try_cast("double")


def quoted(name: str) -> Column:
    """The column of this name, whatever characters it has."""
    return F.col("`{}`".format(name.replace("`", "``")))


def strip_time(value: Column) -> Column:
    return F.regexp_replace(value, TIME_SUFFIX, "")


def parse_date(value: Column, date_format: str = DATE_FORMAT) -> Column:
    """European date with an optional trailing time of day; impossible dates are null."""
    return F.try_to_date(strip_time(value), date_format)


def typed(spec: ColumnSpec) -> Column:
    """The column expression a ``ColumnSpec`` stands for, aliased to its output name."""
    value = quoted(spec.source_name)
    if spec.kind == "text":
        return value.alias(spec.name)
    if spec.kind == "date":
        return parse_date(value, spec.date_format).alias(spec.name)
    if spec.decimal_comma:
        value = decimal_point(value, spec.grouping)
    if spec.kind == "long":
        return to_long(value).alias(spec.name)
    if spec.kind == "double":
        return to_double(value).alias(spec.name)
    if spec.kind.startswith("decimal"):
        return value.try_cast(spec.kind).alias(spec.name)
    raise ValueError(f"column {spec.name}: unknown kind {spec.kind!r}")
