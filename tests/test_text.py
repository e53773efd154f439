import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from ledgerkit.functions import text
from ledgerkit.spec import ColumnSpec

NUMBERS = [
    "21", " 21 ", "-7", "+5", "21.00", "21.99", "-21.99", ".5", "-.5", "5.", ".", "-.", "", " ", "abc", "1e3",
    "1,5", "0x1F", "9223372036854775807", "9223372036854775808", "-9223372036854775808", "99999999999999999999.5",
    "0.99999999999999", "1.2.3", "--1", "NaN", "5d", "00012", "1 2", None,
]


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_to_long_equals_the_lenient_cast(spark, texts):
    df = texts(NUMBERS)
    spark.conf.set("spark.sql.ansi.enabled", "false")
    expected = values(df, F.col("x").cast("bigint"))
    spark.conf.set("spark.sql.ansi.enabled", "true")
    assert values(df, text.to_long(F.col("x"))) == expected


def test_to_long_casts_integers_only(ansi, texts):
    """A cast that fails raises inside, at some twenty times the cost of a match: texts that are no integers meet none."""
    spaces = ["\t12\n", "\x007\x7f", "\u00a05", "5\u00a0", "12\u2028", "\u0663", " + 1", "+", "-", "+-1", "1.", " .\n", "1.\x00"]
    df = texts([*NUMBERS, *spaces])
    x = F.col("x")
    before_dot = F.coalesce(F.substring_index(x, ".", 1).try_cast("bigint"), F.when(x.rlike(text._BARE_DOT), F.lit(0)))
    plain = F.coalesce(x.try_cast("bigint"), F.when(x.rlike(text._DOTTED), before_dot))
    assert values(df, text.to_long(x)) == values(df, plain)
    met = df.filter(x.rlike(text._INTEGER)).select("x", x.try_cast("bigint").alias("n"))
    assert {r.x for r in met.collect() if r.n is None} == {"9223372036854775808"}
    plan = df.select(text.to_long(x))._jdf.queryExecution().analyzed().toString()
    assert text._INTEGER in plan


def test_to_double_equals_the_lenient_cast(spark, texts):
    df = texts(NUMBERS)
    spark.conf.set("spark.sql.ansi.enabled", "false")
    expected = [repr(v) for v in values(df, F.col("x").cast("double"))]
    spark.conf.set("spark.sql.ansi.enabled", "true")
    assert [repr(v) for v in values(df, text.to_double(F.col("x")))] == expected


def test_to_long_cuts_toward_zero(ansi, texts):
    df = texts(["21.50", "-21.50", "6", "", "bad", None, "9223372036854775808.0"])
    assert values(df, text.to_long(F.col("x"))) == [21, -21, 6, None, None, None, None]


def test_clean_text(ansi, texts):
    df = texts([' "a" ', 'b\nc', "d\r\ne", "\tf\t", "\u00a0g\u00a0", '""', None])
    assert values(df, text.clean_text(F.col("x"))) == ["a", "bc", "d\re", "\tf\t", "\u00a0g\u00a0", "", None]


def test_decimal_point_replaces_every_comma(texts):
    df = texts(["1,5", "1,234,5", "1.234,56"])
    assert values(df, text.decimal_point(F.col("x"))) == ["1.5", "1.234.5", "1.234.56"]
    assert values(df, text.decimal_point(F.col("x"), grouping=".")) == ["1.5", "1.234.5", "1234.56"]


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("3/01/2020 0:00:00", dt.date(2020, 1, 3)),
        ("03/01/2020", dt.date(2020, 1, 3)),
        ("29/02/2020 23:59:59", dt.date(2020, 2, 29)),
        ("3/1/2020", None),
        ("31/02/2020", None),
        ("2020-01-03", None),
        ("3/01/2020 1:00:00 PM", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_date(ansi, texts, raw, expected):
    assert values(texts([raw]), text.parse_date(F.col("x"))) == [expected]


def test_strip_time_only_at_the_end(texts):
    df = texts(["1/01/2020 0:00:00", "0:00:00", " 1:2:3 x", "a 10:20:30"])
    assert values(df, text.strip_time(F.col("x"))) == ["1/01/2020", "0:00:00", " 1:2:3 x", "a"]


def test_is_blank(texts):
    assert values(texts(["", "  ", None, "a", "\t"]), text.is_blank(F.col("x"))) == [True, True, True, False, False]


def test_typed_kinds(ansi, texts):
    df = texts(["1.234,56"])
    row = df.select(
        text.typed(ColumnSpec("a", "double", source="x", decimal_comma=True)),
        text.typed(ColumnSpec("b", "double", source="x", decimal_comma=True, grouping=".")),
        text.typed(ColumnSpec("c", "decimal(18,6)", source="x", decimal_comma=True, grouping=".")),
        text.typed(ColumnSpec("d", "long", source="x", decimal_comma=True, grouping=".")),
        text.typed(ColumnSpec("e", source="x")),
    ).first()
    assert (row.a, row.b, float(row.c), row.d, row.e) == (None, 1234.56, 1234.56, 1234, "1.234,56")
    with pytest.raises(ValueError, match="unknown kind"):
        text.typed(ColumnSpec("f", "blob"))


def test_rates_default_to_no_comma_rule(ansi, texts):
    plain, comma = ColumnSpec("r", "long", source="x"), ColumnSpec("r", "long", source="x", decimal_comma=True)
    assert values(texts(["1,08"]), text.typed(plain)) == [None]
    assert values(texts(["1,08"]), text.typed(comma)) == [1]


def test_double_accepts_nan_and_suffix(ansi, texts):
    nan, suffixed = values(texts(["NaN", "5d"]), text.to_double(F.col("x")))
    assert math.isnan(nan) and suffixed == 5.0
