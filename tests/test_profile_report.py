import datetime as dt

import pytest

from ledgerkit.operators import profile as P
from ledgerkit.operators import report as R


@pytest.fixture
def table(spark):
    rows = [
        (1, dt.date(2020, 1, 1), "BE", 7, " "),
        (2, dt.date(2020, 5, 1), "BE", 7, "x"),
        (3, dt.date(2021, 1, 1), "NL", 8, None),
        (4, None, None, None, ""),
        (5, dt.date(2021, 2, 1), "DE", 9, "y"),
    ]
    return spark.createDataFrame(rows, "id bigint, d date, land string, c bigint, t string")


def pairs(df):
    return {r[0]: r[1] for r in df.collect()}


def test_null_profiles(table):
    assert pairs(P.null_profile(table)) == {"d": 1, "land": 1, "c": 1, "t": 1}
    assert pairs(P.key_null_profile(table, ["id", "d", "absent"])) == {"id": 0, "d": 1}
    assert pairs(P.blank_key_profile(table, ["t", "land", "absent"])) == {"t": 3, "land": 1}
    assert [r.id for r in P.null_rows(table, "d").collect()] == [4]


def test_parse_failures(table):
    got = {r.column_name: (r.null_count, r.status) for r in P.parse_failures(table, ["id", "d"]).collect()}
    assert got == {"id": (0, "OK"), "d": (1, "WARNING")}


def test_profiles_scan_once(table):
    for df in (P.null_profile(table), P.key_null_profile(table, ["id", "d"]), P.parse_failures(table, ["id", "d"])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Scan") == 1 and "hashpartitioning" not in plan


def test_ranges_and_distincts(table):
    assert tuple(P.value_range(table, "d").first()) == (dt.date(2020, 1, 1), dt.date(2021, 2, 1))
    assert tuple(P.value_range(table, "land").first()) == ("BE", "NL")
    found = P.distinct_counts(table, {"ids": "id", "cs": "c", "lands": "land"})
    assert (found.columns, tuple(found.first())) == (["ids", "cs", "lands"], (5, 3, 3))
    assert "Expand" not in found._jdf.queryExecution().executedPlan().toString()


def test_date_trial(ansi, texts):
    df = texts(["3/01/2020 0:00:00", "3/01/2020 10:00:00", "3/01/2020", "bad", None], "d")
    assert pairs(P.date_format_trial(df, "d")) == {
        "two_digit_hour": 1,
        "any_hour": 2,
        "timestamp_any_hour": 2,
        "strip_then_day": 3,
        "strip_midnight_then_day": 2,
    }
    assert P.date_trial_columns(df, "d").columns[0] == "original"


def test_length_profile(texts):
    lengths = P.raw_length_profile(texts(["ab", "aa", "abc", None], "d"), "d")
    assert {tuple(r) for r in lengths.collect()} == {(2, 2, "aa"), (3, 1, "abc"), (None, 1, None)}


def test_year_reports(table):
    assert [tuple(r) for r in R.count_by_year(table, "d").collect()] == [(2020, 2), (2021, 2)]
    assert [tuple(r) for r in R.agg_by_year(table, "d", "c").collect()] == [(2020, 2, 1), (2021, 2, 2)]


def test_hot_year_is_spread_by_the_distinct_column(table):
    plan = R.agg_by_year(table, "d", "c")._jdf.queryExecution().executedPlan().toString()
    innermost = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line][-1]
    assert "c#" in innermost


def test_top_categories(table):
    top = R.top_categories(table, "land", 2)
    assert [tuple(r) for r in top.collect()] == [("BE", 2), ("DE", 1)]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
    assert pairs(R.count_by_category(table, "land")) == {"BE": 2, "DE": 1, "NL": 1}


def test_samples(table):
    assert [r.id for r in R.sample_rows(table, 2, ["id"]).collect()] == [1, 2]
    assert R.sample_rows(table, 3).count() == 3


def test_summaries_of_an_empty_table(ansi, table):
    row = R.parent_summary(table.filter("false"), "d", {"customers": "c"}).first()
    assert tuple(row) == (0, None, None, 0)
    stats = R.child_stats(table.filter("false"), "id", "c", "c", "d", "d").first()
    assert (stats.total_children, stats.distinct_parents, stats.total_quantity) == (0, 0, None)
    assert (stats.avg_tax, stats.min_start) == (None, None)


def test_lengths_are_grouped_by_hash_before_the_first_shuffle(table_of_texts):
    plan = P.raw_length_profile(table_of_texts, "a`b")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan.split("Exchange")[-1] and "HashAggregate" in plan.split("Exchange")[-1]
    assert {tuple(r) for r in P.raw_length_profile(table_of_texts, "a`b").collect()} == {(1, 2, "x"), (2, 1, "yy"), (None, 1, None)}


def test_no_key_is_present(table_of_texts):
    for profile in (P.key_null_profile, P.blank_key_profile):
        assert profile(table_of_texts, ["absent"]).count() == 0
        assert profile(table_of_texts, ["a`b"]).count() == 1


@pytest.fixture
def table_of_texts(spark):
    return spark.createDataFrame([("x",), ("x",), ("yy",), (None,)], "`a``b` string")
