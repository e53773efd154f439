import pytest

import __spark_entry__ as entry
from conftest import SMALL
from ledgerkit.operators.project import apply_spec, clean_columns
from ledgerkit.plans.invoices import INVOICES, LINES
from ledgerkit.suite import exports, oracles, queries

QUERIES, ORACLES = queries.QUERIES, oracles.oracle_sql()
TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE"}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    found = duck.execute(ORACLES[name])
    columns = [d[0] for d in found.description]
    assert {n: TYPES[t] for n, t in df.dtypes} == {d[0]: str(d[1]) for d in found.description}
    expected = sorted(repr(row) for row in found.fetchall())
    assert sorted(repr(tuple(row)) for row in df.select(*columns).collect()) == expected


def test_entry_has_one_summary_row(spark):
    assert entry.entry(spark).count() == 1


def test_ingested_text_equals_the_typed_view(spark):
    parsed = apply_spec(clean_columns(exports.raw_invoices(spark, SMALL)), INVOICES)
    view = exports.invoices(spark, SMALL)
    assert parsed.select(*view.columns).exceptAll(view).isEmpty()
    parsed_lines = apply_spec(clean_columns(exports.raw_lines(spark, SMALL)), LINES)
    lines = exports.lines(spark, SMALL)
    assert parsed_lines.select(*lines.columns).exceptAll(lines).isEmpty()


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("agg_by_year", {"o_orderkey", "o_custkey", "o_orderdate"}),
        ("match_rates", {"o_orderkey", "l_orderkey"}),
        ("readback_count", set()),
        ("row_count", set()),
    ],
)
def test_scans_read_only_what_they_need(spark, name, columns):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    schemas = [part.split(">")[0] for part in plan.split("ReadSchema: struct<")[1:]]
    read = {field.split(":")[0] for schema in schemas for field in schema.split(",") if field}
    assert read == columns
