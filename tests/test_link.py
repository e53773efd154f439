import pytest
from pyspark.sql import functions as F

from ledgerkit.operators import link as L
from ledgerkit.operators.project import apply_spec, clean_columns, project_existing, stitch_single_rows
from ledgerkit.plans.invoices import LINES, LINK
from ledgerkit.spec import ColumnSpec, TableSpec


@pytest.fixture
def children(spark):
    rows = [(10, 1), (11, 2), (99, 3), (None, 4), (None, 5)]
    return spark.createDataFrame(rows, "InvoiceNumber bigint, InvoiceLineId bigint")


@pytest.fixture
def parents(spark):
    rows = [(1, 10), (2, 10), (3, 11), (4, None)]
    return spark.createDataFrame(rows, "InvoiceId bigint, InvoiceNumber bigint")


def linked(df):
    return sorted((r.InvoiceLineId, r.InvoiceId) for r in df.collect())


def test_choice_of_link():
    assert L.choose_link(["InvoiceId", "InvoiceNumber"], LINK) == "direct"
    assert L.choose_link(["InvoiceNumber"], LINK) == "lookup"
    with pytest.raises(ValueError, match="neither InvoiceId nor InvoiceNumber"):
        L.choose_link(["Other"], LINK)


@pytest.mark.parametrize("broadcast", [True, False])
def test_lookup_keeps_every_child_and_fans_out(spark, children, parents, broadcast):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before if broadcast else "-1")
    try:
        found = linked(L.lookup_left(children, parents, LINK))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found == [(1, 1), (1, 2), (2, 3), (3, None), (4, None), (5, None)]


def test_duplicate_rules(children, parents):
    assert linked(L.lookup_left(children, parents, LINK, "min"))[0] == (1, 1)
    assert len(linked(L.lookup_left(children, parents, LINK, "min"))) == 5
    with pytest.raises(Exception, match="InvoiceNumber is not unique: 10"):
        L.lookup_left(children, parents, LINK, "error").collect()
    unique = parents.filter("InvoiceId <> 2")
    assert len(linked(L.lookup_left(children, unique, LINK, "error"))) == 5
    with pytest.raises(ValueError, match="duplicate rule"):
        L.lookup_left(children, parents, LINK, "any")


def test_rows_without_key_are_spread_and_read_once(spark):
    many = spark.range(1000).select(F.expr("if(id >= 0, null, id)").alias("InvoiceNumber"), "id")
    parents = spark.createDataFrame([(1, 10)], "InvoiceId bigint, InvoiceNumber bigint")
    joined = L.lookup_left(many, parents, LINK)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and "isnull" in plan.lower()  # one reading of the children; the salt tells them apart
    assert joined.filter("InvoiceId is null").count() == 1000
    assert joined.columns == ["InvoiceId", *many.columns]


def test_alternate_key_spec_and_column_order(spark, parents):
    names = [c.name for c in LINES.columns if c.name != "InvoiceId"]
    raw = spark.createDataFrame([("11", *["1"] * len(names))], ["InvoiceNumber", *names])
    spec = L.spec_for(raw.columns, LINES, LINK)
    assert spec.column_names == ["InvoiceNumber", *names]
    out = L.link_to_parent(apply_spec(raw, spec), parents, LINES, LINK)
    assert out.columns == LINES.column_names
    assert out.first().InvoiceId == 3


def test_direct_link_does_not_join(spark, parents):
    raw = spark.createDataFrame([tuple("1" for _ in LINES.columns)], LINES.column_names)
    out = L.link_to_parent(apply_spec(raw, L.spec_for(raw.columns, LINES, LINK)), parents, LINES, LINK)
    assert "Join" not in out._jdf.queryExecution().toString()


def test_spec_application(spark):
    spec = TableSpec("t", (ColumnSpec("n", "long", source="a"), ColumnSpec("b")), key="n")
    df = spark.createDataFrame([("7", "x", "y")], "a string, b string, c string")
    assert apply_spec(df, spec).dtypes == [("n", "bigint"), ("b", "string")]
    with pytest.raises(ValueError, match=r"t: missing columns \['a'\]"):
        apply_spec(df.drop("a"), spec)


def test_projections(spark):
    df = spark.createDataFrame([(1, ' "x" ', '"y"')], "id bigint, `a.b` string, c string")
    assert tuple(clean_columns(df).first()) == (1, "x", "y")
    assert tuple(clean_columns(df, ["c"]).first()) == (1, ' "x" ', "y")
    assert project_existing(df, ["c", "nope", "id"]).columns == ["c", "id"]


def test_stitching_rows(spark):
    left = spark.sql("select 1 as a, cast(null as string) as b")
    right = spark.sql("select cast('2020-01-01' as date) as d, 2.5d as e")
    row = stitch_single_rows(left, right).first()
    assert (row.a, row.b, str(row.d), row.e) == (1, None, "2020-01-01", 2.5)


def test_fan_out_is_counted(spark):
    children = spark.createDataFrame([(10, 1), (10, 2), (11, 3), (None, 4), (99, 5)], "InvoiceNumber bigint, InvoiceLineId bigint")
    parents = spark.createDataFrame([(1, 10), (2, 10), (3, 10), (4, 11), (5, 12), (6, 12), (7, None)], "InvoiceId bigint, InvoiceNumber bigint")
    row = L.lookup_fan_out(children, parents, LINK).first()
    assert tuple(row) == (2, 4)
    assert L.lookup_left(children, parents, LINK).count() == children.count() + row.rows_added
    assert tuple(L.lookup_fan_out(children.limit(0), parents, LINK).first()) == (2, 0)
