import dataclasses
import datetime
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerkit.plans import job
from ledgerkit.plans.invoices import INVOICES, LINES, LINK
from ledgerkit.session import shared_folder
from ledgerkit.sources import folders
from ledgerkit.sources.folders import kept
from ledgerkit.spec import ColumnSpec, Dialect, JobConfig, ParentLink, TableSpec
from ledgerkit.suite import exports, queries

SMALL = "/root/testdata/sf0.001"

HEADER = ";".join(INVOICES.column_names)
HEADS = [
    '1;100;7;50;3/01/2020 0:00:00;21,50;EUR;1;"Acme ""B"" BV";Main St;12 B;09000;Ghent;BE;0;+++1+++',
    '2;101;7;51;31/02/2020;bad;EUR;1,08;"two\nlines";Side;1;1000;Brussels;BE;1;',
    "3;102;8;50;;6;EUR;1; x ;Side;1;1000;Paris;;True;",
]
LINE_HEADER = ";".join(LINES.column_names)
LINE_ROWS = [
    '1;1;68423,46;2;21,00;1,5;10;11,5;4/04/2000 0:00:00;4/04/2001 0:00:00;"Hosting; yearly";P-1;G-7',
    '1;2;1.234,56;;5d;0;0;0;04/04/2000;4/4/2001;"a\nb";;',
    "9;1;1;1;1;1;1;1;1/01/2020;1/01/2020;orphan;P;G",
]


@pytest.fixture
def config(spark, tmp_path, write_file):
    config = JobConfig(
        parents_path=write_file("\n".join([HEADER, *HEADS]) + "\n", "heads.csv"),
        children_path=write_file("\n".join([LINE_HEADER, *LINE_ROWS]) + "\n", "lines.csv"),
        parents_table="lk_test_heads",
        children_table="lk_test_lines",
        parents=INVOICES,
        children=LINES,
        link=LINK,
        location=str(tmp_path),
    )
    yield config
    for name in (config.parents_table, config.children_table):
        spark.sql(f"drop table if exists {name}")


def by_id(df, key):
    return {tuple(r[k] for k in key): r for r in df.collect()}


@pytest.mark.parametrize("split", [False, True])
def test_run(spark, ansi, config, split):
    result = job.run(spark, dataclasses.replace(config, dialect=Dialect(split=split)))
    heads = by_id(result.parents, ["InvoiceId"])
    assert result.parents.columns == INVOICES.column_names
    assert (str(heads[1,].InvoiceDate), heads[1,].TaxPercentage) == ("2020-01-03", 21)
    assert heads[1,].BillingAddressee == "Acme B BV" and heads[2,].BillingAddressee == "twolines"
    assert (heads[2,].InvoiceDate, heads[2,].TaxPercentage, heads[2,].ExchangeRate) == (None, None, None)
    assert (heads[3,].IsCreditNote, heads[3,].BillingAddressee, heads[1,].BillingPostalCode) == (None, "x", "09000")
    lines = by_id(result.children, ["InvoiceId", "InvoiceLineId"])
    assert (lines[1, 1].UnitPrice, lines[1, 2].UnitPrice, lines[1, 2].TaxPercentage) == (68423.46, None, 5.0)
    assert (str(lines[1, 2].StartDate), lines[1, 2].EndDate) == ("2000-04-04", None)
    assert lines[1, 1].Description == "Hosting; yearly"

    row = result.summary.first()
    assert (row.total_parents, row.total_children, row.orphans, row.childless) == (3, 3, 1, 2)
    assert (row.integrity_status, row.count_parity, row.distinct_customers) == ("FAIL", "PASS", 2)
    failures = {r.column_name: (r.null_count, r.status) for r in result.parse_failures.collect()}
    assert failures == {"InvoiceDate": (2, "WARNING"), "InvoiceId": (0, "OK")}
    assert [tuple(r) for r in result.by_year.collect()] == [(2020, 1, 1)]
    assert [tuple(r) for r in result.top_countries.collect()] == [("BE", 2)]
    nulls = {r.column_name: r.null_count for r in result.invoice_nulls.collect()}
    assert nulls["InvoiceDate"] == 2 and nulls["OGM"] == 2 and "InvoiceId" not in nulls


def test_lines_linked_by_number(spark, config, write_file):
    numbered = ["10" + LINE_ROWS[0], "10" + LINE_ROWS[1], LINE_ROWS[2]]
    text = "\n".join([LINE_HEADER.replace("InvoiceId", "InvoiceNumber"), *numbered]) + "\n"
    by_number = dataclasses.replace(config, children_path=write_file(text, "numbered.csv"))
    result = job.run(spark, by_number)
    assert result.children.columns == LINES.column_names
    assert sorted(((r.InvoiceId, r.InvoiceLineId) for r in result.children.collect()), key=str) == [
        (2, 1),
        (2, 2),
        (None, 1),
    ]
    assert {r.column_name: r.status for r in result.parse_failures.collect()}["InvoiceId"] == "WARNING"


NUMBERED = [
    "100;1;1;1;1;1;1;1;1/01/2020;1/01/2021;a;P;G",
    '"0100 ";2;1;1;1;1;1;1;1/01/2020;1/01/2021;"b\nc";P;G',
    "101.0;3;1;1;1;1;1;1;1/01/2020;1/01/2021;d;P;G",
    "555;4;1;1;1;1;1;1;1/01/2020;1/01/2021;e;P;G",
    ";5;1;1;1;1;1;1;1/01/2020;1/01/2021;f;P;G",
    "none;6;1;1;1;1;1;1;1/01/2020;1/01/2021;g;P;G",
    "100;7",
]


@pytest.fixture
def small_broadcasts(spark):
    """A threshold that the numbers of a few parents pass."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "16")
    yield
    spark.conf.set(name, before)


@pytest.fixture
def by_number(config, write_file):
    """Lines without parent keys; a number that two parents carry."""
    header = LINE_HEADER.replace("InvoiceId;", "InvoiceNumber;", 1)
    return dataclasses.replace(
        config,
        parents_path=write_file("\n".join([HEADER, *HEADS, HEADS[0].replace("1;", "4;", 1)]) + "\n", "heads.csv"),
        children_path=write_file("\n".join([header, *NUMBERED]) + "\n", "by_number.csv"),
    )


def linked_lines(result):
    return sorted((r.InvoiceLineId, r.InvoiceId or 0) for r in result.children.collect())


@pytest.mark.parametrize("on_duplicate, twice", [("fan_out", [1, 4]), ("min", [1])])
def test_looked_up_lines_stay_in_place(spark, small_broadcasts, by_number, monkeypatch, on_duplicate, twice):
    """Beyond the broadcast threshold, only the parents' keys and numbers are shuffled."""
    plans = []

    def link_children(raw, parents, config):
        linked = was(raw, parents, config)
        plans.append(linked._jdf.queryExecution().executedPlan().toString())
        return linked

    was = job.link_children
    monkeypatch.setattr(job, "link_children", link_children)
    result = job.run(spark, dataclasses.replace(by_number, on_duplicate=on_duplicate))
    lines, parents = plans[0].split("ShuffledHashJoin", 1)[1].split("Scan parquet", 2)[:2]
    assert "Exchange" not in lines and "Exchange" in parents and "SortMergeJoin" not in plans[0]
    expected = [(n, k) for n in (1, 2, 7) for k in twice] + [(3, 2), (4, 0), (5, 0), (6, 0)]
    assert linked_lines(result) == sorted(expected)
    assert result.children.columns == LINES.column_names
    assert result.child_rejects.columns == ["InvoiceNumber", *LINES.column_names[1:], job.REJECTED]
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("lk_scratch")] == []


@pytest.mark.parametrize("side", [0, 1])
def test_lines_of_hot_numbers_leave_their_buckets(spark, small_broadcasts, by_number, monkeypatch, side):
    """A number with very many lines or parents: the lines are shuffled, and its rows spread."""
    calls, spread = [], []

    def find_hot(df, column):
        calls.append(column)
        return {100: 3} if len(calls) == side + 1 else {}

    def link_to_parent(typed, parents, spec, link, on_duplicate, hot=None):
        spread.append((job.NUMBER in typed.columns, hot))
        return was(typed, parents, spec, link, on_duplicate, hot)

    was = job.link_to_parent
    monkeypatch.setattr(job, "find_hot", find_hot)
    monkeypatch.setattr(job, "link_to_parent", link_to_parent)
    result = job.run(spark, by_number)
    assert spread == [(False, {} if side else {100: 3})]
    assert linked_lines(result) == sorted([(n, k) for n in (1, 2, 7) for k in (1, 4)] + [(3, 2), (4, 0), (5, 0), (6, 0)])


def test_buckets_follow_the_parents(spark):
    threshold = int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").removesuffix("b"))
    assert job.lookup_buckets(spark, threshold // job.PAIR_BYTES) == 0
    assert job.lookup_buckets(spark, 10**9) == 10**9 // job.BUCKET_PARENTS


def test_orders_are_joined_before_they_become_text(spark, small_broadcasts):
    plan = exports.raw_invoices(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    text, joined = plan.split("Join LeftOuter", 1)
    assert "OGM" in text and "OGM" not in joined


def test_lines_beyond_a_broadcast_are_joined_unsorted(spark, small_broadcasts, tmp_path, monkeypatch):
    """Each task holds its share of the parts: no line is sorted for them, which spills where lines are many."""
    columns = (
        "l_orderkey bigint, l_linenumber int, l_extendedprice double, l_quantity double, l_tax double, l_discount double, "
        "l_shipdate timestamp, l_partkey bigint"
    )
    day = datetime.datetime(2020, 1, 2)
    lines = [(n, 1, 1.5, 2.0, 0.1, 0.2, day, key) for n, key in enumerate([1, 1, 2, 3, None, 9])]
    parts = [(1, "a", "b"), (2, "c", "d"), (2, "e", "f"), (3, None, None), (None, "g", "h")]
    spark.createDataFrame(lines, columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(parts, "p_partkey bigint, p_name string, p_brand string").write.parquet(f"{tmp_path}/part.parquet")

    def joined():
        df = exports.raw_lines(spark, str(tmp_path))
        found = sorted((int(r.InvoiceId), r.Description or "", r.ProductGroupCode or "") for r in df.collect())
        return found, df._jdf.queryExecution().executedPlan().toString()

    found, plan = joined()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    names = [(0, "a", "b"), (1, "a", "b"), (2, "c", "d"), (2, "e", "f")]
    assert found == [(n, f'"{name}";\nyearly', brand) for n, name, brand in names] + [(3, "", ""), (4, "", ""), (5, "", "")]
    monkeypatch.setattr(exports, "task_memory", lambda spark: 0)
    many, plan = joined()
    assert many == found and "ShuffledHashJoin" not in plan  # too many parts to hold


def test_lines_without_any_key(spark, config, write_file):
    text = LINE_HEADER.replace("InvoiceId", "Other") + "\n" + LINE_ROWS[0] + "\n"
    broken = dataclasses.replace(config, children_path=write_file(text, "keyless.csv"))
    with pytest.raises(ValueError, match="neither"):
        job.run(spark, broken)


def test_legacy_repair_takes_the_first_column(spark, config, write_file):
    text = LINE_HEADER.replace("InvoiceId", "Other") + "\n" + LINE_ROWS[0] + "\n"
    legacy = dataclasses.replace(config, children_path=write_file(text, "legacy.csv"), repair="legacy")
    assert [r.InvoiceId for r in job.run(spark, legacy).children.collect()] == [1]


def test_scratch_of_one_task_is_read_by_several(spark, monkeypatch):
    monkeypatch.setattr(folders, "ROW_GROUP_BYTES", 1 << 16)
    with kept(spark.range(0, 100_000, 1, 1)) as df:
        (file,) = [f.removeprefix("file://") for f in df.inputFiles()]
        assert pq.ParquetFile(file).num_row_groups > 2


def test_kept_frames_are_deleted(spark):
    with kept(spark.range(5)) as df:
        assert df.count() == 5 and df.inputFiles()
        folder = os.path.dirname(df.inputFiles()[0].removeprefix("file://"))
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)
    with pytest.raises(RuntimeError), kept(spark.range(5)) as df:
        folder = os.path.dirname(df.inputFiles()[0].removeprefix("file://"))
        raise RuntimeError
    assert not os.path.exists(folder)


def test_a_run_counts_while_it_writes(spark, config):
    result = job.run(spark, config)
    counts = {(r.table_name, r.measure): r.value for r in result.written.collect()}
    assert counts["invoices", "rows_read"] == counts["invoices", "rows_written"] == result.parents.count() == 3
    assert counts["invoice_lines", "rows_written"] == result.children.count() == 3
    for name, table in (("invoices", result.parents), ("invoice_lines", result.children)):
        for (owner, measure), value in counts.items():
            if owner == name and measure.startswith("null_"):
                assert value == table.filter(F.col(measure.removeprefix("null_")).isNull()).count()
    assert counts["invoices", "null_InvoiceDate"] == 2
    assert counts["invoices", "rows_rejected"] == counts["invoice_lines", "rows_rejected"] == 0
    assert result.parent_rejects.count() == 0
    assert [r.InvoiceId for r in result.parent_sample.collect()] and result.child_sample.count() == 3


@pytest.mark.parametrize("split", [False, True])
def test_records_that_do_not_fit_are_kept(spark, config, write_file, split):
    rows = [HEADS[0], HEADS[1] + ";one too many", "3;102;8"]
    path = write_file("\n".join([HEADER, *rows]) + "\n", "uneven.csv")
    result = job.run(spark, dataclasses.replace(config, parents_path=path, dialect=Dialect(split=split)))
    rejects = {r.InvoiceId: r[job.REJECTED] for r in result.parent_rejects.collect()}
    assert rejects == {"2": rows[1], "3": rows[2]}
    counts = {(r.table_name, r.measure): r.value for r in result.written.collect()}
    assert (counts["invoices", "rows_read"], counts["invoices", "rows_rejected"]) == (3, 2)
    assert result.parents.count() == 3  # padded or cut, as before


def test_rejected_records_exports_what_it_reads(spark, monkeypatch):
    """Headers with uneven records stand in for the invoices: those are not exported beside them."""
    monkeypatch.setattr(exports, "raw_invoices", None)
    assert queries.rejected_records(spark, SMALL).columns == ["invoice_id", "fields"]


def test_raw_profile(spark, config):
    rows = {(r.table_name, r.measure, r.column_name, r.detail): r.value for r in job.run(spark, config).raw_profile.collect()}
    assert rows["invoices", "blank", "InvoiceDate", None] == "1"
    assert rows["invoice_lines", "blank", "InvoiceLineId", None] == "0"
    assert rows["invoices", "smallest", "InvoiceDate", None] == "3/01/2020 0:00:00"
    assert rows["invoices", "length", "InvoiceDate", "17"] == "1" and rows["invoices", "length", "InvoiceDate", None] == "1"
    assert rows["invoices", "parsed_as", "InvoiceDate", "strip_then_day"] == "1"


def test_a_bad_child_file_leaves_both_tables_and_no_scratch(spark, config, write_file):
    before = job.run(spark, config)
    heads, lines = before.parents.collect(), before.children.collect()
    broken = write_file(LINE_HEADER + "\n" + LINE_ROWS[0] + '\n1;9;"never closed\n', "broken.csv")
    other = write_file(HEADER + "\n" + HEADS[0] + "\n", "other.csv")
    with pytest.raises(ValueError, match="never closed"):
        job.run(spark, dataclasses.replace(config, parents_path=other, children_path=broken))
    assert sorted(spark.table(config.parents_table).collect(), key=str) == sorted(heads, key=str)
    assert sorted(spark.table(config.children_table).collect(), key=str) == sorted(lines, key=str)
    scratch = f"{shared_folder(spark)}/scratch"
    assert not os.path.isdir(scratch) or not os.listdir(scratch)


def test_tables_without_roles(spark, tmp_path, write_file):
    plain = TableSpec("a", (ColumnSpec("Id", "long"), ColumnSpec("No")), key="Id")
    child = TableSpec("b", (ColumnSpec("Id", "long"), ColumnSpec("Line")), key="Line")
    bare = JobConfig(
        parents_path=write_file("Id;No\n1;x\n2;y\n", "a.csv"), children_path=write_file("No;Line\nx;1\nx;2\nz;3\n", "b.csv"),
        parents_table="lk_test_a", children_table="lk_test_b", parents=plain, children=child, link=ParentLink("Id", "No"),
        location=str(tmp_path),
    )
    with pytest.raises(Exception, match="(?i)cast|type|mismatch|No"):
        job.run(spark, dataclasses.replace(bare, link=ParentLink("Missing", "Nowhere")))
    numbered = dataclasses.replace(
        bare, parents_path=write_file("Id;No\n1;10\n2;20\n", "c.csv"), children_path=write_file("No;Line\n10;1\n10;2\n30;3\n", "d.csv"),
        parents=TableSpec("a", (ColumnSpec("Id", "long"), ColumnSpec("No", "long")), key="Id"),
    )
    result = job.run(spark, numbered)
    assert sorted(map(tuple, result.children.collect()), key=str) == [(1, "1"), (1, "2"), (None, "3")]
    assert result.by_year is None and result.top_countries is None and result.parse_failures.collect() == []
    assert result.summary.first().orphans == 1
    for name in ("lk_test_a", "lk_test_b"):
        spark.sql(f"drop table if exists {name}")
