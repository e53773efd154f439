import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerkit.operators import integrity
from ledgerkit.sources import footers, statistics, versions
from ledgerkit.sources import tables as T
from ledgerkit.sources.folders import delete_folder


@pytest.fixture
def target(spark, tmp_path):
    name = "lk_test_table"
    spark.sql(f"drop table if exists {name}")
    yield name, str(tmp_path / name)
    spark.sql(f"drop table if exists {name}")


def test_overwrite_replaces_rows_and_schema(spark, target):
    name, path = target
    T.overwrite_table(spark.range(10), name, path=path)
    written = T.overwrite_table(spark.sql("select 'x' as a, 1.5d as b"), name, path=path)
    assert [tuple(r) for r in written.collect()] == [("x", 1.5)]
    assert [r.col_name for r in spark.sql(f"describe {name}").collect()] == ["a", "b"]
    assert T.row_count(T.table_scan(spark, name)).first().row_count == 1


@pytest.mark.parametrize("rebalance", [True, False])
def test_files_are_bounded(spark, target, rebalance):
    name, path = target
    written = T.overwrite_table(
        spark.range(0, 1000, 1, 3), name, path=path, max_records_per_file=100, rebalance=rebalance
    )
    row = T.oversized_files(written, 100).first()
    assert (row.total_rows, row.oversized_files) == (1000, 0)
    assert T.oversized_files(written, 99).first().oversized_files > 0


def test_rebalance_merges_small_partitions(spark, target):
    name, path = target
    written = T.overwrite_table(spark.range(0, 1000, 1, 50), name, path=path, rebalance=True)
    assert T.file_sizes(written).count() == 1


def test_describe(spark):
    df = spark.sql("select 1L as a, cast(null as string) as `b c` union all select null, 'x'")
    got = sorted(tuple(r) for r in T.describe(df).collect())
    assert got == [(1, "a", "bigint", 1), (2, "b c", "string", 1)]


def failing(spark, rows=1000, bad=700):
    """Rows of another schema, one of which fails its task after others have been written."""
    return spark.range(0, rows, 1, 8).select(
        F.when(F.col("id") == bad, F.raise_error(F.lit("bad row"))).otherwise(F.col("id")).alias("other")
    )


@pytest.mark.parametrize("managed", [False, True])
def test_a_failed_write_leaves_the_old_rows(spark, target, managed):
    name, path = target
    path = None if managed else path
    root = path or versions.default_root(spark, name)
    T.overwrite_table(spark.range(10), name, path=path)
    before = versions.subfolders(spark, root)
    with pytest.raises(PySparkException, match="bad row"):
        T.overwrite_table(failing(spark), name, path=path)
    assert spark.table(name).columns == ["id"] and spark.table(name).count() == 10
    assert not spark.catalog.tableExists(name + versions.STAGED)
    assert versions.subfolders(spark, root) == before
    T.overwrite_table(spark.range(3), name, path=path)
    assert spark.table(name).count() == 3
    delete_folder(spark, root)


def test_a_table_is_rewritten_from_itself(spark, target):
    name, path = target
    table = T.overwrite_table(spark.range(10), name, path=path)
    table = T.overwrite_table(table.filter("id > 3"), name, path=path)
    assert sorted(r.id for r in table.collect()) == list(range(4, 10))
    table = T.overwrite_table(table.selectExpr("id", "id * 2 as twice"), name, path=path)
    assert table.filter("twice = 18").count() == 1


def test_readers_of_the_version_before_go_on(spark, target):
    name, path = target
    first = T.overwrite_table(spark.range(10), name, path=path)
    T.overwrite_table(spark.range(5), name, path=path)
    assert first.count() == 10
    for n in (4, 3, 2):
        T.overwrite_table(spark.range(n), name, path=path)
    assert len(versions.subfolders(spark, path)) == versions.KEPT_VERSIONS


def test_a_swap_that_ended_between_its_renames_is_undone(spark, target):
    name, path = target
    T.overwrite_table(spark.range(10), name, path=path)
    spark.sql(f"alter table {name} rename to {name}{versions.REPLACED}")
    versions.recover(spark, name)
    assert spark.table(name).count() == 10
    spark.sql(f"alter table {name} rename to {name}{versions.REPLACED}")
    T.overwrite_table(spark.range(4), name, path=path)
    assert spark.table(name).count() == 4


def test_staged_tables_show_nothing_until_published(spark, target):
    name, path = target
    T.overwrite_table(spark.range(10), name, path=path)
    staged = versions.stage(spark.range(7), name, versions.Layout(100), path, {"even": F.count(F.when(F.expr("id % 2 = 0"), 1))})
    assert staged.counts == {"rows": 7, "even": 4} and spark.table(name).count() == 10
    versions.discard(spark, staged)
    assert not os.path.exists(staged.folder) and spark.table(name).count() == 10


def test_files_are_bounded_by_bytes(spark, target):
    name, path = target
    rows = spark.range(0, 20000, 1, 1).select(F.sha2(F.col("id").cast("string"), 256).alias("x"))
    written = T.overwrite_table(rows, name, path=path, max_records_per_file=20000, max_bytes_per_file=200_000)
    row = T.oversized_files(written, 20000, 200_000).first()
    assert (row.total_rows, row.oversized_files) == (20000, 0)
    assert T.file_sizes(written).count() < 20


def test_bucketed_tables_are_compared_without_an_exchange_by_key(spark, target):
    name, path = target
    parents = T.overwrite_table(spark.range(100).withColumnRenamed("id", "k"), name, path=path, buckets=(4, ("k",)))
    child = spark.range(300).select(F.when(F.expr("id % 7 > 0"), F.expr("id % 120")).alias("k"))
    children = T.overwrite_table(child, f"{name}_c", path=f"{path}_c", buckets=(4, ("k",)))
    try:
        found = integrity.key_balance_in_place(parents, children, "k")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and "Bucketed: true" in plan
        assert found.first() == integrity.key_balance(parents, children, "k").first()
    finally:
        spark.sql(f"drop table {name}_c")


def test_statistics_are_rows_and_choose_the_join_side(spark, target):
    name, path = target
    table = T.overwrite_table(spark.range(1000).selectExpr("id as k", "if(id < 10, null, 'x') as s"), name, path=path)
    assert {r.distinct_count for r in statistics.column_statistics(spark, name).collect()} == {None}
    statistics.analyze(spark, name)
    k, s = statistics.column_statistics(spark, name).orderBy("position").collect()
    assert (k.column_name, k.null_count, k.min_value, k.max_value) == ("k", 0, "0", "999") and 950 <= k.distinct_count <= 1050
    assert (s.null_count, s.distinct_count, s.max_length) == (10, 1, 1)
    session = spark.newSession()
    session.conf.set("spark.sql.cbo.enabled", "true")
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000b")
    table = session.table(name)
    few = session.table(name).filter("k < 5").selectExpr("k", "s as other")
    assert "BroadcastHashJoin" in table.join(few, "k")._jdf.queryExecution().executedPlan().toString()
    session.conf.set("spark.sql.cbo.enabled", "false")
    few = session.table(name).filter("k < 5").selectExpr("k", "s as other")
    assert "BroadcastHashJoin" not in session.table(name).join(few, "k")._jdf.queryExecution().executedPlan().toString()
    # new rows: the statistics of the old ones are gone
    T.overwrite_table(spark.range(5).selectExpr("id as k", "'y' as s"), name, path=path)
    assert {r.distinct_count for r in statistics.column_statistics(spark, name).collect()} == {None}


def test_footers_answer_without_reading_a_column(spark, tmp_path):
    path = str(tmp_path / "facts")
    spark.range(1000).selectExpr("id", "cast(id % 7 as int) as n", "cast(id as string) as s", "date'2020-01-01' + cast(id as int) as d").write.parquet(path)
    plan = footers.footer_plan(spark, path, ["id", "n", "d"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(id), MAX(id), MIN(n), MAX(n), MIN(d), MAX(d)]" in plan
    row = footers.footer_facts(spark, path, ["id", "n", "s", "d"]).first()
    assert (row.row_count, row.min_id, row.max_id, row.max_n, row.max_s) == (1000, 0, 999, 6, "999")
    assert str(row.min_d) == "2020-01-01"
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    spark.createDataFrame([(None,)], "a bigint").write.parquet(path + "_null")
    assert tuple(footers.footer_facts(spark, path + "_null", ["a"]).first()) == (1, None, None)


def test_describe_odd_names(spark):
    df = spark.createDataFrame([(1, None)], "`a``b` int, `c.d` string")
    assert sorted(tuple(r) for r in T.describe(df).collect()) == [(1, "a`b", "int", 1), (2, "c.d", "string", 0)]
