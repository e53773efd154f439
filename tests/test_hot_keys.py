import random

import pytest
from pyspark.sql import functions as F

from ledgerkit.operators import hot_keys, integrity, membership, profile
from ledgerkit.operators.link import SALT, lookup_left
from ledgerkit.operators.hot_keys import copied, find_hot, salted
from ledgerkit.spec import ParentLink

LINK = ParentLink("Id", "No")


def tables(spark, n=20000):
    """One number on three tenths of both tables; one row in ten without a number."""
    children = spark.range(0, n, 1, 8).select(
        F.expr("case when id % 10 < 3 then 7 when id % 10 = 9 then null else id end").alias("No"), F.col("id").alias("line")
    )
    parents = spark.range(0, n // 100, 1, 2).select(
        F.col("id").alias("Id"), F.expr("case when id % 10 < 3 then 7 else id * 100 + 5 end").alias("No")
    )
    return children, parents


def plain(children, parents):
    return children.join(parents, "No", "left").select("Id", *children.columns)


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("rule", ["fan_out", "min"])
def test_hot_numbers_give_the_same_rows(spark, rule):
    children, parents = tables(spark, 2000)
    hot = find_hot(children, "No", few_rows=50)
    assert set(hot) == {7} and hot[7] > 1
    expected = parents if rule == "fan_out" else parents.groupBy("No").agg(F.min("Id").alias("Id"))
    assert rows(lookup_left(children, parents, LINK, rule, hot)) == rows(plain(children, expected))
    assert rows(lookup_left(children, parents, LINK, rule)) == rows(plain(children, expected))


def test_the_longest_task_stays_near_the_median(spark):
    children, parents = tables(spark)
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", 16)
    session.conf.set("spark.sql.adaptive.enabled", "false")
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    children, parents = tables(session)

    def tasks(hot):
        lookup = copied(parents.groupBy("No").agg(F.min("Id").alias("least")), "No", hot, SALT)
        joined = salted(children, "No", hot, SALT).join(lookup, ["No", SALT], "left")
        # a column of the parents is used, or the join would be left out
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("rows"), F.max("least"))
        return sorted(r["rows"] for r in sizes.collect())

    hot = find_hot(children, "No", few_rows=100)
    sizes = tasks(hot)
    assert len(sizes) == 16 and sizes[-1] < 2 * sizes[8]
    assert tasks({})[-1] > 3 * sizes[8]
    lonely = tasks({})  # without a hot key, rows that have none are spread all the same
    assert lonely[-2] < 2 * lonely[8]


def test_the_children_are_read_once(spark, tmp_path):
    children, parents = tables(spark, 1000)
    children.write.parquet(str(tmp_path / "c"))
    plan = lookup_left(spark.read.parquet(str(tmp_path / "c")), parents, LINK)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_sketches_bound_what_they_report():
    found = hot_keys.spread_over([(1, 900), (2, 300), (None, 999), (3, 20)], 1000, 10, few_rows=50)
    assert found == {1: 36, 2: 12}
    assert hot_keys.spread_over([], 0, 10) == {}


@pytest.mark.parametrize("seed", range(3))
def test_filtered_anti_joins(spark, seed):
    r = random.Random(seed)
    keys = [r.choice([None, *range(400)]) for _ in range(300)]
    parents = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, p int")
    children = spark.createDataFrame([(r.choice([None, *range(800)]), i) for i in range(1000)], "k long, c int")
    for limit in (membership.FILTER_BYTES, 1):
        assert rows(integrity.anti_orphans(children, parents, "k", limit)) == rows(integrity.anti_orphans(children, parents, "k"))
        assert rows(integrity.anti_parents(parents, children, "k", limit)) == rows(integrity.anti_parents(parents, children, "k"))
    empty = parents.filter("false")
    assert integrity.anti_orphans(children, empty, "k", membership.FILTER_BYTES).count() == 1000
    assert integrity.anti_orphans(children.filter("false"), parents, "k", membership.FILTER_BYTES).count() == 0


def test_only_suspects_move(spark, tmp_path):
    parents = spark.range(0, 4000, 2).withColumnRenamed("id", "k")
    children = spark.range(0, 40000).withColumnRenamed("id", "k")
    suspects, missing = membership.split_by_filter(children, parents, "k")
    held = {r.k for r in suspects.collect()}
    assert held >= set(range(0, 4000, 2)) and len(held) < 2000 + 0.06 * 38000
    assert suspects.count() + missing.count() == 40000
    parents.write.parquet(str(tmp_path / "p"))
    children.write.parquet(str(tmp_path / "c"))
    session = spark.newSession()
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    parents, children = (session.read.parquet(str(tmp_path / x)) for x in "pc")
    plan = integrity.anti_orphans(children, parents, "k", membership.FILTER_BYTES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(k#") == 2  # suspects, and the parents' keys
    missing = plan[plan.index("Union") : plan.index("SortMergeJoin")]
    assert "Exchange hashpartitioning(k#" not in missing  # what misses the filter is scanned and done


def test_bitmaps_count_exactly(spark):
    r = random.Random(2)
    data = [(r.choice([None, *range(-40000, 40000, 7)]), r.randrange(5), r.randrange(1 << 60)) for _ in range(4000)]
    df = spark.createDataFrame(data, "a long, b int, wide long")
    expected = profile.distinct_counts(df, {"x": "a", "y": "b", "z": "wide"}).first()
    assert profile.distinct_counts_dense(df, {"x": "a", "y": "b", "z": "wide"}).first() == expected
    assert profile.dense_columns(df, ["a", "b", "wide"]) == ["a", "b"]
    bitmaps = profile.key_bitmaps(df, ["a", "b"])
    assert bitmaps.count() <= 4 + 2
    halves = [df.filter("b < 2"), df.filter("b >= 2")]
    merged = profile.merge_bitmaps(*[profile.key_bitmaps(h, ["a", "b"]) for h in halves])
    assert sorted(map(tuple, profile.count_bitmaps(merged).collect())) == sorted(map(tuple, profile.count_bitmaps(bitmaps).collect()))
    by_b = {(x.g, x.distinct_count) for x in profile.count_bitmaps(profile.key_bitmaps(df, ["a"], {"g": F.col("b")})).collect()}
    assert by_b == {(x.b, x.n) for x in df.groupBy("b").agg(F.count_distinct("a").alias("n")).collect()}
    none = df.filter("false")
    assert tuple(profile.distinct_counts_dense(none, {"x": "a", "z": "b"}).first()) == (0, 0)


def test_bitmaps_need_one_scan(spark, tmp_path):
    spark.range(1000).selectExpr("id as a", "id % 10 as b").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = profile.count_bitmaps(profile.key_bitmaps(df, ["a", "b"]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
