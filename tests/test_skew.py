import pytest
from pyspark.sql import functions as F

from ledgerkit.operators.integrity import anti_orphans, key_balance
from ledgerkit.operators.link import lookup_left
from ledgerkit.plans.invoices import LINK

EAGER_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
}
ROWS = 30_000


@pytest.fixture
def eager_skew(spark):
    before = {k: spark.conf.get(k, None) for k in EAGER_SKEW}
    for k, v in EAGER_SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def third_each(spark):
    """A third of the rows share one key, a third have none."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id")).cast("bigint")
    filler = F.sha2(F.col("id").cast("string"), 256).alias("t")
    return spark.range(0, ROWS, 1, 8).select(key.alias("InvoiceNumber"), F.col("id").alias("n"), filler)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_lookup_splits_a_hot_number(spark, eager_skew, third_each):
    numbers = spark.range(0, ROWS, 1, 8).withColumnRenamed("id", "InvoiceNumber")
    parents = numbers.withColumn("InvoiceId", F.col("InvoiceNumber") + 10**6)
    joined = lookup_left(third_each, parents, LINK)
    assert "SortMergeJoin(skew=true)" in final_plan(joined)
    row = joined.agg(F.count("*"), F.count("InvoiceId"), F.countDistinct("n")).first()
    assert tuple(row) == (ROWS, ROWS // 3 * 2, ROWS)


def test_orphans_split_a_hot_key(spark, eager_skew, third_each):
    children = third_each.withColumnRenamed("InvoiceNumber", "InvoiceId")
    parents = spark.range(8, ROWS, 1, 8).select(F.col("id").alias("InvoiceId"))
    orphans = anti_orphans(children, parents, "InvoiceId")
    assert "SortMergeJoin(skew=true)" in final_plan(orphans)
    found = orphans.count()
    assert found == children.filter("InvoiceId is null or InvoiceId < 8").count()
    assert found == key_balance(parents, children, "InvoiceId").first().orphans


def test_balance_moves_counters_not_rows(spark, third_each):
    """A hot key leaves each scan task as one row."""
    hot = third_each.select(F.lit(7).cast("bigint").alias("k"))
    balance = key_balance(hot, hot, "k")
    assert balance.first().total_children == ROWS
    plan = balance._jdf.queryExecution().executedPlan().toString()
    below_shuffle = plan.split("Exchange hashpartitioning")[1]
    assert "partial_sum(p" in below_shuffle and "partial_sum(c" in below_shuffle
