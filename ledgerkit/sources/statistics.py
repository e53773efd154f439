"""Column statistics of a catalog table: taken after a write, shown as rows, used by the planner."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


STATISTICS_DDL = (
    "position int, column_name string, data_type string, distinct_count bigint, null_count bigint, min_value string, "
    "max_value string, avg_length bigint, max_length bigint"
)


def analyze(spark: SparkSession, name: str) -> None:
    """Take size, row count and the statistics of all columns: one pass over the table."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")


def column_statistics(spark: SparkSession, name: str) -> DataFrame:
    """One row per column of what the catalog holds; distinct counts are estimates. Only the catalog is asked."""
    rows = []
    for position, field in enumerate(spark.table(name).schema.fields, 1):
        found = spark.sql(f"DESCRIBE TABLE EXTENDED {name} `{field.name.replace('`', '``')}`").collect()
        facts = {r["info_name"]: None if r["info_value"] == "NULL" else r["info_value"] for r in found}

        def number(fact: str, facts: dict[str, str | None] = facts) -> int | None:
            return None if facts.get(fact) is None else int(facts[fact])

        rows.append(
            (
                position, field.name, field.dataType.simpleString(), number("distinct_count"), number("num_nulls"),
                facts.get("min"), facts.get("max"), number("avg_col_len"), number("max_col_len"),
            )
        )
    return spark.createDataFrame(rows, STATISTICS_DDL)
