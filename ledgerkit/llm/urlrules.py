"""URL rules by a sort-merge range join, in DataFrame operations only.

A canonical key is the host's labels in reverse order, each ended by a dot, then a slash mark and the path:
``org.example.|/es/1``. All URLs that a rule fits have, for one of their host's ancestors, a key in the interval from the
rule's key to the key followed by the highest byte. Intervals of different rules nest or lie apart. Rules' ends and
URLs' keys are sorted together; a running count of open intervals is the depth of a stack, and the rule on top of it
is the last one opened at that depth: both are window functions over the same order.

Every distinct host and path is judged once, so a hot URL costs one row. Keys are dealt into ``salts`` parts, each with
all rules: no host, however hot, is swept in one task. The rules are the small side; they are copied, not broadcast.

Cases: null URLs and those without ``://`` have empty host and path, and the default verdict; nulls, repeated rows and
repeated or null ids keep a row each; rules that repeat a host and path with one verdict count once, with two they are
an error; a rule's host and A-Z case are as given; other columns are kept, those named like the result's are replaced;
an empty table gives an empty result, and no rules give the default verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerkit.llm.columns import on_plain_names, settle
from ledgerkit.llm.scratch import partitions

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES_DDL = "host string, path string, verdict string"
RULE_COLUMNS, ADDED = ["host", "path", "verdict"], ["host", "path", "rule", "verdict"]


def _cut(text: Column, marks: str) -> Column:
    """``text`` up to the first of ``marks``."""
    folded = F.translate(text, marks, marks[0] * len(marks))
    return F.substring_index(folded, marks[0], 1)


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; else empty."""
    return F.translate(_cut(_after_scheme(url), "/?#"), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    rest = _after_scheme(url)
    host = _cut(rest, "/?#")
    return F.substring_index(F.substring_index(F.substr(rest, F.length(host) + 1), "?", 1), "#", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def _reversed_labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(labels, "."), F.lit(".|"), path).cast("binary")


def rules_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(host, path, verdict) rows; paths begin with a slash."""
    return spark.createDataFrame(rules, RULES_DDL)


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", salts: int | None = None) -> DataFrame:
    """``pages`` (url, ...) with host, path, rule (host and path of the longest that fits, or null) and verdict."""
    salts = salts or partitions(pages.sparkSession)
    return on_plain_names(pages, ["url"], ADDED, lambda kept: _judge(kept, settle(rules, RULE_COLUMNS), default, salts))


def _judge(kept: DataFrame, rules: DataFrame, default: str, salts: int) -> DataFrame:
    url = F.col("url").cast("string")
    parsed = kept.withColumns({"host": host_of(url), "path": path_of(url)})
    distinct = parsed.select("host", "path").distinct()

    # one key for each ancestor of the host, the host itself included, down to the depth of the deepest rule
    labels = _reversed_labels(F.col("host"))
    deepest = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 1
    depth = F.least(F.size(labels), F.lit(deepest))
    ancestors = F.explode(F.transform(F.sequence(F.lit(1), depth), lambda n: F.slice(labels, 1, n)))
    keys = distinct.select("host", "path", ancestors.alias("labels")).select(
        F.pmod(F.xxhash64("host", "path"), F.lit(salts)).cast("int").alias("salt"),
        _key(F.col("labels"), F.col("path")).alias("key"), F.lit(1).alias("kind"), F.lit(0).alias("step"),
        "host", "path", F.lit(None).cast("struct<rule:string,verdict:string>").alias("opened"),
    )

    named = rules.groupBy("host", "path").agg(F.min("verdict").alias("verdict"), F.max("verdict").alias("other"))
    clash = F.concat(F.lit("two verdicts for "), "host", "path")
    named = named.select("host", "path", F.when(F.col("verdict") == F.col("other"), F.col("verdict")).otherwise(
        F.raise_error(clash)).alias("verdict"))
    start = _key(_reversed_labels(F.col("host")), F.col("path"))
    ends = F.array(
        F.struct(start.alias("key"), F.lit(0).alias("kind"), F.lit(1).alias("step")),
        F.struct(F.concat(start, F.unhex(F.lit("FF"))).alias("key"), F.lit(2).alias("kind"), F.lit(-1).alias("step")),
    )
    rule = F.struct(F.concat("host", "path").alias("rule"), "verdict")
    events = named.select(rule.alias("opened"), F.explode(ends).alias("e"))
    events = events.select(F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), "e.*", "opened").select(
        "salt", "key", "kind", "step", F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("path"),
        F.when(F.col("kind") == 0, F.col("opened")).alias("opened"),
    )

    order = ["key", "kind"]
    sweep = Window.partitionBy("salt").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    stacked = keys.unionByName(events).withColumn("depth", F.sum("step").over(sweep))
    level = Window.partitionBy("salt", "depth").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    top = stacked.withColumn("top", F.last("opened", ignorenulls=True).over(level)).filter("kind = 1")
    size = F.when(F.col("depth") > 0, F.length("top.rule"))
    best = top.groupBy("host", "path").agg(F.max(F.struct(size.alias("size"), "top.rule", "top.verdict")).alias("best"))
    found = best.select(
        F.col("host").alias("of_host"), F.col("path").alias("of_path"),
        F.when(F.col("best.size").isNotNull(), F.col("best.rule")).alias("rule"),
        F.when(F.col("best.size").isNotNull(), F.col("best.verdict")).otherwise(default).alias("verdict"),
    )
    joined = parsed.join(found, (F.col("host") == F.col("of_host")) & (F.col("path") == F.col("of_path")))
    return joined.drop("of_host", "of_path")
