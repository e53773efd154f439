"""Multi-line delimited files read by many tasks per file.

Spark's multi-line reader gives a whole file to one task, so one export holding most of the data stops
everything else. Here the file is scanned as physical lines, which Spark can split. A line with an odd
number of quotes opens or closes a quoted value; counting those per split tells which splits begin or end
inside a record. The few lines of records that cross a split border are put together by a small grouping;
everything else is joined to records inside its own task, in scan order, without a shuffle.

That is right only for files whose quoting is regular, so every record with quotes is checked against the
record grammar and the query fails on the first one that does not fit, naming the reader to use instead.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerkit.session import byte_size, ensure_checkpoint_dir
from ledgerkit.spec import Dialect

SPLIT_KEY = ["file", "start", "size", "modified"]
# Bytes of one row of the split table; it is broadcast only below the session's own threshold.
SPLIT_BYTES = 300
# Tasks for each core of a scan whose splits are read several by one task.
TASKS_PER_CORE = 4
# A line with content; the characters up to the space are what the multi-line reader takes for blank.
FILLED = r"[^\x00-\x20]"


def _pinned_session(spark: SparkSession, split_bytes: int | None) -> SparkSession:
    """A session with the caller's settings whose scans cut files the same way each time.

    Spark sizes splits by the executors present at planning time; under dynamic allocation two scans of
    one file could be cut differently. The caller's own session is left as it is.
    """
    pinned = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            pinned.conf.set(name, value)
    if split_bytes:
        pinned.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
        pinned.conf.set("spark.sql.files.openCostInBytes", min(split_bytes, 4 << 20))
    pinned.conf.set("spark.sql.files.minPartitionNum", spark.sparkContext.defaultParallelism)
    return pinned


def physical_lines(spark: SparkSession, path: str | list[str], split_bytes: int | None = None) -> DataFrame:
    """Lines with the split they lie in and a number that grows along each split.

    Splits smaller than the session's own are read several by one task: each task reports to the driver, so their number
    follows the bytes, not the splits. Lines are numbered before that, by split.
    """
    text = _pinned_session(spark, split_bytes).read.option("lineSep", "\n").text(path)
    lines = text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )
    usual = byte_size(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    if split_bytes and split_bytes < usual:
        splits, least = text.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism
        lines = lines.coalesce(min(splits, max(-(-splits * split_bytes // usual), TASKS_PER_CORE * least)))
    # Through a view, what is built on the pinned scan belongs to the caller's session again.
    view = f"lines_{uuid.uuid4().hex}"
    lines.createGlobalTempView(view)
    try:
        return spark.table(f"{spark.conf.get('spark.sql.globalTempDatabase')}.{view}")
    finally:
        spark.catalog.dropGlobalTempView(view)


def split_states(lines: DataFrame, quote: str) -> DataFrame:
    """One row per split: whether it begins and ends inside a quoted value, its first and last line with
    an odd number of quotes, its first line with content, and the split that owns its leading lines; of
    its file, whether the first line ends in a carriage return and whether a quoted value stays open."""
    quote_bytes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit(quote), F.lit("")))
    odd = F.when(quote_bytes % (2 * len(quote.encode())) != 0, F.col("line"))
    per_split = lines.groupBy(*SPLIT_KEY).agg(
        (F.count(odd) % 2).alias("parity"),
        F.min(odd).alias("first_odd"),
        F.max(odd).alias("last_odd"),
        F.min(F.when(F.rlike("value", F.lit(FILLED)), F.col("line"))).alias("first_filled"),
        F.min_by(F.endswith("value", F.lit("\r")), "line").alias("first_returns"),
    )
    whole_file = W.partitionBy("file")
    in_file = W.partitionBy("file").orderBy("start")
    before = in_file.rowsBetween(W.unboundedPreceding, -1)
    so_far = in_file.rowsBetween(W.unboundedPreceding, 0)
    opens = F.col("ends_inside") & F.col("first_odd").isNotNull()
    return (
        per_split.withColumns(
            {
                "begins_inside": F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2 == 1,
                "ends_inside": F.sum("parity").over(so_far) % 2 == 1,
            }
        )
        .withColumns(
            {
                "head_owner": F.last(F.when(opens, F.col("start")), ignorenulls=True).over(before),
                "returns": F.max(F.when(F.col("start") == 0, F.col("first_returns"))).over(whole_file),
                "stays_open": F.sum("parity").over(whole_file) % 2 == 1,
            }
        )
        .drop("parity", "first_returns")
    )


def _record_pattern(dialect: Dialect) -> str:
    """One whole record: fields that are quoted throughout, or that do not begin with a quote."""
    d, q = re.escape(dialect.delimiter), re.escape(dialect.quote)
    quoted = rf"[ \t]*{q}(?:[^{q}]|{q}{q})*{q}[ \t]*"
    plain = rf"[ \t]*(?:[^{q}{d}\n \t][^{d}\n]*)?"
    field = rf"(?:{quoted}|{plain})"
    return rf"\A{field}(?:{d}{field})*\z"


def _opening_pattern(dialect: Dialect) -> str:
    """The first line of a record that goes on: whole fields, then a quoted one left open."""
    d, q = re.escape(dialect.delimiter), re.escape(dialect.quote)
    text = rf"[^{q}]*+(?:{q}{q}[^{q}]*+)*+"
    field = rf"(?:[ \t]*{q}{text}{q}[ \t]*|[ \t]*(?:[^{q}{d} \t][^{d}]*+)?)"
    return rf"\A(?:{field}{d})*[ \t]*{q}{text}\z"


def _record_joiner(quote: str, pattern: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A batch function joining the lines of each record with line feeds and checking the result."""

    def join_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[pa.Array] = []
        inside = 0
        for batch in batches:
            lines = batch.column(0)
            odd = pc.count_substring(lines, quote).to_numpy(zero_copy_only=False) % 2
            inside_after = (np.cumsum(odd) + inside) % 2
            ends = np.flatnonzero(inside_after == 0)
            if len(lines):
                inside = int(inside_after[-1])
            if not len(ends):
                pending.append(lines)
                continue
            done = int(ends[-1]) + 1
            earlier = sum(len(p) for p in pending)
            whole = pa.concat_arrays([*pending, lines.slice(0, done)])
            pending = [lines.slice(done)] if done < len(lines) else []
            records = whole
            if len(ends) < len(whole):
                offsets = np.concatenate([[0], ends + 1 + earlier]).astype(np.int32)
                records = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), whole), "\n")
            quoted = records.filter(pc.match_substring(records, quote))
            regular = pc.match_substring_regex(quoted, pattern)
            if not pc.all(regular, min_count=0).as_py():
                bad = quoted.filter(pc.invert(regular))[0].as_py()
                raise ValueError(f"irregular quoting, read with Dialect(split=False): {bad[:200]!r}")
            yield pa.RecordBatch.from_arrays([records], names=["value"])
        if any(len(p) for p in pending):
            raise ValueError("a quoted value is never closed, read with Dialect(split=False)")

    return join_lines


def read_split(
    spark: SparkSession,
    path: str | list[str],
    dialect: Dialect,
    names: list[str],
    reject_column: str | None = None,
    same_header: bool = False,
) -> DataFrame:
    """Text columns ``names`` of regular multi-line files, one task per split.

    The split table is worked out at once (one counting pass) and kept in the shared folder; its size
    against ``spark.sql.autoBroadcastJoinThreshold`` decides how it is joined. Line endings are settled file by
    file, by the first line. A file with a value that is never closed fails here, and a line that seems to open
    a value without beginning a quoted field fails before any line is grouped. The rest is lazy. ``same_header`` requires every file to name its columns so.
    """
    if dialect.encoding.upper() != "UTF-8" or dialect.quote != dialect.escape:
        raise ValueError("Dialect(split=True) needs UTF-8 and quotes escaped by doubling")
    if any("\n" in name for name in names):
        raise ValueError("Dialect(split=True) needs a header on one line")
    lines = physical_lines(spark, path, dialect.split_bytes)

    ensure_checkpoint_dir(spark)
    splits = split_states(lines, dialect.quote).checkpoint()
    open_file = splits.filter("stays_open and first_odd is not null").orderBy("file", "start").select("file", "first_odd")
    if bad := open_file.first():
        at = lines.filter((F.col("file") == bad["file"]) & (F.col("line") == bad["first_odd"])).select("value").first()
        raise ValueError(
            f"a quoted value is never closed in {bad['file']}, read with Dialect(split=False); its first line with an odd "
            f"number of quotes: {at['value'][:200]!r}"
        )
    limit = byte_size(spark.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    if splits.count() * SPLIT_BYTES <= limit:
        located = lines.join(F.broadcast(splits), SPLIT_KEY, "left")
    else:
        located = lines.join(splits.hint("shuffle_merge"), SPLIT_KEY, "left").sortWithinPartitions(*SPLIT_KEY, "line")
    ended = F.col("returns") & F.endswith("value", F.lit("\r"))
    located = located.withColumn("value", F.when(ended, F.expr("substr(value, 1, length(value) - 1)")).otherwise(F.col("value")))

    def parsed(columns: list[str], **options: str) -> Column:
        ddl = ", ".join("`{}` string".format(name.replace("`", "``")) for name in columns)
        return F.from_csv("value", F.lit(ddl), dialect.parse_options() | {"multiLine": "true"} | options)

    head = F.col("begins_inside") & F.coalesce(F.col("line") <= F.col("first_odd"), F.lit(True))
    tail = F.col("ends_inside") & F.coalesce(F.col("line") >= F.col("last_odd"), F.lit(False))
    is_header = F.lit(dialect.header) & (F.col("start") == 0)
    is_header &= F.coalesce(F.col("line") == F.col("first_filled"), F.lit(False))
    other_header = parsed(names) != F.struct(*[F.lit(name).alias(name) for name in names])
    problem = F.when(F.col("begins_inside").isNull(), F.raise_error(F.lit("the files changed while being read")))
    opening = F.col("ends_inside") & F.coalesce(F.col("line") == F.col("last_odd"), F.lit(False))
    problem = problem.when(
        opening & ~F.rlike("value", F.lit(_opening_pattern(dialect))),
        F.raise_error(F.concat(F.lit("irregular quoting, read with Dialect(split=False): "), "file", F.lit(": "), "value")),
    )
    if same_header:
        problem = problem.when(
            is_header & other_header,
            F.raise_error(F.concat(F.lit("another header in "), "file", F.lit(": "), "value")),
        )
    body = located.filter(problem.isNull() & ~is_header)

    inner = body.filter(~head & ~tail).select("value")
    parts = F.array_sort(F.collect_list(F.struct("start", "line", "value")))
    crossing = (
        body.filter(head | tail)
        .withColumn("owner", F.when(head, F.col("head_owner")).otherwise(F.col("start")))
        .groupBy("file", "owner")
        .agg(F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("value"))
        .select("value")
    )
    records = inner.unionAll(crossing).mapInArrow(
        _record_joiner(dialect.quote, _record_pattern(dialect)), "value string"
    )

    record = (
        parsed([*names, reject_column], columnNameOfCorruptRecord=reject_column) if reject_column else parsed(names)
    )
    return records.filter(F.rlike("value", F.lit(FILLED))).select(record.alias("record")).select("record.*")
