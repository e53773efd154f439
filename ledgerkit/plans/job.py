"""The whole run: ingest parents, ingest and link children, publish both, validate what was written.

Every file is parsed once, into Parquet scratch that the run deletes at its end; profiles of the raw text, rejected records
and the typed rows all come from there. Counts are taken by the tasks that write. The tables appear together, when
everything is written.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerkit.operators import integrity, profile, report
from ledgerkit.operators.hot_keys import find_hot
from ledgerkit.operators.link import LOOKUP_COLUMNS, NUMBER, choose_link, link_to_parent, numbered, spec_for
from ledgerkit.operators.project import apply_spec, clean_columns, project_existing, quoted, stitch_single_rows
from ledgerkit.session import byte_size
from ledgerkit.sources.delimited import read_delimited, repair_header
from ledgerkit.sources.folders import kept
from ledgerkit.sources.versions import Layout, Staged, discard, publish, stage
from ledgerkit.spec import JobConfig, ParentLink, TableSpec

REJECTED = "_rejected"
PROFILE_DDL = "table_name string, measure string, column_name string, detail string, value string"
COUNTS_DDL = "table_name string, measure string, value bigint"
#: Bytes of a parent's key and number: up to the session's broadcast threshold of them, no child moves in the lookup.
PAIR_BYTES = 16
#: Parents that a task of the lookup holds in memory, and its tasks for each core at least.
BUCKET_PARENTS = 1_000_000
BUCKETS_PER_CORE = 2


@dataclass(frozen=True)
class JobResult:
    """The written tables, and reports over them that run when the caller asks for their rows.

    A report whose role the spec leaves open is None. ``written`` was counted while writing: rows read, rejected and
    written of each table, and nulls of the watched columns.
    """

    parents: DataFrame
    children: DataFrame
    summary: DataFrame
    invoice_nulls: DataFrame
    parse_failures: DataFrame
    line_nulls: DataFrame
    count_by_year: DataFrame | None
    by_year: DataFrame | None
    top_countries: DataFrame | None
    parent_sample: DataFrame
    child_sample: DataFrame
    written: DataFrame | None = None
    raw_profile: DataFrame | None = None
    parent_rejects: DataFrame | None = None
    child_rejects: DataFrame | None = None


def lookup_buckets(spark: SparkSession, parents: int) -> int:
    """In how many buckets children without the key are kept for the lookup; 0 where the parents can be broadcast."""
    limit = byte_size(spark.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    if parents * PAIR_BYTES <= limit:
        return 0
    return max(-(-parents // BUCKET_PARENTS), BUCKETS_PER_CORE * spark.sparkContext.defaultParallelism)


@contextmanager
def raw_stage(
    spark: SparkSession, path: str, config: JobConfig, counts: dict[str, int], name: str, buckets: int = 0
) -> Iterator[DataFrame]:
    """The text columns of a file as Parquet scratch, its first header name repaired; one scan of the file.

    Records that do not fit the header are counted and kept whole in the column REJECTED. Children without the parent key
    are dealt to ``buckets`` by their number as they are written, and have LOOKUP_COLUMNS more.
    """
    raw = read_delimited(spark, path, config.dialect, reject_column=REJECTED, rebalance=config.rebalance)
    observed = Observation()
    raw = repair_header(raw, config.link.key, config.repair).observe(
        observed, F.count(F.lit(1)).alias("rows_read"), F.count(REJECTED).alias("rows_rejected")
    )
    dealt = buckets and config.link.key not in raw.columns and config.link.alternate in raw.columns
    if dealt:
        raw = numbered(raw, config.link)
    with kept(raw, "raw", (buckets, LOOKUP_COLUMNS) if dealt else None) as text:
        counts |= {f"{name}.{k}": v for k, v in observed.get.items()}
        yield text


def clean(raw: DataFrame) -> DataFrame:
    return clean_columns(raw.drop(REJECTED))


def raw_profile(raw: DataFrame, spec: TableSpec, keys: list[str]) -> DataFrame:
    """Blank keys, and of the date column its range, lengths and readings: (measure, column, detail, value) as rows."""

    def rows(df: DataFrame, measure: str, column: str, detail: str | None, value: str) -> DataFrame:
        return df.select(
            F.lit(spec.name).alias("table_name"),
            F.lit(measure).alias("measure"),
            (F.col("column_name") if column == "column_name" else F.lit(column)).alias("column_name"),
            (F.col(detail).cast("string") if detail else F.lit(None).cast("string")).alias("detail"),
            F.col(value).cast("string").alias("value"),
        )

    found = [rows(profile.blank_key_profile(raw, keys), "blank", "column_name", None, "blank_count")]
    date = spec.source_of(spec.roles.date) if spec.roles.date else None
    if date in raw.columns:
        span = profile.value_range(raw, date)
        found += [
            rows(span, "smallest", date, None, "min_value"),
            rows(span, "largest", date, None, "max_value"),
            rows(profile.raw_length_profile(raw, date), "length", date, "length", "row_count"),
            rows(profile.date_format_trial(raw, date), "parsed_as", date, "method", "parsed"),
        ]
    return reduce(DataFrame.unionAll, found)


def _layout(config: JobConfig) -> Layout:
    return Layout(config.max_records_per_file, table_format=config.table_format)


def _stage(df: DataFrame, table: str, config: JobConfig, spec: TableSpec | None = None) -> Staged:
    watched = {*spec.roles.watched, *spec.required} & set(df.columns) if spec else ()
    nulls = {f"null_{c}": F.count(F.when(quoted(c).isNull(), F.lit(1))) for c in sorted(watched)}
    return stage(df, table, _layout(config), f"{config.location}/{table}" if config.location else None, nulls)


def _rejects(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col(REJECTED).isNotNull())


def link_children(raw: DataFrame, parents: DataFrame, config: JobConfig) -> DataFrame:
    """Typed children with the parent key.

    Where it is looked up, children in buckets stay in place; if some numbers have very many rows on either side, they
    are shuffled instead and those numbers spread.
    """
    cleaned = clean(raw)
    spec = spec_for(cleaned.columns, config.children, config.link)
    hot = None
    if NUMBER in raw.columns:
        hot = find_hot(raw, NUMBER)
        if not hot and not find_hot(parents, config.link.alternate):
            typed = apply_spec(cleaned, spec, keep=LOOKUP_COLUMNS)
            return link_to_parent(typed, parents, config.children, config.link, config.on_duplicate)
    typed = apply_spec(cleaned, spec)
    if hot is None and choose_link(typed.columns, config.link) == "lookup":
        hot = find_hot(typed, config.link.alternate)
    return link_to_parent(typed, parents, config.children, config.link, config.on_duplicate, hot)


def run_summary(
    parents: DataFrame, children: DataFrame, link: ParentLink, parent_spec: TableSpec, child_spec: TableSpec
) -> DataFrame:
    """One row: counts, date range, distinct counts, child totals, match rates and both verdicts.

    Distinct parent keys come out of the key balance, which groups them anyway.
    """
    heads, lines = parent_spec.roles, child_spec.roles
    others = {name: c for name, c in heads.distinct.items() if c != link.key}
    parts = [integrity.key_balance(parents, children, link.key)]
    if heads.date:
        date = quoted(heads.date)
        parts.append(parents.agg(F.min(date).alias("min_date"), F.max(date).alias("max_date")))
    if others:
        parts.append(profile.distinct_counts(parents, others))
    totals = {
        "total_quantity": (F.sum, lines.quantity), "avg_tax": (F.avg, lines.rate), "min_start": (F.min, lines.start),
        "max_end": (F.max, lines.end),
    }
    body = [f(quoted(c)).alias(name) for name, (f, c) in totals.items() if c]
    if body:
        parts.append(children.agg(*body))
    row = stitch_single_rows(*parts)
    return integrity.with_integrity_status(integrity.with_count_parity(integrity.with_match_rates(row)))


def validate(config: JobConfig, parents: DataFrame, children: DataFrame, **extra: DataFrame) -> JobResult:
    heads, lines, link = config.parents, config.children, config.link
    date, category = heads.roles.date, heads.roles.category
    counted = next((c for c in heads.roles.distinct.values() if c != link.key), heads.key)
    failures = [
        profile.parse_failures(table, spec.roles.watched)
        for table, spec in ((parents, heads), (children, lines))
        if spec.roles.watched
    ]
    no_failures = profile.parse_failures(parents, ())
    return JobResult(
        parents=parents,
        children=children,
        summary=run_summary(parents, children, link, heads, lines),
        invoice_nulls=profile.null_profile(parents),
        parse_failures=reduce(DataFrame.unionAll, failures) if failures else no_failures,
        line_nulls=profile.key_null_profile(children, lines.required),
        count_by_year=report.count_by_year(parents, date) if date else None,
        by_year=report.agg_by_year(parents, date, counted) if date else None,
        top_countries=report.top_categories(parents, category) if category else None,
        parent_sample=report.sample_rows(project_existing(parents, heads.roles.sample or parents.columns)),
        child_sample=report.sample_rows(project_existing(children, lines.roles.sample or children.columns)),
        **extra,
    )


def counts_frame(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    rows = [(*key.rsplit(".", 1), n) for key, n in counts.items()]
    return spark.createDataFrame(rows, COUNTS_DDL)


def run(spark: SparkSession, config: JobConfig) -> JobResult:
    """Write both tables, their rejects and the raw profile, then return them with their reports.

    Nothing is published before all of it is written: a file that cannot be read leaves the tables of the last run.
    """
    counts: dict[str, int] = {}
    heads, lines, link = config.parents, config.children, config.link
    staged: list[Staged] = []
    try:
        with (
            raw_stage(spark, config.parents_path, config, counts, heads.name) as raw_heads,
            raw_stage(
                spark, config.children_path, config, counts, lines.name,
                lookup_buckets(spark, counts[f"{heads.name}.rows_read"]),
            ) as dealt_lines,
        ):
            raw_lines = dealt_lines.drop(*LOOKUP_COLUMNS)
            staged.append(_stage(apply_spec(clean(raw_heads), heads), config.parents_table, config, heads))
            parents = spark.table(staged[0].staged_as)
            staged.append(_stage(link_children(dealt_lines, parents, config), config.children_table, config, lines))
            staged.append(_stage(_rejects(raw_heads), f"{config.parents_table}_rejects", config))
            staged.append(_stage(_rejects(raw_lines), f"{config.children_table}_rejects", config))
            head_keys = [heads.source_of(c) for c in heads.required]
            line_keys = [*{lines.source_of(c): c for c in (*lines.required, link.key, link.alternate)}]
            profiles = raw_profile(raw_heads, heads, head_keys).unionAll(raw_profile(raw_lines, lines, line_keys))
            staged.append(_stage(profiles.coalesce(1), f"{config.parents_table}_raw_profile", config))
    except BaseException:
        for one in staged:
            discard(spark, one)
        raise
    publish(spark, staged)
    for one, spec in zip(staged, (heads, lines), strict=False):
        names = {"rows": "rows_written"}
        counts |= {f"{spec.name}.{names.get(k, k)}": v for k, v in one.counts.items()}
    parents, children, parent_rejects, child_rejects, profiles = (spark.table(one.name) for one in staged)
    return validate(
        config, parents, children, written=counts_frame(spark, counts), raw_profile=profiles,
        parent_rejects=parent_rejects, child_rejects=child_rejects,
    )
