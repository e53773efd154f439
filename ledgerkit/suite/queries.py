"""One query per operator: each takes a session and a folder of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerkit.functions import text
from ledgerkit.operators import hot_keys, integrity, link, membership, profile, project, report
from ledgerkit.operators.project import apply_spec, clean_columns
from ledgerkit.plans import invoices as I
from ledgerkit.plans import job
from ledgerkit.sources import footers, statistics, tables
from ledgerkit.sources.delimited import read_delimited, repair_header
from ledgerkit.spec import ColumnSpec, Dialect, JobConfig, ParentLink, Roles, TableSpec
from ledgerkit.suite import exports as E

Query = Callable[[SparkSession, str], DataFrame]

EXPORT = Dialect()
NO_HEADER = Dialect(header=False)
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under the name of its function."""
    QUERIES[function.__name__] = function
    return function


def _documents_export(spark: SparkSession, sf: str) -> str:
    documents = E.table(spark, sf, "documents")
    return E.export(spark, sf, "documents", documents, EXPORT)


# Sources and header repair


@query
def scan_delimited(spark: SparkSession, sf: str) -> DataFrame:
    return read_delimited(spark, _documents_export(spark, sf), EXPORT)


@query
def scan_split(spark: SparkSession, sf: str) -> DataFrame:
    """The same files, each read by many tasks: splits are small, so that many records cross their borders."""
    return read_delimited(spark, _documents_export(spark, sf), Dialect(split=True, split_bytes=1 << 16))


@query
def scan_permissive(spark: SparkSession, sf: str) -> DataFrame:
    """Records with a field missing, right, or one too many."""
    raw = E.raw_order_keys(spark, sf)
    key = F.col("InvoiceId").cast("bigint")
    tail = F.when(key % 3 == 0, F.lit("")).when(key % 3 == 1, F.concat(F.lit(";"), "InvoiceDate"))
    tail = tail.otherwise(F.concat(F.lit(";"), "InvoiceDate", F.lit(";extra")))
    records = raw.select(F.concat("InvoiceId", F.lit(";"), "CustomerKey", tail).alias("value"))
    path = E.export_text(spark, sf, "uneven", records)
    columns = ["InvoiceId", "CustomerKey", "InvoiceDate"]
    df = read_delimited(spark, path, NO_HEADER, columns=columns, reject_column="rejected")
    return df.select(*columns, F.col("rejected").isNotNull().cast("bigint").alias("malformed"))


@query
def header_repair(spark: SparkSession, sf: str) -> DataFrame:
    """First name damaged by an encoding mark: renamed."""
    damaged = E.raw_order_keys(spark, sf).withColumnRenamed("InvoiceId", "\ufffd\ufffdInvoiceId")
    path = E.export(spark, sf, "damaged_header", damaged.select(damaged.columns[0], "CustomerKey", "OGM"), EXPORT)
    return repair_header(read_delimited(spark, path, EXPORT), "InvoiceId")


@query
def header_repair_drop(spark: SparkSession, sf: str) -> DataFrame:
    """First name damaged while an intact key exists: the damaged column is dropped."""
    raw = E.raw_order_keys(spark, sf)
    twice = raw.select(F.lit("x").alias("\ufffdInvoiceId"), "CustomerKey", "InvoiceId")
    path = E.export(spark, sf, "doubled_header", twice, EXPORT)
    return repair_header(read_delimited(spark, path, EXPORT), "InvoiceId")


@query
def header_repair_legacy(spark: SparkSession, sf: str) -> DataFrame:
    """Any other first name is taken for the key."""
    raw = E.raw_order_keys(spark, sf).select(F.col("InvoiceId").alias("Nr"), "CustomerKey", "OGM")
    path = E.export(spark, sf, "unnamed_key", raw, EXPORT)
    return repair_header(read_delimited(spark, path, EXPORT), "InvoiceId", mode="legacy")


# Tables


@query
def table_scan(spark: SparkSession, sf: str) -> DataFrame:
    name = E.table_name(spark, sf, "scanned")
    _overwrite(spark, sf, E.invoices(spark, sf), name)
    return tables.table_scan(spark, name)


@query
def describe_schema(spark: SparkSession, sf: str) -> DataFrame:
    return tables.describe(E.table(spark, sf, "orders"))


def _overwrite(spark: SparkSession, sf: str, df: DataFrame, name: str, **options) -> DataFrame:
    return tables.overwrite_table(df, name, path=f"{E.shared_folder(spark)}/tables/{name}", **options)


@query
def overwrite_table(spark: SparkSession, sf: str) -> DataFrame:
    """Written twice: only the second content remains."""
    name = E.table_name(spark, sf, "overwritten")
    _overwrite(spark, sf, E.lines(spark, sf, lost_parents=True), name)
    return _overwrite(spark, sf, E.lines(spark, sf), name)


@query
def overwrite_schema(spark: SparkSession, sf: str) -> DataFrame:
    """The second frame has other columns; they replace the first ones."""
    name = E.table_name(spark, sf, "reshaped")
    _overwrite(spark, sf, E.lines(spark, sf), name)
    return _overwrite(spark, sf, E.invoices(spark, sf), name)


@query
def overwrite_from_itself(spark: SparkSession, sf: str) -> DataFrame:
    """The table is read by the query that replaces it."""
    name = E.table_name(spark, sf, "rewritten")
    written = _overwrite(spark, sf, E.lines(spark, sf, lost_parents=True), name)
    return _overwrite(spark, sf, written.filter(F.col("InvoiceId") < E.LOST_PARENT_OFFSET), name)


@query
def overwrite_failed(spark: SparkSession, sf: str) -> DataFrame:
    """A write that fails half way: the rows and columns from before are there."""
    name = E.table_name(spark, sf, "survivor")
    _overwrite(spark, sf, E.invoices(spark, sf), name)
    lines = E.lines(spark, sf)
    broken = F.when(F.col("InvoiceLineId") == 3, F.raise_error(F.lit("a bad row"))).otherwise(F.col("InvoiceLineId"))
    try:
        _overwrite(spark, sf, lines.withColumn("InvoiceLineId", broken), name)
    except PySparkException:
        return tables.table_scan(spark, name)
    raise AssertionError("the broken rows were written")


@query
def column_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """What the catalog holds after a write, without its estimates of distinct values."""
    name = E.table_name(spark, sf, "analyzed")
    _overwrite(spark, sf, E.invoices(spark, sf), name)
    statistics.analyze(spark, name)
    found = statistics.column_statistics(spark, name)
    return found.select(
        F.col("position").cast("bigint").alias("position"), "column_name", "data_type", "null_count", "min_value", "max_value"
    )


@query
def footer_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and ranges of the line file: keys from the footers, quantities read."""
    return footers.footer_facts(spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_partkey", "l_quantity"])


@query
def match_rates_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """Both tables written bucketed by key, then compared where their rows lie."""
    buckets = (8, ("InvoiceId",))
    parents = _overwrite(spark, sf, E.invoices(spark, sf), E.table_name(spark, sf, "bucketed_heads"), buckets=buckets)
    lines = E.lines(spark, sf, lost_parents=True)
    children = _overwrite(spark, sf, lines, E.table_name(spark, sf, "bucketed_lines"), buckets=buckets)
    balance = integrity.key_balance_in_place(parents, children, "InvoiceId")
    return _rounded(integrity.with_match_rates(balance), "parent_match_pct", "child_match_pct")


#: Records in a file, well under the rows of the smallest table that is tested.
SMALL_FILE = 1_000


@query
def bounded_files(spark: SparkSession, sf: str) -> DataFrame:
    name = E.table_name(spark, sf, "bounded")
    written = _overwrite(spark, sf, E.lines(spark, sf), name, max_records_per_file=SMALL_FILE, rebalance=True)
    return tables.oversized_files(written, SMALL_FILE)


@query
def readback_count(spark: SparkSession, sf: str) -> DataFrame:
    name = E.table_name(spark, sf, "counted")
    return tables.row_count(_overwrite(spark, sf, E.lines(spark, sf), name))


# Projections, cleaning, filters


@query
def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    return clean_columns(E.table(spark, sf, "documents"), ["text", "lang", "source"])


@query
def type_invoices(spark: SparkSession, sf: str) -> DataFrame:
    return apply_spec(clean_columns(E.raw_invoices(spark, sf)), I.INVOICES)


@query
def type_lines(spark: SparkSession, sf: str) -> DataFrame:
    return apply_spec(clean_columns(E.raw_lines(spark, sf)), I.LINES)


@query
def type_lines_altkey(spark: SparkSession, sf: str) -> DataFrame:
    raw = clean_columns(E.raw_lines(spark, sf, key="InvoiceNumber"))
    return apply_spec(raw, link.spec_for(raw.columns, I.LINES, I.LINK))


@query
def project_existing(spark: SparkSession, sf: str) -> DataFrame:
    return project.project_existing(E.raw_lines(spark, sf, key="InvoiceNumber"), I.LINE_SAMPLE)


@query
def project_subset(spark: SparkSession, sf: str) -> DataFrame:
    return project.project_subset(E.raw_order_keys(spark, sf), I.INVOICE_SAMPLE)


@query
def blank_key_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.blank_key_profile(E.raw_order_keys(spark, sf), I.INVOICES.required)


@query
def blank_line_key_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.blank_key_profile(E.raw_lines(spark, sf, key="InvoiceNumber"), I.RAW_LINE_KEYS)


@query
def null_rows(spark: SparkSession, sf: str) -> DataFrame:
    return profile.null_rows(E.invoices(spark, sf), "InvoiceDate").select("InvoiceId", "CustomerKey")


# Linking and joins


def _numbered_parents(spark: SparkSession, sf: str, repeated: bool = False) -> DataFrame:
    """Header keys and numbers; with ``repeated`` some headers carry the number of the one before."""
    number = F.col("InvoiceId")
    if repeated:
        number = F.when(number % E.REPEATED_NUMBER_EVERY == 0, number - 1).otherwise(number)
    return E.invoices(spark, sf).select("InvoiceId", (number + E.NUMBER_OFFSET).alias("InvoiceNumber"))


def _linked(spark: SparkSession, sf: str, key: str) -> DataFrame:
    raw = clean_columns(E.raw_lines(spark, sf, key=key))
    typed = apply_spec(raw, link.spec_for(raw.columns, I.LINES, I.LINK))
    return link.link_to_parent(typed, _numbered_parents(spark, sf), I.LINES, I.LINK)


@query
def link_lines(spark: SparkSession, sf: str) -> DataFrame:
    return _linked(spark, sf, "InvoiceId")


@query
def link_lines_altkey(spark: SparkSession, sf: str) -> DataFrame:
    return _linked(spark, sf, "InvoiceNumber")


def _numbered_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Line keys by number; the numbers of lost parents could not be parsed."""
    number = F.when(F.col("InvoiceId") < E.LOST_PARENT_OFFSET, F.col("InvoiceId") + E.NUMBER_OFFSET)
    typed = E.lines(spark, sf, lost_parents=True)
    return typed.select(number.alias("InvoiceNumber"), "InvoiceLineId", "UnitPrice", "StartDate")


@query
def lookup_left(spark: SparkSession, sf: str) -> DataFrame:
    """Repeated invoice numbers multiply their lines."""
    return link.lookup_left(_numbered_lines(spark, sf), _numbered_parents(spark, sf, repeated=True), I.LINK)


@query
def lookup_fan_out(spark: SparkSession, sf: str) -> DataFrame:
    """What the repeated numbers of ``lookup_left`` do to it."""
    return link.lookup_fan_out(_numbered_lines(spark, sf), _numbered_parents(spark, sf, repeated=True), I.LINK)


@query
def lookup_left_min(spark: SparkSession, sf: str) -> DataFrame:
    parents = _numbered_parents(spark, sf, repeated=True)
    return link.lookup_left(_numbered_lines(spark, sf), parents, I.LINK, on_duplicate="min")


#: The number that three in ten rows of both tables carry in ``lookup_left_hot``.
HOT_NUMBER = 77


@query
def lookup_left_hot(spark: SparkSession, sf: str) -> DataFrame:
    """One number on three tenths of both tables: its lines are spread, its header is copied."""

    def hot(number: str) -> Column:
        return F.when(F.col(number) % 10 < 3, F.lit(HOT_NUMBER)).otherwise(F.col(number)).alias(number)

    lines = _numbered_lines(spark, sf).select(hot("InvoiceNumber"), "InvoiceLineId", "UnitPrice", "StartDate")
    parents = _numbered_parents(spark, sf).select("InvoiceId", hot("InvoiceNumber"))
    frequent = hot_keys.find_hot(lines, "InvoiceNumber", few_rows=100)
    return link.lookup_left(lines, parents, I.LINK, on_duplicate="min", hot=frequent)


@query
def anti_orphans_filtered(spark: SparkSession, sf: str) -> DataFrame:
    """Orphans by a Bloom filter of the header keys: only lines that may have a header reach the join."""
    lines = E.lines(spark, sf, lost_parents=True).select("InvoiceId", "InvoiceLineId", "Quantity")
    return integrity.anti_orphans(lines, E.invoices(spark, sf), "InvoiceId", filter_bytes=membership.FILTER_BYTES)


@query
def anti_parents_filtered(spark: SparkSession, sf: str) -> DataFrame:
    invoices = E.invoices(spark, sf).select("InvoiceId", "CustomerKey", "InvoiceDate")
    return integrity.anti_parents(invoices, E.lines(spark, sf), "InvoiceId", filter_bytes=membership.FILTER_BYTES)


@query
def anti_parents(spark: SparkSession, sf: str) -> DataFrame:
    invoices = E.invoices(spark, sf).select("InvoiceId", "CustomerKey", "InvoiceDate")
    return integrity.anti_parents(invoices, E.lines(spark, sf), "InvoiceId")


@query
def anti_orphans(spark: SparkSession, sf: str) -> DataFrame:
    lines = E.lines(spark, sf, lost_parents=True).select("InvoiceId", "InvoiceLineId", "Quantity")
    return integrity.anti_orphans(lines, E.invoices(spark, sf), "InvoiceId")


# Aggregations


@query
def row_count(spark: SparkSession, sf: str) -> DataFrame:
    return tables.row_count(E.lines(spark, sf))


@query
def count_by_year(spark: SparkSession, sf: str) -> DataFrame:
    return report.count_by_year(E.invoices(spark, sf), "InvoiceDate")


@query
def agg_by_year(spark: SparkSession, sf: str) -> DataFrame:
    return report.agg_by_year(E.invoices(spark, sf), "InvoiceDate", "CustomerKey")


@query
def count_by_country(spark: SparkSession, sf: str) -> DataFrame:
    return report.count_by_category(E.invoice_countries(spark, sf), "BillingCountryCode")


@query
def date_range(spark: SparkSession, sf: str) -> DataFrame:
    return profile.value_range(E.invoices(spark, sf), "InvoiceDate")


@query
def raw_range(spark: SparkSession, sf: str) -> DataFrame:
    """Text order, as the raw values compare."""
    return profile.value_range(E.raw_order_keys(spark, sf), "InvoiceDate")


@query
def multi_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return profile.distinct_counts(E.invoices(spark, sf), I.DISTINCT_INVOICE_COLUMNS)


@query
def multi_distinct_bitmaps(spark: SparkSession, sf: str) -> DataFrame:
    """Several key columns from one scan."""
    return profile.distinct_counts_dense(E.invoices(spark, sf), I.DISTINCT_INVOICE_COLUMNS)


@query
def distinct_by_year_bitmaps(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct customers and providers of each year, merged from two loads of the headers."""
    invoices, year = E.invoices(spark, sf), F.year("InvoiceDate").cast("bigint")
    loads = [invoices.filter(F.col("InvoiceId") % 2 == part) for part in (0, 1)]
    bitmaps = [profile.key_bitmaps(x, ["CustomerKey", "ProviderId"], {"year": year}) for x in loads]
    return profile.count_bitmaps(profile.merge_bitmaps(*bitmaps))


@query
def line_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = report.child_stats(
        E.lines(spark, sf), "InvoiceId", "Quantity", "TaxPercentage", "StartDate", "EndDate"
    )
    return _rounded(stats, "avg_tax")


@query
def invoice_summary(spark: SparkSession, sf: str) -> DataFrame:
    return report.parent_summary(E.invoices(spark, sf), "InvoiceDate", I.DISTINCT_INVOICE_COLUMNS)


@query
def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.null_profile(apply_spec(clean_columns(E.raw_invoices(spark, sf)), I.INVOICES))


@query
def key_null_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.key_null_profile(E.invoices(spark, sf), I.INVOICES.required)


@query
def line_key_null_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.key_null_profile(E.lines(spark, sf), I.LINES.required)


# Sort, limit, samples


@query
def top_countries(spark: SparkSession, sf: str) -> DataFrame:
    return report.top_categories(E.invoice_countries(spark, sf), "BillingCountryCode", k=10)


@query
def sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    invoices = project.project_subset(E.invoices(spark, sf), ["InvoiceId", "InvoiceNumber", "InvoiceDate", "Currency"])
    return report.sample_rows(invoices, 10, order_by=["InvoiceId"])


# Scalar functions over whole columns


@query
def parse_decimal(spark: SparkSession, sf: str) -> DataFrame:
    raw = E.raw_order_keys(spark, sf)
    return raw.select("InvoiceId", text.decimal_point(F.col("TaxPercentage")).alias("value"))


@query
def strip_time(spark: SparkSession, sf: str) -> DataFrame:
    raw = E.raw_order_keys(spark, sf)
    return raw.select("InvoiceId", text.strip_time(F.col("InvoiceDate")).alias("value"))


@query
def parse_date(spark: SparkSession, sf: str) -> DataFrame:
    raw = E.raw_order_keys(spark, sf)
    return raw.select("InvoiceId", text.parse_date(F.col("InvoiceDate")).alias("value"))


@query
def to_long(spark: SparkSession, sf: str) -> DataFrame:
    """Integers, fractions cut toward zero, and text that is no number."""
    raw = E.raw_order_keys(spark, sf)
    tax = text.to_long(text.decimal_point(F.col("TaxPercentage")))
    return raw.select(
        text.to_long(F.col("InvoiceId")).alias("invoice_id"),
        tax.alias("tax"),
        text.to_long(F.col("ExchangeRate")).alias("rate"),
        text.to_long(F.concat(F.lit("-"), F.translate("TaxPercentage", ",", "."))).alias("negative_tax"),
    )


@query
def to_double(spark: SparkSession, sf: str) -> DataFrame:
    raw = E.raw_lines(spark, sf)
    return raw.select(
        text.to_double(text.decimal_point(F.col("UnitPrice"))).alias("unit_price"),
        text.to_double(text.decimal_point(F.col("TotalTaxIncl"))).alias("total"),
        text.to_double(F.col("Description")).alias("not_a_number"),
    )


@query
def grouped_decimal(spark: SparkSession, sf: str) -> DataFrame:
    """Thousands dots: null by default, parsed when the separator is declared."""
    price = F.format_number("o_totalprice", 2)
    european = F.translate(price, ",.", ".,")
    orders = E.table(spark, sf, "orders").select("o_orderkey", european.alias("price"))
    return orders.select(
        "o_orderkey",
        text.to_double(text.decimal_point(F.col("price"))).alias("by_default"),
        text.to_double(text.decimal_point(F.col("price"), grouping=".")).alias("with_grouping"),
    )


@query
def date_format_trial(spark: SparkSession, sf: str) -> DataFrame:
    return profile.date_format_trial(E.mixed_dates(spark, sf), "InvoiceDate")


@query
def raw_length_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.raw_length_profile(E.raw_order_keys(spark, sf), "InvoiceDate")


# Verdicts and the whole run


@query
def parse_failures(spark: SparkSession, sf: str) -> DataFrame:
    return profile.parse_failures(E.invoices(spark, sf), ["InvoiceDate", "CustomerKey"]).unionAll(
        profile.parse_failures(_numbered_lines(spark, sf), ["InvoiceNumber"])
    )


@query
def count_parity(spark: SparkSession, sf: str) -> DataFrame:
    return integrity.count_parity(E.invoices(spark, sf), E.lines(spark, sf))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in columns})


@query
def match_rates(spark: SparkSession, sf: str) -> DataFrame:
    balance = integrity.key_balance(
        E.invoices(spark, sf), E.lines(spark, sf, lost_parents=True), "InvoiceId"
    )
    return _rounded(integrity.with_match_rates(balance), "parent_match_pct", "child_match_pct")


@query
def integrity_status(spark: SparkSession, sf: str) -> DataFrame:
    """The tables as they are, with lost parents, and with only the invoices that have lines."""
    invoices, lines = E.invoices(spark, sf), E.lines(spark, sf)
    cases = {
        "as_given": (invoices, lines),
        "lost_parents": (invoices, E.lines(spark, sf, lost_parents=True)),
        "all_matched": (lines.select("InvoiceId").distinct(), lines),
    }
    rows = [
        integrity.with_integrity_status(integrity.key_balance(parents, children, "InvoiceId")).select(
            F.lit(name).alias("case_name"), "orphans", "childless", "integrity_status"
        )
        for name, (parents, children) in cases.items()
    ]
    return rows[0].unionAll(rows[1]).unionAll(rows[2])


@query
def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    row = job.run_summary(E.invoices(spark, sf), E.lines(spark, sf), I.LINK, I.INVOICES, I.LINES)
    return _rounded(row, "avg_tax", "parent_match_pct", "child_match_pct")


def job_config(
    spark: SparkSession, sf: str, line_key: str = "InvoiceId", split: bool = True, heads: str | None = None
) -> JobConfig:
    """The exports of a folder, written if need be, and where the job puts its tables; ``heads``: other headers' file."""
    suffix = "" if line_key == "InvoiceId" else "_by_number"
    native = "" if split else "_native"
    return JobConfig(
        parents_path=heads or E.export(spark, sf, "invoices", E.raw_invoices(spark, sf), EXPORT),
        children_path=E.export(spark, sf, f"lines{suffix}", E.raw_lines(spark, sf, line_key), EXPORT),
        parents_table=E.table_name(spark, sf, f"stg_invoices{suffix}{native}"),
        children_table=E.table_name(spark, sf, f"stg_invoice_lines{suffix}{native}"),
        parents=I.INVOICES,
        children=I.LINES,
        link=I.LINK,
        dialect=Dialect(split=split),
        rebalance=not split,
        location=f"{E.shared_folder(spark)}/tables",
    )


@query
def full_run(spark: SparkSession, sf: str) -> DataFrame:
    result = job.run(spark, job_config(spark, sf))
    return _rounded(result.summary, "avg_tax", "parent_match_pct", "child_match_pct")


@query
def full_run_native(spark: SparkSession, sf: str) -> DataFrame:
    """The run with whole files read by single tasks, as irregular quoting needs it."""
    result = job.run(spark, job_config(spark, sf, split=False))
    return _rounded(result.summary, "avg_tax", "parent_match_pct", "child_match_pct")


@query
def full_run_altkey(spark: SparkSession, sf: str) -> DataFrame:
    """The run on lines without parent keys: linked by number against the written headers."""
    result = job.run(spark, job_config(spark, sf, "InvoiceNumber"))
    return _rounded(result.summary, "avg_tax", "parent_match_pct", "child_match_pct")


@query
def full_run_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The line table a run writes."""
    return job.run(spark, job_config(spark, sf)).children



@query
def run_counts(spark: SparkSession, sf: str) -> DataFrame:
    """What the run counted while writing."""
    return job.run(spark, job_config(spark, sf)).written


@query
def raw_profile(spark: SparkSession, sf: str) -> DataFrame:
    """The profile of the raw text that the run writes beside its tables."""
    return job.run(spark, job_config(spark, sf)).raw_profile


@query
def rejected_records(spark: SparkSession, sf: str) -> DataFrame:
    """The records of a run that have a field too few or too many: the key of each and its number of fields."""
    raw = E.raw_order_keys(spark, sf)
    columns = [F.col(c) for c in I.INVOICES.column_names if c in raw.columns]
    missing = [F.lit("") for c in I.INVOICES.column_names if c not in raw.columns]
    # every 19th record lacks its last field, every 23rd has one more
    key = F.col("InvoiceId").cast("bigint")
    fields = F.concat_ws(";", *[F.coalesce(c, F.lit("")) for c in (*columns, *missing[:-1])])
    tail = F.when(key % 19 == 0, F.lit("")).when(key % 23 == 0, F.lit(";;more")).otherwise(F.lit(";"))
    header = ";".join([*[c for c in I.INVOICES.column_names if c in raw.columns], *[c for c in I.INVOICES.column_names if c not in raw.columns]])
    head = spark.range(1).select(F.lit(header).alias("value"))
    path = E.export_text(spark, sf, "uneven_heads", head.unionAll(raw.select(F.concat(fields, tail).alias("value"))).coalesce(1))
    result = job.run(spark, replace(job_config(spark, sf, heads=path), parents_table=E.table_name(spark, sf, "uneven_heads")))
    rejected = F.col(job.REJECTED)
    return result.parent_rejects.select(
        F.col("InvoiceId").cast("bigint").alias("invoice_id"), F.size(F.split(rejected, ";")).cast("bigint").alias("fields")
    )


#: Another pair of the given tables: customers and their orders.
CUSTOMERS = TableSpec(
    name="customers",
    key="CustomerId",
    required=("CustomerId", "CustomerNumber"),
    columns=(
        ColumnSpec("CustomerId", "long"),
        ColumnSpec("CustomerNumber"),
        ColumnSpec("Name"),
        ColumnSpec("Segment"),
        ColumnSpec("Balance", "double", decimal_comma=True),
        ColumnSpec("Nation", "long", source="NationId"),
    ),
    roles=Roles(category="Segment", distinct={"distinct_nations": "Nation"}, watched=("Balance",)),
)
ORDERS = TableSpec(
    name="orders",
    key="OrderId",
    required=("OrderId", "CustomerId", "Placed"),
    columns=(
        ColumnSpec("OrderId", "long"),
        ColumnSpec("CustomerId", "long"),
        ColumnSpec("Placed", "date"),
        ColumnSpec("Total", "double", decimal_comma=True),
        ColumnSpec("Priority"),
    ),
    roles=Roles(quantity="OrderId", start="Placed", end="Placed", watched=("Placed",)),
)


@query
def full_run_customers(spark: SparkSession, sf: str) -> DataFrame:
    """The run on another pair of tables, by their specs alone."""
    config = JobConfig(
        parents_path=E.export(spark, sf, "customers", E.raw_customers(spark, sf), EXPORT),
        children_path=E.export(spark, sf, "orders", E.raw_orders(spark, sf), EXPORT),
        parents_table=E.table_name(spark, sf, "stg_customers"),
        children_table=E.table_name(spark, sf, "stg_orders"),
        parents=CUSTOMERS,
        children=ORDERS,
        link=ParentLink(key="CustomerId", alternate="CustomerNumber"),
        location=f"{E.shared_folder(spark)}/tables",
    )
    return _rounded(job.run(spark, config).summary, "parent_match_pct", "child_match_pct")
