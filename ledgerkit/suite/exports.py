"""The given tables seen as invoice exports: orders are headers, line items are lines.

``raw_*`` frames are the text an export would hold, defects included; ``invoices`` and ``lines`` are what
ingesting that text must give. Defects are spread by key over whole tables; no row is left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerkit.operators.hot_keys import join_tasks
from ledgerkit.session import byte_size, shared_folder, task_memory
from ledgerkit.spec import Dialect

NUMBER_OFFSET = 1_000_000
BLANK_DATE_EVERY = 97
NO_COUNTRY_EVERY = 53
LOST_PARENT_EVERY = 10
LOST_PARENT_OFFSET = 1_000_000_000_000
REPEATED_NUMBER_EVERY = 15
#: Bytes of a row held in memory beside its text, the room its table grows by included.
HELD_ROW_BYTES = 150

_written: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _every(column: str, n: int) -> Column:
    return F.col(column) % n == 0


def _comma(column: str | Column) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return F.replace(value.cast("string"), F.lit("."), F.lit(","))


def _european(date: Column) -> Column:
    return F.date_format(date, "d/MM/yyyy H:mm:ss")


def raw_order_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The header columns that come from orders alone, as export text."""
    return table(spark, sf_dir, "orders").select(*_order_text())


def _order_text() -> list[Column]:
    return [
        _text("o_orderkey").alias("InvoiceId"),
        (F.col("o_orderkey") + NUMBER_OFFSET).cast("string").alias("InvoiceNumber"),
        (F.col("o_orderkey") % 7).cast("string").alias("ProviderId"),
        _text("o_custkey").alias("CustomerKey"),
        F.when(_every("o_orderkey", BLANK_DATE_EVERY), F.lit(""))
        .otherwise(_european(F.col("o_orderdate")))
        .alias("InvoiceDate"),
        F.element_at(F.array(F.lit("21,50"), F.lit("6,00"), F.lit("bad")), (F.col("o_orderkey") % 3 + 1).cast("int"))
        .alias("TaxPercentage"),
        F.lit("EUR").alias("Currency"),
        F.when(_every("o_orderkey", 11), F.lit("1,08")).otherwise(F.lit("1")).alias("ExchangeRate"),
        F.when(F.col("o_orderstatus") == "F", F.lit("1")).otherwise(F.lit("0")).alias("IsCreditNote"),
        F.concat(F.lit("+++"), F.lpad(_text("o_orderkey"), 12, "0"), F.lit("+++")).alias("OGM"),
    ]


def mixed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_order_keys`` with some times of day other than midnight and some texts that are no dates."""
    raw, key = raw_order_keys(spark, sf_dir), F.col("InvoiceId").cast("bigint")
    timed = F.regexp_replace("InvoiceDate", " 0:00:00$", " 13:45:10")
    mixed = F.when(_every("InvoiceId", 13), F.lit("no date")).when(key % 5 == 0, timed).otherwise(F.col("InvoiceDate"))
    return raw.withColumn("InvoiceDate", F.when(_every("InvoiceId", BLANK_DATE_EVERY), F.lit("")).otherwise(mixed))


def raw_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All header columns as export text; addressees carry quotes, and line feeds for some keys.

    Orders meet their customers as they are and become text afterwards: a join that shuffles moves four narrow columns.
    """
    nation = table(spark, sf_dir, "nation")
    customer = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    billing = [
        F.concat(
            F.lit(' "'), "c_name", F.when(_every("c_custkey", 5), F.lit('"\nattn. ')).otherwise(F.lit('" ')),
            "c_mktsegment", F.lit(" "),
        ).alias("BillingAddressee"),
        F.col("c_mktsegment").alias("BillingStreet"),
        _text("c_nationkey").alias("BillingStreetNumber"),
        F.lpad(_text("c_custkey"), 12, "0").alias("BillingPostalCode"),
        F.concat(F.lit("City; "), "n_name").alias("BillingCity"),
    ]
    country = F.when(F.col("InvoiceId").cast("bigint") % NO_COUNTRY_EVERY != 0, F.col("n_name"))
    return (
        table(spark, sf_dir, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        .select(*_order_text(), *billing, "n_name")
        .select(
            "InvoiceId", "InvoiceNumber", "ProviderId", "CustomerKey", "InvoiceDate", "TaxPercentage",
            "Currency", "ExchangeRate", "BillingAddressee", "BillingStreet", "BillingStreetNumber",
            "BillingPostalCode", "BillingCity", country.alias("BillingCountryCode"), "IsCreditNote", "OGM",
        )
    )


def _held(lookup: DataFrame) -> DataFrame:
    """A table to join others to: beyond the broadcast threshold the tasks of the join share its rows and hold them in
    memory, so that the other side is not sorted and does not spill. Both are sorted where memory is too small."""
    spark = lookup.sparkSession
    size = int(str(lookup._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size <= byte_size(spark.conf.get("spark.sql.autoBroadcastJoinThreshold")):
        return lookup
    text = F.octet_length(F.concat_ws("", *lookup.columns))
    need = lookup.agg(F.sum(text + F.lit(HELD_ROW_BYTES))).first()[0] or 0
    return lookup.hint("shuffle_hash") if need <= task_memory(spark) * join_tasks(lookup) else lookup


def raw_lines(spark: SparkSession, sf_dir: str, key: str = "InvoiceId") -> DataFrame:
    """Line text keyed by ``InvoiceId``, or by ``InvoiceNumber`` for an export without parent keys."""
    part = _held(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand"))
    lineitem = table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    parent = F.col("l_orderkey") if key == "InvoiceId" else F.col("l_orderkey") + NUMBER_OFFSET
    return lineitem.select(
        parent.cast("string").alias(key),
        _text("l_linenumber").alias("InvoiceLineId"),
        _comma("l_extendedprice").alias("UnitPrice"),
        _comma("l_quantity").alias("Quantity"),
        _comma("l_tax").alias("TaxPercentage"),
        _comma("l_discount").alias("TaxTotal"),
        _comma("l_extendedprice").alias("TotalTaxExcl"),
        _comma(F.col("l_extendedprice") + F.col("l_tax")).alias("TotalTaxIncl"),
        _european(F.col("l_shipdate")).alias("StartDate"),
        _european(F.date_add(F.col("l_shipdate").cast("date"), 365)).alias("EndDate"),
        F.concat(F.lit('"'), "p_name", F.lit('";\nyearly')).alias("Description"),
        F.concat(F.lit("P-"), "l_partkey").alias("ProductCode"),
        F.col("p_brand").alias("ProductGroupCode"),
    )


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed headers without the billing columns: only orders are read."""
    dated = ~_every("o_orderkey", BLANK_DATE_EVERY)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("InvoiceId"),
        (F.col("o_orderkey") + NUMBER_OFFSET).alias("InvoiceNumber"),
        (F.col("o_orderkey") % 7).alias("ProviderId"),
        F.col("o_custkey").alias("CustomerKey"),
        F.when(dated, F.col("o_orderdate").cast("date")).alias("InvoiceDate"),
        F.lit("EUR").alias("Currency"),
        F.when(F.col("o_orderstatus") == "F", F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("IsCreditNote"),
    )


def invoice_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header key and billing country; customers and nations are joined on their keys."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    located = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    country = F.when(~_every("o_orderkey", NO_COUNTRY_EVERY), F.col("n_name"))
    return located.select(F.col("o_orderkey").alias("InvoiceId"), country.alias("BillingCountryCode"))


def lines(spark: SparkSession, sf_dir: str, lost_parents: bool = False) -> DataFrame:
    """Typed line keys, numbers and dates; with ``lost_parents`` some keys point to no invoice."""
    key = F.col("l_orderkey")
    if lost_parents:
        key = F.when(_every("l_orderkey", LOST_PARENT_EVERY), key + LOST_PARENT_OFFSET).otherwise(key)
    start = F.col("l_shipdate").cast("date")
    return table(spark, sf_dir, "lineitem").select(
        key.alias("InvoiceId"),
        F.col("l_linenumber").cast("bigint").alias("InvoiceLineId"),
        F.col("l_extendedprice").alias("UnitPrice"),
        F.col("l_quantity").alias("Quantity"),
        F.col("l_tax").alias("TaxPercentage"),
        start.alias("StartDate"),
        F.date_add(start, 365).alias("EndDate"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as export text: another pair of tables than invoices and lines."""
    return table(spark, sf_dir, "customer").select(
        _text("c_custkey").alias("CustomerId"),
        F.concat(F.lit("C"), F.lpad(_text("c_custkey"), 9, "0")).alias("CustomerNumber"),
        F.concat(F.lit('"'), "c_name", F.lit('"\n')).alias("Name"),
        F.when(~_every("c_custkey", NO_COUNTRY_EVERY), F.col("c_mktsegment")).alias("Segment"),
        _comma("c_acctbal").alias("Balance"),
        _text("c_nationkey").alias("NationId"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as export text; every few have lost their customer."""
    lost = _every("o_orderkey", LOST_PARENT_EVERY)
    key = F.when(lost, F.col("o_custkey") + LOST_PARENT_OFFSET).otherwise(F.col("o_custkey"))
    return table(spark, sf_dir, "orders").select(
        _text("o_orderkey").alias("OrderId"),
        key.cast("string").alias("CustomerId"),
        F.when(_every("o_orderkey", BLANK_DATE_EVERY), F.lit(" ")).otherwise(_european(F.col("o_orderdate"))).alias("Placed"),
        _comma("o_totalprice").alias("Total"),
        F.col("o_orderpriority").alias("Priority"),
    )


def _written_once(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """Write an export to the shared folder unless this application already has; return its path."""
    path = f"{shared_folder(spark)}/exports/{sf_dir.strip('/').replace('/', '_')}/{name}"
    if path not in _written:
        write(path)
        _written.add(path)
    return path


def export(spark: SparkSession, sf_dir: str, name: str, df: DataFrame, dialect: Dialect) -> str:
    """A text frame as delimited files."""
    writer = df.write.mode("overwrite").options(**dialect.write_options())
    return _written_once(spark, sf_dir, name, writer.csv)


def export_text(spark: SparkSession, sf_dir: str, name: str, rows: DataFrame) -> str:
    """Ready-made records, one text value each, without a header."""
    return _written_once(spark, sf_dir, name, rows.write.mode("overwrite").text)


def table_name(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A catalog name no other application uses."""
    parts = [spark.sparkContext.applicationId, sf_dir.strip("/"), name]
    return "lk_" + "_".join("".join(c if c.isalnum() else "_" for c in p) for p in parts).lower()
