"""The same results as plain SQL over the given tables, for DuckDB."""

from __future__ import annotations

from ledgerkit.suite.exports import (
    BLANK_DATE_EVERY,
    LOST_PARENT_EVERY,
    LOST_PARENT_OFFSET,
    NO_COUNTRY_EVERY,
    NUMBER_OFFSET,
    REPEATED_NUMBER_EVERY,
)

RAW_DATE = (
    f"case when o_orderkey % {BLANK_DATE_EVERY} = 0 then '' "
    "else strftime(o_orderdate, '%-d/%m/%Y %-H:%M:%S') end"
)
TAX_TEXT = "case o_orderkey % 3 when 0 then '21,50' when 1 then '6,00' else 'bad' end"
LOST = (
    f"case when l_orderkey % {LOST_PARENT_EVERY} = 0 then l_orderkey + {LOST_PARENT_OFFSET} else l_orderkey end"
)

INVOICES = f"""invoices as (
  select o_orderkey as "InvoiceId", o_orderkey + {NUMBER_OFFSET} as "InvoiceNumber",
    o_orderkey % 7 as "ProviderId", o_custkey as "CustomerKey",
    case when o_orderkey % {BLANK_DATE_EVERY} <> 0 then o_orderdate::date end as "InvoiceDate",
    'EUR' as "Currency", case when o_orderstatus = 'F' then 1 else 0 end::bigint as "IsCreditNote"
  from orders)"""

TYPED_INVOICES = f"""typed_invoices as (
  select i."InvoiceId", i."InvoiceNumber", i."ProviderId", i."CustomerKey", i."InvoiceDate",
    case i."InvoiceId" % 3 when 0 then 21 when 1 then 6 end::bigint as "TaxPercentage",
    'EUR' as "Currency",
    case when i."InvoiceId" % 11 <> 0 then 1 end::bigint as "ExchangeRate",
    c_name || case when c_custkey % 5 = 0 then 'attn. ' else ' ' end || c_mktsegment as "BillingAddressee",
    c_mktsegment as "BillingStreet", c_nationkey::varchar as "BillingStreetNumber",
    lpad(c_custkey::varchar, 12, '0') as "BillingPostalCode", 'City; ' || n_name as "BillingCity",
    case when i."InvoiceId" % {NO_COUNTRY_EVERY} <> 0 then n_name end as "BillingCountryCode",
    i."IsCreditNote", '+++' || lpad(i."InvoiceId"::varchar, 12, '0') || '+++' as "OGM"
  from invoices i left join customer on i."CustomerKey" = c_custkey
    left join nation on c_nationkey = n_nationkey)"""


def _lines(key: str) -> str:
    return f"""lines as (
  select {key} as "InvoiceId", l_linenumber::bigint as "InvoiceLineId", l_extendedprice as "UnitPrice",
    l_quantity as "Quantity", l_tax as "TaxPercentage", l_shipdate::date as "StartDate",
    l_shipdate::date + 365 as "EndDate"
  from lineitem)"""


LINES = _lines("l_orderkey")
LOST_LINES = _lines(LOST)


def _typed_lines(key: str) -> str:
    return f"""select {key}, l_linenumber::bigint as "InvoiceLineId", l_extendedprice as "UnitPrice",
  l_quantity as "Quantity", l_tax as "TaxPercentage", l_discount as "TaxTotal",
  l_extendedprice as "TotalTaxExcl", l_extendedprice + l_tax as "TotalTaxIncl",
  l_shipdate::date as "StartDate", l_shipdate::date + 365 as "EndDate",
  p_name || ';yearly' as "Description", 'P-' || l_partkey as "ProductCode", p_brand as "ProductGroupCode"
from lineitem left join part on l_partkey = p_partkey"""


COUNTRIES = f"""countries as (
  select case when o_orderkey % {NO_COUNTRY_EVERY} <> 0 then n_name end as "BillingCountryCode"
  from orders left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey)"""

NUMBERED_LINES = f"""numbered_lines as (
  select case when "InvoiceId" < {LOST_PARENT_OFFSET} then "InvoiceId" + {NUMBER_OFFSET} end as "InvoiceNumber",
    "InvoiceLineId", "UnitPrice", "StartDate" from lines)"""

REPEATED_PARENTS = f"""parents as (
  select "InvoiceId", {NUMBER_OFFSET} + case when "InvoiceId" % {REPEATED_NUMBER_EVERY} = 0
    then "InvoiceId" - 1 else "InvoiceId" end as "InvoiceNumber" from invoices)"""

BALANCE = """balance as (
  select (select count(*) from invoices) as total_parents, (select count(*) from lines) as total_children,
    (select count(distinct "InvoiceId") from invoices) as parent_keys,
    (select count(distinct "InvoiceId") from lines) as child_keys,
    (select count(*) from lines l where not exists
      (select 1 from invoices i where i."InvoiceId" = l."InvoiceId")) as orphans,
    (select count(*) from invoices i where not exists
      (select 1 from lines l where l."InvoiceId" = i."InvoiceId")) as childless)"""

RATES = """total_parents - childless as matched_parents, total_children - orphans as matched_children,
  round(case when total_parents > 0 then (total_parents - childless) / total_parents * 100 else 0 end, 9)
    as parent_match_pct,
  round(case when total_children > 0 then (total_children - orphans) / total_children * 100 else 0 end, 9)
    as child_match_pct"""

STATUS = "case when orphans > 0 then 'FAIL' when childless > 0 then 'WARNING' else 'PASS' end as integrity_status"
PARITY = "case when total_parents = total_children then 'PASS' else 'FAIL' end as count_parity"

SUMMARY = f"""with {INVOICES}, {LINES}, {BALANCE}
select balance.*, {RATES}, {PARITY}, {STATUS},
  (select min("InvoiceDate") from invoices) as min_date, (select max("InvoiceDate") from invoices) as max_date,
  (select count(distinct "CustomerKey") from invoices) as distinct_customers,
  (select count(distinct "ProviderId") from invoices) as distinct_providers,
  (select sum("Quantity") from lines) as total_quantity,
  (select round(avg("TaxPercentage"), 9) from lines) as avg_tax,
  (select min("StartDate") from lines) as min_start, (select max("EndDate") from lines) as max_end
from balance"""

DOCUMENTS = "select doc_id::varchar as doc_id, text, lang, source, n_chars::varchar as n_chars from documents"

ORDER_COLUMNS = (
    ("o_orderkey", "bigint"),
    ("o_custkey", "bigint"),
    ("o_orderstatus", "string"),
    ("o_totalprice", "double"),
    ("o_orderdate", "timestamp_ntz"),
    ("o_orderpriority", "string"),
)


def _per_column(table: str, value: str, columns: list[str], label: str) -> str:
    """One row per column: ``value`` with the column put in, over the whole table."""
    return " union all ".join(
        f"select '{c}' as column_name, count(*) filter (where {value.format(c=c)}) as {label} from {table}"
        for c in columns
    )


def _cleaned(column: str) -> str:
    return f"""trim(replace(replace({column}, '"', ''), chr(10), ''), ' ') as {column}"""


def _status_case(name: str, lines: str, invoices: str = INVOICES) -> str:
    return f"""select * from (with {invoices}, {lines}, {BALANCE}
  select '{name}' as case_name, orphans, childless, {STATUS} from balance)"""


def _failures(relation: str, column: str) -> str:
    return f"""select '{column}' as column_name, count(*) filter (where "{column}" is null) as null_count,
  case when count(*) filter (where "{column}" is null) > 0 then 'WARNING' else 'OK' end as status from {relation}"""


RAW_KEYS = f"""raw as (
  select o_orderkey::varchar as "InvoiceId", (o_orderkey + {NUMBER_OFFSET})::varchar as "InvoiceNumber",
    o_custkey::varchar as "CustomerKey", {RAW_DATE} as "InvoiceDate", {TAX_TEXT} as "TaxPercentage",
    'EUR' as "Currency" from orders)"""


def _counted(name: str, relation: str, columns: list[str]) -> str:
    """Rows read, rejected and written of a table, and its nulls, as a run counts them."""
    parts = [
        f"select '{name}' as table_name, '{m}' as measure, {v}::bigint as value from {relation}"
        for m, v in (("rows_read", "count(*)"), ("rows_rejected", "0 * count(*)"), ("rows_written", "count(*)"))
    ]
    parts += [f"""select '{name}', 'null_{c}', count(*) filter (where "{c}" is null) from {relation}""" for c in columns]
    return " union all ".join(parts)


def _profiled(name: str, relation: str, columns: list[str]) -> str:
    return " union all ".join(
        f"""select '{name}' as table_name, 'blank' as measure, '{c}' as column_name, null::varchar as detail,
        (count(*) filter (where "{c}" is null))::varchar as value from {relation}"""
        for c in columns
    )


RAW_FILE = f"""raw_file as (
  select o_orderkey::varchar as "InvoiceId", (o_orderkey + {NUMBER_OFFSET})::varchar as "InvoiceNumber",
    o_custkey::varchar as "CustomerKey", nullif({RAW_DATE}, '') as "InvoiceDate" from orders)"""

RAW_DATE_PROFILE = """
  select 'invoices', 'smallest', 'InvoiceDate', null, min("InvoiceDate") from raw_file union all
  select 'invoices', 'largest', 'InvoiceDate', null, max("InvoiceDate") from raw_file union all
  select 'invoices', 'length', 'InvoiceDate', length("InvoiceDate")::varchar, count(*)::varchar from raw_file
    group by length("InvoiceDate") union all
  select 'invoices', 'parsed_as', 'InvoiceDate', method,
    (select case when method = 'two_digit_hour' then 0 else count("InvoiceDate") end from raw_file)::varchar
    from (values ('two_digit_hour'), ('any_hour'), ('timestamp_any_hour'), ('strip_then_day'),
      ('strip_midnight_then_day')) m(method)"""

HOT_TABLES = f"""hot_lines as (
  select case when "InvoiceNumber" % 10 < 3 then 77 else "InvoiceNumber" end as "InvoiceNumber", "InvoiceLineId", "UnitPrice",
    "StartDate" from numbered_lines),
hot_parents as (
  select min("InvoiceId") as "InvoiceId", number as "InvoiceNumber" from (
    select "InvoiceId", case when "InvoiceNumber" % 10 < 3 then 77 else "InvoiceNumber" end as number from invoices)
  group by number)"""

CUSTOMER_RUN = f"""with invoices as (select c_custkey as "InvoiceId", c_nationkey from customer), lines as (
  select case when o_orderkey % {LOST_PARENT_EVERY} = 0 then o_custkey + {LOST_PARENT_OFFSET} else o_custkey end as "InvoiceId",
    o_orderkey, case when o_orderkey % {BLANK_DATE_EVERY} <> 0 then o_orderdate::date end as placed from orders), {BALANCE}
select balance.*, {RATES}, {PARITY}, {STATUS},
  (select count(distinct c_nationkey) from invoices) as distinct_nations,
  (select sum(o_orderkey) from lines)::bigint as total_quantity,
  (select min(placed) from lines) as min_start, (select max(placed) from lines) as max_end
from balance"""

INVOICE_TYPES = (
    ("InvoiceId", "bigint"),
    ("InvoiceNumber", "bigint"),
    ("ProviderId", "bigint"),
    ("CustomerKey", "bigint"),
    ("InvoiceDate", "date"),
    ("Currency", "string"),
    ("IsCreditNote", "bigint"),
)


def _column_statistics() -> str:
    def bound(function: str, column: str, kind: str) -> str:
        return "null::varchar" if kind == "string" else f'{function}("{column}")::varchar'

    return f"with {INVOICES} " + " union all ".join(
        f"""select {i}::bigint as position, '{c}' as column_name, '{t}' as data_type,
        count(*) filter (where "{c}" is null) as null_count, {bound("min", c, t)} as min_value,
        {bound("max", c, t)} as max_value from invoices"""
        for i, (c, t) in enumerate(INVOICE_TYPES, 1)
    )


def oracle_sql() -> dict[str, str]:
    sql = _base_sql()
    return sql | {
        "overwrite_from_itself": f"with {LOST_LINES} select * from lines where \"InvoiceId\" < {LOST_PARENT_OFFSET}",
        "overwrite_failed": sql["overwrite_schema"],
        "column_statistics": _column_statistics(),
        "footer_facts": "select count(*) as row_count, "
        + ", ".join(f"{f}({c}) as {f}_{c}" for c in ("l_orderkey", "l_partkey", "l_quantity") for f in ("min", "max"))
        + " from lineitem",
        "match_rates_bucketed": sql["match_rates"],
        "lookup_left_hot": f"""with {INVOICES}, {LOST_LINES}, {NUMBERED_LINES}, {HOT_TABLES}
            select p."InvoiceId", l.* from hot_lines l left join hot_parents p on l."InvoiceNumber" = p."InvoiceNumber" """,
        "anti_orphans_filtered": sql["anti_orphans"],
        "anti_parents_filtered": sql["anti_parents"],
        "multi_distinct_bitmaps": sql["multi_distinct"],
        "distinct_by_year_bitmaps": f"with {INVOICES} "
        + " union all ".join(
            f"""select year("InvoiceDate")::bigint as year, '{c}' as column_name, count(distinct "{c}") as distinct_count
            from invoices group by 1"""
            for c in ("CustomerKey", "ProviderId")
        ),
        "run_counts": f"with {INVOICES}, {LINES} "
        + _counted("invoices", "invoices", ["CustomerKey", "InvoiceDate", "InvoiceId", "InvoiceNumber"])
        + " union all "
        + _counted("invoice_lines", "lines", ["EndDate", "InvoiceId", "InvoiceLineId", "StartDate"]),
        "raw_profile": f"with {RAW_FILE}, {LINES} "
        + _profiled("invoices", "raw_file", ["InvoiceId", "InvoiceNumber", "CustomerKey", "InvoiceDate"])
        + " union all "
        + _profiled("invoice_lines", "lines", ["InvoiceId", "InvoiceLineId", "StartDate", "EndDate"])
        + f" union all {RAW_DATE_PROFILE}",
        "rejected_records": """select o_orderkey as invoice_id, case when o_orderkey % 19 = 0 then 15 else 17 end::bigint
            as fields from orders where o_orderkey % 19 = 0 or o_orderkey % 23 = 0""",
        "full_run_customers": CUSTOMER_RUN,
    }


def _base_sql() -> dict[str, str]:
    typed_columns = [
        "InvoiceId", "InvoiceNumber", "ProviderId", "CustomerKey", "InvoiceDate", "TaxPercentage", "Currency",
        "ExchangeRate", "BillingAddressee", "BillingStreet", "BillingStreetNumber", "BillingPostalCode",
        "BillingCity", "BillingCountryCode", "IsCreditNote", "OGM",
    ]
    header_keys = ["InvoiceId", "InvoiceNumber", "CustomerKey", "InvoiceDate"]
    described = " union all ".join(
        f"select {i}::bigint as position, '{c}' as column_name, '{t}' as data_type, count({c}) as filled from orders"
        for i, (c, t) in enumerate(ORDER_COLUMNS, 1)
    )
    matched_parents = 'invoices as (select distinct l_orderkey as "InvoiceId" from lineitem)'
    return {
        "scan_delimited": DOCUMENTS,
        "scan_split": DOCUMENTS,
        "scan_permissive": f"""select o_orderkey::varchar as "InvoiceId", o_custkey::varchar as "CustomerKey",
            case when o_orderkey % 3 <> 0 then nullif({RAW_DATE}, '') end as "InvoiceDate",
            case when o_orderkey % 3 = 1 then 0 else 1 end::bigint as malformed from orders""",
        "header_repair": """select o_orderkey::varchar as "InvoiceId", o_custkey::varchar as "CustomerKey",
            '+++' || lpad(o_orderkey::varchar, 12, '0') || '+++' as "OGM" from orders""",
        "header_repair_drop": """select o_custkey::varchar as "CustomerKey", o_orderkey::varchar as "InvoiceId"
            from orders""",
        "header_repair_legacy": """select o_orderkey::varchar as "InvoiceId", o_custkey::varchar as "CustomerKey",
            '+++' || lpad(o_orderkey::varchar, 12, '0') || '+++' as "OGM" from orders""",
        "table_scan": f"with {INVOICES} select * from invoices",
        "describe_schema": described,
        "overwrite_table": f"with {LINES} select * from lines",
        "overwrite_schema": f"with {INVOICES} select * from invoices",
        "bounded_files": "select count(*) as total_rows, 0::bigint as oversized_files from lineitem",
        "readback_count": "select count(*) as row_count from lineitem",
        "clean_text": f"""select doc_id, {_cleaned('text')}, {_cleaned('lang')}, {_cleaned('source')}, n_chars
            from documents""",
        "type_invoices": f"with {INVOICES}, {TYPED_INVOICES} select * from typed_invoices",
        "type_lines": _typed_lines('l_orderkey as "InvoiceId"'),
        "type_lines_altkey": _typed_lines(f'l_orderkey + {NUMBER_OFFSET} as "InvoiceNumber"'),
        "project_existing": f"""select l_linenumber::varchar as "InvoiceLineId",
            (l_orderkey + {NUMBER_OFFSET})::varchar as "InvoiceNumber",
            '"' || p_name || '";' || chr(10) || 'yearly' as "Description",
            replace(l_extendedprice::varchar, '.', ',') as "UnitPrice",
            replace(l_quantity::varchar, '.', ',') as "Quantity"
            from lineitem left join part on l_partkey = p_partkey""",
        "project_subset": f"""with {RAW_KEYS} select "InvoiceId", "InvoiceNumber", "InvoiceDate", "TaxPercentage",
            "Currency" from raw""",
        "blank_key_profile": f"with {RAW_KEYS} "
        + _per_column("raw", "\"{c}\" is null or trim(\"{c}\", ' ') = ''", header_keys, "blank_count"),
        "blank_line_key_profile": """select 'InvoiceLineId' as column_name,
            count(*) filter (where l_linenumber is null) as blank_count from lineitem
            union all select 'InvoiceNumber', count(*) filter (where l_orderkey is null) from lineitem""",
        "null_rows": f"""with {INVOICES} select "InvoiceId", "CustomerKey" from invoices
            where "InvoiceDate" is null""",
        "link_lines": _typed_lines('l_orderkey as "InvoiceId"'),
        "link_lines_altkey": f"""with {INVOICES}, children as ({_typed_lines(
            f'l_orderkey + {NUMBER_OFFSET} as "InvoiceNumber"')})
            select i."InvoiceId", c.* exclude ("InvoiceNumber") from children c
            left join invoices i on c."InvoiceNumber" = i."InvoiceNumber" """,
        "lookup_left": f"""with {INVOICES}, {LOST_LINES}, {NUMBERED_LINES}, {REPEATED_PARENTS}
            select p."InvoiceId", l.* from numbered_lines l
            left join parents p on l."InvoiceNumber" = p."InvoiceNumber" """,
        "lookup_fan_out": f"""with {INVOICES}, {LOST_LINES}, {NUMBERED_LINES}, {REPEATED_PARENTS}, repeats as (
            select "InvoiceNumber", count(*) as n from parents where "InvoiceNumber" is not null group by 1 having count(*) > 1)
            select (select count(*) from repeats) as repeated_numbers, coalesce((select sum(n - 1) from numbered_lines
            join repeats using ("InvoiceNumber")), 0)::bigint as rows_added""",
        "lookup_left_min": f"""with {INVOICES}, {LOST_LINES}, {NUMBERED_LINES}, {REPEATED_PARENTS}
            select p."InvoiceId", l.* from numbered_lines l left join (
              select min("InvoiceId") as "InvoiceId", "InvoiceNumber" from parents group by "InvoiceNumber") p
            on l."InvoiceNumber" = p."InvoiceNumber" """,
        "anti_parents": f"""with {INVOICES}, {LINES} select "InvoiceId", "CustomerKey", "InvoiceDate"
            from invoices i where not exists (select 1 from lines l where l."InvoiceId" = i."InvoiceId")""",
        "anti_orphans": f"""with {INVOICES}, {LOST_LINES} select "InvoiceId", "InvoiceLineId", "Quantity"
            from lines l where not exists (select 1 from invoices i where i."InvoiceId" = l."InvoiceId")""",
        "row_count": "select count(*) as row_count from lineitem",
        "count_by_year": f"""with {INVOICES} select year("InvoiceDate")::bigint as year, count(*) as row_count
            from invoices where "InvoiceDate" is not null group by 1 order by 1""",
        "agg_by_year": f"""with {INVOICES} select year("InvoiceDate")::bigint as year, count(*) as row_count,
            count(distinct "CustomerKey") as distinct_count
            from invoices where "InvoiceDate" is not null group by 1 order by 1""",
        "count_by_country": f"""with {COUNTRIES} select "BillingCountryCode", count(*) as row_count
            from countries where "BillingCountryCode" is not null group by 1""",
        "date_range": f"""with {INVOICES} select min("InvoiceDate") as min_value, max("InvoiceDate") as max_value
            from invoices""",
        "raw_range": f"""with {RAW_KEYS} select min("InvoiceDate") as min_value, max("InvoiceDate") as max_value
            from raw""",
        "multi_distinct": f"""with {INVOICES} select count(distinct "InvoiceId") as distinct_invoices,
            count(distinct "CustomerKey") as distinct_customers,
            count(distinct "ProviderId") as distinct_providers from invoices""",
        "line_stats": f"""with {LINES} select count(*) as total_children,
            count(distinct "InvoiceId") as distinct_parents, sum("Quantity") as total_quantity,
            round(avg("TaxPercentage"), 9) as avg_tax, min("StartDate") as min_start, max("EndDate") as max_end
            from lines""",
        "invoice_summary": f"""with {INVOICES} select count(*) as total_parents, min("InvoiceDate") as min_date,
            max("InvoiceDate") as max_date, count(distinct "InvoiceId") as distinct_invoices,
            count(distinct "CustomerKey") as distinct_customers,
            count(distinct "ProviderId") as distinct_providers from invoices""",
        "null_profile": f"""with {INVOICES}, {TYPED_INVOICES} select * from (
            {_per_column("typed_invoices", '"{c}" is null', typed_columns, "null_count")}) where null_count > 0""",
        "key_null_profile": f"with {INVOICES} "
        + _per_column("invoices", '"{c}" is null', header_keys, "null_count"),
        "line_key_null_profile": f"with {LINES} "
        + _per_column("lines", '"{c}" is null', ["InvoiceId", "InvoiceLineId", "StartDate", "EndDate"], "null_count"),
        "top_countries": f"""with {COUNTRIES} select "BillingCountryCode", count(*) as row_count from countries
            where "BillingCountryCode" is not null group by 1 order by 2 desc, 1 limit 10""",
        "sample_rows": f"""with {INVOICES} select "InvoiceId", "InvoiceNumber", "InvoiceDate", "Currency"
            from invoices order by "InvoiceId" limit 10""",
        "parse_decimal": f"""select o_orderkey::varchar as "InvoiceId", replace({TAX_TEXT}, ',', '.') as value
            from orders""",
        "strip_time": f"""select o_orderkey::varchar as "InvoiceId",
            case when o_orderkey % {BLANK_DATE_EVERY} = 0 then '' else strftime(o_orderdate, '%-d/%m/%Y') end
            as value from orders""",
        "parse_date": f"""select o_orderkey::varchar as "InvoiceId",
            case when o_orderkey % {BLANK_DATE_EVERY} <> 0 then o_orderdate::date end as value from orders""",
        "to_long": """select o_orderkey as invoice_id,
            case o_orderkey % 3 when 0 then 21 when 1 then 6 end::bigint as tax,
            case when o_orderkey % 11 <> 0 then 1 end::bigint as rate,
            case o_orderkey % 3 when 0 then -21 when 1 then -6 end::bigint as negative_tax from orders""",
        "to_double": """select l_extendedprice as unit_price, l_extendedprice + l_tax as total,
            try_cast(p_name as double) as not_a_number from lineitem left join part on l_partkey = p_partkey""",
        "grouped_decimal": """select o_orderkey,
            case when o_totalprice < 999.995 then o_totalprice end as by_default,
            o_totalprice as with_grouping from orders""",
        "date_format_trial": f"""with readable as (
            select o_orderkey % 5 = 0 as timed from orders where o_orderkey % {BLANK_DATE_EVERY} <> 0 and o_orderkey % 13 <> 0)
            select method, (select count(*) from readable where (timed and way <> 'midnight') or (not timed and way <> 'timed'))
            ::bigint as parsed from (values ('two_digit_hour', 'timed'), ('any_hour', 'both'), ('timestamp_any_hour', 'both'),
            ('strip_then_day', 'both'), ('strip_midnight_then_day', 'midnight')) m(method, way)""",
        "raw_length_profile": f"""with {RAW_KEYS} select length("InvoiceDate")::bigint as length,
            count(*) as row_count, min("InvoiceDate") as example from raw group by 1""",
        "parse_failures": f"""with {INVOICES}, {LOST_LINES}, {NUMBERED_LINES}
            {_failures("invoices", "InvoiceDate")} union all {_failures("invoices", "CustomerKey")}
            union all {_failures("numbered_lines", "InvoiceNumber")}""",
        "count_parity": f"""with totals as (select (select count(*) from orders) as total_parents,
            (select count(*) from lineitem) as total_children) select *, {PARITY} from totals""",
        "match_rates": f"with {INVOICES}, {LOST_LINES}, {BALANCE} select *, {RATES} from balance",
        "integrity_status": " union all ".join(
            [
                _status_case("as_given", LINES),
                _status_case("lost_parents", LOST_LINES),
                _status_case("all_matched", LINES, matched_parents),
            ]
        ),
        "run_summary": SUMMARY,
        "full_run": SUMMARY,
        "full_run_native": SUMMARY,
        "full_run_altkey": SUMMARY,
        "full_run_lines": _typed_lines('l_orderkey as "InvoiceId"'),
    }
