"""Specs of the two invoice exports: headers (parents) and lines (children)."""

from __future__ import annotations

from ledgerkit.spec import ColumnSpec as C
from ledgerkit.spec import ParentLink, Roles, TableSpec

# Columns shown as samples, keys checked in raw lines, and columns whose distinct values are counted.
RAW_LINE_KEYS = ("InvoiceLineId", "InvoiceId", "InvoiceNumber")
INVOICE_SAMPLE = ("InvoiceId", "InvoiceNumber", "InvoiceDate", "TaxPercentage", "Currency")
LINE_SAMPLE = ("InvoiceLineId", "InvoiceId", "InvoiceNumber", "Description", "UnitPrice", "Quantity")
DISTINCT_INVOICE_COLUMNS = {
    "distinct_invoices": "InvoiceId",
    "distinct_customers": "CustomerKey",
    "distinct_providers": "ProviderId",
}

# Column names, types and order of both typed tables, their keys and watched columns.
INVOICES = TableSpec(
    name="invoices",
    key="InvoiceId",
    required=("InvoiceId", "InvoiceNumber", "CustomerKey", "InvoiceDate"),
    roles=Roles(
        date="InvoiceDate",
        category="BillingCountryCode",
        distinct=DISTINCT_INVOICE_COLUMNS,
        watched=("InvoiceDate",),
        sample=INVOICE_SAMPLE,
    ),
    columns=(
        C("InvoiceId", "long"),
        C("InvoiceNumber", "long"),
        C("ProviderId", "long"),
        C("CustomerKey", "long"),
        C("InvoiceDate", "date"),
        C("TaxPercentage", "long", decimal_comma=True),
        C("Currency"),
        C("ExchangeRate", "long"),
        C("BillingAddressee"),
        C("BillingStreet"),
        C("BillingStreetNumber"),
        C("BillingPostalCode"),
        C("BillingCity"),
        C("BillingCountryCode"),
        C("IsCreditNote", "long"),
        C("OGM"),
    ),
)

LINES = TableSpec(
    name="invoice_lines",
    key="InvoiceLineId",
    required=("InvoiceId", "InvoiceLineId", "StartDate", "EndDate"),
    roles=Roles(
        quantity="Quantity",
        rate="TaxPercentage",
        start="StartDate",
        end="EndDate",
        watched=("InvoiceId",),
        sample=LINE_SAMPLE,
    ),
    columns=(
        C("InvoiceId", "long"),
        C("InvoiceLineId", "long"),
        C("UnitPrice", "double", decimal_comma=True),
        C("Quantity", "double", decimal_comma=True),
        C("TaxPercentage", "double", decimal_comma=True),
        C("TaxTotal", "double", decimal_comma=True),
        C("TotalTaxExcl", "double", decimal_comma=True),
        C("TotalTaxIncl", "double", decimal_comma=True),
        C("StartDate", "date"),
        C("EndDate", "date"),
        C("Description"),
        C("ProductCode"),
        C("ProductGroupCode"),
    ),
)

LINK = ParentLink(key="InvoiceId", alternate="InvoiceNumber")
