"""Controls over invoices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditweave.functions.anchors import months_before
from auditweave.functions.envelope import Label, emit
from auditweave.functions.keys import erp_date, erp_date_between, order_system, strip_zeros
from auditweave.operators.groups import label_group, members_of, with_group_number
from auditweave.operators.ordering import dense_numbers, join_nullsafe
from auditweave.operators.proximity import day_islands
from auditweave.operators.split import split_groups
from auditweave.plans.controls.orders import ORDER_INVOICE_DOCS
from auditweave.plans.scope import COMPANY, in_scope_spend, scope_columns
from auditweave.sources.shelf import pin

L2 = "supplier_custom_category_l2"
SPLIT_THRESHOLD = 50000
ISLAND_GAP_DAYS = 3

DUPLICATE_SAME_DAY = Label(
    "Payments",
    "Scan duplicate invoices having same amount, same vendor (even if PO numbers are"
    " different) raised on same day",
    "Duplicate Invoice",
)
DUPLICATE_NEARBY = Label(
    "Payments",
    "Scan duplicate invoices having same amount, same vendor (even if PO numbers are"
    " different) raised in a span of 0-3 days",
    "Duplicate Invoice",
)
SPLIT_INVOICE = Label(
    "Payments",
    "Detect potential invoice splitting by identifying multiple invoices from the same vendor"
    " on the same day where the combined total exceeds the threshold of $50,000.",
    "Invoice Count",
)
WITHOUT_APPROVED_PO = Label("Payments", "Payment made without approved PO", "Invoice Count")


def ariba_dupe_invoices(book) -> DataFrame:
    """Invoices of one vendor, day and net paid amount."""
    src, day = book.src, book.local_today
    invoices = (
        src.ariba_invoice_line.filter(
            F.col("invoice_date").between(months_before(day, 24), F.lit(day))
            & (F.col("order_id") != "Unclassified")
        )
        .groupBy(
            F.col("order_id").alias("po_order_id"),
            "po_ordered_date",
            "po_status",
            "invoice_id",
            "invoice_date",
            F.col("description").alias("inv_description"),
            "invoice_status",
            "contract_id",
            "paid_amount",
        )
        .agg((F.col("paid_amount") - F.sum("tax_amount")).alias("invoice_amt_paid"))
        .filter(F.col("invoice_amt_paid") != 0)
    )
    scope = scope_columns(book, "vendor_id")
    suppliers = (
        src.spend_base.join(scope, "vendor_id", "left_semi")
        .select(
            F.col("vendor_id").alias("erp_supplier_id"),
            F.col("supplier_name").alias("erp_supplier"),
            F.col("po_document").alias("po_order_id"),
            F.col("category_l2").alias(L2),
        )
        .distinct()
    )
    rows = invoices.join(suppliers, "po_order_id").select(
        L2,
        "invoice_id",
        "invoice_date",
        "inv_description",
        "invoice_amt_paid",
        "erp_supplier_id",
        "erp_supplier",
    )
    rows = pin(rows, "lines")  # read for the groups and again for their members
    keys = ["invoice_date", "erp_supplier_id", "invoice_amt_paid"]
    groups = rows.groupBy(*keys).agg(F.count("*").alias("_rows")).filter("_rows > 1")
    rows = members_of(rows, with_group_number(groups.select(*keys), keys), keys)
    blank = F.lit("")
    rows = rows.withColumns(
        {
            "h_usnam_user_name": blank,
            "d_gl_account": blank,
            "d_clearing": blank,
            "d_clrng_doc": blank,
            "system": F.lit("Ariba"),
            "dupe_invoice_group": label_group("group_number"),
        }
    )
    return emit(rows, DUPLICATE_SAME_DAY, "invoice_date", book.today)


def sap_dupe_invoices(book) -> DataFrame:
    """Ledger invoices of one vendor and amount in runs of days less than 3 apart, where the
    run has several invoices and several item texts."""
    src, day = book.src, book.today
    invoices = (
        src.ledger.filter(
            (F.col("h_company_code") == COMPANY)
            & erp_date_between("h_document_date", months_before(day, 24))
            & F.col("h_document_type").isin(ORDER_INVOICE_DOCS)
        ).select(
            F.col("h_reference").alias("invoice_id"),
            erp_date("h_document_date").alias("invoice_date"),
            F.col("d_purchasing_doc").alias("_po"),
            F.col("h_docheader_text").alias("_text"),
            "d_amount_in_lc",
            "d_cost_center",
            order_system().alias("system"),
        )
    )
    orders = src.po_schedule_line.filter(
        (F.col("purchasing_document_date") >= months_before(day, 24))
        & (F.col("purchasing_organization") == COMPANY)
    ).select(
        F.col("purchasing_document_number").alias("_po"),
        "purchasing_document_date",
        F.col("vendor").alias("_order_vendor"),
        F.col("purchasing_item_short_text").alias("inv_description"),
    )
    summed = (
        invoices.join(orders, "_po")
        .groupBy(
            "invoice_id",
            "invoice_date",
            "_po",
            "purchasing_document_date",
            "_text",
            "_order_vendor",
            "inv_description",
            "d_cost_center",
            "system",
        )
        .agg(F.sum("d_amount_in_lc").alias("invoice_amt_paid"))
    )
    # one row per name and category, as the vendor list is kept
    in_scope = scope_columns(book, "vendor_id", "supplier_name", L2).select(
        F.col("vendor_id").alias("_scope")
    )
    # vendors meet their scope first, so the sums are joined, and shuffled, once
    vendors = src.dim_vendor.select(
        F.col("vendor").alias("erp_supplier_id"),
        F.col("vendor_description").alias("erp_supplier"),
    ).join(in_scope, strip_zeros("_scope") == strip_zeros("erp_supplier_id"))
    rows = (
        summed.join(vendors, strip_zeros("_order_vendor") == strip_zeros("erp_supplier_id"))
        .select(
            "invoice_id",
            "invoice_date",
            "inv_description",
            F.lit("").alias("invoice_status"),
            "invoice_amt_paid",
            "erp_supplier_id",
            "erp_supplier",
            "system",
        )
    )
    pair = ["erp_supplier_id", "invoice_amt_paid"]
    day_key, run_key = [*pair, "invoice_date"], [*pair, "island"]
    rows = pin(rows, "lines")
    runs = pin(day_islands(rows, pair, "invoice_date", ISLAND_GAP_DAYS), "runs")
    # runs are numbered before the suspicious ones are picked
    numbers = dense_numbers(runs, run_key, "group_number")
    suspicious = (
        join_nullsafe(rows, runs, day_key)
        .groupBy(*run_key)
        .agg(
            # more than one distinct value <=> smallest and largest differ
            (F.min("invoice_id") != F.max("invoice_id")).alias("_ids"),
            (F.min("inv_description") != F.max("inv_description")).alias("_texts"),
        )
        .filter("_ids AND _texts")
        .select(*run_key)
    )
    groups = join_nullsafe(suspicious, numbers, run_key)
    days = join_nullsafe(runs, groups, run_key).drop("island")
    rows = join_nullsafe(rows, days, day_key)
    rows = rows.withColumn("dupe_invoice_group", label_group("group_number", "group "))
    return emit(
        rows,
        DUPLICATE_NEARBY,
        "invoice_date",
        book.today,
        # Fixed value: this check reports one area whatever the vendor's category.
        area=F.lit("Facilities Management Services"),
    )


_SPLIT_COLUMNS = [
    L2,
    "vendor",
    "vendor_description",
    "invoice_date",
    "total_group_invoice_amount",
    "invoice_id",
    "invoice_amount_ex_tax",
    "group_id",
    "splitinvoice_group",
    "inv_description",
    "reconciliation_status",
    "system",
]


def _split_invoices(book, invoices: DataFrame) -> DataFrame:
    small = pin(invoices.filter(F.col("invoice_amount_ex_tax") < SPLIT_THRESHOLD), "small")
    groups = split_groups(
        small,
        "vendor",
        "invoice_date",
        ["vendor_description"],
        F.min("invoice_id") != F.max("invoice_id"),
        F.sum("invoice_amount_ex_tax"),
        SPLIT_THRESHOLD,
        totals={"total_group_invoice_amount": F.sum("invoice_amount_ex_tax")},
    )
    rows = (
        members_of(small, groups, ["vendor", "invoice_date"])
        .withColumn("splitinvoice_group", label_group("group_id"))
        .select(*_SPLIT_COLUMNS)
        .distinct()
    )
    return emit(rows, SPLIT_INVOICE, "invoice_date", book.today)


def ariba_split_invoice(book) -> DataFrame:
    """Invoices below the threshold that together reach it on one vendor and day."""
    src, day = book.src, book.local_today
    window_start = months_before(day, 24)
    # at most one row per calendar day of two years
    years = (
        src.dim_date.filter(F.col("calendar_day").between(window_start, F.lit(day)))
        .select(F.col("fiscal_year").cast("long").alias("_year"))
        .distinct()
    )
    suppliers = (
        in_scope_spend(src)
        .join(
            F.broadcast(years),
            F.col("fiscal_year").cast("long") == F.col("_year"),
            "left_semi",
        )
        .select(
            F.col("vendor_id").alias("vendor"),
            F.col("supplier_name").alias("vendor_description"),
            F.col("category_l2").alias(L2),
            F.col("po_document").alias("po_order_id"),
        )
        .distinct()
    )
    invoices = (
        src.ariba_invoice_line.filter(
            F.col("invoice_date").between(window_start, F.lit(day))
            & (F.col("paid_amount") != 0)
        )
        .groupBy(
            F.col("order_id").alias("po_order_id"),
            "invoice_date",
            "invoice_id",
            "reconciliation_status",
            "paid_amount",
        )
        .agg(
            (F.col("paid_amount") - F.sum("tax_amount")).alias("invoice_amount_ex_tax"),
            F.max("description").alias("inv_description"),
        )
    )
    rows = invoices.join(suppliers, "po_order_id").withColumn("system", F.lit("Ariba"))
    return _split_invoices(book, rows)


def sap_split_invoice(book) -> DataFrame:
    rows = (
        book.table("sap_invoices")
        .filter(F.col("invoice_amt") != 0)
        .groupBy(
            "vendor",
            F.col("vendor_name").alias("vendor_description"),
            L2,
            F.col("invoice_date").cast("date").alias("invoice_date"),
            F.col("invoice_desc").alias("inv_description"),
            F.col("invoice_number").alias("invoice_id"),
            "h_usnam_user_name",
            "d_gl_account",
            "system",
        )
        .agg(F.sum("invoice_amt").alias("invoice_amount_ex_tax"))
        .withColumn("reconciliation_status", F.lit(""))
    )
    return _split_invoices(book, rows)


def ariba_payments_without_approved_po(book) -> DataFrame:
    rows = (
        book.table("ariba_po_invoice")
        .filter(
            (F.col("po_status") != "Received")
            & (F.col("po_order_id") != "Unclassified")
            & F.col("amount_paid").isNotNull()
        )
        .select(
            L2,
            F.col("vendor_number").alias("erp_supplier_id"),
            "invoice_id",
            "invoice_date",
            "inv_description",
            F.col("vendor_description").alias("erp_supplier"),
            F.col("amount_paid").alias("invoice_amt_paid"),
            "tax_paid",
            F.col("amount_paid_excl_tax").alias("invoice_amt_paid_excl_tax"),
            "reconciliation_status",
            "po_order_id",
            F.col("po_spend").alias("po_spend_aud"),
            "po_status",
        )
        .distinct()
    )
    return emit(rows, WITHOUT_APPROVED_PO, "invoice_date", book.today)
