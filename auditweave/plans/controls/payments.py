"""Controls over payments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditweave.functions.anchors import months_before
from auditweave.functions.envelope import Label, emit
from auditweave.functions.keys import erp_date_between, order_system
from auditweave.functions.money import repeated
from auditweave.operators.groups import label_group, members_of, with_group_number
from auditweave.operators.ordering import dense_numbers
from auditweave.operators.proximity import has_other_nearby, on_or_after
from auditweave.plans.scope import COMPANY, scope_columns, vendor_categories
from auditweave.sources.shelf import pin

L2 = "supplier_custom_category_l2"

SAME_DAY = Label(
    "Payments", "SAP - Scan for multiple payments to same vendor on same date.", "Payment Count"
)
SAME_AMOUNT = Label(
    "Payments",
    "SAP - Scan for multiple payments of same amount to same vendor in span of 30 days.",
    "Payment Count",
)
WITHIN_ONE_DAY = Label(
    "Payments", "Scan for multiple payments >$1000 to same vendor within 1 day.", "Invoice"
)
SAME_DATE_AS_INVOICE = Label(
    "Payments",
    "SAP-Detect potential early payments by scanning for vendor payments made on the same day"
    " as the invoice date (or invoice receipt date), even though the vendor has payment terms"
    " greater than 0 days",
    "Invoice Count",
)
EXCEEDING_INVOICE = Label(
    "Payments", "SAP - Scan for payments exceeding invoiced amount", "Invoice"
)
BLOCKED_VENDOR = Label(
    "Payments", "SAP - Scan for Payments on Blocked Vendor Accounts", "Vendor Count"
)
WEEKEND_HOLIDAY = Label(
    "Payments", "SAP - Scan for payments made on weekends and public holidays.", "Payment Count"
)
ONE_TIME = Label("Payments", "One time Vendor payment over 50000AUD", "Vendor Count")
SOON_AFTER_CREATION = Label(
    "Payments", "Scan for payments done within 7 days of Vendor Creation", "Vendor Count"
)

REPEAT_DAYS = 30
SAME_DAY_FLOOR = 10000
ONE_TIME_FLOOR = 50000
NEW_VENDOR_DAYS = 7
# Fixed value: payment terms that are due at once.
IMMEDIATE_TERMS = "N005"

def _payment_columns() -> list:
    return [
        L2,
        F.col("d_vendor").alias("vendor"),
        "vendor_name",
        "payment_date",
        "payment_date_appears_in_vendor_account",
        "payment_clearing_doc",
        "payment_amount",
    ]


def multiple_payments_same_day(book) -> DataFrame:
    payments = book.table("base_payment")
    groups = (
        payments.filter(F.col("payment_date").isNotNull())
        .groupBy("d_vendor", "payment_date", "vendor_name")
        .agg(F.count("*").alias("_rows"))
        .filter("_rows > 1")
    )
    numbers = dense_numbers(groups, ["d_vendor", "payment_date"], "payment_group")
    rows = (
        members_of(payments, numbers, ["d_vendor", "payment_date"])
        .select(*_payment_columns(), "payment_group")
        .distinct()
    )
    return emit(rows, SAME_DAY, "payment_date", book.today)


def repeat_payments_same_amount(book, within: int = REPEAT_DAYS) -> DataFrame:
    """Payments whose clearing document repeats a vendor's amount within ``within`` days."""
    payments = book.table("base_payment")
    repeated = has_other_nearby(
        payments,
        ["d_vendor", "payment_amount"],
        "payment_clearing_doc",
        "payment_date",
        within,
    )
    vendors = scope_columns(book, "vendor_id", "supplier_name", L2)
    rows = (
        payments.drop(L2, "vendor_name")
        .join(repeated, "payment_clearing_doc", "left_semi")
        .join(vendors, F.col("d_vendor") == F.col("vendor_id"))
        .withColumnRenamed("supplier_name", "vendor_name")
        .select(*_payment_columns(), "d_gl_account")
        .distinct()
    )
    return emit(rows, SAME_AMOUNT, "payment_date", book.today)


def payments_within_1_day(book, floor: int = SAME_DAY_FLOOR) -> DataFrame:
    """Vendor credits of at least ``floor`` that share a vendor and posting day."""
    src, day = book.src, book.today
    credits = src.ledger.filter(
        (F.col("h_company_code") == COMPANY)
        & (F.col("d_shkzg_debit_credit_ind") == "H")
        & (F.coalesce("d_special_gl_ind", F.lit("")) == "")
        & (F.col("d_amount") >= floor)
        & (F.col("d_vendor") != "")
        & erp_date_between("h_document_date", months_before(day, 24))
    ).select(
        order_system(with_freight=True).alias("system"),
        F.col("d_vendor").alias("vendor"),
        F.col("d_document_number").alias("invoice_number"),
        F.col("h_posting_date").alias("payment_date"),
        F.col("d_amount").alias("payment_amount"),
    )
    credits = pin(credits, "credits")  # read for the groups and again for their members
    vendors = scope_columns(book, "vendor_id", "supplier_name", L2)
    keys = ["vendor", "payment_date"]
    shared = credits.groupBy(*keys).agg(F.count("*").alias("_rows")).filter("_rows > 1")
    # groups are numbered over the vendors in scope only
    in_scope = shared.select(*keys).join(
        vendors.select(F.col("vendor_id").alias("vendor")), "vendor", "left_semi"
    )
    groups = with_group_number(in_scope, keys, "_number")
    rows = (
        members_of(credits.distinct(), groups, keys)
        .join(vendors, F.col("vendor") == F.col("vendor_id"))
        .select(
            L2,
            "system",
            "vendor",
            F.col("supplier_name").alias("vendor_name"),
            "invoice_number",
            "payment_date",
            "payment_amount",
            label_group("_number").alias("payment_group"),
        )
        .distinct()
    )
    return emit(rows, WITHIN_ONE_DAY, "payment_date", book.today, prior_year="never")


def same_invoice_payment_date(book) -> DataFrame:
    """Invoices paid on their own date although the vendor's terms allow later payment."""
    terms = (
        book.src.vendor_terms.filter(F.col("payment_terms") != IMMEDIATE_TERMS)
        .select(
            F.col("vendor").alias("_vendor"),
            "payment_terms",
            F.col("payment_terms_desc").alias("payment_terms_description"),
        )
        .distinct()
    )
    invoices = book.table("sap_invoices").select(
        "vendor",
        "vendor_name",
        L2,
        "invoice_date",
        # the check reports the header text in the place of the number
        F.col("invoice_desc").alias("invoice_number"),
        "invoice_amt",
        "d_clrng_doc",
        "system",
    )
    payments = book.table("base_payment").select(
        "payment_clearing_doc", "payment_date", "payment_amount"
    )
    same = (F.col("d_clrng_doc") == F.col("payment_clearing_doc")) & (
        F.col("invoice_date") == F.col("payment_date")
    )
    rows = (
        invoices.join(payments, same)
        .join(terms, F.col("vendor") == F.col("_vendor"))
        .drop("_vendor", "payment_clearing_doc")
        .distinct()
    )
    return emit(rows, SAME_DATE_AS_INVOICE, "invoice_date", book.today, keep_area=True)


def payment_vs_invoice_amount(book, direction: str = "invoice_over_payment") -> DataFrame:
    """Payments against the invoices cleared by the same document.

    As written it keeps payments below the invoiced total; 'payment_over_invoice' is what
    its label says. The total counts an invoice once per payment of the document, so it is
    the invoice sum times the number of payments and needs no window over the joined rows.
    """
    payments, invoices = book.table("base_payment"), book.table("sap_invoices")
    doc = "payment_clearing_doc"
    invoiced = invoices.groupBy(F.col("d_clrng_doc").alias(doc)).agg(
        F.sum("invoice_amt").alias("_sum")
    )
    paid = payments.groupBy(doc).agg(F.count("*").alias("_payments"))
    totals = invoiced.join(paid, doc).select(
        doc, repeated(invoiced, "_sum", "_payments").alias("invoice_total")
    )
    over = {
        "invoice_over_payment": F.col("invoice_total") > F.col("payment_amount"),
        "payment_over_invoice": F.col("payment_amount") > F.col("invoice_total"),
    }[direction]
    lines = invoices.select(
        F.col("d_clrng_doc").alias(doc),
        "invoice_date",
        "invoice_desc",
        "invoice_number",
        "invoice_amt",
        "system",
    )
    rows = payments.join(totals, doc).filter(over).join(lines, doc).distinct()
    return emit(rows, EXCEEDING_INVOICE, "invoice_date", book.today, keep_area=True)


def payments_to_blocked_vendors(book) -> DataFrame:
    # Vendor status codes and their report texts.
    status = (
        F.when(F.col("vendor_status") == "B", "Block- applied for Payments")
        .when(F.col("vendor_status") == "C", "Block -applied to Purchase/Procurement")
        .when(F.col("vendor_status") == "", "No Response")
    )
    blocked = book.src.dim_vendor.filter(F.col("vendor_status") != "A").select(
        F.col("vendor").alias("_vendor"),
        status.alias("vendorstatus"),
        "date_first_created",
        "date_last_changed",
    )
    # payments are distinct already; a vendor listed twice alike is reported once
    rows = (
        book.table("base_payment")
        .join(blocked.distinct(), F.col("d_vendor") == F.col("_vendor"))
        .drop("_vendor")
    )
    return emit(rows, BLOCKED_VENDOR, "payment_date", book.today, keep_area=True)


def payments_weekend_holiday(book) -> DataFrame:
    day = book.today
    # distinct days of two years: a few hundred rows whatever the data
    holidays = (
        book.src.holiday.filter(
            (F.col("event_type") == "Public Holiday")
            & F.col("event_start_date").between(months_before(day, 24), F.lit(day))
        )
        .select(F.col("event_start_date").alias("_holiday"))
        .distinct()
    )

    def flag(condition):
        return F.when(condition, "Y").otherwise("N")

    rows = (
        book.table("base_payment")
        .join(F.broadcast(holidays), F.col("payment_date") == F.col("_holiday"), "left")
        .withColumn("is_weekend", flag(F.dayofweek("payment_date").isin(1, 7)))
        .withColumn("is_public_holiday", flag(F.col("_holiday").isNotNull()))
        .filter("is_weekend = 'Y' OR is_public_holiday = 'Y'")
        .select(*_payment_columns(), "is_weekend", "is_public_holiday")
        .distinct()
    )
    return emit(rows, WEEKEND_HOLIDAY, "payment_date", day, prior_year="cumulative")


def one_time_vendor_payment(book) -> DataFrame:
    """Vendors with a single payment row, over the floor."""
    vendor = book.src.dim_vendor.select(
        F.col("vendor").alias("supplier_id"),
        F.col("vendor_description").alias("supplier_name"),
        "vendor_status",
        F.trim("tax_id").alias("abn"),
        F.col("date_first_created").alias("supplier_creation_date"),
        "building_number",
        "street",
        "city",
        "postal_code",
        "state",
        "country",
    )
    # A vendor with several payments is out whatever the look-ups do, so count first: the
    # look-ups then meet one row per remaining vendor.
    single = (
        book.table("base_payment")
        .groupBy(F.col("d_vendor").alias("supplier_id"))
        .agg(
            F.count("*").alias("_payments"),
            F.max("payment_date").alias("payment_date"),
            F.max("payment_amount").alias("payment_amount"),
        )
        .filter("_payments = 1")
        .drop("_payments")
    )
    detailed = single.join(vendor, "supplier_id").join(
        vendor_categories(book, "supplier_id"), "supplier_id"
    )
    only_once = (
        detailed.groupBy("supplier_id").agg(F.count("*").alias("_rows")).filter("_rows = 1")
    )
    rows = detailed.join(only_once.select("supplier_id"), "supplier_id").filter(
        F.col("payment_amount") > ONE_TIME_FLOOR
    )
    return emit(rows, ONE_TIME, "payment_date", book.today, keep_area=True)


def payment_soon_after_creation(book) -> DataFrame:
    vendor = book.src.dim_vendor.select(
        F.col("vendor").alias("supplier_id"),
        F.col("vendor_description").alias("supplier_name"),
        F.trim("tax_id").alias("abn"),
        F.col("date_first_created").alias("supplier_creation_date"),
    )
    paid = book.table("base_payment").select("d_vendor", "payment_date").distinct()
    soon = on_or_after(
        F.col("payment_date"), F.col("supplier_creation_date"), NEW_VENDOR_DAYS
    )
    rows = (
        paid.join(vendor, (F.col("d_vendor") == F.col("supplier_id")) & soon)
        .drop("d_vendor")
        .join(vendor_categories(book, "supplier_id"), "supplier_id")
        .distinct()
    )
    return emit(
        rows, SOON_AFTER_CREATION, "supplier_creation_date", book.today, keep_area=True
    )
