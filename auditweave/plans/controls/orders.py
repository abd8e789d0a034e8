"""Controls over purchase orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditweave.functions.anchors import months_before
from auditweave.functions.envelope import Label, emit
from auditweave.functions.keys import erp_date, erp_date_between, order_system, strip_zeros
from auditweave.functions.money import repeated
from auditweave.operators.groups import label_group, members_of, with_group_number
from auditweave.operators.ordering import dense_numbers
from auditweave.operators.proximity import later_day_members, near_date_pairs
from auditweave.plans.scope import COMPANY, vendor_categories
from auditweave.sources.shelf import pin

L2 = "supplier_custom_category_l2"

DUPLICATE_FLOOR = 10000
SPLIT_THRESHOLD = 50000
OPEN_AFTER_DAYS = 30
CLOSED_STATUSES = ["Confirmed", "Received", "Rejected"]

# The report texts below.
DUPLICATE_PO = Label(
    "Procurement",
    "Duplicate POs having same amount, same vendor raised in a span of 0-3 days",
    "Duplicate PO",
)
SPLIT_PO = Label(
    "Payments",
    "Detect potential PO splitting by identifying multiple POs raised by the same vendor on the"
    " same day where the combined total exceeds the threshold of $50,000. ",
    "PO Count",
)
OPEN_PO = Label(
    "Procurement",
    "Ariba - Scan for aged open purchase orders i.e. > x days from purchase order date",
    "PO Count",
)
INVOICE_BEFORE_PO = Label(
    "Payments", "Invoices dated before their matched PO dates", "Invoice Count"
)
INVOICE_NOT_MATCHING = Label(
    "Payments", "Invoices where sum(invoice) ≠ sum(PO)", "Invoice Count"
)



def ariba_dupe_po(book, symmetric: bool = False) -> DataFrame:
    """Orders of one vendor and amount within 3 days.

    As written the order with the smaller number must not be the earlier one;
    ``symmetric`` drops that and counts every two orders at most 3 days apart.
    """
    po = (
        book.table("ariba_po_invoice")
        .filter(
            ~F.col("vendor_number").isin(*book.exempt_vendors)
            & (F.col("po_spend") > DUPLICATE_FLOOR)
        )
        .select(
            "po_number",
            "po_date",
            F.col("po_title").alias("po_description"),
            "vendor_number",
            "vendor_description",
            "po_spend",
            "po_status",
            L2,
        )
        .distinct()
    )
    keyed = pin(po, "orders").withColumn(
        "_key", F.concat("vendor_number", F.lit("-"), F.col("po_spend").cast("string"))
    )
    members = later_day_members(keyed, ["_key"], "po_number", "po_date", 3, both=symmetric)
    # The group text is the key's number followed by the anchor day, ordered as text.
    numbers = dense_numbers(keyed, ["_key"], "_key_number")
    members = members.join(numbers, "_key").select(
        "po_number",
        F.concat(
            F.col("_key_number").cast("string"), F.lit("-"), F.col("anchor").cast("string")
        ).alias("_group"),
    )
    # written, so that their size is known before the orders are dealt for them
    members = pin(members, "members")
    flagged = pin(keyed.drop("_key").join(members, "po_number"), "flagged")
    repeated = (
        flagged.groupBy("_group").agg(F.count("*").alias("_rows")).filter("_rows > 1")
    )
    groups = with_group_number(repeated.select("_group"), ["_group"])
    rows = members_of(flagged, groups, ["_group"]).drop("_group").distinct()
    rows = rows.withColumns(
        {"dupe_po_group": label_group("group_number", "group "), "system": F.lit("Ariba")}
    )
    return emit(rows, DUPLICATE_PO, "po_date", book.today)


def _pair_groups(orders: DataFrame, within: int) -> DataFrame:
    """(po_number, group_number): every two orders of one vendor and amount at most
    ``within`` days apart form a group, named by the smaller order number."""
    pairs = pin(
        near_date_pairs(
            orders, ["vendor_number", "po_spend"], "po_number", "po_date", within
        ),
        "pairs",
    )
    return (
        pairs.select("low", F.explode(F.array("low", "high")).alias("po_number"))
        .distinct()
        .join(dense_numbers(pairs, ["low"], "group_number"), "low")
        .drop("low")
    )


def sap_duplicate_po(book) -> DataFrame:
    """Orders of one vendor and gross amount at most 3 days apart, grouped by the smaller
    order number of each pair; an order is in every group it pairs into."""
    po = book.table("sap_po").filter(
        (F.col("po_amount_gross") > DUPLICATE_FLOOR) & ~F.col("vendor").isin(*book.exempt_vendors)
    )
    shaped = po.select(
        F.col("purchasing_document_number").alias("po_number"),
        F.col("purchasing_document_date").cast("date").alias("po_date"),
        F.col("purchasing_item_short_text").alias("po_description"),
        F.col("vendor").alias("vendor_number"),
        F.col("vendor_name").alias("vendor_description"),
        F.col("po_amount_gross").alias("po_spend"),
        F.lit("").alias("po_status"),
        L2,
    )
    rows = shaped.distinct().join(_pair_groups(shaped, 3), "po_number").withColumns(
        {"dupe_po_group": label_group("group_number"), "system": F.lit("SAP")}
    )
    return emit(rows, DUPLICATE_PO, "po_date", book.today, prior_year="cumulative")


def maximo_duplicate_po(book, within: int | None = None) -> DataFrame:
    """Orders of one vendor, name, day and gross amount.

    The report's text speaks of 0-3 days; ``within=3`` groups as it says, the way
    ``sap_duplicate_po`` does.
    """
    po = (
        book.table("maximo_po")
        .filter(F.col("po_amount_gross") > DUPLICATE_FLOOR)
        .select(
            L2,
            F.col("purchasing_document_number").alias("po_number"),
            F.col("purchasing_document_date").cast("date").alias("po_date"),
            F.col("purchasing_item_short_text").alias("po_description"),
            F.col("vendor").alias("vendor_number"),
            F.col("vendor_name").alias("vendor_description"),
            F.col("po_amount_gross").alias("po_spend"),
            F.col("status").alias("po_status"),
        )
    )
    keys = ["vendor_number", "vendor_description", "po_date", "po_spend"]
    if within is None:
        groups = po.groupBy(*keys).agg(F.count("*").alias("_rows")).filter("_rows > 1")
        rows = members_of(po, with_group_number(groups.select(*keys), keys), keys).distinct()
    else:
        rows = po.distinct().join(_pair_groups(po, within), "po_number")
    rows = rows.withColumns(
        {"dupe_po_group": label_group("group_number"), "system": F.lit("Maximo")}
    )
    return emit(rows, DUPLICATE_PO, "po_date", book.today)


def _split_members(
    rows: DataFrame, also_by: list[str], several: Column, reached: Column, amount: str
) -> DataFrame:
    """Members of vendor-days on which some group of orders reaches the threshold.

    Groups are formed by vendor, day and ``also_by`` but numbered by vendor and day. The
    amount reported for a day counts every order of the day once per group found on it, so
    one pass over the rows gives groups, day totals and numbers.
    """
    keys = ["vendor_number", "po_date"]
    found = F.col("_several") & (F.col("_reached") >= SPLIT_THRESHOLD)
    days = (
        rows.filter(F.col("vendor_number").isNotNull() & F.col("po_date").isNotNull())
        .groupBy(*keys, *also_by)
        .agg(
            several.alias("_several"), reached.alias("_reached"), F.sum(amount).alias("_sum")
        )
        .groupBy(*keys)
        .agg(F.count(F.when(found, 1)).alias("_groups"), F.sum("_sum").alias("_sum"))
        .filter("_groups > 0")
        .select(
            *keys,
            repeated(rows, amount, "_groups", "_sum").alias("total_po_amount"),
        )
    )
    return members_of(rows, with_group_number(days, keys, "group_id"), keys)


def ariba_split_po(book) -> DataFrame:
    po = (
        book.table("ariba_po_invoice")
        .select(
            "po_number",
            "requisition_id",
            "po_date",
            "vendor_number",
            "vendor_description",
            "po_amount_invoiced",
            "po_spend",
            "po_status",
            "po_title",
            "contract_id",
            "requestor",
            "approver",
            L2,
        )
        .distinct()
    )
    members = _split_members(
        po, ["vendor_description", L2], F.count("po_number") > 1, F.sum("po_amount_invoiced"), "po_amount_invoiced"
    )
    rows = (
        members.select(
            L2,
            "vendor_number",
            "vendor_description",
            "po_date",
            "total_po_amount",
            "po_number",
            F.col("po_amount_invoiced").alias("po_individual_amount"),
            "group_id",
            label_group("group_id").alias("splitpo_group"),
            F.lit("Ariba").alias("system"),
        )
        .distinct()
    )
    return emit(rows, SPLIT_PO, "po_date", book.today, prior_year="same_as_last_year")


def sap_split_po(book) -> DataFrame:
    po = (
        book.table("sap_po")
        .select(
            F.col("purchasing_document_number").alias("po_number"),
            F.col("purchasing_document_date").alias("po_date"),
            F.col("vendor").alias("vendor_number"),
            F.col("vendor_name").alias("vendor_description"),
            F.col("po_amount_net").alias("po_amount"),
            F.col("purchasing_item_short_text").alias("po_description"),
            L2,
        )
        .distinct()
    )
    members = _split_members(
        po, ["vendor_description"], F.min("po_number") != F.max("po_number"), F.sum("po_amount"), "po_amount"
    )
    rows = (
        members.select(
            L2,
            "vendor_number",
            "vendor_description",
            "po_date",
            "total_po_amount",
            "po_number",
            F.col("po_amount").alias("po_individual_amount"),
            "group_id",
            label_group("group_id").alias("splitpo_group"),
            F.lit("SAP").alias("system"),
        )
        .distinct()
    )
    return emit(rows, SPLIT_PO, "po_date", book.today)


def ariba_open_po(book) -> DataFrame:
    age = F.datediff(F.lit(book.today), "po_date")
    rows = (
        book.table("ariba_po_invoice")
        .filter(
            ~F.col("po_status").isin(CLOSED_STATUSES)
            & (age > OPEN_AFTER_DAYS)
            & (F.col("po_spend") > 1)
        )
        .select(
            L2,
            "po_number",
            "po_date",
            F.col("po_title").alias("po_description"),
            "po_status",
            "vendor_number",
            "vendor_description",
            "po_spend",
            "po_amount_invoiced",
            F.lit("Ariba").alias("system"),
        )
        .distinct()
    )
    return emit(rows, OPEN_PO, "po_date", book.today)


def ariba_invoices_before_po(book) -> DataFrame:
    rows = (
        book.table("ariba_po_invoice")
        .filter(F.col("invoice_date") <= F.col("po_date"))
        .select(
            L2,
            "po_order_id",
            "po_date",
            F.col("po_spend").alias("sum_po_spend_aud"),
            "po_status",
            "invoice_id",
            "invoice_date",
            "inv_description",
            "invoice_status",
            F.col("amount_invoiced").alias("invoice_amt"),
            F.col("vendor_number").alias("erp_supplier_id"),
            F.col("vendor_description").alias("erp_supplier"),
            F.lit("Ariba").alias("system"),
        )
    )
    return emit(rows, INVOICE_BEFORE_PO, "invoice_date", book.today)


# Ledger document types of order-based invoices.
ORDER_INVOICE_DOCS = ["PX", "PY", "VS", "Y0", "YM"]


def sap_invoices_before_po(book, open_ended: bool = False) -> DataFrame:
    """Ledger invoices dated on or before their order.

    ``open_ended`` is the second definition of this check: no upper date bound, and
    duplicates removed once after the joins instead of on each side.
    """
    src, day = book.src, book.today
    start, end = months_before(day, 24), None if open_ended else F.lit(day)
    po_day = F.col("purchasing_document_date")
    invoices = src.ledger.filter(
        (F.col("h_company_code") == COMPANY)
        & erp_date_between("h_document_date", start, end)
        & F.col("h_document_type").isin(ORDER_INVOICE_DOCS)
    ).select(
        F.col("h_reference").alias("invoice_id"),
        erp_date("h_document_date").alias("invoice_date"),
        F.col("d_purchasing_doc").alias("po_order_id"),
        F.col("h_docheader_text").alias("inv_description"),
        "d_amount",
        "d_amount_in_lc",
        "d_gl_amount",
        "d_cost_center",
        "h_document_type",
        order_system().alias("system"),
    )
    orders = src.po_schedule_line.filter(
        (po_day >= start if end is None else po_day.between(start, end))
        & (F.col("purchasing_organization") == COMPANY)
    ).select(
        F.col("purchasing_document_number").alias("po_order_id"),
        F.col("purchasing_document_date").alias("po_date"),
        F.col("vendor").alias("erp_supplier_id"),
        "purchasing_item_short_text",
        F.col("net_order_value").alias("po_amount"),
    )
    # both dates are at hand before any look-up, so late invoices leave first
    lines = (
        invoices.distinct()
        .join(orders.distinct(), "po_order_id")
        .filter(F.col("invoice_date") <= F.col("po_date"))
    )
    named = lines.join(
        src.dim_vendor.select(
            F.col("vendor").alias("_vendor"), F.col("vendor_description").alias("erp_supplier")
        ),
        strip_zeros("erp_supplier_id") == strip_zeros("_vendor"),
    ).join(
        vendor_categories(book, "_scope"),
        strip_zeros("erp_supplier_id") == strip_zeros("_scope"),
    )
    named = named.drop("_vendor", "_scope")
    if open_ended:
        named = named.distinct()
    rows = (
        named.groupBy(
            "invoice_id",
            "invoice_date",
            "po_order_id",
            "po_date",
            "inv_description",
            "erp_supplier_id",
            "erp_supplier",
            "purchasing_item_short_text",
            "d_cost_center",
            "system",
            L2,
        )
        .agg(
            F.sum("d_amount_in_lc").alias("invoice_amt"),
            F.sum("po_amount").alias("sum_po_spend_aud"),
        )
        .select(
            L2,
            "po_order_id",
            "po_date",
            "sum_po_spend_aud",
            F.lit("").alias("po_status"),
            "invoice_id",
            "invoice_date",
            "inv_description",
            F.lit("").alias("invoice_status"),
            "invoice_amt",
            "erp_supplier_id",
            "erp_supplier",
            "system",
        )
    )
    return emit(rows, INVOICE_BEFORE_PO, "invoice_date", book.today)


def sap_invoices_before_po_open_ended(book) -> DataFrame:
    return sap_invoices_before_po(book, open_ended=True)


def ariba_invoices_not_matching_po(book) -> DataFrame:
    """All invoice rows of orders whose invoiced and ordered totals differ."""
    rows = (
        book.table("ariba_po_invoice")
        .select(
            "po_order_id",
            "po_date",
            "po_status",
            F.col("po_spend").alias("sum_po_spend_aud"),
            "invoice_id",
            "invoice_date",
            "inv_description",
            "invoice_status",
            F.col("po_amount_invoiced").alias("invoice_amt"),
            "contract_id",
            "inv_contract_id",
            F.col("vendor_number").alias("erp_supplier_id"),
            F.col("vendor_description").alias("erp_supplier"),
            L2,
        )
        .distinct()
    )
    unmatched = (
        rows.groupBy("po_order_id")
        .agg((F.sum("invoice_amt") - F.sum("sum_po_spend_aud")).alias("_gap"))
        .filter(F.abs("_gap") > 0)
        .select("po_order_id")
    )
    rows = members_of(rows, unmatched, ["po_order_id"]).select(
        L2,
        "po_order_id",
        "po_date",
        "sum_po_spend_aud",
        "po_status",
        "invoice_id",
        "invoice_date",
        "inv_description",
        "invoice_status",
        "invoice_amt",
        "erp_supplier_id",
        "erp_supplier",
        F.lit("Ariba").alias("system"),
    )
    return emit(rows, INVOICE_NOT_MATCHING, "invoice_date", book.today)


def sap_invoices_not_matching_po(book) -> DataFrame:
    """Invoice lines of orders whose net amount and invoiced total are over a cent apart.

    An order can appear with several net amounts; its invoices then count once per
    occurrence of the amount, and every row of the order is returned.
    """
    invoices, po = book.table("sap_invoices"), book.table("sap_po")
    key = "purchasing_document_number"
    invoiced = invoices.groupBy(F.col("d_purchasing_doc").alias(key)).agg(
        F.sum("invoice_amt").alias("_invoiced")
    )
    ordered = po.groupBy(key, "po_amount_net").agg(F.count("*").alias("_times"))
    total = repeated(invoiced, "_invoiced", "_times")
    # compared side by side: a difference of two wide decimals would give up places
    net, cent = F.col("po_amount_net"), F.lit("0.01").cast("decimal(3,2)")
    unmatched = (
        ordered.join(invoiced, key)
        .filter((total > net + cent) | (total < net - cent))
        .select(key, total.alias("_total"))
    )
    orders = po.select(
        key,
        "purchasing_document_date",
        "document_last_changed_on",
        "purchasing_item_short_text",
        "po_amount_net",
        "document_currency",
    )
    rows = (
        invoices.join(orders, F.col("d_purchasing_doc") == F.col(key))
        .drop("d_purchasing_doc")
        .join(unmatched, key)
        .distinct()
        .select(
            L2,
            F.col(key).alias("po_order_id"),
            F.col("purchasing_document_date").alias("po_date"),
            F.col("po_amount_net").alias("sum_po_spend_aud"),
            F.lit("").alias("po_status"),
            F.col("invoice_number").alias("invoice_id"),
            "invoice_date",
            F.col("invoice_desc").alias("inv_description"),
            F.lit("").alias("invoice_status"),
            "invoice_amt",
            F.col("vendor").alias("erp_supplier_id"),
            F.col("vendor_name").alias("erp_supplier"),
            "system",
        )
    )
    return emit(rows, INVOICE_NOT_MATCHING, "invoice_date", book.today)
