"""Controls over requisition approvals and delegated authority."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditweave.functions.envelope import Label, emit
from auditweave.operators.history import largest_from_here, previous_row
from auditweave.plans.conformed import APPROVER_COLUMNS
from auditweave.sources.shelf import pin

L2 = "supplier_custom_category_l2"

DELETED_USER = Label(
    "Payments", "Ariba-Invoices/PO paid outside of approved workflow systems", "PO Count"
)
EXCEEDING_DOA = Label(
    "Payments",
    "Ariba - Approvals made by employees without appropriate DOA or exceeding their DOA",
    "PO Count",
)
CLOSE_TO_DOA = Label(
    "Payments",
    "Ariba - Employees frequently approving invoices/PO close to their DOA limit",
    "Invoice Count",
)

# Marks of a removed user and of a line without an order.
REMOVED_USER = "Unclassified"
NO_ORDER = "Unclassified"
CLOSE_SHARE = 0.10

_HISTORY_ORDER = [
    "assigned_date",
    "approver",
    "approver_reason",
    "approved_by_user",
    "requester_user",
    "approver_deleted_by",
]


def authority_limits(src) -> DataFrame:
    """Distinct (name key, limit) pairs of the authority register."""
    return src.doa.select(
        F.trim(F.lower("employee_name")).alias("_doa_name"),
        F.col("annual_limit").alias("_limit"),
    ).distinct()


def _with_limit(
    rows: DataFrame, limits: DataFrame, approver: str, out: str, how: str = "left"
) -> DataFrame:
    return (
        rows.join(limits, F.lower(approver) == F.col("_doa_name"), how)
        .drop("_doa_name")
        .withColumnRenamed("_limit", out)
    )


def _ordered_requisitions(book, columns: list) -> DataFrame:
    """Distinct order columns with the requisition and its last approver's limit.

    Both controls on it need a limit to compare with, so the joins are inner. Limits are looked
    up for requisitions, which are narrow; the orders themselves are shuffled once, by number.
    """
    src = book.src
    orders = (
        book.table("ariba_po_invoice")
        .filter(F.col("po_number") != NO_ORDER)
        .select(*columns)
        .repartition("po_number")
        .distinct()
    )
    requisitions = (
        book.table("ordered_requisitions")
        .join(book.table("final_approver"), F.col("approvable_id") == F.col("req_requisition_id"))
        .drop("approvable_id")
    )
    limited = _with_limit(
        requisitions, authority_limits(src), "last_approver", "annual_limit_approver_last", "inner"
    )
    return orders.join(limited, F.col("po_number") == F.col("po_order_id")).drop("po_order_id")


def _with_approver_limits(rows: DataFrame, approvers: DataFrame, limits: DataFrame) -> DataFrame:
    """``rows`` with each approver's limit, by one look-up for all positions.

    A name with several limits in the register gives a row for each of them, at every
    position on its own, as one left join per position would.
    """
    by_name = limits.groupBy("_doa_name").agg(F.collect_set(F.struct("_limit")).alias("_limits"))
    found = (
        approvers.select("approvable_id", F.posexplode(F.array(*APPROVER_COLUMNS)))
        .join(by_name, F.lower("col") == F.col("_doa_name"))
        .groupBy("approvable_id")
        .agg(
            *[
                F.max(F.when(F.col("pos") == i, F.col("_limits"))).alias(f"annual_limit_{name}")
                for i, name in enumerate(APPROVER_COLUMNS)
            ]
        )
    )
    wide = approvers.join(found, "approvable_id", "left")
    rows = rows.join(
        wide, F.col("approvable_id") == F.col("req_requisition_id"), "left"
    ).drop("approvable_id")
    for name in APPROVER_COLUMNS:
        limit = f"annual_limit_{name}"
        rows = rows.withColumn(limit, F.explode_outer(limit)).withColumn(
            limit, F.col(f"{limit}._limit")
        )
    return rows


def approvals_exceeding_doa(book) -> DataFrame:
    """Orders whose spend exceeds the last approver's annual limit, with every approver.

    The last approver decides, so the seven other look-ups only meet flagged orders.
    """
    limits = authority_limits(book.src)
    flagged = _ordered_requisitions(
        book,
        [
            "po_number",
            "po_date",
            "po_title",
            F.col("po_title").alias("po_description"),
            "vendor_number",
            "vendor_description",
            "po_amount_invoiced",
            "po_spend",
            "po_status",
            L2,
            "requestor",
        ],
    ).filter(F.col("po_spend").cast("double") > F.col("annual_limit_approver_last"))
    flagged = pin(flagged, "over-limit")
    approvers = book.table("first_approvers").join(
        flagged.select(F.col("req_requisition_id").alias("approvable_id")).distinct(),
        "approvable_id",
        "left_semi",
    )
    rows = _with_approver_limits(flagged, approvers, limits)
    rows = rows.withColumn("annual_limit_check_last_approver", F.lit("Yes")).distinct()
    return emit(rows, EXCEEDING_DOA, "po_date", book.today, keep_area=True)


def invoice_close_to_doa(book) -> DataFrame:
    """Invoices whose net paid amount is within 10 % of the last approver's limit."""
    amount, limit = F.col("invoice_amount").cast("double"), F.col("annual_limit_approver_last")
    rows = (
        _ordered_requisitions(
            book,
            [
                L2,
                "po_number",
                "invoice_id",
                "invoice_date",
                "inv_description",
                F.col("amount_paid_excl_tax").alias("invoice_amount"),
                "vendor_number",
                "vendor_description",
                "po_status",
                "requestor",
            ],
        )
        .filter(F.abs(amount - limit) <= F.lit(CLOSE_SHARE) * limit)
        .withColumn("po_spend_proximity_flag", F.lit("Close to Limit"))
        .distinct()
    )
    return emit(rows, CLOSE_TO_DOA, "invoice_date", book.today, keep_area=True)


def ariba_deleted_user(book) -> DataFrame:
    """Orders whose requisition was approved by a removed user, with who approved before
    and who would be answerable, compared with that person's limit."""
    src = book.src
    raw = src.approvals_raw
    removed = F.col("approved_by_user") == REMOVED_USER
    affected = raw.filter(removed).select("approvable_id").distinct()
    # lines may be equal in these columns: they are one row with a count
    history = (
        raw.join(affected, "approvable_id", "left_semi")
        .groupBy("approvable_id", *_HISTORY_ORDER)
        .agg(F.count("*").alias("_lines"))
    )
    marked = previous_row(
        history, "approvable_id", _HISTORY_ORDER, ["approver", "assigned_date"], "prev_"
    ).filter(removed)
    # of several equal lines the first has the line before them, the others have an equal one
    marked = marked.unionByName(
        marked.filter("_lines > 1").withColumns(
            {"prev_approver": F.col("approver"), "prev_assigned_date": F.col("assigned_date")}
        )
    ).drop("_lines")
    onward = largest_from_here(
        history, "approvable_id", "assigned_date", "approver", "_running"
    )
    events = (
        marked.join(
            onward.withColumnsRenamed(
                {"approvable_id": "_approvable", "assigned_date": "_assigned"}
            ),
            (F.col("approvable_id") == F.col("_approvable"))
            & F.col("assigned_date").eqNullSafe(F.col("_assigned")),
        )
        .select(
            F.col("approvable_id").alias("requisition_id"),
            "requester_user",
            F.col("approver").alias("deleted_user"),
            F.col("assigned_date").alias("deleted_user_date"),
            "prev_approver",
            F.col("prev_assigned_date").alias("prev_approver_assigned_date"),
            "approver_deleted_by",
            F.when(F.col("approver") != F.col("_running"), F.col("_running")).alias(
                "last_approver"
            ),
        )
        .distinct()
    )
    header: list[str | Column] = [
        "po_number",
        "po_date",
        "po_title",
        F.col("po_title").alias("po_description"),
        L2,
        "vendor_number",
        "vendor_description",
        "requisition_id",
        "po_status",
        "contract_id",
        "requestor",
        "approver",
        "cost_center",
    ]
    orders = (
        book.table("ariba_po_invoice")
        .groupBy(*header)
        .agg(
            F.sum("po_amount_invoiced").alias("po_amount_invoiced"),
            F.sum("po_spend").alias("po_spend"),
        )
    )
    # every register entry of the name counts here, equal ones included
    limits = src.doa.select(
        F.trim(F.lower("employee_name")).alias("_doa_name"),
        F.col("annual_limit").alias("_limit"),
    )
    rows = orders.join(events, "requisition_id").withColumn(
        "final_approver", F.coalesce("last_approver", "prev_approver")
    )
    rows = _with_limit(rows, limits, "final_approver", "annual_limit").withColumns(
        {
            "annual_limit_check_exceeded_final_approver": F.when(
                F.col("po_spend").cast("double") > F.col("annual_limit"), "Yes"
            ).otherwise("No"),
            "system": F.lit("Ariba"),
        }
    )
    return emit(rows, DELETED_USER, "po_date", book.today, keep_area=True)
