"""Vendor master, transaction and feature tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditweave.functions.anchors import months_before
from auditweave.functions.keys import full_address_blank_nulls
from auditweave.functions.money import scale_of
from auditweave.operators.features import peer_positions, peer_summary, unpivot
from auditweave.operators.ordering import join_nullsafe
from auditweave.operators.ranking import first_per_key
from auditweave.plans.scope import in_scope_spend, scope_columns
from auditweave.sources.shelf import pin

SYSTEM = "Ariba"

WINDOWS = {"3m": 3, "6m": 6, "12m": 12, "24m": None}  # None: the whole history
INVOICE_MEASURES = [
    "total_invoice_spend",
    "total_payment_amount",
    "invoice_count",
    "paid_invoice_count",
    "vendor_active_months",
]
PO_MEASURES = ["total_po_spend", "po_count"]
FEATURES = [f"{m}_{w}" for m in PO_MEASURES + INVOICE_MEASURES for w in WINDOWS]
IDENTITY = [
    "vendor_number",
    "vendor_name",
    "supplier_category_l1",
    "supplier_category_l2",
    "supplier_category_l3",
    "supplier_country",
]


def vendor_attributes(book, one_category_per_vendor: bool = False) -> DataFrame:
    """Vendor master with category; a vendor in two categories has two rows.

    ``one_category_per_vendor`` keeps only the category with the largest spend.
    """
    src = book.src
    if one_category_per_vendor:
        categories = _main_category(src)
    else:
        categories = scope_columns(
            book,
            "vendor_id",
            *[f"supplier_custom_category_l{i}" for i in (1, 2, 3)],
        )
    absent = F.lit(None).cast("string")
    vendor = src.dim_vendor.select(
        F.col("vendor").alias("vendor_number"),
        F.col("vendor_description").alias("vendor_name"),
        F.col("tax_id").alias("vendor_abn"),
        "vendor_status",
        F.col("date_first_created").alias("vendor_creation_date"),
        F.col("marked_for_deletion_flag").alias("marked_for_deletion"),
        "non_trade_vendor_flag",
        absent.alias("supplier_id"),
        "building_number",
        "street",
        "city",
        "postal_code",
        "state",
        "country",
        full_address_blank_nulls().alias("vendor_full_address"),
        F.when(F.col("country") == "AU", "Y").otherwise("N").alias("local_supplier_flag"),
        "financial_party_contact_name",
        F.col("email_address").alias("vendor_email"),
        F.col("telephone_number").alias("vendor_phone"),
        absent.alias("bank_country_key"),
        absent.alias("vendor_bank_bsb"),
        absent.alias("vendor_bank_account"),
        absent.alias("bank_account_holder"),
    )
    return vendor.join(
        categories.withColumnsRenamed(
            {
                "supplier_custom_category_l1": "supplier_category_l1",
                "supplier_custom_category_l2": "supplier_category_l2",
                "supplier_custom_category_l3": "supplier_category_l3",
            }
        ),
        F.col("vendor_number") == F.col("vendor_id"),
        "left",
    ).drop("vendor_id")


def _main_category(src) -> DataFrame:
    names = {f"category_l{i}": f"supplier_custom_category_l{i}" for i in (1, 2, 3)}
    spend = in_scope_spend(src).groupBy("vendor_id", *names).agg(F.sum("amount").alias("_spend"))
    return (
        first_per_key(spend, ["vendor_id"], [F.desc("_spend"), *[F.asc(c) for c in names]])
        .drop("_spend")
        .withColumnsRenamed(names)
    )


def last_approver(book, among: DataFrame | None = None) -> DataFrame:
    """Latest approval by a real user per requisition, and whether it was on behalf.

    ``among`` holds the requisitions wanted, by default all.
    """
    approved = book.src.approvals_curated.filter(
        (F.col("approver_state") == "Approved") & (F.col("real_user") != "")
    ).select("approvable_id", "real_user", "approver", "action_date")
    if among is not None:
        approved = approved.join(among.distinct(), "approvable_id", "left_semi")
    latest = first_per_key(
        approved,
        ["approvable_id"],
        [F.desc("action_date"), F.asc("real_user"), F.asc("approver")],
    )
    return latest.select(
        "approvable_id",
        F.col("real_user").alias("approved_by_user"),
        F.col("approver").alias("nominated_approver"),
        F.col("action_date").cast("date").alias("approval_date"),
        F.coalesce(F.col("approver") != F.col("real_user"), F.lit(False)).alias(
            "acted_on_behalf_of"
        ),
    )


def doa_unique(book) -> DataFrame:
    """Authority limits of names that occur once; ambiguous names are left out."""
    return (
        book.src.doa.filter(F.col("employee_name").isNotNull())
        .groupBy(F.upper("employee_name").alias("approved_by_user_upper"))
        .agg(
            F.max(F.col("annual_limit").cast("double")).alias("approver_doa_annual_limit"),
            F.count("*").alias("_names"),
        )
        .filter("_names = 1")
        .drop("_names")
    )


#: Columns of ``base_transaction``; amounts have the places of their sources.
TRANSACTION_COLUMNS = {
    **dict.fromkeys(("po_number", "invoice_id", "vendor_number", "requisition_id", "po_status"), "string"),
    **dict.fromkeys(("po_date", "invoice_date"), "date"),
    **dict.fromkeys(
        ("approver_last", "requestor", "invoice_status", "reconciliation_status", "contract_id", "payment_terms"),
        "string",
    ),
    **dict.fromkeys(
        ("po_spend", "invoice_amount_excl_tax", "payment_amount", "amount_paid_excl_tax", "tax_amount"),
        "decimal(38,9)",
    ),
    **dict.fromkeys(("cost_centre", "approved_by_user", "nominated_approver"), "string"),
    "approval_date": "date",
    "acted_on_behalf_of": "boolean",
    "approver_doa_annual_limit": "double",
    **dict.fromkeys(("po_line_item_count", "invoiced_line_item_count"), "bigint"),
    **dict.fromkeys(("total_po_spend_line_level", "total_invoiced_line_level"), "double"),
    **dict.fromkeys(("transaction_id", "system"), "string"),
    **dict.fromkeys(("payment_date", "po_last_modified_date"), "date"),
    "gl_account": "string",
    **dict.fromkeys(("po_to_invoice_ratio", "po_to_payment_ratio", "po_to_doa_ratio"), "double"),
    "po_to_invoice_days": "bigint",
}


def po_line_level(book, among: DataFrame | None = None) -> DataFrame:
    """Line counts and totals per order; ``among`` holds the orders wanted, by default all."""
    lines = book.src.ariba_po_line
    if among is not None:
        lines = lines.join(among.distinct(), "po_order_id", "left_semi")
    return lines.groupBy("po_order_id").agg(
        F.count("*").alias("po_line_item_count"),
        F.count(F.when(F.col("sum_amount_invoiced") > 0, 1)).alias("invoiced_line_item_count"),
        F.sum("sum_po_spend").cast("double").alias("total_po_spend_line_level"),
        F.sum("sum_amount_invoiced").cast("double").alias("total_invoiced_line_level"),
    )


def base_transaction(book) -> DataFrame:
    """One row per order and invoice, with approval, authority limit and line totals.

    The approver, limit and line totals depend on the requisition or order alone, so they
    are joined after the rows have been summed to the final grain. Rows are dealt by order
    first, which serves the sums and the join with the line totals.
    """
    header = {
        "po_number": "po_number",
        "invoice_id": "invoice_id",
        "vendor_number": "vendor_number",
        "requisition_id": "requisition_id",
        "po_status": "po_status",
        "po_date": F.col("po_date").cast("date"),
        "invoice_date": F.col("invoice_date").cast("date"),
        "approver_last": F.col("approver"),
        "requestor": "requestor",
        "invoice_status": "invoice_status",
        "reconciliation_status": "reconciliation_status",
        "contract_id": "contract_id",
        "payment_terms": "payment_terms",
    }
    keys = [
        (F.col(source) if isinstance(source, str) else source).alias(name)
        for name, source in header.items()
    ]
    centre = F.when(~F.col("cost_center").isin("", "0"), F.col("cost_center"))
    grain = (
        book.table("ariba_po_invoice")
        .withColumn("_centre", centre)
        .repartition("po_number")
        .groupBy(*keys)
        .agg(
            F.sum("po_spend").alias("po_spend"),
            F.sum("amount_invoiced").alias("invoice_amount_excl_tax"),
            F.max("amount_paid").alias("payment_amount"),
            F.max("amount_paid_excl_tax").alias("amount_paid_excl_tax"),
            F.sum("tax_paid").alias("tax_amount"),
            # exactly one distinct value <=> smallest and largest agree
            F.min("_centre").alias("_low"),
            F.max("_centre").alias("_high"),
        )
        .withColumn("cost_centre", F.when(F.col("_low") == F.col("_high"), F.col("_high")))
        .drop("_low", "_high")
    )
    # only what the rows need is ranked and summed, not the whole history
    needed = book.table("ariba_po_invoice").select("requisition_id", "po_number").distinct()
    approvers = last_approver(book, needed.select(F.col("requisition_id").alias("approvable_id")))
    lines = po_line_level(book, needed.select(F.col("po_number").alias("po_order_id")))
    joined = book.meter.join(
        grain,
        "base_transaction: line totals",
        lambda rows: rows.join(lines, F.col("po_number") == F.col("po_order_id"), "left").drop(
            "po_order_id"
        ),
        "po_line_item_count",
    )
    joined = book.meter.join(
        joined,
        "base_transaction: approver",
        lambda rows: rows.join(
            approvers, F.col("requisition_id") == F.col("approvable_id"), "left"
        ).drop("approvable_id"),
        "approved_by_user",
    )
    joined = book.meter.join(
        joined,
        "base_transaction: limit",
        lambda rows: rows.join(
            book.table("doa_unique"),
            F.col("approved_by_user") == F.col("approved_by_user_upper"),
            "left",
        ).drop("approved_by_user_upper"),
        "approver_doa_annual_limit",
    )
    totals = [c for c in lines.columns if c != "po_order_id"]
    joined = joined.select(*[c for c in joined.columns if c not in totals], *totals)
    spend = F.col("po_spend").cast("double")
    blank = F.lit("NULL")
    return joined.withColumns(
        {
            "transaction_id": F.concat(
                F.coalesce("po_number", blank),
                F.lit("|"),
                F.coalesce("invoice_id", blank),
                F.lit("|" + SYSTEM),
            ),
            "system": F.lit(SYSTEM),
            "payment_date": F.lit(None).cast("date"),
            "po_last_modified_date": F.lit(None).cast("date"),
            "gl_account": F.lit(None).cast("string"),
            "po_to_invoice_ratio": F.try_divide(
                spend, F.col("invoice_amount_excl_tax").cast("double")
            ),
            "po_to_payment_ratio": F.try_divide(spend, F.col("payment_amount").cast("double")),
            "po_to_doa_ratio": F.try_divide(spend, F.col("approver_doa_annual_limit")),
            "po_to_invoice_days": F.datediff("invoice_date", "po_date").cast("long"),
        }
    )


def _in_window(day_col: str, today, months: int | None) -> Column:
    if months is None:
        return F.lit(True)
    return F.coalesce(F.col(day_col) >= months_before(today, months), F.lit(False))


def vendor_windowed_features(book) -> DataFrame:
    """Seven measures over four look-back windows per vendor; nothing in a window is 0.

    Distinct counts come from first collapsing to (vendor, order), (vendor, invoice) and
    (vendor, month) with the window flags kept, so no row is multiplied per count.
    """
    today = book.local_today
    rows = book.table("base_transaction").filter(F.col("vendor_number").isNotNull())
    rows = book.meter.rows(rows, "vendor_windowed_features: order rows", "po_number")
    labels = list(WINDOWS)

    def money(value: Column, like: str) -> Column:
        """0 for nothing, with the places that the source column has."""
        places = scale_of(rows, like)
        kind = "double" if places is None else f"decimal(38,{places})"
        return F.coalesce(value.cast(kind), F.lit(0).cast(kind))

    def hits(flag: str) -> Column:
        return F.count(F.when(F.col(flag), 1))

    # undo the fan-out of order spend: one row per order with its largest spend
    orders = book.meter.rows(
        rows.groupBy("vendor_number", "po_number").agg(
            F.min("po_date").alias("po_date"), F.max("po_spend").alias("po_spend")
        ),
        "vendor_windowed_features: orders",
    )
    po_part = orders.groupBy("vendor_number").agg(
        *[
            measure
            for w, months in WINDOWS.items()
            for inside in [_in_window("po_date", today, months)]
            for measure in (
                money(F.sum(F.when(inside, F.col("po_spend"))), "po_spend").alias(
                    f"total_po_spend_{w}"
                ),
                F.count(F.when(inside, F.col("po_number"))).alias(f"po_count_{w}"),
            )
        ]
    )
    inside = {w: _in_window("invoice_date", today, m) for w, m in WINDOWS.items()}
    invoices = rows.groupBy("vendor_number", "invoice_id").agg(
        *[F.sum(F.when(inside[w], F.col("invoice_amount_excl_tax"))).alias(f"_inv_{w}") for w in labels],
        *[F.sum(F.when(inside[w], F.col("payment_amount"))).alias(f"_pay_{w}") for w in labels],
        *[F.bool_or(inside[w]).alias(f"_in_{w}") for w in labels],
        *[
            F.bool_or(inside[w] & F.col("payment_date").isNotNull()).alias(f"_paid_{w}")
            for w in labels
        ],
    )
    known = F.col("invoice_id").isNotNull()
    invoice_part = invoices.groupBy("vendor_number").agg(
        *[
            measure
            for w in labels
            for measure in (
                money(F.sum(f"_inv_{w}"), "invoice_amount_excl_tax").alias(
                    f"total_invoice_spend_{w}"
                ),
                money(F.sum(f"_pay_{w}"), "payment_amount").alias(f"total_payment_amount_{w}"),
                F.count(F.when(known & F.col(f"_in_{w}"), 1)).alias(f"invoice_count_{w}"),
                F.count(F.when(known & F.col(f"_paid_{w}"), 1)).alias(f"paid_invoice_count_{w}"),
            )
        ]
    )
    months = (
        rows.filter(F.col("invoice_date").isNotNull())
        .groupBy("vendor_number", F.trunc("invoice_date", "month").alias("_month"))
        .agg(*[F.bool_or(inside[w]).alias(f"_in_{w}") for w in labels])
    )
    month_part = months.groupBy("vendor_number").agg(
        *[hits(f"_in_{w}").alias(f"vendor_active_months_{w}") for w in labels]
    )
    joined = po_part.join(invoice_part, "vendor_number", "left").join(
        month_part, "vendor_number", "left"
    )
    return joined.select(
        "vendor_number",
        *[
            F.coalesce(F.col(f), F.lit(0).cast(joined.schema[f].dataType)).alias(f)
            for f in FEATURES
        ],
    )


def _raw_features(book) -> DataFrame:
    attributes = book.table("vendor_attributes").select(
        *IDENTITY[:-1], F.col("country").alias("supplier_country")
    )
    return book.table("vendor_windowed_features").join(attributes, "vendor_number", "left")


def vendor_peer_stats(book) -> DataFrame:
    """Peer median and mean of every feature per second-level category, with group size."""
    raw = _raw_features(book)
    return _wide_summary(_positions(raw))


def _positions(raw: DataFrame) -> DataFrame:
    # one row per (category, feature, value), read for ranks, medians and sizes
    return pin(peer_positions(raw, "supplier_category_l2", FEATURES), "positions")


def _wide_summary(positions: DataFrame) -> DataFrame:
    summary = peer_summary(positions, "supplier_category_l2")
    is_ = {f: F.col("feature") == f for f in FEATURES}
    wide = summary.groupBy("supplier_category_l2").agg(
        *[F.max(F.when(is_[f], F.col("median"))).alias(f"peer_median_{f}") for f in FEATURES],
        *[F.max(F.when(is_[f], F.col("mean"))).alias(f"peer_mean_{f}") for f in FEATURES],
    )
    sizes = (
        positions.filter(F.col("feature") == FEATURES[0])
        .groupBy("supplier_category_l2")
        .agg(F.sum("at_value").alias("peer_group_size"))
    )
    return join_nullsafe(wide, sizes, ["supplier_category_l2"])


def vendor_features(book, load_stamp: bool = True) -> DataFrame:
    """Every feature with its peer median, peer mean and percentile rank."""
    raw = _raw_features(book)
    # equal rows (a vendor listed twice with the same attributes) are carried as a count
    distinct = raw.groupBy(*IDENTITY, *FEATURES).agg(F.count("*").alias("_copies"))
    positions = _positions(raw)
    ranks = positions.select(
        "supplier_category_l2",
        "feature",
        "value",
        F.coalesce(
            F.try_divide(F.col("below").cast("double"), (F.col("peers") - 1).cast("double")),
            F.lit(0.0),
        ).alias("_rank"),
    )
    row_key = [*IDENTITY]
    ranked = join_nullsafe(
        unpivot(distinct, [*row_key], FEATURES),
        ranks,
        ["supplier_category_l2", "feature", "value"],
    )
    rank_columns = ranked.groupBy(*row_key).agg(
        *[
            F.max(F.when(F.col("feature") == f, F.col("_rank"))).alias(f"peer_pct_rank_{f}")
            for f in FEATURES
        ]
    )
    result = join_nullsafe(
        join_nullsafe(distinct, rank_columns, row_key),
        _wide_summary(positions),
        ["supplier_category_l2"],
    )
    result = result.withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))
    )
    ordered = [
        c
        for f in FEATURES
        for c in (f, f"peer_median_{f}", f"peer_mean_{f}", f"peer_pct_rank_{f}")
    ]
    stamp = [F.current_timestamp().alias("_loaded_at")] if load_stamp else []
    return result.select(*IDENTITY, *ordered, "peer_group_size", *stamp)
