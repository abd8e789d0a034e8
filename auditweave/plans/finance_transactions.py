"""The finance-system side of the transactions: orders, invoices and what was paid for them.

The order-system side has one amount paid per invoice. In the ledger payments and invoices only
meet in a clearing document, any number of each, so a join would count every payment once per
invoice. Here both sides are summed per vendor and clearing document first; what was paid is
then shared out over the document's invoices in proportion to their amounts, in whole cents,
and the rest of a cent goes to the largest invoice. So what the invoices of a document got is
exactly what was paid with it.

The rules do not define this branch; it is an extension with the columns of ``base_transaction``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditweave.functions.anchors import months_before
from auditweave.functions.keys import erp_date, erp_date_between
from auditweave.operators.ordering import join_nullsafe
from auditweave.plans import conformed
from auditweave.plans.scope import COMPANY, scope_columns
from auditweave.plans.vendor_tables import TRANSACTION_COLUMNS
from auditweave.sources.shelf import pin

SYSTEM = "SAP"
MONEY = "decimal(38,9)"
_DOCUMENT = ["vendor_number", "clearing_doc"]


def _in_scope(book, lines: DataFrame) -> DataFrame:
    vendors = scope_columns(book, F.col("vendor_id").alias("vendor_number"))
    return lines.join(vendors, "vendor_number", "left_semi")


def _paid(book) -> DataFrame:
    """What was paid to a vendor with each clearing document, and when last."""
    sign = F.when(F.col("d_shkzg_debit_credit_ind") == "H", -F.col("d_amount_in_lc"))
    lines = book.src.ledger.filter(
        F.col("h_document_type").isin(conformed.PAYMENT_DOCS)
        & (F.col("h_company_code") == COMPANY)
        & erp_date_between("h_document_date", months_before(book.today, 24))
        & (F.col("d_clrng_doc") != "")
    ).select(
        F.col("d_vendor").alias("vendor_number"),
        F.col("d_clrng_doc").alias("clearing_doc"),
        erp_date("h_document_date").alias("payment_date"),
        sign.otherwise(F.col("d_amount_in_lc")).alias("amount"),
    )
    return (
        _in_scope(book, lines)
        .groupBy(*_DOCUMENT)
        .agg(F.sum("amount").cast(MONEY).alias("paid"), F.max("payment_date").alias("payment_date"))
    )


def _invoices(book) -> DataFrame:
    lines = conformed.invoice_lines(book).select(
        F.col("d_vendor").alias("vendor_number"),
        F.col("d_clrng_doc").alias("clearing_doc"),
        F.col("d_purchasing_doc").alias("po_number"),
        F.col("h_reference").alias("invoice_id"),
        erp_date("h_document_date").alias("invoice_date"),
        F.col("d_gl_account").alias("gl_account"),
        F.col("d_amount_in_lc").alias("amount"),
    )
    return (
        _in_scope(book, lines)
        .groupBy(*_DOCUMENT, "po_number", "invoice_id", "invoice_date")
        .agg(
            F.sum("amount").cast(MONEY).alias("amount"),
            F.min("gl_account").alias("low_account"),
            F.max("gl_account").alias("high_account"),
        )
    )


def share_out(items: DataFrame, totals: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Adds ``share`` to ``items`` (keys, amount): its part of ``paid`` in ``totals`` (keys, paid).

    Parts are in proportion to amount, rounded down to whole cents; what is left goes to the item
    of the largest amount, of equal ones the first by ``order``, which tells items of a key apart.
    So the parts of a key add up to what was paid exactly. Where the amounts add up to nothing,
    that item gets it all. Items without a total have a null share. Only sums per key are joined.
    """
    sums = items.groupBy(*keys).agg(F.sum("amount").alias("_sum"))
    both = sums.join(totals.select(*keys, "paid"), keys)

    def number(column: str) -> Column:
        return F.col(column).cast("double")

    cents = F.floor(number("paid") * number("amount") / number("_sum") * 100)
    part = F.when(F.col("_sum") == 0, F.lit(0)).otherwise(
        F.coalesce(cents, F.lit(0)).cast(MONEY) / F.lit(100)
    )
    parts = pin(
        items.join(both, keys, "left").withColumn(
            "_part", F.when(F.col("paid").isNotNull(), part.cast(MONEY))
        ),
        "parts",
    )
    first = F.min(F.struct((-F.col("amount")).alias("_less"), *order))
    rest = (
        parts.where("paid IS NOT NULL")
        .groupBy(*keys)
        .agg(first.alias("_first"), (F.first("paid") - F.sum("_part")).cast(MONEY).alias("_rest"))
        .select(*keys, *[F.col("_first")[c].alias(c) for c in order], "_rest")
    )
    whole = join_nullsafe(parts, rest, [*keys, *order], "left")
    share = F.col("_part") + F.coalesce("_rest", F.lit(0).cast(MONEY))
    return whole.withColumn("share", share.cast(MONEY)).drop("paid", "_sum", "_part", "_rest")


def _orders(book) -> DataFrame:
    """Net amount and day of each order."""
    lines = conformed.order_lines(
        book.src.po_schedule_line.filter(
            (F.col("purchasing_document_date") >= months_before(book.today, 24))
            & (F.col("purchasing_organization") == COMPANY)
        )
    )
    return lines.groupBy(F.col("purchasing_document_number").alias("po_number")).agg(
        F.sum("net_order_value").alias("po_spend"),
        F.min("purchasing_document_date").cast("date").alias("po_date"),
    )


def sap_transaction(book) -> DataFrame:
    """One row per vendor, order and invoice of the ledger, with the columns of
    ``base_transaction``; what the ledger does not know is null.

    payment_amount is the invoice's part of what was paid with its clearing documents. The
    account is given where all lines have the same one.
    """
    paid = pin(_paid(book), "paid")
    items = ["po_number", "invoice_id", "invoice_date"]
    shared = share_out(_invoices(book), paid, _DOCUMENT, items)
    shared = shared.join(paid.drop("paid"), _DOCUMENT, "left")
    rows = shared.groupBy("vendor_number", *items).agg(
        F.sum("amount").alias("invoice_amount_excl_tax"),
        F.sum("share").alias("payment_amount"),
        F.max("payment_date").alias("payment_date"),
        F.min("low_account").alias("_low"),
        F.max("high_account").alias("_high"),
    )
    rows = rows.join(_orders(book), "po_number", "left")
    blank, spend = F.lit("NULL"), F.col("po_spend").cast("double")
    known = {
        "transaction_id": F.concat(
            F.coalesce("po_number", blank),
            F.lit("|"),
            F.coalesce("invoice_id", blank),
            F.lit("|" + SYSTEM),
        ),
        "system": F.lit(SYSTEM),
        "gl_account": F.when(F.col("_low") == F.col("_high"), F.col("_low")),
        "amount_paid_excl_tax": F.col("payment_amount"),
        "po_to_invoice_ratio": F.try_divide(spend, F.col("invoice_amount_excl_tax").cast("double")),
        "po_to_payment_ratio": F.try_divide(spend, F.col("payment_amount").cast("double")),
        "po_to_invoice_days": F.datediff("invoice_date", "po_date").cast("long"),
    }
    rows = rows.withColumns(known)
    return rows.select(
        *[
            (F.col(name) if name in rows.columns else F.lit(None)).cast(kind).alias(name)
            # the table itself is another plan's work, which this one does not read
            for name, kind in TRANSACTION_COLUMNS.items()
        ]
    )
