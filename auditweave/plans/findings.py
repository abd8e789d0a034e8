"""Hits of all controls as one fact table, their summary, and the inputs of a case brief.

These are extensions: the audit rules define the hits, these plans only bring them to one
shape and count them.
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from auditweave.book import SHARED
from auditweave.functions.anchors import days_before, months_before
from auditweave.operators.ranking import top_rows
from auditweave.plans.vendor_tables import FEATURES
from auditweave.sources.facts import FactTable
from auditweave.sources.shelf import shelf_of

#: Evidence rows that a brief shows for a vendor and control.
EVIDENCE_ROWS = 5
#: Controls that run at the same time.
CONTROLS_AT_ONCE = 6
#: Exact for money of up to nine places.
MONEY = "decimal(38,9)"


@dataclass(frozen=True)
class Hit:
    """The columns of a control's report that say whom, what, when and how much."""

    vendor: str
    entity: str
    day: str
    amount: str | None = None

    def columns(self, control: str) -> list[Column]:
        amount = F.lit(None) if self.amount is None else F.col(self.amount)
        return [
            F.col(self.vendor).cast("string").alias("vendor_number"),
            F.col(self.entity).cast("string").alias("entity"),
            F.col(self.day).cast("date").alias("day"),
            amount.cast(MONEY).alias("amount"),
            F.lit(control).alias("control"),
        ]


_ORDER = Hit("vendor_number", "po_number", "po_date", "po_spend")
_SPLIT_ORDER = Hit("vendor_number", "po_number", "po_date", "po_individual_amount")
_PAID_INVOICE = Hit("erp_supplier_id", "invoice_id", "invoice_date", "invoice_amt_paid")
_INVOICE = Hit("erp_supplier_id", "invoice_id", "invoice_date", "invoice_amt")
_SPLIT_INVOICE = Hit("vendor", "invoice_id", "invoice_date", "invoice_amount_ex_tax")
_PAYMENT = Hit("vendor", "payment_clearing_doc", "payment_date", "payment_amount")
_VENDOR = Hit("supplier_id", "supplier_id", "supplier_creation_date")
_EMPLOYEE = Hit("supplier_id", "employee_id", "supplier_creation_date", "amount")

#: Every control with the columns of its report. The second definition of a control is left out.
HITS: dict[str, Hit] = {
    "ariba_dupe_po": _ORDER,
    "sap_duplicate_po": _ORDER,
    "maximo_duplicate_po": _ORDER,
    "ariba_dupe_invoices": _PAID_INVOICE,
    "sap_dupe_invoices": _PAID_INVOICE,
    "ariba_invoices_before_po": _INVOICE,
    "sap_invoices_before_po": _INVOICE,
    "ariba_invoices_not_matching_po": _INVOICE,
    "sap_invoices_not_matching_po": _INVOICE,
    "ariba_split_invoice": _SPLIT_INVOICE,
    "sap_split_invoice": _SPLIT_INVOICE,
    "ariba_split_po": _SPLIT_ORDER,
    "sap_split_po": _SPLIT_ORDER,
    "ariba_open_po": _ORDER,
    "ariba_payments_without_approved_po": _PAID_INVOICE,
    "ariba_deleted_user": _ORDER,
    "approvals_exceeding_doa": _ORDER,
    "invoice_close_to_doa": Hit("vendor_number", "invoice_id", "invoice_date", "invoice_amount"),
    "multiple_payments_same_day": _PAYMENT,
    "repeat_payments_same_amount": _PAYMENT,
    "payments_within_1_day": Hit("vendor", "invoice_number", "payment_date", "payment_amount"),
    "same_invoice_payment_date": Hit("vendor", "invoice_number", "invoice_date", "invoice_amt"),
    "payment_vs_invoice_amount": Hit("d_vendor", "invoice_number", "invoice_date", "invoice_amt"),
    "payments_to_blocked_vendors": Hit(
        "d_vendor", "payment_clearing_doc", "payment_date", "payment_amount"
    ),
    "payments_weekend_holiday": _PAYMENT,
    "one_time_vendor_payment": Hit("supplier_id", "supplier_id", "payment_date", "payment_amount"),
    "payment_soon_after_creation": Hit("supplier_id", "supplier_id", "payment_date"),
    "vendor_employee_same_bank": _EMPLOYEE,
    "vendor_employee_same_address": _EMPLOYEE,
    "payments_shared_bank": Hit("supplier_id", "employee_id", "payment_date", "payment_amount"),
    "dupe_vendors": _VENDOR,
    "approved_vs_blocked": Hit(
        "approved_supplier_id", "blocked_supplier_id", "approved_vendor_creation_date"
    ),
    "blocked_reonboarded": Hit(
        "approved_supplier_id", "blocked_supplier_id", "approved_supplier_creation_date"
    ),
    "same_financial_contact": Hit(
        "supplier_id", "financial_party_contact_name", "supplier_creation_date"
    ),
    "vendors_no_bank": _VENDOR,
    "local_vendors_incomplete": _VENDOR,
    "international_vendors_incomplete": _VENDOR,
}

HIT_SCHEMA = f"vendor_number string, entity string, day date, amount {MONEY}, control string"


def hits_of(book, control: str) -> DataFrame:
    """The hits of one control, one per row of its report."""
    return book.once_over(control).select(*HITS[control].columns(control))


def open_hits(spark: SparkSession, path: str) -> FactTable:
    return FactTable(spark, path, StructType.fromDDL(HIT_SCHEMA), "control")


def refresh_hits(
    spark: SparkSession,
    book,
    path: str,
    controls: Iterable[str] | None = None,
    at_once: int = CONTROLS_AT_ONCE,
) -> FactTable:
    """Replace the hits of ``controls`` (by default all) in the fact table under ``path``.

    Tables that controls share are written first, ``at_once`` at a time. Then as many controls run
    at a time, each to a folder of its own, as one alone leaves most of a cluster idle; the fact table is
    replaced by one job, when all of them are whole. The rows of other controls stay as they are.
    What a control writes on its way goes when its hits are written, and these when they are in
    the fact table, so the disk holds the shared tables and the hits, not all steps of all controls.
    """
    wanted = list(HITS if controls is None else controls)
    shelf = shelf_of(spark)
    written: list[str] = []

    def stage(control: str) -> DataFrame:
        with shelf.passing():
            return shelf.put(hits_of(book, control), f"hits-{control}", noted=written)

    with ThreadPoolExecutor(at_once) as pool:
        list(pool.map(book.table, SHARED))  # one that another needs is awaited, not built twice
        staged = list(pool.map(stage, wanted))
    facts = open_hits(spark, path)
    facts.replace(reduce(DataFrame.unionByName, staged), wanted, book.today)
    shelf.remove(written)
    return facts


def control_hits(book) -> DataFrame:
    """Hits of every control: vendor_number, entity, day, amount, control.

    A fact table partitioned by control. The summary and the briefs read it, not the reports.
    """

    def build() -> FactTable:
        return refresh_hits(book.spark, book, book.place("control-hits"))

    return book.once("control_hits", build).rows()


def _by_entity(book) -> DataFrame:
    """Hits summed per vendor, control and entity, by one scan of the fact table."""
    day, today = F.col("day"), book.today

    def since(start: Column) -> Column:
        return F.count(F.when(day.between(start, F.lit(today)), 1))

    return (
        book.table("control_hits")
        .groupBy("vendor_number", "control", "entity")
        .agg(
            F.count("*").alias("hits"),
            since(days_before(today, 90)).alias("hits_last_90_days"),
            since(months_before(today, 12)).alias("hits_last_year"),
            F.sum("amount").cast(MONEY).alias("amount"),
            F.min("day").alias("first_day"),
            F.max("day").alias("last_day"),
        )
    )


def _totals() -> list[Column]:
    return [
        *[F.sum(c).alias(c) for c in ("hits", "hits_last_90_days", "hits_last_year")],
        F.sum("amount").cast(MONEY).alias("amount"),
        F.min("first_day").alias("first_day"),
        F.max("last_day").alias("last_day"),
    ]


def _by_vendor_control(by_entity: DataFrame) -> DataFrame:
    return by_entity.groupBy("vendor_number", "control").agg(
        *_totals(), F.count("entity").alias("entities")
    )


def vendor_control_summary(book) -> DataFrame:
    """Hits per vendor and control, per vendor, per control and overall.

    ``level`` tells which: 'vendor and control', 'vendor', 'control' or 'all'. entities counts
    distinct (vendor, entity) pairs of a control; a hit without an amount adds none. The
    fact table is read once and summed to (vendor, control) before the grouping sets, so
    only these sums are multiplied.
    """
    cells = _by_vendor_control(_by_entity(book))
    sets = [["vendor_number", "control"], ["vendor_number"], ["control"], []]
    level = (
        F.when(F.col("_set") == 0, "vendor and control")
        .when(F.col("_set") == 1, "vendor")
        .when(F.col("_set") == 2, "control")
        .otherwise("all")
    )
    totals = cells.groupingSets(
        [[F.col(c) for c in names] for names in sets], "vendor_number", "control"
    ).agg(
        F.grouping_id("vendor_number", "control").alias("_set"),
        *_totals(),
        F.sum("entities").alias("entities"),
        F.count_distinct("vendor_number").alias("vendors"),
        F.count_distinct("control").alias("controls"),
    )
    return totals.select(
        level.alias("level"),
        "vendor_number",
        "control",
        "hits",
        "hits_last_90_days",
        "hits_last_year",
        "entities",
        "vendors",
        "controls",
        "amount",
        "first_day",
        "last_day",
    )


def _strongest(rows: DataFrame, k: int) -> DataFrame:
    """At most ``k`` rows per vendor and control: the largest amounts, then the latest."""
    order = [
        F.desc_nulls_last("amount"),
        F.desc_nulls_last("last_day"),
        F.asc_nulls_last("entity"),
    ]
    return top_rows(rows, ["vendor_number", "control"], order, k, rank="place")


def evidence(book, k: int = EVIDENCE_ROWS) -> DataFrame:
    """The ``k`` strongest entities of every vendor and control, with their place."""
    return _strongest(_by_entity(book), k)


def merge_evidence(kept: DataFrame, more: DataFrame, k: int = EVIDENCE_ROWS) -> DataFrame:
    """Evidence of two disjoint sets of hits from the evidence of each.

    The best ``k`` of a whole are among the best ``k`` of its parts, so parts can be kept and
    merged, a month at a time, without their hits.
    """
    columns = [c for c in kept.columns if c != "place"]
    return _strongest(kept.select(*columns).unionByName(more.select(*columns)), k)


def case_brief_inputs(book, k: int = EVIDENCE_ROWS) -> DataFrame:
    """What a brief about a vendor starts from, one row per vendor with hits.

    vendor_number, vendor_name, supplier_country, categories, totals over all controls, the
    look-back features, and ``findings``: per control its totals and the ``k`` strongest
    entities. Only evidence rows, at most ``k`` per task and control, are ever sorted by vendor;
    hits are summed. A vendor without transactions has null features; hits without a vendor
    belong to no brief.
    """
    named = _by_entity(book).where(F.col("vendor_number").isNotNull())
    shown = (
        _strongest(named, k)
        .groupBy("vendor_number", "control")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("place", "entity", "hits", "amount", "last_day"))
            ).alias("evidence")
        )
    )
    cells = _by_vendor_control(named).join(shown, ["vendor_number", "control"])
    finding = F.struct(
        "control", "hits", "entities", "amount", "first_day", "last_day", "evidence"
    )
    briefs = cells.groupBy("vendor_number").agg(
        F.count("*").alias("controls"),
        *_totals(),
        # at most one per control
        F.array_sort(F.collect_list(finding)).alias("findings"),
    )
    master = (
        book.table("vendor_attributes")
        .groupBy("vendor_number")
        .agg(
            F.max("vendor_name").alias("vendor_name"),
            F.max("country").alias("supplier_country"),
            F.array_sort(F.collect_set("supplier_category_l2")).alias("categories"),
        )
    )
    features = book.table("vendor_windowed_features").select(
        "vendor_number", F.struct(*FEATURES).alias("features")
    )
    return (
        briefs.join(master, "vendor_number", "left")
        .join(features, "vendor_number", "left")
        .select(
            "vendor_number",
            "vendor_name",
            "supplier_country",
            "categories",
            "controls",
            "hits",
            "hits_last_90_days",
            "hits_last_year",
            "amount",
            "first_day",
            "last_day",
            "features",
            "findings",
        )
    )
