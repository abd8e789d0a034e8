"""Runs the audit: every plan in order, each result fully replaced at the sink."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from auditweave.book import AuditBook
from auditweave.operators.measure import Measure
from auditweave.plans.findings import HITS
from auditweave.plans.registry import AUDIT, PLANS, VENDOR_TABLES

# How a reader expects each report to be sorted. Sorting is a property of the sink: nothing
# downstream depends on it and the plans themselves never sort.
PRESENTATION_ORDER: dict[str, list[str]] = {
    "ariba_dupe_po": ["group_number", "po_number"],
    "sap_duplicate_po": ["group_number", "po_date", "po_number"],
    "ariba_dupe_invoices": ["group_number", "invoice_date"],
    "sap_dupe_invoices": ["group_number"],
    "ariba_invoices_before_po": ["erp_supplier_id"],
    "sap_invoices_before_po": ["erp_supplier"],
    "sap_invoices_before_po_open_ended": ["erp_supplier"],
    "ariba_invoices_not_matching_po": ["erp_supplier"],
    "sap_invoices_not_matching_po": ["erp_supplier_id"],
    "ariba_split_po": ["group_id"],
    "sap_split_po": ["group_id"],
    "ariba_open_po": ["po_date"],
    "ariba_payments_without_approved_po": ["erp_supplier"],
    "ariba_deleted_user": ["vendor_description"],
    "approvals_exceeding_doa": ["vendor_number"],
    "invoice_close_to_doa": ["vendor_number"],
    "multiple_payments_same_day": ["vendor", "vendor_name", "payment_date"],
    "repeat_payments_same_amount": ["vendor", "payment_date"],
    "payments_within_1_day": ["vendor", "payment_date", "invoice_number"],
    "same_invoice_payment_date": ["vendor", "invoice_number"],
    "payments_to_blocked_vendors": ["d_vendor"],
    "payments_weekend_holiday": ["vendor", "payment_date"],
    "dupe_vendors": ["duplicate_reason", "group_number"],
    "approved_vs_blocked": ["approved_supplier_id"],
    "blocked_reonboarded": ["approved_supplier_id"],
    "dupe_po": ["system", "vendor_number", "group_number"],
}


@dataclass
class RunReport:
    written: dict[str, str] = field(default_factory=dict)
    skipped: dict[str, str] = field(default_factory=dict)
    #: by plan, and by join as "plan: join"; empty unless the book has a meter
    measured: dict[str, Measure] = field(default_factory=dict)


def run_audit(
    spark: SparkSession,
    book: AuditBook,
    out_dir: str,
    names: Iterable[str] | None = None,
    sort: bool = False,
    strict: bool = True,
) -> RunReport:
    """Write each plan to ``out_dir/<name>/<run>`` as Parquet, one folder per run.

    ``names`` are by default those of the audit; other readings run when they are named.
    Later plans read the written results of earlier ones. A result counts once it is whole:
    only then does ``out_dir/_current`` name its folder, so that a failing write leaves the last
    good report as it was, and readers go by ``current_results``. With ``strict`` any failure ends
    the run. Otherwise a conformed view whose sources cannot be read is skipped, with all that
    reads it; what is skipped is named without a folder, so no reader takes an old report
    for a current one.
    """
    wanted = set(AUDIT if names is None else names)
    report = RunReport()
    out_dir, run = out_dir.rstrip("/"), uuid.uuid4().hex
    for name in PLANS:
        if name not in wanted:
            continue
        path = f"{out_dir}/{name}/{run}"
        try:
            df = book.plan(name)
            if sort and name in PRESENTATION_ORDER:
                df = df.orderBy(*[F.asc(c) for c in PRESENTATION_ORDER[name]])
            keys = [HITS[name].vendor, HITS[name].entity] if name in HITS else []
            book.meter.rows(df, name, *dict.fromkeys(keys)).write.parquet(path)
        except (AttributeError, AnalysisException) as error:  # a source that is not there
            if strict or name in VENDOR_TABLES:
                raise
            report.skipped[name] = f"{type(error).__name__}: {str(error).splitlines()[0]}"
            _note(spark, out_dir, run, name, None)
            continue
        book.store(name, spark.read.schema(df.schema).parquet(path))
        _note(spark, out_dir, run, name, path)
        report.written[name] = path
    report.measured = book.meter.report()
    return report


_NOTE = "name string, path string, run string, noted_at timestamp"


def _note(spark: SparkSession, out_dir: str, run: str, name: str, path: str | None) -> None:
    """One row more in the list of results; a file of its own, so nothing is rewritten."""
    row = spark.createDataFrame([(name, path, run)], "name string, path string, run string")
    row.withColumn("noted_at", F.current_timestamp()).write.mode("append").parquet(
        f"{out_dir}/_current"
    )


def current_results(spark: SparkSession, out_dir: str) -> dict[str, str | None]:
    """Folder of each plan's last whole result; None if the last run skipped it."""
    notes = spark.read.schema(_NOTE).parquet(f"{out_dir.rstrip('/')}/_current")
    latest = notes.groupBy("name").agg(F.max_by(F.struct("path"), "noted_at").alias("last"))
    return {r.name: r.last.path for r in latest.collect()}


def create_views(book: AuditBook, names: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """Register plans as temporary views of the same name, replacing earlier ones."""
    views = {name: book.plan(name) for name in (AUDIT if names is None else names)}
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views
