"""What plans write and shuffle: each row as few times as the work needs."""

from __future__ import annotations

import os
import re
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from auditweave.book import AuditBook
from auditweave.functions.anchors import Anchors
from auditweave.plans import rolling
from auditweave.plans.controls import vendors
from auditweave.sources.catalog import Sources
from auditweave.sources.schemas import LAYOUTS, schema_of
from auditweave.sources.shelf import CLEANUP, Shelf, pin
from auditweave.sources.starschema import bind, open_book

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def large(spark):
    """Nothing is small enough to be broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, "-1")
    yield spark
    spark.conf.unset(key)


def shuffles(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)


def names(keys: str) -> list[str]:
    return re.findall(r"(\w+)#\d+", keys)


@pytest.mark.parametrize(
    "name", ["ariba_po_line", "ariba_invoice_line", "po_schedule_line", "spend_base"]
)
def test_sources_made_of_lines_are_views_of_them(spark, name):
    sources = bind(spark, SF_DIR)
    assert any("line_item" in f for f in getattr(sources, name).inputFiles())


def test_approvals_are_views_of_their_events(spark):
    sources = bind(spark, SF_DIR)
    for name in ("approvals_raw", "approvals_curated"):
        assert all("approval_event" in f for f in getattr(sources, name).inputFiles())


def test_a_written_table_leaves_no_shuffle_files_and_the_setting_as_it_was(spark):
    root = os.environ.get("SPARK_LOCAL_DIRS") or spark.conf.get("spark.local.dir", "/tmp")

    def shuffle_files():
        folders = Path(root).glob("blockmgr-*")
        return {f for d in folders for f in d.rglob("shuffle_*_*_0.data")}

    before = shuffle_files()
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    written = pin(rows)
    assert not shuffle_files() - before
    assert written.count() == 7 and rows.count() == 7
    assert all(".zstd." in f for f in written.inputFiles())
    assert spark.conf.get(CLEANUP, "false") == "false"
    spark.conf.set(CLEANUP, "true")
    try:
        Shelf(spark).put(rows)
        assert spark.conf.get(CLEANUP) == "true"
    finally:
        spark.conf.unset(CLEANUP)


def test_orders_and_invoices_are_shuffled_once_each(large):
    keys = [names(k) for k in shuffles(open_book(large, SF_DIR).plan("ariba_po_invoice"))]
    assert not [k for k in keys if len(k) > 4]  # the sums take the partitions of the join


def test_orders_meet_their_approvers_in_one_shuffle(large):
    keys = [names(k) for k in shuffles(open_book(large, SF_DIR).plan("approvals_matrix"))]
    assert keys.count(["po_number"]) == 1
    assert not [k for k in keys if len(k) > 1]


def test_base_transaction_sums_where_the_line_totals_are_joined(large):
    keys = [names(k) for k in shuffles(open_book(large, SF_DIR).plan("base_transaction"))]
    assert keys.count(["po_number"]) == 1
    assert not [k for k in keys if len(k) > 4]


@pytest.mark.parametrize("name", ["approvals_exceeding_doa", "invoice_close_to_doa"])
def test_limits_are_found_for_requisitions_before_orders(large, name):
    from auditweave.plans.controls.approvals import _ordered_requisitions

    rows = _ordered_requisitions(open_book(large, SF_DIR), ["po_number", "po_spend", "vendor_number"])
    keys = [names(k) for k in shuffles(rows)]
    assert keys.count(["po_number"]) == 1
    assert ["po_number", "po_spend", "vendor_number"] not in keys


def test_an_order_of_several_requisitions_without_approvals_is_one_row(spark):
    def line(number, requisition):
        return {
            "po_order_id": number,
            "req_requisition_id": requisition,
            "ordered_date": date(2024, 1, 3),
            "supplier_erp_id": "0001",
            "sum_po_spend": Decimal(5),
        }

    def approval(requisition, user):
        return {"approvable_id": requisition, "real_user": user, "action_date": datetime(2024, 1, 4)}

    lines = [line("P1", "R1"), line("P1", "R2"), line("P2", "R1"), line("P2", "R3"), line("P3", None)]
    vendor = {
        "vendor_id": "0001",
        "supplier_name": "One",
        "category_l1": "Indirect",
        "category_l2": "Cleaning",
        "company_code": "1000",
    }
    given = {
        "ariba_po_line": lines + lines,
        "spend_base": [vendor],
        "approvals_raw": [approval("R3", "Ann"), approval("R3", "Bob")],
    }
    frames = {}
    for name in LAYOUTS:
        schema = schema_of(name)
        rows = [tuple(row.get(f.name) for f in schema) for row in given.get(name, [])]
        frames[name] = spark.createDataFrame(rows, schema)
    book = AuditBook(Sources.from_frames(frames), Anchors.fixed(date(2024, 3, 31)))
    rows = book.plan("approvals_matrix").collect()
    found = sorted((r.po_number, r.approvable_id or "", r.approver_1 or "", r.approver_2 or "") for r in rows)
    assert found == [("P1", "", "", ""), ("P2", "", "", ""), ("P2", "R3", "Ann", "Bob"), ("P3", "", "", "")]


def joins(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [" ".join([kind, *names(keys)]) for kind, keys in re.findall(r"(\w+Join) (.*?), \w+(?:,|\n)", plan)]


def test_employees_spend_and_payments_are_dealt_not_sent_to_the_driver(spark):
    book = open_book(spark, SF_DIR)
    assert "SortMergeJoin bank_key emp_bank_key" in joins(vendors._employee_accounts(book))
    found = joins(vendors.vendor_employee_same_bank(book))
    assert {"SortMergeJoin employee_id _employee", "SortMergeJoin supplier_id supplier_id"} <= set(found)
    for summed, how_many in ((False, 1), (True, 2)):
        found = joins(vendors.payments_shared_bank(book, summed))
        assert found.count("SortMergeJoin supplier_id supplier_id") == how_many
        assert not {"BroadcastHashJoin supplier_id supplier_id", "BroadcastHashJoin employee_id _employee"} & set(found)


def test_the_ledger_by_month_has_all_lines_but_only_columns_that_are_read(spark, monkeypatch):
    landed = []

    def noting(rows, month, path):
        before = spark.conf.get(CLEANUP, None)
        landed.append(land(rows, month, path))
        assert spark.conf.get(CLEANUP, None) == before
        return landed[0]

    land = rolling.land_by_month
    monkeypatch.setattr(rolling, "land_by_month", noting)
    book = open_book(spark, SF_DIR)
    rolling.base_payment_rolling(AuditBook(book.src, book.anchors))
    assert set(landed[0].columns) == {*rolling.PAYMENT_COLUMNS, rolling.MONTH}
    assert landed[0].count() == book.src.ledger.count()
    assert "h_docheader_text" in book.src.ledger.columns
    assert all(".zstd." in f for f in landed[0].inputFiles())
