"""Fact table of hits, briefs, rolling views, published tables and measured runs."""

from __future__ import annotations

import random
import subprocess
import sys
import threading
from datetime import date, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

from auditweave import Anchors, AuditBook
from auditweave.book import SHARED
from auditweave.operators.measure import Meter
from auditweave.operators.ranking import top_rows
from auditweave.plans import conformed, finance_transactions, findings, monthly_features, publish, rolling
from auditweave.plans.registry import CONTROLS
from auditweave.plans.runner import run_audit
from auditweave.plans.vendor_tables import vendor_windowed_features
from auditweave.sources import buckets
from auditweave.sources.facts import FactTable
from auditweave.sources.shelf import shelf_of
from auditweave.sources.starschema import open_book
from tests.test_plans import SF_DIR, book_of, payment, spend

FACTS = StructType().add("entity", "string").add("amount", DecimalType(38, 9)).add("control", "string")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# --- fact table -------------------------------------------------------------------------


def test_partitions_are_replaced_alone_and_can_become_empty(spark, tmp_path):
    facts = FactTable(spark, str(tmp_path / "facts"), FACTS, "control")
    rows = spark.createDataFrame([("1", 1, "a"), ("2", 2, "b"), ("3", 3, "b")], "entity string, amount int, control string")
    facts.replace(rows, ["a", "b", "c"], date(2024, 1, 1))
    assert sorted(r.entity for r in facts.rows().collect()) == ["1", "2", "3"]
    facts.replace(rows.where("entity = '3'"), ["b"], date(2024, 2, 1))
    facts.replace(rows.limit(0), ["a"], date(2024, 3, 1))
    assert [tuple(r) for r in facts.rows().collect()] == [("3", Decimal("3.000000000"), "b")]
    assert {r.control: r.as_of for r in facts.refreshed().collect()} == {
        "a": date(2024, 3, 1), "b": date(2024, 2, 1), "c": date(2024, 1, 1),
    }


def test_rows_of_other_partitions_are_refused(spark, tmp_path):
    facts = FactTable(spark, str(tmp_path / "facts"), FACTS, "control")
    rows = spark.createDataFrame([("1", 1, "a"), ("2", 2, None)], "entity string, amount int, control string")
    with pytest.raises(Exception, match="outside the partitions"):
        facts.replace(rows, ["a"], date(2024, 1, 1))


# --- findings ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def sample(spark):
    return open_book(spark, SF_DIR)


def test_every_control_is_a_fact_but_the_second_definition():
    assert set(findings.HITS) == set(CONTROLS) - {"sap_invoices_before_po_open_ended"}
    assert len(findings.HITS) == 37


def test_hits_are_the_rows_of_the_reports(sample):
    counted = {r.control: r["count"] for r in sample.table("control_hits").groupBy("control").count().collect()}
    for control in ("ariba_open_po", "payments_weekend_holiday", "dupe_vendors"):
        assert counted[control] == sample.plan(control).count()


def test_summary_and_brief_scan_the_facts_once(sample):
    plan = _plan(findings.vendor_control_summary(sample))
    assert plan.count("FileScan") == 1


def test_summary_levels_add_up(sample):
    rows = findings.vendor_control_summary(sample).collect()
    by = {level: [r for r in rows if r.level == level] for level in {r.level for r in rows}}
    (total,) = by["all"]
    for level in ("vendor and control", "vendor", "control"):
        assert sum(r.hits for r in by[level]) == total.hits
        assert sum(r.amount or 0 for r in by[level]) == total.amount
        assert sum(r.entities for r in by[level]) == total.entities
    assert total.vendors == len([r for r in by["vendor"] if r.vendor_number is not None])
    assert total.controls == len(by["control"])


def _hits(spark, rows):
    return spark.createDataFrame(rows, findings.HIT_SCHEMA.replace("decimal(38,9)", "int"))


class _Given:
    """A book whose only table are the given hits."""

    today = date(2024, 3, 31)

    def __init__(self, hits):
        self._hits = hits

    def table(self, name):
        assert name == "control_hits"
        return self._hits


def test_evidence_is_the_top_of_each_cell_and_parts_merge(spark):
    rnd = random.Random(5)
    rows = [
        (rnd.choice(["v1", "v2", None]), f"{part}{rnd.randint(0, 30)}", rnd.choice([None, date(2024, 1, 1) + timedelta(rnd.randint(0, 9))]),
         rnd.choice([None, 1, 2, 3, 50]), rnd.choice(["a", "b"]))
        for part in "xy" for _ in range(150)
    ]
    whole = findings.evidence(_Given(_hits(spark, rows)), 4)
    cells = {}
    for vendor, entity, day, amount, control in rows:
        cells.setdefault((vendor, control), {}).setdefault(entity, []).append((amount, day))
    expected = set()
    for key, entities in cells.items():
        ranked = sorted(
            (
                (-sum(a for a, _ in hits if a is not None) if any(a is not None for a, _ in hits) else 1,
                 -max((d.toordinal() for _, d in hits if d), default=0), entity)
                for entity, hits in entities.items()
            )
        )
        expected |= {(*key, e, i + 1) for i, (_, _, e) in enumerate(ranked[:4])}
    got = {(r.vendor_number, r.control, r.entity, r.place) for r in whole.collect()}
    assert got == expected
    halves = [findings.evidence(_Given(_hits(spark, [r for r in rows if r[1][0] == p])), 4) for p in "xy"]
    merged = findings.merge_evidence(*halves, 4)
    assert {(r.vendor_number, r.control, r.entity, r.place) for r in merged.collect()} == expected


def test_only_the_tasks_best_rows_are_shuffled_by_key(spark):
    rows = spark.range(1000).withColumn("k", F.col("id") % 3)
    plan = _plan(top_rows(rows, ["k"], [F.desc("id")], 2))
    below = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_only_the_facts_stay_of_what_hits_took(spark, tmp_path):
    def orders(number, day):
        return {
            "po_order_id": number, "ordered_date": day, "supplier_erp_id": "1", "supplier_erp_name": "n",
            "sum_amount_invoiced": Decimal(90000), "sum_po_spend": Decimal(90000), "po_status": "Open",
        }

    lines = [orders("P1", date(2024, 1, 3)), orders("P2", date(2024, 1, 3)), orders("P3", date(2024, 1, 3))]
    book = book_of(spark, ariba_po_line=lines, spend_base=[spend("1")])
    kept = book.plan("ariba_dupe_po").count()
    shelf = shelf_of(spark)

    def tables():
        return {p.name.split("-", 1)[1] for p in Path(shelf.folder).iterdir() if int(p.name[:5]) > first}

    first = next(shelf._count)
    facts = findings.refresh_hits(spark, book, str(tmp_path / "hits"), ["ariba_dupe_po", "ariba_open_po"])
    assert tables() <= set(SHARED)
    counted = {r.control: r["count"] for r in facts.rows().groupBy("control").count().collect()}
    assert counted == {"ariba_dupe_po": kept, "ariba_open_po": 3} and kept > 0
    # a report that another plan reads keeps what it is made of
    first = next(shelf._count)
    report = book.table("ariba_dupe_po")
    findings.refresh_hits(spark, book, str(tmp_path / "hits"), ["ariba_dupe_po"])
    assert "flagged" in tables() and report.count() == kept


def test_briefs_have_one_row_per_vendor_with_hits(sample):
    briefs = findings.case_brief_inputs(sample).collect()
    vendors = {r.vendor_number for r in sample.table("control_hits").select("vendor_number").distinct().collect()}
    assert {b.vendor_number for b in briefs} == vendors - {None} and len(briefs) == len(vendors - {None})
    for b in briefs:
        assert b.controls == len(b.findings) and b.hits == sum(f.hits for f in b.findings)
        assert all(1 <= len(f.evidence) <= 5 and f.entities >= 0 for f in b.findings)
        assert [e.place for e in b.findings[0].evidence] == list(range(1, len(b.findings[0].evidence) + 1))


# --- rolling views ----------------------------------------------------------------------


def _ledger(rnd, n):
    rows = []
    for i in range(n):
        day = date(2024, 3, 31) - timedelta(rnd.randint(0, 900))
        posted = rnd.choice([None, day, day + timedelta(rnd.randint(-70, 70))])
        rows.append(
            payment(
                rnd.choice(["1", "2", "3", "", None]), f"C{rnd.randint(0, 60)}", rnd.choice([100, 200]),
                rnd.choice([day.strftime("%Y%m%d")] * 9 + ["00000000"]),
                h_posting_date=posted, h_document_number=f"D{rnd.randint(0, 40)}",
                d_clearing=rnd.choice(["00000000", "20240301"]), d_shkzg_debit_credit_ind=rnd.choice("HS"),
                h_document_type=rnd.choice(["ZP", "ZP", "ZP", "KR"]),
            )
        )
    return rows


def test_shared_tables_are_written_several_at_a_time(spark, tmp_path):
    book = book_of(spark)
    meeting, come = threading.Barrier(2), []
    table = book.table

    def noting(name):
        if name in SHARED[:2] and name not in come:
            come.append(name)
            meeting.wait(timeout=30)
        return table(name)

    book.table = noting
    facts = findings.refresh_hits(spark, book, str(tmp_path / "hits"), ["vendors_no_bank"])
    assert facts.rows().count() == 0 and facts.refreshed().count() == 1
    assert set(come) == set(SHARED[:2]) and set(SHARED) <= set(book._kept)


def _same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    return sorted(map(repr, (tuple(r[c] for c in columns) for r in left.collect()))) == sorted(
        map(repr, (tuple(r[c] for c in columns) for r in right.collect()))
    )


def test_rolling_payments_equal_the_rebuild_at_every_day(spark, tmp_path):
    rnd = random.Random(7)
    rows = _ledger(rnd, 600)
    scope = [spend(v, invoice_document=f"D{i}", invoice_line_item="001") for i, v in enumerate("123" * 14)]
    book = book_of(spark, ledger=rows, spend_base=scope)
    landed = rolling.land_by_month(book.src.ledger, rolling.payment_month(), str(tmp_path / "ledger"))
    assert landed.count() == len(rows)
    state = rolling.payment_state(spark, landed, str(tmp_path / "state"))
    reads = []
    for day in (date(2023, 12, 15), date(2024, 1, 15), date(2024, 1, 31), date(2024, 2, 29), date(2024, 3, 31)):
        at = AuditBook(book.src, Anchors.fixed(day))
        # rows that a run of that day could not have seen are told apart by the posting month
        reads.append(state.advance(landed, day, rolling.month_back(day, 24)))
        assert _same(rolling.payments_of(at, state), conformed.base_payment(at))
    ahead = {m for m in reads[-1].read if m > "2024-03"}
    assert [m for m in reads[1].read if m <= "2024-01"] == ["2023-12", "2024-01"]
    assert [m for m in reads[2].read if m <= "2024-01"] == ["2024-01"]
    assert [m for m in reads[4].read if m not in ahead] == ["2024-02", "2024-03"]
    assert reads[1].dropped == ["2021-12"] and reads[0].dropped == []
    # a state is its folder: opened again it goes on from there
    again = rolling.payment_state(spark, landed, str(tmp_path / "state"))
    assert set(again.advance(landed, date(2024, 3, 31), "2022-03").read) == {"2024-03"} | ahead
    assert "2023-05" in again.advance(landed, date(2024, 3, 31), "2022-03", again=["2023-05"]).read


def test_a_run_scans_only_the_months_it_reads(spark, tmp_path):
    book = book_of(spark, ledger=_ledger(random.Random(1), 300))
    landed = rolling.land_by_month(book.src.ledger, rolling.payment_month(), str(tmp_path / "ledger"))
    months = ["2024-02", "2024-03"]
    plan = _plan(rolling._payment_partial(landed.where(F.col("month").isin(months))))
    assert "PartitionFilters: [month" in plan.replace("isnotnull(month#", "[month#") or "month#" in plan
    files = landed.where(F.col("month").isin(months)).inputFiles()
    assert {f.split("month=")[1].split("/")[0] for f in landed.inputFiles()} > set(months)
    parts = [line for line in plan.split("\n") if "PartitionFilters" in line]
    assert parts and all("2024-02" in line and "2024-03" in line for line in parts)
    assert files


def test_rolling_orders_equal_the_rebuild(spark, tmp_path):
    rnd = random.Random(2)
    lines = [
        {
            "purchasing_document_number": f"P{rnd.randint(0, 40)}", "purchasing_document_item": str(rnd.randint(1, 2)),
            "vendor": rnd.choice(["001", "1", "02", "9"]), "purchasing_document_date": date(2024, 3, 31) - timedelta(rnd.randint(0, 800)),
            "document_last_changed_on": date(2024, 1, rnd.randint(1, 9)), "purchasing_item_short_text": rnd.choice("ab"),
            "gross_order_value": Decimal(rnd.randint(1, 3)), "net_order_value": Decimal(1), "document_currency": "AUD",
            "purchasing_organization": rnd.choice(["1000", "1000", "2000"]),
        }
        for _ in range(300)
    ]
    book = book_of(spark, po_schedule_line=lines, spend_base=[spend("1"), spend("2"), spend("01", category_l2="Other")])
    month = rolling.month_of(F.col("purchasing_document_date"))
    landed = rolling.land_by_month(book.src.po_schedule_line, month, str(tmp_path / "lines"))
    state = rolling.order_state(spark, landed, str(tmp_path / "state"))
    for day in (date(2024, 2, 29), date(2024, 3, 31)):
        at = AuditBook(book.src, Anchors.fixed(day))
        state.advance(landed, day, rolling.month_back(day, 24))
        assert _same(
            rolling.orders_of(at, state).withColumns({c: F.col(c).cast("double") for c in ("po_amount_gross", "po_amount_net")}),
            conformed.sap_po(at).withColumns({c: F.col(c).cast("double") for c in ("po_amount_gross", "po_amount_net")}),
        )


def _transactions(spark, rnd, n, today):
    rows = []
    for _ in range(n):
        ordered = today - timedelta(rnd.randint(-20, 900))
        billed = rnd.choice([None, ordered + timedelta(rnd.randint(0, 200))])
        rows.append(
            (
                rnd.choice(["v1", "v2", "v3", None]), f"P{rnd.randint(0, 80)}", None if billed is None else f"I{rnd.randint(0, 90)}",
                ordered, billed, Decimal(rnd.randint(1, 9)), rnd.choice([None, Decimal(2)]), rnd.choice([None, Decimal(3)]),
                rnd.choice([None, billed]),
            )
        )
    return spark.createDataFrame(
        rows,
        "vendor_number string, po_number string, invoice_id string, po_date date, invoice_date date,"
        " po_spend decimal(18,2), invoice_amount_excl_tax decimal(18,2), payment_amount decimal(18,2), payment_date date",
    )


@pytest.mark.parametrize("today", [date(2024, 3, 1), date(2024, 3, 17)])
def test_features_by_month_equal_the_rebuild(spark, tmp_path, today):
    rows = _transactions(spark, random.Random(today.day), 500, today)
    at = book_of(spark)
    at.anchors = Anchors.fixed(today)
    at.store("base_transaction", rows)
    state = monthly_features.FeatureState(spark, str(tmp_path / "state"), rows, today)
    # on the first run, what is billed later are orders without an invoice
    billed = F.col("invoice_date") < F.lit(today - timedelta(days=20))
    columns = ("invoice_id", "invoice_amount_excl_tax", "payment_amount", "payment_date", "invoice_date")
    early = rows.select(*[F.when(billed, F.col(c)).alias(c) if c in columns else c for c in rows.columns])
    state.advance(early, date(2024, 2, today.day))
    read = state.advance(rows, today)
    assert {"0000-00", "2024-02", "2024-03"} <= set(read["bitmaps"]) and "2024-01" not in read["bitmaps"]
    like = vendor_windowed_features(at)
    assert _same(state.features(today, like), like)


def test_a_dictionary_only_grows(spark):
    def pairs(*rows):
        return spark.createDataFrame(rows, "vendor_number string, invoice_id string, month string")

    first = monthly_features.extend_dictionary(None, pairs(("v", "b", "2024-01"), ("v", "a", "2024-02"), ("w", "a", "2024-01"), ("v", None, "2024-01")))
    second = monthly_features.extend_dictionary(first, pairs(("v", "0", "2024-03"), ("v", "b", "2024-03"), ("x", "q", "2024-03")))
    assert {(r.vendor_number, r.invoice_id): r.number for r in second.collect()} == {
        ("v", "b"): 1, ("v", "a"): 2, ("w", "a"): 1, ("v", "0"): 3, ("x", "q"): 1,
    }


def test_months_must_be_whole(spark):
    with pytest.raises(ValueError, match="first 28 days"):
        monthly_features.anchored_month(F.lit(date(2024, 3, 31)), date(2024, 3, 31))


# --- published tables -------------------------------------------------------------------


def test_views_stay_with_the_last_whole_run(spark, monkeypatch):
    names = ["addressable_vendors", "base_payment", "payments_weekend_holiday"]
    scope = [spend("1"), spend("2")]
    book = book_of(spark, spend_base=scope, ledger=[payment("1", "A", 5, "20240302")])
    first = publish.publish(spark, book, "audit_test", names)
    assert spark.table("audit_test.base_payment").count() == 1

    more = book_of(spark, spend_base=scope, ledger=[payment("1", "A", 5, "20240302"), payment("2", "B", 6, "20240303")])

    def broken(book):
        raise RuntimeError("lost")

    from auditweave.plans.registry import PLANS

    with monkeypatch.context() as m:
        m.setitem(PLANS, "payments_weekend_holiday", broken)
        with pytest.raises(RuntimeError):
            publish.publish(spark, more, "audit_test", names)
    # the failed run wrote two tables, but no reader sees them
    assert spark.table("audit_test.base_payment").count() == 1
    assert publish.runs(spark, "audit_test") == [first]

    second = publish.publish(spark, more, "audit_test", names)
    assert spark.table("audit_test.base_payment").count() == 2
    publish.turn_to(spark, "audit_test", first)
    assert spark.table("audit_test.base_payment").count() == 1
    publish.turn_to(spark, "audit_test", second)
    dropped = publish.forget(spark, "audit_test", keep=1)
    # the first run's three tables and the two of the run that failed
    assert len(dropped) == 5 and not any(second in name for name in dropped)
    assert spark.table("audit_test.payments_weekend_holiday").count() == 2
    with pytest.raises(KeyError):
        publish.turn_to(spark, "audit_test", "nosuchrun")
    with pytest.raises(KeyError):
        publish.publish(spark, more, "audit_test", ["no_such_plan"])
    spark.sql("DROP DATABASE audit_test CASCADE")


# --- buckets ----------------------------------------------------------------------------


def _above(plan: str, scan: str) -> list[str]:
    """The nodes between the scan of a table and the join above it."""
    lines = plan.split("\n")
    (at,) = [i for i, line in enumerate(lines) if "FileScan" in line and scan in line]

    def depth(line):
        return len(line) - len(line.lstrip(" :+-"))

    found, level = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < level:
            level = depth(line)
            if "Join" in line:
                return found
            found.append(line)
    raise AssertionError("no join above the scan")


@pytest.mark.parametrize("view", ["base_payment", "sap_invoices"])
def test_the_stored_ledger_is_joined_where_it_lies(spark, view):
    rows = _ledger(random.Random(4), 200)
    rows += [r | {"h_document_type": "Y0"} for r in rows[:100]]
    scope = [spend(v, invoice_document=f"D{i}", invoice_line_item="001") for i, v in enumerate("123" * 14)]
    plain = book_of(spark, ledger=rows, spend_base=scope)
    spark.sql("CREATE DATABASE IF NOT EXISTS audit_buckets")
    table, keys = "audit_buckets.ledger_by_document", tuple(conformed.LINE_KEY)
    buckets.store_clustered(plain.src.ledger, table, keys, 6)
    stored = book_of(spark, ledger=rows, spend_base=scope)
    buckets.bind_clusters(spark, stored.src, {("ledger", keys): table})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = stored.plan(view)
        assert not any("Exchange" in line for line in _above(_plan(result), "ledger_by_document"))
        assert result.count() and _same(result, plain.plan(view))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE audit_buckets CASCADE")


def test_a_stored_copy_must_fit_the_layout(spark):
    book = book_of(spark)
    assert book.src.clustered("ledger", "d_vendor") is None
    book.src.bind_clustered("ledger", ("d_vendor",), lambda: spark.range(1).select(F.col("id").alias("d_vendor")))
    with pytest.raises(TypeError, match="d_vendor"):
        book.src.clustered("ledger", "d_vendor")
    with pytest.raises(KeyError):
        book.src.bind_clustered("nothing", ("a",), None)


def test_credits_are_read_from_the_ledger_once(sample):
    def folders(df):
        return {f.rsplit("/", 2)[1] for f in df.inputFiles()}

    (ledger,) = folders(sample.src.ledger)
    read = folders(sample.plan("payments_within_1_day"))
    assert ledger not in read and any(f.endswith("credits") for f in read)


# --- finance transactions ---------------------------------------------------------------


def test_what_was_paid_is_shared_out_whole(spark):
    rnd = random.Random(9)
    items = [(f"d{rnd.randint(0, 9)}", f"i{i}", Decimal(rnd.choice([-5, 0, 1, 1, 3, 7]))) for i in range(60)]
    items += [("zero", "a", Decimal(5)), ("zero", "b", Decimal(-5)), ("unpaid", "a", Decimal(1)), (None, "a", Decimal(1))]
    paid = [(f"d{i}", Decimal(rnd.choice([100, 10, -7, 0])) + Decimal("0.01")) for i in range(9)] + [("zero", Decimal(9)), ("nobody", Decimal(1))]
    shared = finance_transactions.share_out(
        spark.createDataFrame(items, "doc string, item string, amount decimal(38,9)"),
        spark.createDataFrame(paid, "doc string, paid decimal(38,9)"),
        ["doc"], ["item"],
    ).collect()
    assert len(shared) == len(items)
    totals = {}
    for r in shared:
        if r.share is not None:
            totals[r.doc] = totals.get(r.doc, 0) + r.share
    docs = {d for d, _, _ in items}
    assert totals == {d: p for d, p in paid if d in docs}
    assert {r.doc for r in shared if r.share is None} >= {"unpaid", None}
    assert {(r.item, r.share) for r in shared if r.doc == "zero"} == {("a", Decimal(9)), ("b", Decimal(0))}


def test_finance_transactions_have_the_columns_of_the_other_branch(sample):
    ours = sample.plan("sap_transaction")
    assert ours.columns == sample.table("base_transaction").columns
    both = sample.table("base_transaction").unionByName(ours)
    assert {r.system for r in both.select("system").distinct().collect()} == {"Ariba", "SAP"}


def test_finance_transactions_do_not_need_the_other_branch(spark):
    book = open_book(spark, SF_DIR)
    ours = book.plan("sap_transaction")
    assert "base_transaction" not in book._kept
    money = {"po_spend", "invoice_amount_excl_tax", "payment_amount", "amount_paid_excl_tax", "tax_amount"}
    kinds = {f.name: f.dataType for f in book.table("base_transaction").schema if f.name not in money}
    assert {f.name: f.dataType for f in ours.schema if f.name not in money} == kinds


# --- measured runs ----------------------------------------------------------------------


def test_a_run_reports_rows_nulls_and_fan_out_without_more_jobs(spark, tmp_path):
    order = {
        "po_order_id": "P1", "ordered_date": date(2024, 3, 1), "supplier_erp_id": "1", "supplier_erp_name": "n",
        "sum_amount_invoiced": Decimal(5), "sum_po_spend": Decimal(5), "po_status": "Open", "req_requisition_id": "R",
    }
    tables = {
        "ariba_po_line": [order, order | {"po_order_id": "P2"}],
        # a vendor in two categories doubles its orders
        "spend_base": [spend("1"), spend("1", category_l2="Other")],
        "ariba_invoice_line": [
            {"order_id": "P1", "po_ordered_date": date(2024, 3, 1), "invoice_id": i, "invoice_date": date(2024, 3, 2),
             "amount_invoiced": Decimal(1), "tax_amount": Decimal(0), "paid_amount": Decimal(1)} for i in ("I1", "I2")
        ],
    }
    names = ["ariba_po_invoice", "base_transaction", "ariba_open_po"]
    plain = book_of(spark, **tables)
    metered = AuditBook(book_of(spark, **tables).src, plain.anchors, meter=Meter())
    tracker = spark.sparkContext.statusTracker()
    jobs = {}
    for label, book in (("plain", plain), ("metered", metered)):
        spark.sparkContext.setJobGroup(label, label)
        report = run_audit(spark, book, str(tmp_path / label), names)
        jobs[label] = len(tracker.getJobIdsForGroup(label))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs["metered"] <= jobs["plain"]
    seen = report.measured
    assert seen["ariba_po_invoice: categories"].fan_out == 2.0
    assert seen["ariba_po_invoice: invoices"].before == 4 and seen["ariba_po_invoice: invoices"].rows == 6
    assert seen["ariba_po_invoice: invoices"].nulls == {"invoice_id": 2}
    assert seen["base_transaction: approver"].fan_out == 1.0
    assert seen["base_transaction: approver"].nulls == {"approved_by_user": 3}
    assert seen["ariba_po_invoice"].rows == 6
    assert run_audit(spark, plain, str(tmp_path / "again"), ["ariba_open_po"]).measured == {}


# --- entry ------------------------------------------------------------------------------


def test_audit_queries_do_without_the_training_data_part():
    code = (
        "import sys; sys.modules['auditweave.llm'] = None; import __spark_entry__ as e;"
        "q, o = e.queries(), e.oracle_sql();"
        "assert 'split_invoice' in q and 'split_invoice' in o and not any(n.startswith('op') for n in q)"
    )
    root = Path(__file__).resolve().parents[1]
    for broken in (code, code.replace("auditweave.llm'", "xxhash'")):
        subprocess.run([sys.executable, "-c", broken], check=True, cwd=root, timeout=120)
