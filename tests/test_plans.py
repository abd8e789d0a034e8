"""Functions, sources and whole plans on hand-made rows."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from auditweave import Anchors, AuditBook, Sources
from auditweave.functions.envelope import FLAGS, time_flags
from auditweave.functions.keys import erp_date, erp_date_between, full_address, joined_key, strip_zeros
from auditweave.plans.conformed import invoice_lines, payment_lines
from auditweave.plans.runner import create_views, current_results, run_audit
from auditweave.plans.vendor_tables import FEATURES, vendor_attributes, vendor_features
from auditweave.sources.schemas import LAYOUTS, schema_of
from auditweave.sources.shelf import shelf_of
from auditweave.sources.starschema import open_book

TODAY = date(2024, 3, 31)
SF_DIR = "/root/testdata/sf0.001"


def book_of(spark, **tables):
    """A book over given rows (dicts); every other source is empty."""
    frames = {}
    for name in LAYOUTS:
        schema = schema_of(name)
        rows = [
            tuple(row.get(field.name) for field in schema) for row in tables.get(name, [])
        ]
        frames[name] = spark.createDataFrame(rows, schema)
    return AuditBook(Sources.from_frames(frames), Anchors.fixed(TODAY))


def spend(vendor, **more):
    return {
        "vendor_id": vendor,
        "supplier_name": f"name {vendor}",
        "category_l1": "Indirect",
        "category_l2": "Cleaning",
        "category_l3": "Office",
        "company_code": "1000",
        "amount": Decimal(10),
        **more,
    }


def payment(vendor, doc, amount, day="20240301", **more):
    return {
        "h_company_code": "1000",
        "h_document_type": "ZP",
        "h_document_number": f"Z{doc}",
        "h_document_date": day,
        "h_posting_date": date(2024, 3, 1),
        "d_vendor": vendor,
        "d_gl_account": "1",
        "d_buzei_line_item": "001",
        "d_clrng_doc": doc,
        "d_shkzg_debit_credit_ind": "S",
        "d_clearing": day,
        "d_amount_in_lc": Decimal(amount),
        **more,
    }


def test_flags_on_every_boundary(spark):
    def flags(day, prior="standard"):
        df = spark.createDataFrame([(day,)], "d date")
        return "".join(time_flags(df, "d", TODAY, prior).select(*FLAGS).first())

    assert flags(TODAY) == "YYYYYN"
    assert flags(TODAY - timedelta(days=7)) == "YYYYYN"
    assert flags(TODAY - timedelta(days=8)) == "NYYYYN"
    assert flags(date(2024, 2, 29)) == "NYYYYN"  # a month before, clamped
    assert flags(date(2024, 2, 28)) == "NNYYYN"
    assert flags(TODAY - timedelta(days=90)) == "NNYYYN"
    assert flags(TODAY - timedelta(days=180)) == "NNNYYN"
    assert flags(date(2023, 3, 31)) == "NNNNYY"  # in both years
    assert flags(date(2022, 3, 31)) == "NNNNNY"
    assert flags(date(2022, 3, 30)) == "NNNNNN"
    assert flags(TODAY + timedelta(days=1)) == "NNNNNN"
    assert flags(None) == "NNNNNN"
    assert flags(TODAY, "cumulative") == "YYYYYY"
    assert flags(date(2022, 4, 1), "same_as_last_year") == "NNNNNN"
    assert flags(date(2022, 4, 1), "never") == "NNNNNN"


def test_key_expressions(spark):
    df = spark.createDataFrame(
        [("00120", "20240229", None, "1", "St", "C", "2", "N", "AU")],
        "v string, d string, n string, building_number string, street string, city string,"
        " postal_code string, state string, country string",
    )
    row = df.select(
        strip_zeros("v").alias("v"),
        erp_date("d").alias("d"),
        erp_date(F.lit("00000000")).alias("zero"),
        joined_key("v", "n").alias("k"),
        full_address().alias("a"),
    ).first()
    assert tuple(row) == ("120", date(2024, 2, 29), None, "00120-", "1 st c 2 n au")
    assert df.withColumn("state", F.lit(None).cast("string")).select(full_address()).first()[0] is None


def test_erp_date_bounds_drop_text_that_is_no_date(spark):
    df = spark.createDataFrame([("20240101",), ("20239999",), ("00000000",), ("20231231",)], "d string")
    inside = erp_date_between("d", F.lit(date(2023, 12, 31)), F.lit(date(2024, 1, 1)))
    assert sorted(r.d for r in df.filter(inside).collect()) == ["20231231", "20240101"]


def test_probe_reports_each_source(spark, tmp_path):
    good = spark.createDataFrame([("N005",)], "terms_of_payment_key string")
    good.write.parquet(str(tmp_path / "terms"))
    good.filter("false").write.parquet(str(tmp_path / "empty"))
    sources = Sources.from_paths(
        spark,
        {
            "terms_of_payment": str(tmp_path / "terms"),
            "business_address": str(tmp_path / "terms"),
            "dim_date": str(tmp_path / "nowhere"),
        },
    )
    report = sources.probe()
    assert report["terms_of_payment"] == "ok"
    assert report["business_address"].startswith("missing columns")
    assert report["dim_date"].startswith("unreadable")
    empty = Sources.from_paths(spark, {"terms_of_payment": str(tmp_path / "empty")})
    assert empty.probe() == {"terms_of_payment": "empty"}
    with pytest.raises(KeyError):
        Sources.from_paths(spark, {"no_such_source": "x"})


def test_sources_from_tables_rename_columns(spark):
    spark.createDataFrame([("N005",)], "Key string").createOrReplaceTempView("erp_terms")
    sources = Sources.from_tables(
        spark,
        {"terms_of_payment": "erp_terms"},
        {"terms_of_payment": {"Key": "terms_of_payment_key"}},
    )
    assert sources.terms_of_payment.columns == ["terms_of_payment_key"]


def test_shelf_lies_under_the_checkpoint_folder(spark):
    table = shelf_of(spark).put(spark.range(3).toDF("x"))
    root = spark.conf.get("spark.checkpoint.dir")
    assert all(root in path for path in table.inputFiles())


def test_base_payment_signs_blanks_and_sentinels(spark):
    book = book_of(
        spark,
        spend_base=[
            spend("0001"),
            spend("0002", invoice_document="D9", invoice_line_item="001"),
            spend("0003", category_l1="Non Addressable"),
            spend("", invoice_document="D8", invoice_line_item="001"),
        ],
        ledger=[
            payment("0001", "C1", 100),
            payment("0001", "C1", 30, d_shkzg_debit_credit_ind="H"),
            payment("0001", "C2", 5, d_clearing="00000000"),
            payment("0001", "C3", 7, day="20200101"),
            payment(None, "C4", 9, h_document_number="D9"),
            payment(None, "C5", 9, h_document_number="D9", d_clearing="00000000"),
            payment("", "C6", 9, h_document_number="D8"),
            payment("0003", "C7", 9),
        ],
    )
    rows = {
        (r.d_vendor, r.payment_clearing_doc): (
            r.payment_amount,
            r.payment_date_appears_in_vendor_account,
        )
        for r in book.plan("base_payment").collect()
    }
    # The sums follow one key (vendor, date, account, clearing): debit and credit net out.
    assert rows == {
        ("0001", "C1"): (Decimal(70), date(2024, 3, 1)),
        ("0001", "C2"): (Decimal(5), None),
        ("0002", "C4"): (Decimal(9), date(2024, 3, 1)),
    }


def test_one_time_vendor_payment_needs_one_row_after_look_ups(spark):
    vendors = [
        {"vendor": v, "vendor_status": "A", "date_first_created": TODAY}
        for v in ("0001", "0002", "0003", "0004")
    ]
    book = book_of(
        spark,
        dim_vendor=vendors,
        spend_base=[
            *[spend(v) for v in ("0001", "0002", "0003", "0004")],
            spend("0003", category_l2="Travel"),
        ],
        ledger=[
            payment("0001", "C1", 60000),
            payment("0002", "C2", 60000),
            payment("0002", "C3", 60000),
            payment("0003", "C4", 60000),  # two categories double the row
            payment("0004", "C5", 50000),  # not over the floor
        ],
    )
    found = book.plan("one_time_vendor_payment").collect()
    assert [r.supplier_id for r in found] == ["0001"]


def test_repeat_payments_ignore_same_day_and_same_document(spark):
    book = book_of(
        spark,
        spend_base=[spend("0001")],
        ledger=[
            payment("0001", "C1", 50, "20240101"),
            payment("0001", "C2", 50, "20240131"),  # 30 days later: still in
            payment("0001", "C3", 50, "20240302"),  # 31 days after C2
            payment("0001", "C4", 80, "20240101"),
            payment("0001", "C5", 80, "20240101"),  # same day does not count
        ],
    )
    docs = {r.payment_clearing_doc for r in book.plan("repeat_payments_same_amount").collect()}
    assert docs == {"C1", "C2"}


def test_deleted_user_previous_and_running_approver(spark):
    def event(step, approver, by, minutes=0):
        return {
            "approvable_id": "PR1",
            "real_user": approver,
            "approver": approver,
            "approved_by_user": by,
            "assigned_date": datetime(2024, 1, step, 9, minutes),
            "action_date": datetime(2024, 1, step, 10),
        }

    book = book_of(
        spark,
        spend_base=[spend("0001")],
        ariba_po_line=[
            {
                "po_order_id": "PO1",
                "req_requisition_id": "PR1",
                "ordered_date": date(2024, 1, 5),
                "supplier_erp_id": "0001",
                "sum_po_spend": Decimal(500),
                "sum_amount_invoiced": Decimal(500),
            }
        ],
        approvals_raw=[
            event(1, "Mia", "Mia"),
            event(2, "Ann", "Unclassified"),
            event(3, "Bob", "Bob"),
        ],
        doa=[
            {"employee_name": " bob ", "annual_limit": 100.0},
            {"employee_name": "BOB", "annual_limit": 900.0},
        ],
    )
    rows = book.plan("ariba_deleted_user").collect()
    # "Bob" is the largest name from the removed user's date on; both register rows count
    assert {(r.deleted_user, r.prev_approver, r.last_approver, r.final_approver) for r in rows} == {
        ("Ann", "Mia", "Bob", "Bob")
    }
    assert sorted((r.annual_limit, r.annual_limit_check_exceeded_final_approver) for r in rows) == [
        (100.0, "Yes"),
        (900.0, "No"),
    ]


def test_duplicate_orders_asymmetric_and_symmetric(spark):
    from auditweave.plans.controls.orders import ariba_dupe_po

    def order(number, day):
        return {
            "po_order_id": number,
            "req_requisition_id": "R",
            "ordered_date": date(2024, 1, day),
            "supplier_erp_id": "0001",
            "sum_po_spend": Decimal(20000),
        }

    # the smaller number is the earlier order: only the symmetric rule sees the pair
    book = book_of(
        spark, spend_base=[spend("0001")], ariba_po_line=[order("PO1", 1), order("PO2", 3)]
    )
    assert ariba_dupe_po(book).count() == 0
    assert {r.po_number for r in ariba_dupe_po(book, symmetric=True).collect()} == {"PO1", "PO2"}


def test_vendor_attributes_one_category(spark):
    book = book_of(
        spark,
        dim_vendor=[{"vendor": "0001", "street": "Main", "country": "NZ"}],
        spend_base=[
            spend("0001", amount=Decimal(1)),
            spend("0001", category_l2="Travel", amount=Decimal(5)),
        ],
    )
    rows = book.plan("vendor_attributes").collect()
    assert {r.supplier_category_l2 for r in rows} == {"Cleaning", "Travel"}
    assert {(r.vendor_full_address, r.local_supplier_flag) for r in rows} == {(" Main    NZ", "N")}
    single = vendor_attributes(book, one_category_per_vendor=True).collect()
    assert [r.supplier_category_l2 for r in single] == ["Travel"]


def test_features_are_120_columns_and_keep_equal_vendors(spark):
    vendor = {"vendor": "0001", "vendor_description": "V", "country": "AU"}
    book = book_of(
        spark,
        dim_vendor=[vendor, vendor],
        spend_base=[spend("0001")],
        ariba_po_line=[
            {
                "po_order_id": "PO1",
                "req_requisition_id": "R",
                "ordered_date": date(2024, 3, 1),
                "supplier_erp_id": "0001",
                "sum_po_spend": Decimal(500),
            }
        ],
    )
    df = vendor_features(book)
    assert len(df.columns) == 6 + 4 * len(FEATURES) + 2 == 120
    rows = df.collect()
    assert len(rows) == 2 and {r.peer_group_size for r in rows} == {2}
    assert {(r.total_po_spend_3m, r.peer_median_po_count_24m, r.peer_pct_rank_po_count_24m) for r in rows} == {
        (Decimal(500), 1.0, 0.0)
    }


def test_union_of_unlike_reports_goes_by_name(spark):
    columns = open_book(spark, SF_DIR).plan("dupe_invoices").columns
    assert {"invoice_status", "h_usnam_user_name"} <= set(columns)


def test_run_audit_replaces_results_and_skips_unreadable(spark, tmp_path):
    book = open_book(spark, SF_DIR)
    names = ["base_payment", "multiple_payments_same_day", "vendor_attributes"]
    for _ in range(2):  # a second run replaces the first
        report = run_audit(spark, book, str(tmp_path), names, sort=True)
    assert set(report.written) == set(names) and not report.skipped
    stored = spark.read.parquet(report.written["base_payment"])
    assert stored.count() == book.plan("base_payment").count()

    bare = AuditBook(Sources.from_frames({}), Anchors.fixed(TODAY))
    with pytest.raises(AttributeError):
        run_audit(spark, bare, str(tmp_path), ["base_payment"])
    assert current_results(spark, str(tmp_path))["base_payment"] == report.written["base_payment"]
    report = run_audit(spark, bare, str(tmp_path), ["base_payment", "split_po"], strict=False)
    assert set(report.skipped) == {"base_payment", "split_po"}
    assert current_results(spark, str(tmp_path))["base_payment"] is None
    with pytest.raises(AttributeError):
        run_audit(spark, bare, str(tmp_path / "bare"), ["po_line_level"], strict=False)


def test_a_failing_plan_is_not_passed_over(spark, tmp_path):
    book = open_book(spark, SF_DIR)
    names = ["base_payment"]
    good = run_audit(spark, book, str(tmp_path), names).written["base_payment"]
    broken = open_book(spark, SF_DIR)
    fail = F.raise_error(F.lit("disk gone")).cast("string")
    broken.plan = lambda name: AuditBook.plan(broken, name).withColumn("x", fail)
    for strict in (True, False):
        with pytest.raises(Exception, match="disk gone"):
            run_audit(spark, broken, str(tmp_path), names, strict=strict)
    assert current_results(spark, str(tmp_path)) == {"base_payment": good}
    assert spark.read.parquet(good).count() > 0


def test_text_files_are_read_by_the_layout(spark, tmp_path):
    path = tmp_path / "bank"
    path.mkdir()
    (path / "a.csv").write_text(
        "LIFNR,bank_country_key,bank_keys,bank_account_number,account_holder_name\n"
        "0000012,AU,062100,0012,Ann\n"
    )
    renames = {"vendor_bank": {"LIFNR": "vendor"}}
    sources = Sources.from_paths(spark, {"vendor_bank": str(path)}, "csv", renames)
    assert sources.probe() == {"vendor_bank": "ok"}
    row = sources.vendor_bank.first()
    assert (row.vendor, row.bank_keys, row.bank_account_number) == ("0000012", "062100", "0012")


def test_types_that_lose_digits_are_refused(spark):
    wide = spark.createDataFrame([(Decimal("1.5"),)], "amount decimal(38,12)")
    ids = spark.createDataFrame([(12,)], "vendor int")
    sources = Sources.from_frames({"spend_base": wide, "vendor_bank": ids})
    for name in ("spend_base", "vendor_bank"):
        with pytest.raises(TypeError, match="does not fit"):
            getattr(sources, name)
    full = spark.createDataFrame([], schema_of("vendor_bank")).withColumn("vendor", F.lit(1))
    report = Sources.from_frames({"vendor_bank": full}).probe()
    assert report["vendor_bank"] == "wrong types: vendor is int, not string"


def _invoice(amount, doc="PO1"):
    return {
        "h_company_code": "1000",
        "h_document_type": "YM",
        "h_document_number": "D1",
        "h_reference": f"I{amount}",
        "h_document_date": "20240301",
        "h_posting_date": date(2024, 3, 1),
        "d_vendor": "0001",
        "d_purchasing_doc": doc,
        "d_clrng_doc": "C1",
        "d_amount_in_lc": Decimal(amount),
    }


def _order(amount):
    return {
        "purchasing_document_number": "PO1",
        "vendor": "0001",
        "purchasing_document_date": date(2024, 2, 1),
        "gross_order_value": Decimal(amount),
        "net_order_value": Decimal(amount),
        "purchasing_organization": "1000",
    }


@pytest.mark.parametrize("amount, found", [("100.014", 1), ("100.01", 0), ("100.010000001", 1)])
def test_gap_over_a_cent_is_measured_in_full(spark, amount, found):
    book = book_of(
        spark,
        spend_base=[spend("0001")],
        ledger=[_invoice(amount)],
        po_schedule_line=[_order("100")],
    )
    assert book.plan("sap_invoices_not_matching_po").count() == found


@pytest.mark.parametrize("paid, found", [("100.004", 1), ("100.0041", 0), ("100.005", 0)])
def test_payment_and_invoice_compare_in_full(spark, paid, found):
    book = book_of(
        spark,
        spend_base=[spend("0001")],
        ledger=[_invoice("100.0041"), payment("0001", "C1", paid)],
    )
    assert book.plan("payment_vs_invoice_amount").count() == found


def test_features_keep_places(spark):
    vendors = [{"vendor": v, "vendor_description": v, "country": "AU"} for v in ("0001", "0002")]
    orders = [
        {
            "po_order_id": f"PO{v}",
            "req_requisition_id": "R",
            "ordered_date": date(2024, 3, 1),
            "supplier_erp_id": v,
            "sum_po_spend": Decimal(amount),
        }
        for v, amount in (("0001", "5.001"), ("0002", "5.002"))
    ]
    book = book_of(
        spark, dim_vendor=vendors, spend_base=[spend("0001"), spend("0002")], ariba_po_line=orders
    )
    ranks = {r.vendor_number: r.peer_pct_rank_total_po_spend_3m for r in vendor_features(book).collect()}
    assert ranks == {"0001": 0.0, "0002": 1.0}


def test_equal_lines_of_a_removed_user_give_both_rows(spark):
    def event(step, approver, by, action=1):
        return {
            "approvable_id": "PR1",
            "real_user": approver,
            "approver": approver,
            "approved_by_user": by,
            "assigned_date": datetime(2024, 1, step, 9),
            "action_date": datetime(2024, 1, step, 10 + action),
        }

    order = {
        "po_order_id": "PO1",
        "req_requisition_id": "PR1",
        "ordered_date": date(2024, 1, 5),
        "supplier_erp_id": "0001",
        "sum_po_spend": Decimal(500),
        "sum_amount_invoiced": Decimal(500),
    }
    book = book_of(
        spark,
        spend_base=[spend("0001")],
        ariba_po_line=[order],
        approvals_raw=[
            event(1, "Mia", "Mia"),
            event(2, "Ann", "Unclassified"),
            event(2, "Ann", "Unclassified", 2),
            event(2, "Ann", "Unclassified", 3),
        ],
    )
    rows = book.plan("ariba_deleted_user").collect()
    assert {(r.deleted_user, r.prev_approver) for r in rows} == {("Ann", "Mia"), ("Ann", "Ann")}


def test_exempt_vendors_are_a_parameter(spark):
    def order(number):
        return {
            "po_order_id": number,
            "req_requisition_id": "R",
            "ordered_date": date(2024, 1, 3),
            "supplier_erp_id": "0001",
            "sum_po_spend": Decimal(20000),
        }

    book = book_of(spark, spend_base=[spend("0001")], ariba_po_line=[order("PO1"), order("PO2")])
    assert book.plan("ariba_dupe_po").count() == 2
    book.exempt_vendors = ("0001",)
    assert book.plan("ariba_dupe_po").count() == 0


def test_vendor_without_bank_is_one_row_per_category(spark):
    vendor = {"vendor": "0001", "vendor_status": "A", "date_first_created": TODAY}
    book = book_of(
        spark,
        dim_vendor=[vendor],
        spend_base=[spend("0001", amount=Decimal(i)) for i in range(5)]
        + [spend("0001", category_l2="Travel")],
    )
    rows = book.plan("vendors_no_bank")
    assert "amount" not in rows.columns and rows.count() == 2


def test_runs_of_invoices_count_without_expanding(spark):
    text = open_book(spark, SF_DIR).plan("sap_dupe_invoices")._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in text


def test_views_are_replaceable(spark):
    book = open_book(spark, SF_DIR)
    for _ in range(2):
        create_views(book, ["doa_unique"])
    assert spark.table("doa_unique").count() > 0


def test_ledger_filters_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    text = plan_text(payment_lines(open_book(spark, SF_DIR)))
    assert "EqualTo(h_document_type,ZP)" in text
    assert "GreaterThanOrEqual(h_document_date,19990801)" in text


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ledger_is_scanned_once(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    book = open_book(spark, SF_DIR)
    for lines, view in ((payment_lines, "base_payment"), (invoice_lines, "sap_invoices")):
        place = book.src.ledger.inputFiles()[0].split("/")[-2]
        assert plan_text(lines(book)).count("FileScan") == 1
        assert place in plan_text(lines(book))
        assert place not in plan_text(book.plan(view))


def test_history_is_cut_before_it_is_ranked(spark):
    book = open_book(spark, SF_DIR)
    for name in ("first_approvers", "final_approver"):
        text = plan_text(book.plan(name))
        assert text.index("Window") < text.index("LeftSemi")  # the join is below
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    text = plan_text(book.plan("approvals_exceeding_doa"))  # the rest is written before
    assert text.count("ReadSchema: struct<employee_name") == 1


def test_each_limit_of_a_name_counts_at_each_position(spark):
    from auditweave.plans.conformed import APPROVER_COLUMNS
    from auditweave.plans.controls.approvals import _with_approver_limits, _with_limit

    names = ["Ann", "Bob", "ANN", None, "Zoe", None, None]
    approvers = spark.createDataFrame(
        [("R1", *names), ("R2", "Cy", *[None] * 6)],
        "approvable_id string, " + ", ".join(f"{c} string" for c in APPROVER_COLUMNS),
    )
    limits = spark.createDataFrame(
        [("ann", 5.0), ("ann", 7.0), ("bob", None), ("cy", None), ("cy", 1.0), (None, 9.0)],
        "_doa_name string, _limit double",
    )
    rows = spark.createDataFrame([("R1", 1), ("R2", 2), ("R3", 3), (None, 4)], "req_requisition_id string, n int")
    ours = _with_approver_limits(rows, approvers, limits)
    plain = rows.join(
        approvers, F.col("approvable_id") == F.col("req_requisition_id"), "left"
    ).drop("approvable_id")
    for name in APPROVER_COLUMNS:
        plain = _with_limit(plain, limits, name, f"annual_limit_{name}")
    assert ours.count() == 4 + 2 + 2
    assert ours.exceptAll(plain.select(ours.columns)).count() == 0
    assert plain.select(ours.columns).exceptAll(ours).count() == 0


def test_asset_orders_within_days(spark):
    from auditweave.plans.controls.orders import maximo_duplicate_po

    def order(number, day):
        return {
            "ponum": number,
            "vendor": "0001",
            "changeby": "P1",
            "orderdate": datetime(2024, 1, day),
            "changedate": datetime(2024, 1, day),
            "totalcost": Decimal(20000),
        }

    book = book_of(
        spark,
        spend_base=[spend("0001")],
        maximo_po=[order("M1", 1), order("M2", 1), order("M3", 4), order("M4", 9)],
        maximo_person=[{"personid": "P1", "displayname": "Pat"}],
        maximo_company=[{"company": "0001", "name": "One"}],
    )
    assert {r.po_number for r in maximo_duplicate_po(book).collect()} == {"M1", "M2"}
    near = maximo_duplicate_po(book, within=3).collect()
    assert {(r.po_number, r.group_number) for r in near} == {
        ("M1", 1),
        ("M2", 1),
        ("M3", 1),
        ("M2", 2),
        ("M3", 2),
    }


def test_orders_of_either_side_form_no_pairs(spark, monkeypatch):
    from auditweave.plans.controls import orders

    def no_pairs(*args, **more):
        raise AssertionError("pairs grow with the square of a key's orders")

    monkeypatch.setattr(orders, "near_date_pairs", no_pairs)
    days = {"P1": 1, "P2": 3, "P3": 9, "P4": 7}
    order = {
        "supplier_erp_id": "1", "supplier_erp_name": "n", "sum_amount_invoiced": Decimal(5),
        "sum_po_spend": Decimal(20000), "po_status": "Open", "req_requisition_id": "R",
    }
    lines = [order | {"po_order_id": p, "ordered_date": date(2024, 3, d)} for p, d in days.items()]
    book = book_of(spark, ariba_po_line=lines, spend_base=[spend("1")])
    rows = book.plan("ariba_dupe_po_symmetric").collect()
    # P1 is the earlier of its group, P3 the later of its
    assert sorted((r.po_number, r.group_number) for r in rows) == [
        ("P1", 1), ("P2", 1), ("P3", 2), ("P4", 2)
    ]


def test_payments_are_dealt_once(spark):
    book = book_of(
        spark,
        ledger=[payment("1", "C1", 10), payment(None, "C2", 20), payment("2", "C3", 30)],
        spend_base=[
            spend("1", invoice_document="ZC1", invoice_line_item="001"),
            spend("1", invoice_document="ZC2", invoice_line_item="001"),
            spend("1", invoice_document="ZC3", invoice_line_item="001"),
        ],
    )
    rows = book.plan("base_payment")
    dealt = [line for line in plan_text(rows).splitlines() if "Exchange hashpartitioning(d_vendor" in line]
    assert len(dealt) == 1 and "REPARTITION" in dealt[0]
    found = sorted((r.d_vendor, r.vendor_name, r.payment_clearing_doc, int(r.payment_amount)) for r in rows.collect())
    assert found == [("1", "name 1", "C1", 10), ("1", "name 1", "C2", 20), ("2", "name 1", "C3", 30)]


def test_invoices_found_by_vendor_are_not_dealt_again(spark):
    invoice = payment("1", "C1", 10) | {"h_document_type": "Y0"}
    book = book_of(
        spark,
        ledger=[invoice, invoice | {"d_vendor": "2"}, invoice | {"d_vendor": None}],
        spend_base=[spend("1", invoice_document="ZC1", invoice_line_item="001")],
    )
    rows = book.plan("sap_invoices")
    # the branch by document keeps the lines of another or no vendor only
    text = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "NOT coalesce((d_vendor" in text
    assert sorted((r.vendor, r.vendor_name) for r in rows.collect()) == [("1", "name 1"), ("2", "name 1")]


def test_texts_spelled_by_keys_are_not_written(spark):
    from auditweave.sources.starschema import SPELLED

    book = open_book(spark, SF_DIR)
    read = book.src.ariba_po_line.inputFiles()
    stored = spark.read.parquet(*[f for f in read if "line_item" in f])
    assert not set(SPELLED["line_item"]) & set(stored.columns)
    assert {"l_orderkey", "l_suppkey", "l_partkey"} <= set(stored.columns)
