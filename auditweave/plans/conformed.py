"""Conformed views: ERP extracts brought to one shape per business object."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditweave.functions.anchors import months_before
from auditweave.functions.keys import erp_date, erp_date_between, erp_text_from, invoice_origin, strip_zeros
from auditweave.operators.ranking import first_per_key, ranked_columns
from auditweave.plans.scope import COMPANY, in_scope_spend, scope_columns
from auditweave.sources.shelf import pin

L2 = "supplier_custom_category_l2"

# Ledger document types of payments and of invoices.
PAYMENT_DOCS = ["ZP"]
INVOICE_DOCS = ["Y0", "VN", "RN", "YM", "VS", "FI", "FN", "FR", "ZF"]
UNCLEARED = "00000000"

LINE_KEY = ["h_document_number", "d_buzei_line_item"]

# Marks lines of the branch by document that the branch by vendor holds as well.
BY_VENDOR = "_by_vendor"


def ariba_po_invoice(book) -> DataFrame:
    """Orders of the last 24 months with their invoices.

    Grain: order header x cost centre x invoice header x description x vendor category.
    Each side is summed to its own grain before the join, and both grains are kept in full,
    so the joined rows are distinct without a further pass. Both are dealt by order first,
    which serves the sums and the join: each row is shuffled once.
    """
    src, day = book.src, book.local_today
    window_start = months_before(day, 24)

    orders = (
        src.ariba_po_line.filter(
            F.col("ordered_date").cast("date").between(window_start, F.lit(day))
        )
        .repartition("po_order_id")
        .groupBy(
            F.col("po_order_id").alias("po_number"),
            F.col("req_requisition_id").alias("requisition_id"),
            F.col("ordered_date").alias("po_date"),
            F.col("title").alias("po_title"),
            F.col("supplier_erp_id").alias("vendor_number"),
            F.col("supplier_erp_name").alias("vendor_description"),
            "po_status",
            "contract_id",
            F.col("requester_user").alias("requestor"),
            F.col("requester_manager_l1").alias("approver"),
            strip_zeros("cost_center_id").alias("cost_center"),
            "payment_terms",
        )
        .agg(
            F.sum("sum_amount_invoiced").alias("po_amount_invoiced"),
            F.sum("sum_po_spend").alias("po_spend"),
        )
    )
    invoices = (
        src.ariba_invoice_line.filter(
            F.col("po_ordered_date").between(window_start, F.lit(day))
        )
        .repartition("order_id")
        .groupBy(
            F.col("order_id").alias("po_order_id"),
            "invoice_id",
            "invoice_date",
            F.col("description").alias("inv_description"),
            "reconciliation_status",
            "invoice_status",
            F.col("contract_id").alias("inv_contract_id"),
            F.col("paid_amount").alias("amount_paid"),
        )
        .agg(
            F.sum("amount_invoiced").alias("amount_invoiced"),
            F.sum("tax_amount").alias("tax_paid"),
        )
        .withColumn("amount_paid_excl_tax", F.col("amount_paid") - F.col("tax_paid"))
    )
    vendors = scope_columns(
        book, "vendor_id", "supplier_custom_category_l1", L2, "supplier_custom_category_l3"
    )
    scoped = book.meter.join(
        orders,
        "ariba_po_invoice: categories",
        lambda rows: rows.join(vendors, F.col("vendor_number") == F.col("vendor_id")).drop("vendor_id"),
    )
    return book.meter.join(
        scoped,
        "ariba_po_invoice: invoices",
        lambda rows: rows.join(invoices, F.col("po_order_id") == F.col("po_number"), "left"),
        "invoice_id",
    )


def _paid_by_vendor(start: Column) -> Column:
    return erp_date_between("h_document_date", start)


def _paid_by_document(start: Column) -> Column:
    return (F.col("d_clearing") != UNCLEARED) & (F.col("h_posting_date") > start)


def _payment_documents(ledger: DataFrame) -> DataFrame:
    return ledger.filter(
        F.col("h_document_type").isin(PAYMENT_DOCS) & (F.col("h_company_code") == COMPANY)
    )


def payment_lines(book) -> DataFrame:
    """Ledger lines that either branch of ``base_payment`` needs, by one scan."""
    start = months_before(book.today, 24)
    return _payment_documents(book.src.ledger).filter(
        (_paid_by_vendor(start) | _paid_by_document(start))
        # implied by the line above, but all of it can go to the scan; a whole branch repeated
        # here would be merged with the line above
        & (erp_text_from("h_document_date", start) | (F.col("h_posting_date") > start))
    ).select(
        *LINE_KEY,
        "h_document_date",
        "h_posting_date",
        "d_vendor",
        "d_gl_account",
        "d_amount_in_lc",
        "d_shkzg_debit_credit_ind",
        "d_clearing",
        "d_clrng_doc",
    )


def base_payment(book) -> DataFrame:
    """Signed payment amounts per vendor, payment date, account and clearing document."""
    start = months_before(book.today, 24)
    shape = [*payment_shape(), *LINE_KEY]
    also = _paid_by_vendor(start).alias(BY_VENDOR)
    stored = book.src.clustered("ledger", *LINE_KEY)
    if stored is not None:
        # joined by document where they lie; the few vendors in scope come to the other branch
        return payments_from(
            book,
            _payment_documents(book.src.ledger).filter(_paid_by_vendor(start)).select(*shape),
            _payment_documents(stored).filter(_paid_by_document(start)).select(*shape, also),
        )
    ledger = pin(payment_lines(book), "payment-lines")
    return payments_from(
        book,
        ledger.filter(_paid_by_vendor(start)).select(*shape),
        ledger.filter(_paid_by_document(start)).select(*shape, also),
    )


def payment_shape() -> list[Column]:
    """A payment line's own columns of the view."""
    sign = F.when(F.col("d_shkzg_debit_credit_ind") == "H", -F.col("d_amount_in_lc"))
    return [
        F.col("d_vendor"),
        erp_date("h_document_date").alias("payment_date"),
        F.col("d_gl_account"),
        sign.otherwise(F.col("d_amount_in_lc")).alias("amount"),
        erp_date("d_clearing").alias("payment_date_appears_in_vendor_account"),
        F.col("d_clrng_doc").alias("payment_clearing_doc"),
    ]


def payments_from(book, vendor_lines: DataFrame, document_lines: DataFrame) -> DataFrame:
    """The view from shaped lines of its two branches.

    Of a document line marked ``BY_VENDOR``, the vendor's own spend lines give what its branch
    by vendor gives anyway: these go before the rows are shuffled.
    """
    shaped = [
        F.coalesce("d_vendor", "vendor_id").alias("d_vendor"),
        F.col("supplier_name").alias("vendor_name"),
        F.col(L2),
        *[F.col(c) for c in (
            "payment_date", "d_gl_account", "amount",
            "payment_date_appears_in_vendor_account", "payment_clearing_doc",
        )],
    ]
    by_vendor = vendor_lines.join(
        scope_columns(book, "vendor_id", "supplier_name", L2),
        F.col("d_vendor") == F.col("vendor_id"),
    ).select(*shaped)
    found = document_lines.join(_spend_documents(book.src), _same_document())
    if BY_VENDOR in document_lines.columns:
        found = found.filter(~F.coalesce(F.col(BY_VENDOR) & _own_vendor(), F.lit(False)))
    by_document = found.select(*shaped)
    keys = [c for c in by_vendor.columns if c != "amount"]
    # Removing the blank vendor first is the same as removing it last and shuffles less.
    return (
        by_vendor.unionByName(by_document)
        .filter(F.col("d_vendor") != "")
        # dealt for the sums, which serves the distinct rows as well: one shuffle
        .repartition(*keys)
        .distinct()
        .groupBy(*keys)
        .agg(F.sum("amount").alias("payment_amount"))
    )


def invoice_lines(book) -> DataFrame:
    """Ledger lines that both branches of ``sap_invoices`` read, by one scan."""
    return _invoice_lines(book, book.src.ledger)


def _invoice_lines(book, ledger: DataFrame) -> DataFrame:
    ledger = ledger.filter(
        (F.col("h_company_code") == COMPANY)
        & F.col("h_document_type").isin(INVOICE_DOCS)
        & erp_date_between("h_document_date", months_before(book.today, 24))
    ).withColumn("system", invoice_origin(book.automation_users))
    return ledger.filter(F.col("system") != "").select(
        *LINE_KEY,
        "h_document_date",
        "h_docheader_text",
        "h_reference",
        "h_usnam_user_name",
        "d_vendor",
        "d_gl_account",
        "d_amount_in_lc",
        "d_clearing",
        "d_clrng_doc",
        "d_purchasing_doc",
        "system",
    )


def sap_invoices(book) -> DataFrame:
    """Distinct ledger invoice lines of the last 24 months with their origin system."""
    src = book.src
    stored = src.clustered("ledger", *LINE_KEY)
    if stored is None:
        vendor_side = document_side = pin(invoice_lines(book), "invoice-lines")
    else:
        vendor_side, document_side = invoice_lines(book), _invoice_lines(book, stored)

    def shaped(vendor: Column) -> list[Column]:
        return [
            vendor.alias("vendor"),
            F.col("supplier_name").alias("vendor_name"),
            F.col(L2),
            erp_date("h_document_date").alias("invoice_date"),
            F.col("h_docheader_text").alias("invoice_desc"),
            F.col("h_reference").alias("invoice_number"),
            F.col("h_usnam_user_name"),
            F.col("d_gl_account"),
            F.col("d_amount_in_lc").alias("invoice_amt"),
            F.col("d_clearing"),
            F.col("d_clrng_doc"),
            F.col("d_purchasing_doc"),
            F.col("system"),
        ]

    # the vendor's own spend lines give the rows of the branch by vendor once more
    by_document = (
        document_side.join(_spend_documents(src), _same_document())
        .filter(~F.coalesce(_own_vendor(), F.lit(False)))
        .select(*shaped(F.coalesce("d_vendor", "vendor_id")))
    )
    by_vendor = vendor_side.join(
        scope_columns(book, "vendor_id", "supplier_name", L2),
        F.col("d_vendor") == F.col("vendor_id"),
    ).select(*shaped(F.col("d_vendor")))
    return by_vendor.unionByName(by_document).distinct()


def _spend_documents(src) -> DataFrame:
    """In-scope spend lines by document. Not made distinct: both readers remove duplicates
    after the join, so doing it here would only shuffle the spend cube once more."""
    return in_scope_spend(src).select(
        "vendor_id",
        "supplier_name",
        F.col("category_l2").alias(L2),
        "invoice_document",
        "invoice_line_item",
    )


def _same_document() -> Column:
    return (F.col("h_document_number") == F.col("invoice_document")) & (
        F.col("d_buzei_line_item") == F.col("invoice_line_item")
    )


def _own_vendor() -> Column:
    """Whether a ledger line's vendor is that of its spend line, which is then in scope too."""
    return F.col("d_vendor") == F.col("vendor_id")


def sap_po(book) -> DataFrame:
    """Purchase orders of the last 24 months summed over their schedule lines."""
    lines = order_lines(
        book.src.po_schedule_line.filter(
            (F.col("purchasing_document_date") >= months_before(book.today, 24))
            & (F.col("purchasing_organization") == COMPANY)
        )
    )
    return orders_from(book, lines, "gross_order_value", "net_order_value")


def order_lines(lines: DataFrame, *more: str) -> DataFrame:
    """Distinct schedule lines."""
    return lines.select(
        "purchasing_document_number",
        "purchasing_document_item",
        F.col("vendor").alias("line_vendor"),
        "purchasing_document_date",
        "document_last_changed_on",
        "purchasing_item_short_text",
        "gross_order_value",
        "net_order_value",
        "document_currency",
        *more,
    ).distinct()


def order_sums(gross: str, net: str) -> list[Column]:
    return [
        F.max("document_last_changed_on").alias("document_last_changed_on"),
        F.max("purchasing_item_short_text").alias("purchasing_item_short_text"),
        F.sum(gross).alias("po_amount_gross"),
        F.sum(net).alias("po_amount_net"),
    ]


def orders_from(book, lines: DataFrame, gross: str, net: str) -> DataFrame:
    """The view from lines or from partial sums of them."""
    vendors = scope_columns(book, "vendor_id", "supplier_name", L2)
    return (
        lines.join(vendors, strip_zeros("line_vendor") == strip_zeros("vendor_id"))
        .groupBy(
            L2,
            "purchasing_document_number",
            F.col("vendor_id").alias("vendor"),
            F.col("supplier_name").alias("vendor_name"),
            "purchasing_document_date",
            "document_currency",
        )
        .agg(*order_sums(gross, net))
    )


def maximo_po(book) -> DataFrame:
    """Latest revision of each asset-system order, in the shape of ``sap_po``."""
    src = book.src
    orders = src.maximo_po.filter(
        (F.col("orderdate") >= months_before(book.local_today, 24))
        & F.col("isdeleted").isNull()
    )
    people = src.maximo_person.filter("isdeleted IS NULL AND valid_until IS NULL").select(
        "personid", "displayname"
    )
    companies = src.maximo_company.filter("isdeleted IS NULL").select(
        "company", F.col("name").alias("vendor_name")
    )
    vendors = scope_columns(book, "vendor_id", L2)
    joined = (
        orders.join(people, F.col("changeby") == F.col("personid"))
        .join(companies, F.col("vendor") == F.col("company"))
        .join(vendors, strip_zeros("vendor") == strip_zeros("vendor_id"))
    )
    latest = first_per_key(
        joined,
        ["ponum"],
        # the change date decides; the rest only makes ties repeatable
        [
            F.desc("changedate"),
            F.desc("revisionnum"),
            F.asc(L2),
            F.asc("displayname"),
            F.asc("description"),
        ],
    )
    return latest.select(
        L2,
        F.col("ponum").alias("purchasing_document_number"),
        "vendor",
        "vendor_name",
        F.col("orderdate").alias("purchasing_document_date"),
        F.col("changedate").alias("document_last_changed_on"),
        F.col("description").alias("purchasing_item_short_text"),
        F.lit(None).cast("string").alias("document_currency"),
        F.col("totalcost").alias("po_amount_net"),
        "status",
        F.col("totalcost").alias("po_amount_gross"),
    )


def vendor_profile(book) -> DataFrame:
    """Spend by vendor, country, categories, terms, purchasing system and fiscal year."""
    src = book.src
    terms = src.vendor_terms.select(
        F.col("payment_terms").alias("_terms"),
        F.col("payment_terms_desc").alias("payment_terms_description"),
    ).distinct()
    keys = [
        F.col("vendor_id").alias("supplier_id"),
        "supplier_name",
        "supplier_country",
        F.col("category_l1").alias("supplier_custom_category_l1"),
        F.col("category_l2").alias(L2),
        F.col("category_l3").alias("supplier_custom_category_l3"),
        "payment_terms",
        "purchasing_system",
        "fiscal_year",
        "company_code",
    ]
    # Spend is summed before the look-ups; the look-ups may fan out, so sum again after.
    spend = in_scope_spend(src).groupBy(*keys).agg(F.sum("amount").alias("_spend"))
    return (
        spend.join(
            src.dim_vendor.select(
                F.col("vendor").alias("_vendor"), F.col("country_description").alias("country")
            ),
            F.col("supplier_id") == F.col("_vendor"),
            "left",
        )
        .join(terms, F.col("payment_terms") == F.col("_terms"), "left")
        .groupBy(
            "supplier_id",
            "supplier_name",
            "country",
            F.when(F.col("supplier_country") == "AU", "Y")
            .otherwise("N")
            .alias("local_supplier_flag"),
            "supplier_custom_category_l1",
            L2,
            "supplier_custom_category_l3",
            "payment_terms",
            "payment_terms_description",
            "purchasing_system",
            "fiscal_year",
            "company_code",
        )
        .agg(F.sum("_spend").alias("supplier_spend"))
    )


APPROVER_COLUMNS = [f"approver_{i}" for i in range(1, 8)]


def ordered_requisitions(book) -> DataFrame:
    """(requisition, order) pairs of the orders in ``ariba_po_invoice``.

    A shared table: the approval plans look only at what these requisitions went through, so
    the rest of the approval history leaves before anything is ranked.
    """
    orders = book.table("ariba_po_invoice").select(F.col("po_number").alias("po_order_id"))
    return (
        book.src.ariba_po_line.select("req_requisition_id", "po_order_id")
        .join(orders.distinct(), "po_order_id", "left_semi")
        .select("req_requisition_id", "po_order_id")
        .distinct()
    )


def _approvals_of_orders(book) -> DataFrame:
    needed = book.table("ordered_requisitions").select(
        F.col("req_requisition_id").alias("approvable_id")
    )
    return book.src.approvals_raw.select("approvable_id", "real_user", "action_date").join(
        needed.distinct(), "approvable_id", "left_semi"
    )


def first_approvers(book) -> DataFrame:
    """The first seven approvers of each ordered requisition by action date, as columns."""
    return ranked_columns(
        _approvals_of_orders(book),
        "approvable_id",
        "real_user",
        [F.asc("action_date"), F.asc("real_user")],
        APPROVER_COLUMNS,
    )


def final_approver(book) -> DataFrame:
    """The last user who acted on each ordered requisition."""
    return first_per_key(
        _approvals_of_orders(book),
        ["approvable_id"],
        [F.desc("action_date"), F.asc("real_user")],
    ).select("approvable_id", F.col("real_user").alias("last_approver"))


def approvals_matrix(book) -> DataFrame:
    """Orders with the first seven approvers of their requisition.

    The approvers are brought to the orders' numbers and made distinct there, as one order may
    hang on several requisitions without approvals. Orders are shuffled once, by number, and
    what is joined to distinct orders needs no further pass.
    """
    po = (
        book.table("ariba_po_invoice")
        .select(
            "po_number",
            "po_date",
            "po_title",
            F.col("po_title").alias("po_description"),
            "vendor_number",
            "vendor_description",
            L2,
            "po_amount_invoiced",
            "po_spend",
            "po_status",
            "contract_id",
            "requestor",
            "approver",
            "cost_center",
        )
        .repartition("po_number")
        .distinct()
    )
    approvers = (
        book.table("ordered_requisitions")
        .join(
            book.table("first_approvers"),
            F.col("approvable_id") == F.col("req_requisition_id"),
            "left",
        )
        .drop("req_requisition_id")
        .repartition("po_order_id")
        .distinct()
    )
    return po.join(approvers, F.col("po_number") == F.col("po_order_id"), "left").drop(
        "po_order_id"
    )
