"""Statements of the plans that go beyond the audit rules."""

from __future__ import annotations

from oracle.fragments import MONTHS_12, MONTHS_24, TODAY

DAYS_90 = "DATE '2001-05-03'"

#: control: vendor, entity, day and amount of its report.
_HITS = """
ariba_dupe_po                      vendor_number         po_number                     po_date                          po_spend
sap_duplicate_po                   vendor_number         po_number                     po_date                          po_spend
maximo_duplicate_po                vendor_number         po_number                     po_date                          po_spend
ariba_open_po                      vendor_number         po_number                     po_date                          po_spend
ariba_deleted_user                 vendor_number         po_number                     po_date                          po_spend
approvals_exceeding_doa            vendor_number         po_number                     po_date                          po_spend
ariba_split_po                     vendor_number         po_number                     po_date                          po_individual_amount
sap_split_po                       vendor_number         po_number                     po_date                          po_individual_amount
ariba_dupe_invoices                erp_supplier_id       invoice_id                    invoice_date                     invoice_amt_paid
sap_dupe_invoices                  erp_supplier_id       invoice_id                    invoice_date                     invoice_amt_paid
ariba_payments_without_approved_po erp_supplier_id       invoice_id                    invoice_date                     invoice_amt_paid
ariba_invoices_before_po           erp_supplier_id       invoice_id                    invoice_date                     invoice_amt
sap_invoices_before_po             erp_supplier_id       invoice_id                    invoice_date                     invoice_amt
ariba_invoices_not_matching_po     erp_supplier_id       invoice_id                    invoice_date                     invoice_amt
sap_invoices_not_matching_po       erp_supplier_id       invoice_id                    invoice_date                     invoice_amt
ariba_split_invoice                vendor                invoice_id                    invoice_date                     invoice_amount_ex_tax
sap_split_invoice                  vendor                invoice_id                    invoice_date                     invoice_amount_ex_tax
invoice_close_to_doa               vendor_number         invoice_id                    invoice_date                     invoice_amount
multiple_payments_same_day         vendor                payment_clearing_doc          payment_date                     payment_amount
repeat_payments_same_amount        vendor                payment_clearing_doc          payment_date                     payment_amount
payments_weekend_holiday           vendor                payment_clearing_doc          payment_date                     payment_amount
payments_to_blocked_vendors        d_vendor              payment_clearing_doc          payment_date                     payment_amount
payments_within_1_day              vendor                invoice_number                payment_date                     payment_amount
same_invoice_payment_date          vendor                invoice_number                invoice_date                     invoice_amt
payment_vs_invoice_amount          d_vendor              invoice_number                invoice_date                     invoice_amt
one_time_vendor_payment            supplier_id           supplier_id                   payment_date                     payment_amount
payment_soon_after_creation        supplier_id           supplier_id                   payment_date                     NULL
vendor_employee_same_bank          supplier_id           employee_id                   supplier_creation_date           amount
vendor_employee_same_address       supplier_id           employee_id                   supplier_creation_date           amount
payments_shared_bank               supplier_id           employee_id                   payment_date                     payment_amount
dupe_vendors                       supplier_id           supplier_id                   supplier_creation_date           NULL
approved_vs_blocked                approved_supplier_id  blocked_supplier_id           approved_vendor_creation_date    NULL
blocked_reonboarded                approved_supplier_id  blocked_supplier_id           approved_supplier_creation_date  NULL
same_financial_contact             supplier_id           financial_party_contact_name  supplier_creation_date           NULL
vendors_no_bank                    supplier_id           supplier_id                   supplier_creation_date           NULL
local_vendors_incomplete           supplier_id           supplier_id                   supplier_creation_date           NULL
international_vendors_incomplete   supplier_id           supplier_id                   supplier_creation_date           NULL
"""


def _hit(line: str) -> str:
    control, vendor, entity, day, amount = line.split()
    return (
        f"SELECT CAST({vendor} AS VARCHAR) AS vendor_number, CAST({entity} AS VARCHAR) AS entity, "
        f"CAST({day} AS DATE) AS day, CAST({amount} AS DECIMAL(38,9)) AS amount, "
        f"'{control}' AS control FROM {{{control}}}"
    )


_SUMS = f"""count(*) AS hits,
 count(*) FILTER (day BETWEEN {DAYS_90} AND {TODAY}) AS hits_last_90_days,
 count(*) FILTER (day BETWEEN {MONTHS_12} AND {TODAY}) AS hits_last_year,
 sum(amount) AS amount, min(day) AS first_day, max(day) AS last_day"""
_FEATURES = ", ".join(
    f"'{m}_{w}': " + (f"CAST({m}_{w} AS VARCHAR)" if m.startswith("total") else f"{m}_{w}")
    for m in (
        "total_po_spend", "po_count", "total_invoice_spend", "total_payment_amount",
        "invoice_count", "paid_invoice_count", "vendor_active_months",
    )
    for w in ("3m", "6m", "12m", "24m")
)

_NO = ", ".join(
    f"CAST(NULL AS {kind}) AS {name}"
    for kind, names in (
        (
            "VARCHAR",
            "requisition_id po_status approver_last requestor invoice_status reconciliation_status contract_id"
            " payment_terms cost_centre approved_by_user nominated_approver",
        ),
        ("DATE", "approval_date po_last_modified_date"),
        ("BOOLEAN", "acted_on_behalf_of"),
        ("BIGINT", "po_line_item_count invoiced_line_item_count"),
        (
            "DOUBLE",
            "approver_doa_annual_limit total_po_spend_line_level total_invoiced_line_level po_to_doa_ratio",
        ),
        ("DECIMAL(38,9)", "tax_amount"),
    )
    for name in names.split()
)

EXTENSIONS: dict[str, str] = {
    "cleared_payment": f"""
SELECT d_vendor AS vendor_number, d_clrng_doc AS clearing_doc, sum(CASE WHEN d_shkzg_debit_credit_ind='H' THEN -d_amount_in_lc ELSE d_amount_in_lc END) AS paid,
 max(CAST(try_strptime(h_document_date,'%Y%m%d') AS DATE)) AS payment_date
FROM {{ledger}} WHERE h_document_type='ZP' AND h_company_code='1000' AND CAST(try_strptime(h_document_date,'%Y%m%d') AS DATE)>={MONTHS_24} AND d_clrng_doc<>'' AND d_vendor IN (SELECT vendor_id FROM {{scope_l2}}) GROUP BY 1,2""",
    "cleared_invoice": """
SELECT d_vendor AS vendor_number, d_clrng_doc AS clearing_doc, d_purchasing_doc AS po_number, h_reference AS invoice_id, invoice_date, CAST(sum(d_amount_in_lc) AS DECIMAL(38,9)) AS amount, min(d_gl_account) AS low_account, max(d_gl_account) AS high_account
FROM {origin_ledger} WHERE system IS NOT NULL AND d_vendor IN (SELECT vendor_id FROM {scope_l2}) GROUP BY 1,2,3,4,5""",
    # each invoice's part in whole cents; the first of a document takes the rest
    "cleared_part": """
SELECT *, CASE WHEN place=1 THEN paid-coalesce(sum(part) OVER (PARTITION BY vendor_number, clearing_doc),0)+part ELSE part END AS share
FROM (SELECT i.*, p.paid, p.payment_date, row_number() OVER doc AS place,
  CASE WHEN p.paid IS NOT NULL THEN CASE WHEN sum(amount) OVER whole=0 THEN 0 ELSE CAST(floor(CAST(p.paid AS DOUBLE)*CAST(amount AS DOUBLE)/CAST(sum(amount) OVER whole AS DOUBLE)*100) AS DECIMAL(36,2))/100 END::DECIMAL(38,9) END AS part
 FROM {cleared_invoice} i LEFT JOIN {cleared_payment} p USING (vendor_number, clearing_doc)
 WINDOW whole AS (PARTITION BY vendor_number, clearing_doc), doc AS (PARTITION BY vendor_number, clearing_doc ORDER BY amount DESC, po_number NULLS FIRST, invoice_id NULLS FIRST, invoice_date NULLS FIRST))""",
    "sap_transaction": f"""
SELECT *, coalesce(po_number,'NULL')||'|'||coalesce(invoice_id,'NULL')||'|SAP' AS transaction_id, 'SAP' AS system, payment_amount AS amount_paid_excl_tax,
 CASE WHEN invoice_amount_excl_tax<>0 THEN CAST(po_spend AS DOUBLE)/CAST(invoice_amount_excl_tax AS DOUBLE) END AS po_to_invoice_ratio,
 CASE WHEN payment_amount<>0 THEN CAST(po_spend AS DOUBLE)/CAST(payment_amount AS DOUBLE) END AS po_to_payment_ratio,
 date_diff('day', po_date, invoice_date) AS po_to_invoice_days, {_NO}
FROM (SELECT vendor_number, po_number, invoice_id, invoice_date, CAST(sum(amount) AS DECIMAL(38,9)) AS invoice_amount_excl_tax, CAST(sum(share) AS DECIMAL(38,9)) AS payment_amount, max(payment_date) AS payment_date,
  CASE WHEN min(low_account)=max(high_account) THEN min(low_account) END AS gl_account FROM {{cleared_part}} GROUP BY 1,2,3,4)
LEFT JOIN (SELECT purchasing_document_number AS po_number, CAST(sum(net_order_value) AS DECIMAL(38,9)) AS po_spend, CAST(min(purchasing_document_date) AS DATE) AS po_date
 FROM (SELECT DISTINCT * EXCLUDE (purchasing_organization) FROM {{po_schedule_line}} WHERE purchasing_document_date>={MONTHS_24} AND purchasing_organization='1000') GROUP BY 1) USING (po_number)""",
    "base_payment_rolling": "SELECT * FROM {base_payment}",
    "sap_po_rolling": "SELECT * FROM {sap_po}",
    "vendor_windowed_features_monthly": "SELECT * FROM {vendor_windowed_features}",
    "control_hits": "\nUNION ALL ".join(_hit(line) for line in _HITS.split("\n") if line),
    "vendor_control_summary": " UNION ALL ".join(
        f"SELECT '{level}' AS level, {vendor} AS vendor_number, {control} AS control, {_SUMS},\n"
        # a pair counts once for each control it is in
        " count(DISTINCT (control, vendor_number, entity)) FILTER (entity IS NOT NULL) AS entities,"
        " count(DISTINCT vendor_number) AS vendors, count(DISTINCT control) AS controls"
        f" FROM {{control_hits}} GROUP BY {by}\n"
        for level, vendor, control, by in (
            ("vendor and control", "vendor_number", "control", "vendor_number, control"),
            ("vendor", "vendor_number", "NULL", "vendor_number"),
            ("control", "NULL", "control", "control"),
            ("all", "NULL", "NULL", "()"),
        )
    ),
    "hit_entity": f"""
SELECT vendor_number, control, entity, count(*) AS hits, sum(amount) AS amount, max(day) AS last_day,
 row_number() OVER (PARTITION BY vendor_number, control ORDER BY sum(amount) DESC NULLS LAST, max(day) DESC NULLS LAST, entity NULLS LAST) AS place
FROM {{control_hits}} WHERE vendor_number IS NOT NULL GROUP BY 1,2,3""",
    "hit_shown": """
SELECT vendor_number, control, list({'place': place, 'entity': entity, 'hits': hits, 'amount': CAST(amount AS VARCHAR), 'last_day': last_day} ORDER BY place) AS evidence
FROM {hit_entity} WHERE place<=5 GROUP BY 1,2""",
    "hit_cell": f"""
SELECT vendor_number, control, {_SUMS}, count(DISTINCT entity) AS entities
FROM {{control_hits}} WHERE vendor_number IS NOT NULL GROUP BY 1,2""",
    "hit_master": """
SELECT vendor_number, max(vendor_name) AS vendor_name, max(country) AS supplier_country, coalesce(list(DISTINCT supplier_category_l2 ORDER BY supplier_category_l2) FILTER (supplier_category_l2 IS NOT NULL), []) AS categories
FROM {vendor_attributes} GROUP BY 1""",
    # nested columns compare as text
    "case_brief_inputs": """
SELECT * REPLACE (CAST(to_json(categories) AS VARCHAR) AS categories, CASE WHEN features IS NOT NULL THEN CAST(to_json(features) AS VARCHAR) END AS features, CAST(to_json(findings) AS VARCHAR) AS findings)
FROM {brief}""",
    "brief": f"""
SELECT c.vendor_number, any_value(vendor_name) AS vendor_name, any_value(supplier_country) AS supplier_country, any_value(categories) AS categories,
 count(*) AS controls, CAST(sum(hits) AS BIGINT) AS hits, CAST(sum(hits_last_90_days) AS BIGINT) AS hits_last_90_days, CAST(sum(hits_last_year) AS BIGINT) AS hits_last_year,
 sum(amount) AS amount, min(first_day) AS first_day, max(last_day) AS last_day, any_value(features) AS features,
 list({{'control': control, 'hits': hits, 'entities': entities, 'amount': CAST(amount AS VARCHAR), 'first_day': first_day, 'last_day': last_day, 'evidence': evidence}} ORDER BY control) AS findings
FROM {{hit_cell}} c JOIN {{hit_shown}} USING (vendor_number, control) LEFT JOIN {{hit_master}} USING (vendor_number)
LEFT JOIN (SELECT vendor_number, {{{_FEATURES}}} AS features FROM {{vendor_windowed_features}}) USING (vendor_number)
GROUP BY 1""",
}
