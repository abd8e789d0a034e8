"""Column layout of the source extracts the audit plans read.

Each layout is a DDL string. Money has up to nine places; sums of it keep them all, as they
need no more than 38 digits. Identifiers stay strings: vendor ids carry significant leading
zeros.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

MONEY = "DECIMAL(27,9)"

LAYOUTS: dict[str, str] = {
    # spend cube: which vendors are in scope, and under which category
    "spend_base": f"""vendor_id STRING, supplier_name STRING, supplier_country STRING,
        category_l1 STRING, category_l2 STRING, category_l3 STRING, company_code STRING,
        fiscal_year STRING, invoice_document STRING, invoice_line_item STRING,
        po_document STRING, amount {MONEY}, payment_terms STRING, purchasing_system STRING""",
    # procurement suite
    "ariba_po_line": f"""po_order_id STRING, req_requisition_id STRING, ordered_date DATE,
        title STRING, supplier_erp_id STRING, supplier_erp_name STRING,
        sum_amount_invoiced {MONEY}, sum_po_spend {MONEY}, po_status STRING,
        contract_id STRING, requester_user STRING, requester_manager_l1 STRING,
        cost_center_id STRING, payment_terms STRING""",
    "ariba_invoice_line": f"""order_id STRING, po_ordered_date DATE, po_status STRING,
        invoice_id STRING, invoice_date DATE, description STRING,
        reconciliation_status STRING, invoice_status STRING, contract_id STRING,
        amount_invoiced {MONEY}, paid_amount {MONEY}, tax_amount {MONEY}""",
    "approvals_curated": """approvable_id STRING, real_user STRING, approver STRING,
        action_date TIMESTAMP_NTZ, approver_state STRING""",
    "approvals_raw": """approvable_id STRING, real_user STRING, approver STRING,
        action_date TIMESTAMP_NTZ, approved_by_user STRING, approver_reason STRING,
        assigned_date TIMESTAMP_NTZ, requester_user STRING, approver_deleted_by STRING""",
    # finance system
    "dim_vendor": """vendor STRING, vendor_description STRING, vendor_status STRING,
        tax_id STRING, date_first_created DATE, date_last_changed DATE,
        building_number STRING, street STRING, city STRING, postal_code STRING,
        state STRING, country STRING, country_description STRING,
        financial_party_contact_name STRING, email_address STRING,
        telephone_number STRING, marked_for_deletion_flag STRING,
        non_trade_vendor_flag STRING, search_term1 STRING, search_term2 STRING,
        industry STRING, address_number STRING""",
    "vendor_bank": """vendor STRING, bank_country_key STRING, bank_keys STRING,
        bank_account_number STRING, account_holder_name STRING""",
    "ledger": f"""h_company_code STRING, h_document_type STRING, h_document_number STRING,
        h_reference STRING, h_docheader_text STRING, h_usnam_user_name STRING,
        h_document_date STRING, h_posting_date DATE, d_vendor STRING,
        d_gl_account STRING, d_buzei_line_item STRING, d_purchasing_doc STRING,
        d_cost_center STRING, d_clrng_doc STRING, d_document_number STRING,
        d_item_text STRING, d_special_gl_ind STRING, d_shkzg_debit_credit_ind STRING,
        d_clearing STRING, d_amount {MONEY}, d_amount_in_lc {MONEY}, d_gl_amount {MONEY}""",
    "po_schedule_line": f"""purchasing_document_number STRING,
        purchasing_document_item STRING, vendor STRING, purchasing_document_date DATE,
        document_last_changed_on DATE, purchasing_item_short_text STRING,
        gross_order_value {MONEY}, net_order_value {MONEY}, document_currency STRING,
        purchasing_organization STRING""",
    "vendor_terms": "vendor STRING, payment_terms STRING, payment_terms_desc STRING",
    "vendor_contact": """vendor STRING, function_id STRING, first_name STRING,
        last_name STRING, telephone STRING, fax STRING, email STRING""",
    "vendor_purch_org": """vendor STRING, order_currency STRING,
        minority_indicator STRING, incoterms2 STRING, schema_group_vendor STRING""",
    "vendor_company_code": """vendor STRING, periodic_acc_stat_ind STRING,
        vendor_clerk STRING, accounting_clerk_telephone STRING,
        partner_comp_clerk_internet STRING, payment_method_supp STRING""",
    "business_address": "address_number STRING, communication_method STRING",
    "terms_of_payment": "terms_of_payment_key STRING",
    # people
    "doa": "employee_name STRING, annual_limit DOUBLE",
    "payroll_bank": "employee_id STRING, bank_number STRING, bank_account_number STRING",
    "employee": """employee_id STRING, first_name STRING, last_name STRING,
        first_day_at_work DATE, employment_status STRING, employee_type STRING,
        job_title STRING""",
    # calendar
    "holiday": "event_name STRING, event_type STRING, event_start_date DATE",
    "dim_date": "calendar_day DATE, fiscal_year BIGINT",
    # asset-management system
    "maximo_po": f"""ponum STRING, description STRING, potype STRING, status STRING,
        historyflag STRING, vendor STRING, contractrefid STRING, changeby STRING,
        revcomments STRING, orderdate TIMESTAMP_NTZ, statusdate TIMESTAMP_NTZ,
        changedate TIMESTAMP_NTZ, revisionnum INT, totalcost {MONEY}, totaltax1 {MONEY},
        isdeleted STRING""",
    "maximo_person": """personid STRING, displayname STRING, isdeleted STRING,
        valid_until TIMESTAMP_NTZ""",
    "maximo_company": "company STRING, name STRING, isdeleted STRING",
}


def schema_of(name: str) -> StructType:
    """The layout of one source as a StructType (needs an active session)."""
    return StructType.fromDDL(LAYOUTS[name])
