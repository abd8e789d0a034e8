"""Binds the sample star schema to the audit sources.

Every source is one SELECT over the sample tables or over sources defined above it, in SQL
that Spark and DuckDB both accept, so the same text feeds the Spark plans and the oracle.
Names in braces are input relations. The modulo cases vary the values so that every audit
rule meets rows on both sides of its test. Some relations leave rows out on purpose, so that
joins meet keys without a partner: payments (of every fifth part), bank accounts, contacts and
employees. One-time vendors are made from some orders only.
"""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditweave.book import AuditBook
from auditweave.functions.anchors import Anchors
from auditweave.sources.catalog import Sources
from auditweave.sources.schemas import LAYOUTS
from auditweave.sources.shelf import shelf_of

AS_OF = date(2001, 8, 1)
# Invented values of the run's parameters.
EXEMPT_VENDORS = ("0000000007", "0000000011")
AUTOMATION_USER = "ROBOT01"

# One-time vendors: each of these orders is billed by a vendor that exists only for it.
_ONE_TIME = """
SELECT o_orderkey, lpad(CAST(5000000+o_orderkey AS STRING),10,'0') AS vendor,
 CAST(o_orderdate AS DATE) AS ordered_date, CAST(floor(o_totalprice/100)*100 AS DECIMAL(18,2)) AS amount
FROM {orders} WHERE o_orderkey%500=7
"""

DEFINITIONS: dict[str, str] = {
    "one_time_vendor": _ONE_TIME,
    # one row per (order, supplier, part)
    "line_item": """
SELECT l_orderkey, l_suppkey, l_partkey, lpad(CAST(l_suppkey AS STRING),10,'0') AS vendor,
 CAST(l_orderkey AS STRING)||'-'||CAST(l_suppkey AS STRING) AS po_key,
 CAST(l_orderkey AS STRING)||'-'||CAST(l_suppkey AS STRING)||'-'||CAST(l_partkey AS STRING) AS line_key,
 min(CAST(o_orderdate AS DATE)) AS ordered_date, min(o_orderstatus) AS o_orderstatus, min(o_custkey) AS o_custkey,
 CAST(sum(floor(l_extendedprice/1000)*1000) AS DECIMAL(18,2)) AS po_spend
FROM {lineitem} JOIN {orders} ON l_orderkey=o_orderkey
GROUP BY l_orderkey, l_suppkey, l_partkey
""",
    "ariba_po_line": """
SELECT 'PO'||po_key AS po_order_id, 'PR'||CAST(l_orderkey AS STRING) AS req_requisition_id, ordered_date,
 'Order '||CAST(l_orderkey AS STRING) AS title, vendor AS supplier_erp_id,
 'Supplier#'||lpad(CAST(l_suppkey AS STRING),9,'0') AS supplier_erp_name,
 CASE WHEN l_partkey%10=0 THEN CAST(po_spend+500 AS DECIMAL(18,2)) WHEN l_partkey%10=9 THEN CAST(0 AS DECIMAL(18,2)) ELSE po_spend END AS sum_amount_invoiced,
 po_spend AS sum_po_spend,
 CASE o_orderstatus WHEN 'F' THEN 'Received' WHEN 'P' THEN 'Confirmed' ELSE 'Ordered' END AS po_status,
 'CW'||CAST(l_orderkey%5 AS STRING) AS contract_id, 'EMPLOYEE '||CAST(o_custkey AS STRING) AS requester_user,
 'EMPLOYEE '||CAST(o_custkey+13 AS STRING) AS requester_manager_l1,
 CASE WHEN l_partkey%7=6 THEN '000' WHEN l_partkey%7=5 THEN '' ELSE '00'||CAST(10+l_partkey%7 AS STRING) END AS cost_center_id,
 CASE WHEN l_suppkey%2=0 THEN 'N005' ELSE 'N030' END AS payment_terms
FROM {line_item}
""",
    "invoice_base": """
SELECT l_orderkey, l_suppkey, l_partkey, vendor, po_key, line_key, ordered_date, o_orderstatus, po_spend,
 ordered_date+CAST(l_partkey%60-5 AS INT) AS invoice_date,
 CASE WHEN l_partkey%10=0 THEN CAST(po_spend+500 AS DECIMAL(18,2)) ELSE po_spend END AS amount_invoiced,
 CAST(po_spend/10 AS DECIMAL(18,2)) AS tax_amount
FROM {line_item}
""",
    "ariba_invoice_line": """
SELECT CASE WHEN l_partkey%33=32 THEN 'Unclassified' ELSE 'PO'||po_key END AS order_id, ordered_date AS po_ordered_date,
 CASE o_orderstatus WHEN 'F' THEN 'Received' WHEN 'P' THEN 'Confirmed' ELSE 'Ordered' END AS po_status,
 'INV'||line_key AS invoice_id, invoice_date, 'part '||CAST(l_partkey AS STRING) AS description,
 CASE WHEN l_partkey%4=0 THEN 'Paying' ELSE 'Reconciled' END AS reconciliation_status,
 CASE WHEN l_partkey%3=0 THEN 'Approved' ELSE 'Paid' END AS invoice_status, 'CW'||CAST(l_orderkey%5 AS STRING) AS contract_id,
 amount_invoiced,
 CASE WHEN l_partkey%5=4 THEN NULL WHEN l_partkey%17=3 THEN tax_amount ELSE CAST(amount_invoiced+tax_amount AS DECIMAL(18,2)) END AS paid_amount, tax_amount
FROM {invoice_base}
""",
    "payment_base": """
SELECT l_orderkey, l_suppkey, l_partkey, vendor, po_key, line_key, 'CL'||po_key AS clearing_doc,
 invoice_date+CAST(CASE WHEN l_partkey%10=3 THEN 0 ELSE l_partkey%45 END AS INT) AS payment_date,
 CASE WHEN l_partkey%25=7 THEN CAST(amount_invoiced+1000 AS DECIMAL(18,2)) ELSE amount_invoiced END AS payment_amount
FROM {invoice_base} WHERE l_partkey%5<>4
""",
    "dim_vendor": """
SELECT lpad(CAST(s_suppkey AS STRING),10,'0') AS vendor, s_name AS vendor_description,
 CASE WHEN s_suppkey%13=5 THEN 'B' WHEN s_suppkey%13=6 THEN 'C' WHEN s_suppkey%13=7 THEN '' ELSE 'A' END AS vendor_status,
 ' '||CAST(10000000000+CASE WHEN s_suppkey%10 IN (0,1) THEN s_suppkey-s_suppkey%10 ELSE s_suppkey END AS STRING) AS tax_id,
 DATE '1995-01-01'+CAST(s_suppkey*37%2400 AS INT) AS date_first_created,
 DATE '2000-01-01'+CAST(s_suppkey%500 AS INT) AS date_last_changed,
 CASE WHEN s_suppkey%71=70 THEN NULL WHEN s_suppkey%9=5 THEN CAST(s_suppkey%90 AS STRING) ELSE CAST(1+s_suppkey%90 AS STRING) END AS building_number,
 CASE WHEN s_suppkey%9 IN (4,5) THEN 'Station '||substr(md5(CAST(s_suppkey-s_suppkey%90 AS STRING)),1,12) ELSE 'Market '||substr(md5(CAST(s_suppkey AS STRING)),1,12) END AS street,
 CASE WHEN s_suppkey%9 IN (4,5) THEN 'Central' ELSE n_name END AS city,
 CASE WHEN s_suppkey%9 IN (4,5) THEN '2000' ELSE lpad(CAST(n_nationkey AS STRING),4,'0') END AS postal_code,
 CASE WHEN s_suppkey%9 IN (4,5) THEN 'S1' WHEN s_suppkey%5=2 THEN '' ELSE 'S'||CAST(n_regionkey AS STRING) END AS state,
 CASE WHEN s_suppkey%3=0 THEN 'NZ' ELSE 'AU' END AS country,
 CASE WHEN s_suppkey%3=0 THEN 'New Zealand' ELSE 'Australia' END AS country_description,
 CASE WHEN s_suppkey%41=40 THEN NULL WHEN s_suppkey%15=0 THEN '' ELSE 'Contact '||CAST(CASE WHEN s_suppkey%6 IN (2,3) THEN s_suppkey-s_suppkey%6 ELSE s_suppkey END AS STRING) END AS financial_party_contact_name,
 'ap'||CAST(CASE WHEN s_suppkey%12 IN (5,9) THEN s_suppkey-s_suppkey%12 ELSE s_suppkey END AS STRING)||'@example.com' AS email_address,
 CASE WHEN s_suppkey%29=28 THEN 'N/A' ELSE '+61 2 '||CAST(CASE WHEN s_suppkey%13 IN (6,8) THEN s_suppkey-s_suppkey%13 ELSE s_suppkey+900000 END AS STRING) END AS telephone_number,
 CASE WHEN s_suppkey%19=18 THEN 'X' ELSE '' END AS marked_for_deletion_flag, CASE WHEN s_suppkey%23=22 THEN 'X' ELSE '' END AS non_trade_vendor_flag,
 'S'||CAST(s_suppkey AS STRING) AS search_term1, CASE WHEN s_suppkey%31=30 THEN '' ELSE 'GOODS' END AS search_term2, 'IND'||CAST(s_suppkey%4 AS STRING) AS industry,
 'AD'||CAST(s_suppkey AS STRING) AS address_number
FROM {supplier} JOIN {nation} ON s_nationkey=n_nationkey JOIN {region} ON n_regionkey=r_regionkey
UNION ALL
SELECT vendor, 'One-time '||vendor, 'A', CAST(30000000000+o_orderkey AS STRING), ordered_date, ordered_date, CAST(1+o_orderkey%90 AS STRING), 'Quay '||substr(md5(vendor),1,12), 'Harbour', '3000', 'S2',
 'AU', 'Australia', 'Clerk '||vendor, vendor||'@example.org', '+61 3 '||vendor, '', '', vendor, 'ONE', 'IND9', 'AD'||vendor
FROM {one_time_vendor}
""",
    "vendor_bank": """
SELECT lpad(CAST(s_suppkey AS STRING),10,'0') AS vendor, 'AU' AS bank_country_key, CASE WHEN s_suppkey%53=52 THEN NULL ELSE '062100' END AS bank_keys,
 CAST(700000+CASE WHEN s_suppkey%8 IN (4,5) THEN s_suppkey-s_suppkey%8 ELSE s_suppkey END AS STRING) AS bank_account_number, s_name AS account_holder_name
FROM {supplier} WHERE s_suppkey%9<>8
UNION ALL
SELECT lpad(CAST(s_suppkey AS STRING),10,'0'), 'NZ', '010200', CAST(800000+s_suppkey AS STRING), s_name FROM {supplier} WHERE s_suppkey%14=3
""",
    "spend_base": """
SELECT vendor AS vendor_id, s_name AS supplier_name, CASE WHEN s_suppkey%3=0 THEN 'NZ' ELSE 'AU' END AS supplier_country,
 CASE WHEN n_nationkey%11=10 THEN 'Non Addressable' ELSE 'Addressable '||CAST(n_regionkey AS STRING) END AS category_l1,
 CASE WHEN s_suppkey%17=3 AND l_partkey%2=0 THEN 'CAT-9' WHEN s_suppkey%37=36 THEN NULL ELSE 'CAT-'||CAST(n_nationkey%5 AS STRING) END AS category_l2,
 'SUB-'||CAST(n_nationkey%3 AS STRING) AS category_l3, CASE WHEN l_partkey%50=49 THEN '2000' ELSE '1000' END AS company_code,
 CAST(extract(year FROM ordered_date)+CASE WHEN extract(month FROM ordered_date)>=7 THEN 1 ELSE 0 END AS STRING) AS fiscal_year,
 'D'||line_key AS invoice_document, '001' AS invoice_line_item, 'PO'||po_key AS po_document, po_spend AS amount,
 CASE WHEN s_suppkey%43=42 THEN '' WHEN s_suppkey%2=0 THEN 'N005' ELSE 'N030' END AS payment_terms, CASE WHEN l_partkey%2=0 THEN 'Ariba' ELSE 'SAP' END AS purchasing_system
FROM {line_item} JOIN {supplier} ON l_suppkey=s_suppkey JOIN {nation} ON s_nationkey=n_nationkey
UNION ALL
SELECT vendor, 'One-time '||vendor, 'AU', 'Addressable 9', 'CAT-'||CAST(o_orderkey%5 AS STRING), 'SUB-9', '1000',
 CAST(extract(year FROM ordered_date)+CASE WHEN extract(month FROM ordered_date)>=7 THEN 1 ELSE 0 END AS STRING), 'T'||vendor, '001', 'PT'||vendor, amount, 'N030', 'SAP'
FROM {one_time_vendor}
""",
    "ledger": """
SELECT CASE WHEN l_partkey%50=49 THEN '2000' ELSE '1000' END AS h_company_code,
 CASE l_partkey%12 WHEN 0 THEN 'Y0' WHEN 1 THEN 'VN' WHEN 2 THEN 'RN' WHEN 3 THEN 'YM' WHEN 4 THEN 'VS' WHEN 5 THEN 'FI' WHEN 6 THEN 'FN' WHEN 7 THEN 'FR' WHEN 8 THEN 'ZF' WHEN 9 THEN 'PX' WHEN 10 THEN 'PY' ELSE 'KR' END AS h_document_type,
 'D'||line_key AS h_document_number, 'INV'||line_key AS h_reference,
 CASE WHEN l_partkey%24=1 THEN 'TPUE load' WHEN l_partkey%24=2 THEN 'Ariba_ASN feed' WHEN l_partkey%24=14 THEN 'CPTP capital' WHEN l_partkey%24=11 THEN 'tms freight' ELSE 'part '||CAST(l_partkey AS STRING) END AS h_docheader_text,
 CASE WHEN l_partkey%48=13 THEN 'ROBOT01' WHEN l_partkey%48=37 THEN 'WF_BATCH' ELSE 'USER'||CAST(l_partkey%4 AS STRING) END AS h_usnam_user_name,
 replace(CAST(invoice_date AS STRING),'-','') AS h_document_date, invoice_date+CAST(l_partkey%2 AS INT) AS h_posting_date,
 CASE WHEN l_partkey%20=3 THEN NULL WHEN l_partkey%20=13 THEN '' ELSE vendor END AS d_vendor, '21'||CAST(l_suppkey%10 AS STRING) AS d_gl_account, '001' AS d_buzei_line_item,
 'PO'||po_key AS d_purchasing_doc, '00'||CAST(10+l_partkey%7 AS STRING) AS d_cost_center, CASE WHEN l_partkey%5<>4 THEN 'CL'||po_key ELSE '' END AS d_clrng_doc, 'D'||line_key AS d_document_number,
 CASE WHEN l_partkey%29=3 THEN 'TMS run' ELSE 'goods' END AS d_item_text, CASE WHEN l_partkey%9=4 THEN 'A' WHEN l_partkey%9=5 THEN '' ELSE NULL END AS d_special_gl_ind,
 CASE WHEN l_partkey%6=5 THEN 'S' ELSE 'H' END AS d_shkzg_debit_credit_ind,
 CASE WHEN l_partkey%5<>4 THEN replace(CAST(invoice_date+CAST(l_partkey%45 AS INT) AS STRING),'-','') ELSE '00000000' END AS d_clearing,
 amount_invoiced AS d_amount, amount_invoiced AS d_amount_in_lc, po_spend AS d_gl_amount
FROM {invoice_base}
UNION ALL
SELECT CASE WHEN l_partkey%50=48 THEN '2000' ELSE '1000' END, 'ZP', CASE WHEN l_partkey%3=0 THEN 'D'||line_key ELSE 'Z'||line_key END, 'PAY'||line_key, 'payment run', 'USER9',
 replace(CAST(payment_date AS STRING),'-',''), payment_date, CASE WHEN l_partkey%40=6 THEN NULL WHEN l_partkey%40=7 THEN '' ELSE vendor END, '11'||CAST(l_suppkey%10 AS STRING), '001',
 '', '', clearing_doc, 'Z'||line_key, 'payment', '', CASE WHEN l_partkey%23=4 THEN 'H' ELSE 'S' END,
 CASE WHEN l_partkey%27=9 THEN '00000000' ELSE replace(CAST(payment_date+CAST(l_partkey%3 AS INT) AS STRING),'-','') END, payment_amount, payment_amount, payment_amount
FROM {payment_base}
UNION ALL
SELECT '1000', 'ZP', 'T'||vendor, 'PAY'||vendor, 'payment run', 'USER9', replace(CAST(ordered_date AS STRING),'-',''), ordered_date, vendor, '119', '001',
 '', '', 'CT'||vendor, 'T'||vendor, 'payment', '', 'S', replace(CAST(ordered_date AS STRING),'-',''), amount, amount, amount
FROM {one_time_vendor}
""",
    "po_schedule_line": """
SELECT 'PO'||po_key AS purchasing_document_number, lpad(CAST(l_partkey AS STRING),5,'0') AS purchasing_document_item,
 CASE WHEN l_partkey%4=1 THEN CAST(l_suppkey AS STRING) ELSE vendor END AS vendor, ordered_date AS purchasing_document_date,
 ordered_date+CAST(l_partkey%30 AS INT) AS document_last_changed_on, 'item '||CAST(l_partkey AS STRING) AS purchasing_item_short_text,
 po_spend AS gross_order_value, CASE WHEN l_partkey%7=0 THEN CAST(po_spend-100 AS DECIMAL(18,2)) ELSE po_spend END AS net_order_value,
 CASE WHEN l_suppkey%3=0 THEN 'NZD' ELSE 'AUD' END AS document_currency, CASE WHEN l_partkey%40=39 THEN '2000' ELSE '1000' END AS purchasing_organization
FROM {line_item}
""",
    "approval_event": """
SELECT 'PR'||CAST(o_orderkey AS STRING) AS approvable_id, 'EMPLOYEE '||CAST(o_custkey+k*13 AS STRING) AS real_user,
 'EMPLOYEE '||CAST(o_custkey+k*13+CASE WHEN o_orderkey%6=0 THEN 1 ELSE 0 END AS STRING) AS approver, CAST(o_orderdate AS DATE) AS ordered_date, o_orderkey, o_custkey, k
FROM {orders} JOIN (SELECT * FROM (VALUES (1,0),(2,1),(3,2),(4,3),(5,4),(6,5),(7,6),(8,7)) AS r(k,need)) AS steps ON need<=o_orderkey%8
""",
    "approvals_curated": """
SELECT approvable_id, CASE WHEN o_orderkey%21=20 THEN '' WHEN o_orderkey%22=21 THEN NULL ELSE real_user END AS real_user, approver,
 CAST(ordered_date+CAST(k AS INT) AS TIMESTAMP) AS action_date, CASE WHEN o_orderkey%16=15 AND k=8 THEN 'Denied' ELSE 'Approved' END AS approver_state
FROM {approval_event}
""",
    "approvals_raw": """
SELECT approvable_id, real_user, approver, CAST(ordered_date+CAST(k AS INT) AS TIMESTAMP) AS action_date,
 CASE WHEN o_orderkey%9=4 AND k=2 THEN 'Unclassified' ELSE real_user END AS approved_by_user, 'rule '||CAST(k AS STRING) AS approver_reason,
 CAST(ordered_date+CAST(k-1 AS INT) AS TIMESTAMP) AS assigned_date, 'EMPLOYEE '||CAST(o_custkey AS STRING) AS requester_user,
 CASE WHEN o_orderkey%9=4 AND k=2 THEN 'ADMIN' ELSE '' END AS approver_deleted_by
FROM {approval_event}
UNION ALL
SELECT approvable_id, real_user, approver, CAST(ordered_date+CAST(k+1 AS INT) AS TIMESTAMP), 'Unclassified', 'rule 2',
 CAST(ordered_date+CAST(k-1 AS INT) AS TIMESTAMP), 'EMPLOYEE '||CAST(o_custkey AS STRING), 'ADMIN'
FROM {approval_event} WHERE o_orderkey%9=4 AND k=2 AND o_orderkey%2=0
""",
    "doa": """
SELECT CASE WHEN c_custkey%10=9 THEN ' Employee '||CAST(c_custkey AS STRING)||' ' WHEN c_custkey%25=24 THEN 'Employee '||CAST(c_custkey-1 AS STRING) ELSE 'Employee '||CAST(c_custkey AS STRING) END AS employee_name,
 CAST(10000*(1+c_custkey%20) AS DOUBLE) AS annual_limit
FROM {customer}
""",
    "payroll_bank": """
SELECT CAST(c_custkey AS STRING) AS employee_id, '062100' AS bank_number, CAST(CASE WHEN c_custkey%10=2 THEN 700000+c_custkey ELSE 900000+c_custkey END AS STRING) AS bank_account_number
FROM {customer}
""",
    "employee": """
SELECT CAST(c_custkey AS STRING) AS employee_id, 'First'||CAST(c_custkey AS STRING) AS first_name, c_name AS last_name, DATE '1994-01-01'+CAST(c_custkey%900 AS INT) AS first_day_at_work,
 CASE WHEN c_custkey%4=0 THEN 'Terminated' ELSE 'Active' END AS employment_status, 'Permanent' AS employee_type, c_mktsegment AS job_title
FROM {customer} WHERE c_custkey%30<>22
""",
    "holiday": """
SELECT DISTINCT 'Day '||CAST(extract(month FROM o_orderdate) AS STRING)||'/'||CAST(extract(day FROM o_orderdate) AS STRING) AS event_name,
 CASE WHEN extract(month FROM o_orderdate)=12 AND extract(day FROM o_orderdate) IN (25,26) THEN 'Public Holiday' WHEN extract(month FROM o_orderdate)=1 AND extract(day FROM o_orderdate) IN (1,26) THEN 'Public Holiday' ELSE 'Trading Day' END AS event_type,
 CAST(o_orderdate AS DATE) AS event_start_date
FROM {orders}
""",
    "dim_date": """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS calendar_day, CAST(extract(year FROM o_orderdate)+CASE WHEN extract(month FROM o_orderdate)>=7 THEN 1 ELSE 0 END AS BIGINT) AS fiscal_year
FROM {orders}
""",
    "vendor_terms": """
SELECT lpad(CAST(s_suppkey AS STRING),10,'0') AS vendor, CASE WHEN s_suppkey%2=0 THEN 'N005' ELSE 'N030' END AS payment_terms,
 CASE WHEN s_suppkey%2=0 THEN 'Within 5 days' ELSE 'Within 30 days' END AS payment_terms_desc
FROM {supplier}
""",
    "vendor_contact": """
SELECT lpad(CAST(s_suppkey AS STRING),10,'0') AS vendor, 'Z1' AS function_id, 'Ann' AS first_name, s_name AS last_name, '02' AS telephone, '03' AS fax, CASE WHEN s_suppkey%16=9 THEN '' ELSE 'z1@example.com' END AS email
FROM {supplier} WHERE s_suppkey%11<>3
UNION ALL
SELECT lpad(CAST(s_suppkey AS STRING),10,'0'), 'Z3', 'Bob', s_name, '04', CASE WHEN s_suppkey%8=6 THEN NULL ELSE '05' END, 'z3@example.com'
FROM {supplier} WHERE s_suppkey%7<>2
""",
    "vendor_purch_org": """
SELECT lpad(CAST(s_suppkey AS STRING),10,'0') AS vendor, 'AUD' AS order_currency, CASE WHEN s_suppkey%25=12 THEN '' ELSE 'N' END AS minority_indicator, 'FOB' AS incoterms2, 'ZV' AS schema_group_vendor
FROM {supplier}
""",
    "vendor_company_code": """
SELECT lpad(CAST(s_suppkey AS STRING),10,'0') AS vendor, '1' AS periodic_acc_stat_ind, 'clerk' AS vendor_clerk, '02' AS accounting_clerk_telephone, 'ap@example.com' AS partner_comp_clerk_internet, CASE WHEN s_suppkey%27=13 THEN NULL ELSE 'T' END AS payment_method_supp
FROM {supplier}
""",
    "business_address": """
SELECT 'AD'||CAST(s_suppkey AS STRING) AS address_number, 'INT' AS communication_method FROM {supplier}
""",
    "terms_of_payment": """
SELECT DISTINCT CASE WHEN s_suppkey%2=0 THEN 'N005' ELSE 'N030' END AS terms_of_payment_key FROM {supplier}
""",
    "maximo_po": """
SELECT 'MX'||line_key AS ponum, 'work '||CAST(l_partkey AS STRING) AS description, 'STD' AS potype,
 CASE WHEN l_partkey%3=0 THEN 'APPR' ELSE 'CLOSE' END AS status, 'N' AS historyflag, vendor, 'CT'||CAST(l_suppkey AS STRING) AS contractrefid,
 'P'||CAST(o_custkey AS STRING) AS changeby, '' AS revcomments, CAST(ordered_date AS TIMESTAMP) AS orderdate,
 CAST(ordered_date+CAST(rev AS INT) AS TIMESTAMP) AS statusdate, CAST(ordered_date+CAST(rev*2 AS INT) AS TIMESTAMP) AS changedate, CAST(rev AS INT) AS revisionnum,
 CASE WHEN rev=0 THEN CAST(po_spend+100 AS DECIMAL(18,2)) ELSE po_spend END AS totalcost, CAST(po_spend/10 AS DECIMAL(18,2)) AS totaltax1, CASE WHEN l_partkey%45=44 THEN 'Y' ELSE NULL END AS isdeleted
FROM {line_item} JOIN (SELECT * FROM (VALUES (0),(1)) AS r(rev)) AS revs ON rev<=l_partkey%2
""",
    "maximo_person": """
SELECT 'P'||CAST(c_custkey AS STRING) AS personid, c_name AS displayname, CASE WHEN c_custkey%37=36 THEN 'Y' ELSE NULL END AS isdeleted, CAST(NULL AS TIMESTAMP) AS valid_until
FROM {customer}
UNION ALL
SELECT 'P'||CAST(c_custkey AS STRING), c_name||' (old)', NULL, CAST(DATE '1999-12-31' AS TIMESTAMP) FROM {customer}
""",
    "maximo_company": """
SELECT lpad(CAST(s_suppkey AS STRING),10,'0') AS company, s_name AS name, CASE WHEN s_suppkey%47=46 THEN 'Y' ELSE NULL END AS isdeleted FROM {supplier}
""",
}

# Relations that shape the rows of a written one are not written again: their readers take the
# columns and rows that they need from it, as from a view. The ledger, which most plans read, is
# written. A sample table is one file, hence one task, so what is derived from it row by row is
# spread over more: its input is, which has fewer and shorter rows.
INLINE = {
    "invoice_base",
    "payment_base",
    "one_time_vendor",
    "ariba_po_line",
    "ariba_invoice_line",
    "spend_base",
    "po_schedule_line",
    "approvals_curated",
    "approvals_raw",
}
SPREAD = {"approval_event"}
# Columns of a written relation that its other columns spell out: unique texts, which are most of
# its bytes. They are not written but made again where they are read.
SPELLED = {
    "line_item": {
        "vendor": "lpad(CAST(l_suppkey AS STRING),10,'0')",
        "po_key": "CAST(l_orderkey AS STRING)||'-'||CAST(l_suppkey AS STRING)",
        "line_key": "CAST(l_orderkey AS STRING)||'-'||CAST(l_suppkey AS STRING)||'-'||CAST(l_partkey AS STRING)",
    },
}

_INPUT = re.compile(r"{(\w+)}")


def inputs_of(name: str) -> list[str]:
    return list(dict.fromkeys(_INPUT.findall(DEFINITIONS[name])))


def bind(spark: SparkSession, sf_dir: str) -> Sources:
    """Sources over the sample tables in ``sf_dir``.

    What takes a join or a sum to derive is written on first use, once per application, so that
    the audit plans read it the way they would read an extract: as a stored table. The rest are
    views of that.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    shelf = shelf_of(spark)

    def relation(name: str) -> DataFrame:
        if name not in DEFINITIONS:
            return spark.read.parquet(f"{sf_dir}/{name}.parquet")
        if name in INLINE:
            return derive(name)
        if name not in SPELLED:
            return shelf.keep((sf_dir, name), lambda: derive(name))
        texts = SPELLED[name]
        kept = shelf.keep((sf_dir, name), lambda: derive(name).drop(*texts))
        return kept.withColumns({column: F.expr(text) for column, text in texts.items()})

    def derive(name: str) -> DataFrame:
        inputs = {dep: relation(dep) for dep in inputs_of(name)}
        if name in SPREAD:
            tasks = spark.sparkContext.defaultParallelism
            inputs = {dep: df.repartition(tasks) for dep, df in inputs.items()}
        return spark.sql(DEFINITIONS[name], **inputs)

    return Sources({name: (lambda name=name: relation(name)) for name in LAYOUTS})


def open_book(spark: SparkSession, sf_dir: str) -> AuditBook:
    """The audit book of the sample tables, as of the day they end."""
    return AuditBook(
        bind(spark, sf_dir),
        Anchors.fixed(AS_OF),
        tag=sf_dir,
        exempt_vendors=EXEMPT_VENDORS,
        automation_users=(AUTOMATION_USER,),
    )
