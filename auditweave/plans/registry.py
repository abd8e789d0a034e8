"""Every plan by name, in an order in which each one's inputs come first."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from auditweave.plans import conformed, finance_transactions, findings, monthly_features, readings, rolling, scope, unions, vendor_tables
from auditweave.plans.controls import approvals, invoices, orders, payments, vendors

Plan = Callable[..., DataFrame]

#: What several approval plans read.
APPROVAL_TABLES: dict[str, Plan] = {
    f.__name__: f
    for f in (
        conformed.ordered_requisitions,
        conformed.first_approvers,
        conformed.final_approver,
    )
}

CONFORMED: dict[str, Plan] = {
    f.__name__: f
    for f in (
        scope.addressable_vendors,
        conformed.ariba_po_invoice,
        conformed.base_payment,
        conformed.sap_invoices,
        conformed.sap_po,
        conformed.maximo_po,
        conformed.vendor_profile,
        *APPROVAL_TABLES.values(),
        conformed.approvals_matrix,
    )
}

VENDOR_TABLES: dict[str, Plan] = {
    f.__name__: f
    for f in (
        vendor_tables.vendor_attributes,
        vendor_tables.last_approver,
        vendor_tables.doa_unique,
        vendor_tables.po_line_level,
        vendor_tables.base_transaction,
        vendor_tables.vendor_windowed_features,
        vendor_tables.vendor_peer_stats,
        vendor_tables.vendor_features,
    )
}

CONTROLS: dict[str, Plan] = {
    f.__name__: f
    for f in (
        orders.ariba_dupe_po,
        orders.sap_duplicate_po,
        orders.maximo_duplicate_po,
        invoices.ariba_dupe_invoices,
        invoices.sap_dupe_invoices,
        orders.ariba_invoices_before_po,
        orders.sap_invoices_before_po,
        orders.sap_invoices_before_po_open_ended,
        orders.ariba_invoices_not_matching_po,
        orders.sap_invoices_not_matching_po,
        invoices.ariba_split_invoice,
        invoices.sap_split_invoice,
        orders.ariba_split_po,
        orders.sap_split_po,
        orders.ariba_open_po,
        invoices.ariba_payments_without_approved_po,
        approvals.ariba_deleted_user,
        approvals.approvals_exceeding_doa,
        approvals.invoice_close_to_doa,
        payments.multiple_payments_same_day,
        payments.repeat_payments_same_amount,
        payments.payments_within_1_day,
        payments.same_invoice_payment_date,
        payments.payment_vs_invoice_amount,
        payments.payments_to_blocked_vendors,
        payments.payments_weekend_holiday,
        payments.one_time_vendor_payment,
        payments.payment_soon_after_creation,
        vendors.vendor_employee_same_bank,
        vendors.vendor_employee_same_address,
        vendors.payments_shared_bank,
        vendors.dupe_vendors,
        vendors.approved_vs_blocked,
        vendors.blocked_reonboarded,
        vendors.same_financial_contact,
        vendors.vendors_no_bank,
        vendors.local_vendors_incomplete,
        vendors.international_vendors_incomplete,
    )
}

UNIONS: dict[str, Plan] = {
    f.__name__: f
    for f in (
        unions.dupe_po,
        unions.dupe_invoices,
        unions.invoices_before_po,
        unions.invoices_not_matching_po,
        unions.split_po,
        unions.split_invoice,
    )
}

#: Extensions: hits of all controls and what is made of them, and the finance-system branch.
FINDINGS: dict[str, Plan] = {
    f.__name__: f
    for f in (
        findings.control_hits,
        findings.vendor_control_summary,
        findings.case_brief_inputs,
        finance_transactions.sap_transaction,
    )
}

#: Views kept by month, each equal to the view rebuilt in full.
ROLLING: dict[str, Plan] = {
    f.__name__: f
    for f in (
        rolling.base_payment_rolling,
        rolling.sap_po_rolling,
        monthly_features.vendor_windowed_features_monthly,
    )
}

READINGS: dict[str, Plan] = {
    f.__name__: f
    for f in (
        readings.ariba_dupe_po_symmetric,
        readings.maximo_duplicate_po_within_3_days,
        readings.repeat_payments_within_14_days,
        readings.payments_within_1_day_over_1000,
        readings.payment_over_invoice_amount,
        readings.vendor_attributes_one_category,
        readings.vendor_employee_same_bank_filled,
        readings.vendor_employee_same_address_filled,
        readings.payments_shared_bank_summed,
        readings.approved_vs_blocked_filled,
        readings.blocked_reonboarded_filled,
    )
}

#: What an audit runs unless told otherwise.
AUDIT: dict[str, Plan] = {**CONFORMED, **VENDOR_TABLES, **CONTROLS, **UNIONS}
PLANS: dict[str, Plan] = {**AUDIT, **FINDINGS, **ROLLING, **READINGS}
