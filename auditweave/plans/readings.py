"""Other readings of rules, each as a plan of its own.

The plans of the same name without the ending keep the rule as it is written; these take it
as its label says, or leave out what only agrees because it is blank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from auditweave.plans import vendor_tables
from auditweave.plans.controls import orders, payments, vendors


def ariba_dupe_po_symmetric(book) -> DataFrame:
    return orders.ariba_dupe_po(book, symmetric=True)


def maximo_duplicate_po_within_3_days(book) -> DataFrame:
    return orders.maximo_duplicate_po(book, within=3)


def repeat_payments_within_14_days(book) -> DataFrame:
    return payments.repeat_payments_same_amount(book, within=14)


def payments_within_1_day_over_1000(book) -> DataFrame:
    return payments.payments_within_1_day(book, floor=1000)


def payment_over_invoice_amount(book) -> DataFrame:
    return payments.payment_vs_invoice_amount(book, direction="payment_over_invoice")


def vendor_attributes_one_category(book) -> DataFrame:
    return vendor_tables.vendor_attributes(book, one_category_per_vendor=True)


def vendor_employee_same_bank_filled(book) -> DataFrame:
    return vendors.vendor_employee_same_bank(book, filled=True)


def vendor_employee_same_address_filled(book) -> DataFrame:
    return vendors.vendor_employee_same_address(book, filled=True)


def payments_shared_bank_summed(book) -> DataFrame:
    return vendors.payments_shared_bank(book, summed=True)


def approved_vs_blocked_filled(book) -> DataFrame:
    return vendors.approved_vs_blocked(book, filled=True)


def blocked_reonboarded_filled(book) -> DataFrame:
    return vendors.blocked_reonboarded(book, filled=True)
