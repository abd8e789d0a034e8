"""One control family across the systems it runs on."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _union(book, *names: str) -> DataFrame:
    """By name; a column only some members have is NULL for the others."""
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [book.table(name) for name in names],
    )


def dupe_po(book) -> DataFrame:
    rows = _union(book, "ariba_dupe_po", "sap_duplicate_po", "maximo_duplicate_po")
    return rows.filter(
        F.col("dupe_po_group").isNotNull() & F.col("group_number").isNotNull()
    )


def dupe_invoices(book) -> DataFrame:
    return _union(book, "ariba_dupe_invoices", "sap_dupe_invoices")


def invoices_before_po(book) -> DataFrame:
    return _union(book, "ariba_invoices_before_po", "sap_invoices_before_po")


def invoices_not_matching_po(book) -> DataFrame:
    return _union(book, "ariba_invoices_not_matching_po", "sap_invoices_not_matching_po")


def split_po(book) -> DataFrame:
    return _union(book, "sap_split_po", "ariba_split_po")


def split_invoice(book) -> DataFrame:
    return _union(book, "sap_split_invoice", "ariba_split_invoice")
