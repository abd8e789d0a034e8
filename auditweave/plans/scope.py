"""Vendor scope shared by nearly every plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The audited company and the category that is out of scope.
COMPANY = "1000"
OUT_OF_SCOPE = "Non Addressable"


def in_scope_spend(src) -> DataFrame:
    return src.spend_base.filter(
        (F.col("company_code") == COMPANY) & (F.col("category_l1") != OUT_OF_SCOPE)
    )


def addressable_vendors(book) -> DataFrame:
    """Vendors in scope with their names, categories and terms; several rows a vendor.

    A shared table: it is the only thing most plans need from the spend cube, so the cube
    is scanned for it once a run.
    """
    return (
        in_scope_spend(book.src)
        .select(
            "vendor_id",
            "supplier_name",
            F.col("category_l1").alias("supplier_custom_category_l1"),
            F.col("category_l2").alias("supplier_custom_category_l2"),
            F.col("category_l3").alias("supplier_custom_category_l3"),
            "payment_terms",
        )
        .distinct()
    )


def scope_columns(book, *cols: str) -> DataFrame:
    """Distinct columns of the vendors in scope."""
    return book.table("addressable_vendors").select(*cols).distinct()


def vendor_categories(book, key: str = "vendor") -> DataFrame:
    """(vendor, second-level category) pairs in scope, vendor column named ``key``."""
    return scope_columns(
        book, F.col("vendor_id").alias(key), "supplier_custom_category_l2"
    )
