"""Scalar expressions for vendor identity keys and ERP codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_zeros(col: str | Column) -> Column:
    """Vendor id without its leading zeros."""
    return F.ltrim(F.col(col) if isinstance(col, str) else col, F.lit("0"))


def erp_date(col: str | Column) -> Column:
    """'yyyyMMdd' text to a date; the '00000000' sentinel and other junk give NULL."""
    return F.try_to_date(F.col(col) if isinstance(col, str) else col, "yyyyMMdd")


def erp_date_between(col: str, low: Column, high: Column | None = None) -> Column:
    """Whether 'yyyyMMdd' text is a date in [low, high].

    The text is also compared as text, which orders the same way: that part reaches the
    scan as a pushed filter and skips row groups, the parsed part then drops non-dates.
    """
    day = erp_date(col)
    inside = erp_text_from(col, low) & (day >= low)
    if high is not None:
        inside = inside & (F.col(col) <= F.date_format(high, "yyyyMMdd")) & (day <= high)
    return inside


def erp_text_from(col: str, low: Column) -> Column:
    """The part of ``erp_date_between`` that a scan can take, also inside an OR."""
    return F.col(col) >= F.date_format(low, "yyyyMMdd")


ADDRESS_PARTS = ["building_number", "street", "city", "postal_code", "state", "country"]


def full_address() -> Column:
    """Lower-case one-line address; NULL as soon as one part is NULL."""
    pieces: list[Column] = []
    for part in ADDRESS_PARTS:
        pieces += [F.lit(" "), F.col(part)]
    return F.lower(F.trim(F.concat(*pieces[1:])))


def full_address_blank_nulls() -> Column:
    """One-line address in its original case, missing parts left blank."""
    pieces: list[Column] = []
    for part in ADDRESS_PARTS:
        pieces += [F.lit(" "), F.coalesce(F.col(part), F.lit(""))]
    return F.concat(*pieces[1:])


def joined_key(*cols: str) -> Column:
    """Parts joined by '-', NULL parts as empty text; never NULL itself."""
    pieces: list[Column] = []
    for col in cols:
        pieces += [F.lit("-"), F.coalesce(F.col(col), F.lit(""))]
    return F.concat(*pieces[1:])


def invoice_origin(automation_users: tuple[str, ...] = ()) -> Column:
    """Which upstream system keyed a ledger invoice; NULL when no rule applies.

    ``automation_users`` are parts of the user names of form-filling software.
    Fixed values: document types, text marks and system names of the ledger; the order of
    the rules decides between overlapping ones.
    """
    doc_type = F.col("h_document_type")
    text, user = F.col("h_docheader_text"), F.col("h_usnam_user_name")
    automatic = F.lit(False)
    for name in automation_users:
        automatic = automatic | user.contains(name)
    rules = [
        (doc_type == "Y0", "Ariba"),
        ((doc_type == "VN") & text.contains("TPUE"), "SAP"),
        ((doc_type == "RN") & F.lower(text).like("%ariba_asn%"), "ARIBA_ASN"),
        ((doc_type == "RN") & F.lower(text).contains("cptp"), "Manually Keyed Capital Invoice"),
        (doc_type == "YM", "Maximo"),
        (doc_type == "VS", "PEPs Property Leases"),
        ((doc_type == "VN") & automatic, "Smartsheet Robot"),
        ((doc_type == "VN") & F.lower(user).like("%wf_batch%"), "VIM Docs"),
        (doc_type.isin("FI", "FN", "FR", "ZF"), "Overseas"),
    ]
    return _first_match(rules)


def order_system(with_freight: bool = False) -> Column:
    """Purchasing system behind a ledger document (fixed values)."""
    doc_type = F.col("h_document_type")
    rules = [
        (doc_type == "Y0", "Ariba_WDP"),
        (doc_type.isin("PX", "PY", "VS"), "PEPS"),
        (doc_type == "YM", "Maximo"),
    ]
    if with_freight:
        def marked(col: str) -> Column:
            return F.upper(F.substring(col, 1, 6)).contains("TMS")

        rules.append((marked("h_docheader_text") | marked("d_item_text"), "TMS"))
    return _first_match(rules, "SAP")


def _first_match(rules: list[tuple[Column, str]], default: str | None = None) -> Column:
    (condition, value), *rest = rules
    chain = F.when(condition, F.lit(value))
    for condition, value in rest:
        chain = chain.when(condition, F.lit(value))
    return chain if default is None else chain.otherwise(F.lit(default))
