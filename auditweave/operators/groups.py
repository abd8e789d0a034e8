"""Groups that meet a condition, numbered, with their member rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditweave.operators.ordering import dense_numbers, join_nullsafe, number_unique
from auditweave.sources.shelf import pin


def with_group_number(
    groups: DataFrame, order: list[str], out: str = "group_number", unique: bool = True
) -> DataFrame:
    """Add the dense rank of ``order`` over all rows of ``groups``.

    ``unique`` states that no two groups share an ``order`` tuple.
    """
    if unique:
        return number_unique(groups, order, out)
    kept = pin(groups, "groups")
    return join_nullsafe(kept, dense_numbers(kept, order, out), order)


def members_of(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose ``keys`` equal a group's; a NULL key never matches. Groups fan out."""
    return rows.join(groups, keys)


def shared_key_groups(
    rows: DataFrame, key: str, usable: Column | None = None, out: str = "group_number"
) -> DataFrame:
    """Rows whose ``key`` occurs on more than one row, numbered by key."""
    pool = rows if usable is None else rows.filter(usable)
    groups = (
        pool.groupBy(key).agg(F.count("*").alias("_rows")).filter("_rows > 1").select(key)
    )
    return members_of(rows, with_group_number(groups, [key], out), [key])


def label_group(number: str, prefix: str = "Group ") -> Column:
    return F.concat(F.lit(prefix), F.col(number).cast("string"))
