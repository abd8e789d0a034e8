"""Amounts split over several documents of one party and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditweave.operators.groups import with_group_number


def split_groups(
    rows: DataFrame,
    party: str,
    day: str,
    also_by: list[str],
    several: Column,
    threshold_sum: Column,
    threshold: int,
    totals: dict[str, Column] | None = None,
    number: str = "group_id",
) -> DataFrame:
    """Party-days with several documents that together reach ``threshold``.

    ``several`` says whether a group has more than one document.

    Groups are formed by party, day and ``also_by`` but numbered by party and day alone.
    Groups without a party or day can have no members and take no number.
    """
    groups = (
        rows.filter(F.col(party).isNotNull() & F.col(day).isNotNull())
        .groupBy(party, day, *also_by)
        .agg(
            several.alias("_several"),
            threshold_sum.alias("_reached"),
            *[c.alias(n) for n, c in (totals or {}).items()],
        )
        .filter(F.col("_several") & (F.col("_reached") >= threshold))
        .select(party, day, *(totals or {}))
    )
    return with_group_number(groups, [party, day], number, unique=not also_by)
