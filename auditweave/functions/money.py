"""Exact arithmetic on money of any scale."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# A count of at most ten digits leaves 27 for the amount, so that the product keeps its scale.
_COUNT, _AMOUNT = "decimal(10,0)", 27


def scale_of(rows: DataFrame, name: str) -> int | None:
    """Places behind the point of a decimal column, None for other types."""
    kind = rows.schema[name].dataType
    return kind.scale if isinstance(kind, DecimalType) else None


def repeated(rows: DataFrame, like: str, times: str, amount: str | None = None) -> Column:
    """``amount`` (by default the column ``like`` of ``rows``) times the count ``times``.

    A plain product of wide decimals gives up places; this one keeps those that the column
    ``like`` of ``rows`` has.
    """
    scale = scale_of(rows, like)
    value = F.col(amount or like)
    if scale is None:
        return value * F.col(times)
    return value.cast(f"decimal({_AMOUNT},{scale})") * F.col(times).cast(_COUNT)
