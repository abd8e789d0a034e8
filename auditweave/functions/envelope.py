"""The audit envelope every control shares: label columns and look-back flags."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditweave.functions.anchors import days_before, months_before

FLAGS = [
    "last_week",
    "last_month",
    "last_90_days",
    "last_180_days",
    "last_year",
    "last_last_year",
]

LABELS = ["routine_category", "routine_description", "metric_description", "metric_unit"]


@dataclass(frozen=True)
class Label:
    category: str
    description: str
    metric: str
    unit: str = "Count"

    def columns(self) -> list[Column]:
        values = (self.category, self.description, self.metric, self.unit)
        return [F.lit(v).alias(c) for c, v in zip(LABELS, values)]


def flag_columns(day: Column, today: date, prior_year: str = "standard") -> dict[str, Column]:
    """Six 'Y'/'N' columns; every bucket is closed on both ends, a missing day is 'N'.

    ``prior_year`` picks the last bucket: 'standard' [-2y, -1y], 'cumulative' [-2y, 0],
    'same_as_last_year' [-1y, 0] or 'never'.
    """
    now = F.lit(today)
    year, two_years = months_before(today, 12), months_before(today, 24)
    spans = {
        "last_week": (days_before(today, 7), now),
        "last_month": (months_before(today, 1), now),
        "last_90_days": (days_before(today, 90), now),
        "last_180_days": (days_before(today, 180), now),
        "last_year": (year, now),
    }
    prior = {
        "standard": (two_years, year),
        "cumulative": (two_years, now),
        "same_as_last_year": (year, now),
        "never": None,
    }[prior_year]
    if prior is not None:
        spans["last_last_year"] = prior
    flags = {
        name: F.when(day.between(low, high), F.lit("Y")).otherwise(F.lit("N"))
        for name, (low, high) in spans.items()
    }
    flags.setdefault("last_last_year", F.lit("N"))
    return flags


def time_flags(
    df: DataFrame, date_col: str, today: date, prior_year: str = "standard"
) -> DataFrame:
    return df.withColumns(flag_columns(F.col(date_col).cast("date"), today, prior_year))


def emit(
    rows: DataFrame,
    label: Label,
    date_col: str,
    today: date,
    area: str | Column | None = "supplier_custom_category_l2",
    area_name: str = "vendor_area",
    prior_year: str = "standard",
    keep_area: bool = False,
) -> DataFrame:
    """Put the envelope around finished rows.

    ``rows`` already holds the control's own columns; labels are constants and flags are
    functions of ``date_col``, so adding them here never changes which rows are distinct.
    """
    lead: list[Column] = []
    body = rows.columns
    if area is not None:
        lead.append((F.col(area) if isinstance(area, str) else area).alias(area_name))
        if isinstance(area, str) and not keep_area:
            body = [c for c in body if c != area]
    flags = flag_columns(F.col(date_col).cast("date"), today, prior_year)
    return rows.select(
        *lead, *label.columns(), *body, *[col.alias(name) for name, col in flags.items()]
    )
