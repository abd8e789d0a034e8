"""The calendar day an audit run looks back from."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_ZONE = "Australia/Sydney"


@dataclass(frozen=True)
class Anchors:
    """``today`` is the UTC day, ``local_today`` the day in the business time zone.

    Both are literals in the plan, so every look-back bound folds to a constant and
    reaches the scan as a pushed filter.
    """

    today: date
    local_today: date

    @classmethod
    def fixed(cls, day: date) -> Anchors:
        return cls(day, day)

    @classmethod
    def now(cls, zone: str = LOCAL_ZONE) -> Anchors:
        instant = datetime.now(timezone.utc)
        return cls(instant.date(), instant.astimezone(ZoneInfo(zone)).date())


def months_before(day: date, months: int) -> Column:
    """``day`` minus whole months, clamped to the month's end."""
    return F.add_months(F.lit(day), -months)


def days_before(day: date, days: int) -> Column:
    return F.date_sub(F.lit(day), days)
