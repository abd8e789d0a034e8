"""Mandatory-field checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def missing(col: str) -> Column:
    return F.col(col).isNull() | (F.col(col) == "")


def any_missing(cols: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [missing(c) for c in cols])
