"""Peer statistics of many numeric columns at once, without a window per column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditweave.functions.money import repeated, scale_of
from auditweave.operators.ordering import join_nullsafe, running_offset


def unpivot(rows: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    """(keys, feature, value) rows; values as DECIMAL so that equality is exact.

    They get the largest scale of any feature, at least 2, so no place is lost.
    """
    places = max([2, *[s for s in (scale_of(rows, name) for name in features) if s is not None]])
    kind = f"decimal(38,{places})"
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("feature"), F.col(name).cast(kind).alias("value"))
            for name in features
        ]
    )
    return rows.select(*keys, F.inline(pairs))


def peer_positions(rows: DataFrame, group: str, features: list[str]) -> DataFrame:
    """Per (group, feature, value): peers below, peers at the value and the group's totals.

    The values are counted before anything is ordered, so a value shared by very many rows
    (zero, typically) is one row here, and the order is global over (group, feature, value)
    instead of one sort task per group. A NULL group is a group of its own.
    """
    counted = (
        unpivot(rows, [group], features)
        .groupBy(group, "feature", "value")
        .agg(F.count("*").alias("at_value"))
    )
    placed = running_offset(counted, [group, "feature", "value"], "at_value", "_before")
    totals = placed.groupBy(group, "feature").agg(
        F.min("_before").alias("_start"),
        F.sum("at_value").alias("peers"),
        F.sum(repeated(placed, "value", "at_value")).alias("_sum"),
    )
    return (
        join_nullsafe(placed, totals, [group, "feature"])
        .withColumn("below", F.col("_before") - F.col("_start"))
        .drop("_before", "_start")
    )


def peer_summary(positions: DataFrame, group: str) -> DataFrame:
    """Median and mean per (group, feature) from ``peer_positions`` rows."""
    low = F.floor((F.col("peers") - 1) / 2)
    high = F.ceil((F.col("peers") - 1) / 2)

    def at(position: Column) -> Column:
        inside = (F.col("below") <= position) & (
            position < F.col("below") + F.col("at_value")
        )
        return F.max(F.when(inside, F.col("value"))).cast("double")

    return positions.groupBy(group, "feature").agg(
        ((at(low) + at(high)) / 2).alias("median"),
        (F.max("_sum").cast("double") / F.max("peers")).alias("mean"),
    )
