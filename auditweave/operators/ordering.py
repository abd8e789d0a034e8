"""Global order without a global sort in one task.

A window without PARTITION BY moves every row to one task. Here rows are range-partitioned
and sorted by all tasks, and each row is written down with its place: the number of its
range and its place inside it. Written once, the places cannot differ between two readers.
Ranks are then the place inside the range plus the sizes of the ranges before it, and
there are only as many ranges as shuffle partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from auditweave.sources.shelf import pin

_BEFORE = (W.unboundedPreceding, -1)
# monotonically_increasing_id: partition number above, row number in the low 33 bits
_PLACE_BITS = 33


def sorted_table(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` written in global order (NULLs first) with ``_range`` and ``_place``."""
    placed = (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    return (
        pin(placed, "sorted")
        .withColumn("_range", F.shiftright("_id", _PLACE_BITS))
        .withColumn("_place", F.col("_id").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)))
        .drop("_id")
    )


def _with_offsets(table: DataFrame, amount) -> DataFrame:
    """Add ``_offset``, the total of ``amount`` in all earlier ranges.

    One row per range, so the window without a partition is as small as the number of
    shuffle partitions, and so is the broadcast.
    """
    ranges = (
        table.groupBy("_range")
        .agg(amount.alias("_total"))
        .withColumn("_offset", F.sum("_total").over(W.orderBy("_range").rowsBetween(*_BEFORE)))
        .select("_range", F.coalesce("_offset", F.lit(0)).alias("_offset"))
    )
    return table.join(F.broadcast(ranges), "_range")


def number_unique(rows: DataFrame, order: list[str], out: str) -> DataFrame:
    """Number rows 1, 2, … in ``order``; each ``order`` tuple must occur once."""
    table = _with_offsets(sorted_table(rows, order), F.count("*"))
    return table.withColumn(out, F.col("_place") + F.col("_offset") + 1).drop(
        "_range", "_place", "_offset"
    )


def dense_numbers(rows: DataFrame, order: list[str], out: str) -> DataFrame:
    """Each distinct ``order`` tuple of ``rows`` with its dense rank, 1-based, NULLs first."""
    return number_unique(rows.select(*order).distinct(), order, out)


def running_offset(
    rows: DataFrame, order: list[str], weight: str, out: str = "before"
) -> DataFrame:
    """Add ``out``: the sum of ``weight`` over all rows before this one in ``order``."""
    table = _with_offsets(sorted_table(rows, order), F.sum(weight))
    inside = W.partitionBy("_range").orderBy("_place").rowsBetween(*_BEFORE)
    return table.withColumn(
        out, (F.coalesce(F.sum(weight).over(inside), F.lit(0)) + F.col("_offset")).cast("long")
    ).drop("_range", "_place", "_offset")


def join_nullsafe(
    left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner"
) -> DataFrame:
    """Equi-join on ``keys`` where NULL equals NULL; key columns come from the left."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])
