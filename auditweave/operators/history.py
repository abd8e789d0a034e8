"""Look-ups along an ordered history that may be very long for one key.

The history is written in global order first; each range of it is worked on alone and what
crosses the edge of a range is carried in a summary of one row per key and range. A key's
rows are spread over as many ranges as it fills.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from auditweave.operators.ordering import join_nullsafe, sorted_table


def previous_row(
    rows: DataFrame, key: str, order: list[str], carried: list[str], prefix: str
) -> DataFrame:
    """Add ``prefix + column``: the ``carried`` columns of the key's row before this one.

    ``rows`` must hold each (key, order) tuple once.
    """
    table = sorted_table(rows, [key, *order])
    inside = W.partitionBy(key, "_range").orderBy("_place")
    value = F.struct(*carried)
    edges = (
        table.groupBy(key, "_range")
        .agg(F.max_by(value, "_place").alias("_edge"))
        .withColumn("_carry", F.lag("_edge").over(W.partitionBy(key).orderBy("_range")))
        .select(key, "_range", "_carry")
    )
    return (
        join_nullsafe(
            table.withColumn("_inside", F.lag(value).over(inside)), edges, [key, "_range"]
        )
        .withColumn("_value", F.coalesce("_inside", "_carry"))
        .withColumns({prefix + c: F.col("_value")[c] for c in carried})
        .drop("_range", "_place", "_inside", "_carry", "_value")
    )


def largest_from_here(
    rows: DataFrame, key: str, order: str, value: str, out: str
) -> DataFrame:
    """(key, order, out): the key's largest ``value`` at this ``order`` or any later one."""
    steps = rows.groupBy(key, order).agg(F.max(value).alias("_value"))
    table = sorted_table(steps, [key, order])
    onward = (
        W.partitionBy(key, "_range").orderBy("_place").rowsBetween(0, W.unboundedFollowing)
    )
    later = W.partitionBy(key).orderBy("_range").rowsBetween(1, W.unboundedFollowing)
    edges = (
        table.groupBy(key, "_range")
        .agg(F.max("_value").alias("_largest"))
        .withColumn("_later", F.max("_largest").over(later))
        .select(key, "_range", "_later")
    )
    return join_nullsafe(
        table.withColumn("_here", F.max("_value").over(onward)), edges, [key, "_range"]
    ).select(key, order, F.greatest("_here", "_later").alias(out))
