"""Rows of one key whose dates lie close together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from auditweave.sources.shelf import pin

def near_date_pairs(
    rows: DataFrame, keys: list[str], row_id: str, day: str, within: int
) -> DataFrame:
    """Distinct (low, high) id pairs with equal ``keys``, low < high and days <= ``within`` apart.

    Days are cut into buckets and one side is listed in every bucket its range touches (two
    at most), so the join is an equi-join on keys and bucket and compares neighbours only.
    """
    width = 2 * within + 1
    points = rows.select(*keys, row_id, day).distinct()
    number = F.unix_date(F.col(day).cast("date"))
    left = points.select(
        *keys,
        F.col(row_id).alias("low"),
        number.alias("_left_day"),
        F.floor(number / width).cast("int").alias("_bucket"),
    )
    right = points.select(
        *keys,
        F.col(row_id).alias("high"),
        number.alias("_right_day"),
        F.explode(
            F.sequence(
                F.floor((number - within) / width).cast("int"),
                F.floor((number + within) / width).cast("int"),
            )
        ).alias("_bucket"),
    )
    close = F.abs(F.col("_left_day") - F.col("_right_day")) <= within
    return (
        left.join(right, [*keys, "_bucket"])
        .filter((F.col("low") < F.col("high")) & close)
        .select("low", "high")
        .distinct()
    )


def has_other_nearby(
    rows: DataFrame, keys: list[str], row_id: str, day: str, within: int
) -> DataFrame:
    """Distinct ids of rows that have a partner: equal ``keys``, another id, another day at
    most ``within`` days away. No pair is ever formed.

    Per key and day only the smallest and largest id are kept: a day holds an id other than
    mine exactly when one of the two differs from it. The windows then run over days, so a
    partition is bounded by the days covered, however many rows a key has.
    """
    rows = rows.filter(F.col(day).isNotNull() & F.col(row_id).isNotNull())
    for key in keys:
        rows = rows.filter(F.col(key).isNotNull())
    days = rows.groupBy(*keys, day).agg(
        F.min(row_id).alias("_first"), F.max(row_id).alias("_last")
    )
    by_day = W.partitionBy(*keys).orderBy(F.unix_date(day))
    before, after = by_day.rangeBetween(-within, -1), by_day.rangeBetween(1, within)
    surroundings = days.select(
        *keys,
        day,
        F.least(F.min("_first").over(before), F.min("_first").over(after)).alias("_low"),
        F.greatest(F.max("_last").over(before), F.max("_last").over(after)).alias("_high"),
    ).filter(F.col("_low").isNotNull())
    return (
        rows.select(*keys, day, row_id)
        .join(surroundings, [*keys, day])
        .filter((F.col("_low") != F.col(row_id)) | (F.col("_high") != F.col(row_id)))
        .select(row_id)
        .distinct()
    )


def later_day_members(
    rows: DataFrame, keys: list[str], row_id: str, day: str, within: int, both: bool = False
) -> DataFrame:
    """Members of the groups (keys, anchor day): rows a on the anchor day and rows b up to
    ``within`` days earlier with a < b by id, as (keys, anchor, id), without forming pairs.
    With ``both`` the rows b may also be up to ``within`` days later.

    b belongs when some id on the anchor day is smaller, a when some id in the reach is
    larger; both need only the smallest and largest id per key and day.
    """
    # neither the smallest and largest nor the distinct members need distinct rows
    days = rows.groupBy(*keys, day).agg(
        F.min(row_id).alias("_first"), F.max(row_id).alias("_last")
    )
    later_days = within if both else 0
    by_day = W.partitionBy(*keys).orderBy(F.unix_date(day))
    reach, anchors = by_day.rangeBetween(-within, later_days), by_day.rangeBetween(-later_days, within)
    # a day's anchors are days of its key, so there are at most 2 * within + 1 of them
    ahead = days.withColumns(
        {
            "_largest": F.max("_last").over(reach),
            "_anchors": F.collect_list(F.struct(F.col(day).alias("anchor"), "_first")).over(anchors),
        }
    )
    # written, as days that have members are few as a rule and then need not move their rows
    near = F.exists("_anchors", lambda a: a["_first"] < F.col("_last"))
    ahead = pin(ahead.filter((F.col("_first") < F.col("_largest")) | near).drop("_first", "_last"), "days")
    found = F.filter(
        "_anchors",
        lambda a: (a["_first"] < F.col(row_id))
        | ((a["anchor"] == F.col(day)) & (F.col(row_id) < F.col("_largest"))),
    )
    return (
        rows.select(*keys, day, row_id)
        .join(ahead, [*keys, day])
        .select(*keys, F.explode(F.transform(found, lambda a: a["anchor"])).alias("anchor"), row_id)
        .distinct()
    )


def day_islands(rows: DataFrame, keys: list[str], day: str, gap: int) -> DataFrame:
    """(keys, day, island): runs of days per key, a new one where the step is >= ``gap`` days.

    Rows of one day always share an island, so runs are found on distinct days and a window
    never holds more rows than there are days.
    """
    per_key = W.partitionBy(*keys).orderBy(day)
    step = F.datediff(day, F.lag(day).over(per_key))
    starts = (
        rows.select(*keys, day)
        .distinct()
        .withColumn("_start", F.when(step.isNull() | (step >= gap), 1).otherwise(0))
    )
    return starts.withColumn("island", F.sum("_start").over(per_key)).drop("_start")


def on_or_after(day: Column, start: Column, days: int) -> Column:
    return day.between(start, F.date_add(start, days))
