"""Matching two sets of parties on alternative keys and on similar text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from auditweave.sources.shelf import pin


@dataclass(frozen=True)
class MatchRule:
    """Rows match when the key expressions are equal and the left row passes ``guard``."""

    reason: str
    left_keys: list[Column]
    right_keys: list[Column]
    guard: Column | None = None


def match_by_rule(left: DataFrame, right: DataFrame, rule: MatchRule) -> DataFrame:
    """One equi-join; column names of the two sides must differ."""
    source = left if rule.guard is None else left.filter(rule.guard)
    names = [f"_k{i}" for i in range(len(rule.left_keys))]
    keyed_left = source.withColumns(dict(zip(names, rule.left_keys)))
    keyed_right = right.withColumns(dict(zip(names, rule.right_keys)))
    return (
        keyed_left.join(keyed_right, names)
        .drop(*names)
        .withColumn("match_reason", F.lit(rule.reason))
    )


def match_by_rules(left: DataFrame, right: DataFrame, rules: list[MatchRule]) -> DataFrame:
    """All matches of every rule, one equi-join per rule."""
    matched = [match_by_rule(left, right, rule) for rule in rules]
    result = matched[0]
    for more in matched[1:]:
        result = result.unionByName(more)
    return result


def similar_text_pairs(
    left: DataFrame, right: DataFrame, text: str, other: str, limit: int
) -> DataFrame:
    """All distinct (text, other) with edit distance <= ``limit``, without comparing all.

    Partition filter of the Pass-Join kind (Li et al., PVLDB 2011): a text cut into n
    segments keeps at least n - limit of them whole under ``limit`` edits, each shifted by
    at most ``limit`` places. So any ``limit + 1`` of its segments include one that occurs
    in the other text. We cut ``limit + 4`` segments and look up the ``limit + 1`` that are
    rarest among the other texts, which leaves common street or city parts unused.
    Texts too short to cut are paired by length. Every candidate is verified.
    """
    needed, cut = limit + 1, limit + 4
    ours = left.select(text).filter(F.col(text).isNotNull()).distinct()
    theirs = right.select(other).filter(F.col(other).isNotNull()).distinct()
    size = F.length(text)

    parts = F.least(size, F.lit(cut))

    def segment_start(i: Column) -> Column:
        return F.floor(i * size / parts).cast("int")

    segments = (
        ours.filter(size >= needed)
        .withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
        .withColumn("_from", segment_start(F.col("_part")))
        .withColumn("_to", segment_start(F.col("_part") + 1))
        .select(
            text,
            size.alias("_size"),
            "_part",
            F.substr(F.col(text), F.col("_from") + 1, F.col("_to") - F.col("_from")).alias(
                "_piece"
            ),
        )
    )
    # every piece another text could hold for a left text of length _size
    length = F.length(other)
    other_parts = F.least(F.col("_size"), F.lit(cut))

    def other_start(i: Column) -> Column:
        return F.floor(i * F.col("_size") / other_parts).cast("int")

    pieces = (
        theirs.withColumn(
            "_size",
            F.explode(F.sequence(F.greatest(length - limit, F.lit(needed)), length + limit)),
        )
        .filter(length >= F.col("_size") - limit)
        .withColumn("_part", F.explode(F.sequence(F.lit(0), other_parts - 1)))
        .withColumn("_from", other_start(F.col("_part")))
        .withColumn("_width", other_start(F.col("_part") + 1) - F.col("_from"))
        .withColumn(
            "_at",
            F.explode(
                F.filter(
                    F.transform(
                        F.sequence(F.lit(-limit), F.lit(limit)), lambda s: s + F.col("_from")
                    ),
                    lambda at: (at >= 0) & (at + F.col("_width") <= length),
                )
            ),
        )
        .select(
            other,
            "_size",
            "_part",
            F.substr(F.col(other), F.col("_at") + 1, F.col("_width")).alias("_piece"),
        )
    )
    where = ["_size", "_part", "_piece"]
    # pieces nobody looks for go before anything is counted; what is left is read twice
    pieces = pin(
        pieces.join(segments.select(*where).distinct(), where, "left_semi").distinct(),
        "pieces",
    )
    frequency = pieces.groupBy(*where).agg(F.count("*").alias("_hits"))
    rarest = W.partitionBy(text).orderBy("_hits", "_part")  # at most ``cut`` rows a text
    probes = (
        segments.join(frequency, where, "left")
        .withColumn("_rank", F.row_number().over(rarest))
        .filter((F.col("_rank") <= needed) & F.col("_hits").isNotNull())
        .select(text, *where)
    )
    candidates = probes.join(pieces, where).select(text, other)
    short = (
        ours.filter(size < needed)
        .withColumn("_size", F.explode(F.sequence(F.lit(0), size + limit)))
        .join(theirs.withColumn("_size", length).filter(length <= 2 * limit), "_size")
        .select(text, other)
    )
    return (
        candidates.unionByName(short)
        .distinct()
        .filter(F.levenshtein(text, other, limit) >= 0)
    )
