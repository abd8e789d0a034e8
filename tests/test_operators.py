"""Operators against brute force on small rows, hot keys and NULLs included."""

from __future__ import annotations

import random
import statistics
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from auditweave.operators.features import peer_positions, peer_summary
from auditweave.operators.groups import shared_key_groups, with_group_number
from auditweave.operators.history import largest_from_here, previous_row
from auditweave.operators.matching import MatchRule, match_by_rules, similar_text_pairs
from auditweave.operators.ordering import dense_numbers, join_nullsafe, running_offset
from auditweave.operators.proximity import (
    day_islands,
    has_other_nearby,
    later_day_members,
    near_date_pairs,
)
from auditweave.operators.ranking import first_per_key, ranked_columns

DAY0 = date(2001, 1, 1)


def _null_low(values):
    return tuple((v is not None, v) for v in values)


def _rows(n=400, seed=1, days=60):
    """(key, id, day): one key holds a third of the rows, ids repeat over days."""
    rng = random.Random(seed)
    return [
        (
            "hot" if rng.random() < 1 / 3 else f"k{rng.randrange(8)}",
            f"d{rng.randrange(150):03d}",
            DAY0 + timedelta(days=rng.randrange(days)),
        )
        for _ in range(n)
    ]


def test_dense_numbers_over_many_ranges(many_ranges):
    rng = random.Random(2)
    rows = [
        (rng.choice(["hot", "hot", None, *"abcdefgh"]), rng.choice([None, *range(40)]))
        for _ in range(900)
    ]
    df = many_ranges.createDataFrame(rows, "a string, b int")
    expected = {
        key: i
        for i, key in enumerate(sorted(set(rows), key=_null_low), start=1)
    }
    result = dense_numbers(df, ["a", "b"], "n").collect()
    assert len(result) == len(expected)
    assert {(r.a, r.b): r.n for r in result} == expected


def test_running_offset_sums_weights_before(many_ranges):
    rows = [(i, i % 7) for i in range(500)]
    df = many_ranges.createDataFrame(rows, "k int, w int").repartition(5)
    result = {r.k: r.before for r in running_offset(df, ["k"], "w").collect()}
    total = 0
    for key, weight in rows:
        assert result[key] == total
        total += weight


def test_group_number_shared_by_groups_of_one_order_key(spark):
    df = spark.createDataFrame([("v1", "x"), ("v1", "y"), ("v2", "x")], "v string, n string")
    rows = with_group_number(df, ["v"], "g", unique=False).collect()
    assert sorted((r.v, r.n, r.g) for r in rows) == [
        ("v1", "x", 1),
        ("v1", "y", 1),
        ("v2", "x", 2),
    ]


def test_join_nullsafe_matches_null_keys(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, l int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "k string, r int")
    rows = join_nullsafe(left, right, ["k"]).collect()
    assert sorted((r.l, r.r) for r in rows) == [(1, 10), (2, 20)]


@pytest.mark.parametrize("within", [0, 3, 10])
def test_near_date_pairs(spark, within):
    rows = _rows()
    df = spark.createDataFrame(rows, "k string, id string, day date")
    got = {(r.low, r.high) for r in near_date_pairs(df, ["k"], "id", "day", within).collect()}
    expected = {
        (a[1], b[1])
        for a in rows
        for b in rows
        if a[0] == b[0] and a[1] < b[1] and abs((a[2] - b[2]).days) <= within
    }
    assert got == expected


def test_has_other_nearby(spark):
    rows = _rows(n=150, days=400, seed=3) + [(None, "x", DAY0), ("hot", None, DAY0)]
    df = spark.createDataFrame(rows, "k string, id string, day date")
    got = {r.id for r in has_other_nearby(df, ["k"], "id", "day", 5).collect()}
    expected = {
        a[1]
        for a in rows
        for b in rows
        if a[0] is not None
        and a[0] == b[0]
        and None not in (a[1], b[1])
        and a[1] != b[1]
        and 0 < abs((a[2] - b[2]).days) <= 5
    }
    assert got == expected


@pytest.mark.parametrize("both", [False, True])
def test_day_members_on_either_side(spark, both):
    odd = [(None, "x", DAY0), ("hot", None, DAY0), ("hot", "y", None), ("one", "z", DAY0)]
    rows = _rows(n=120, seed=5) + odd
    df = spark.createDataFrame(rows, "k string, id string, day date")
    got = [
        (r.k, r.anchor, r.id)
        for r in later_day_members(df, ["k"], "id", "day", 3, both=both).collect()
    ]
    whole = [r for r in rows if None not in r]
    expected = {
        (a[0], a[2], member)
        for a in whole
        for b in whole
        if a[0] == b[0] and a[1] < b[1] and (-3 if both else 0) <= (a[2] - b[2]).days <= 3
        for member in (a[1], b[1])
    }
    assert len(got) == len(set(got)) and set(got) == expected


def test_later_day_members(spark):
    rows = _rows(n=200, days=90, seed=4)
    df = spark.createDataFrame(rows, "k string, id string, day date")
    got = {
        (r.k, r.anchor, r.id)
        for r in later_day_members(df, ["k"], "id", "day", 3).collect()
    }
    expected = set()
    for a in rows:
        for b in rows:
            if a[0] == b[0] and a[1] < b[1] and 0 <= (a[2] - b[2]).days <= 3:
                expected |= {(a[0], a[2], a[1]), (a[0], a[2], b[1])}
    assert got == expected


def test_day_islands_with_null_key(spark):
    rows = [("a", 1), ("a", 1), ("a", 3), ("a", 6), ("a", 20), (None, 1), (None, 9)]
    df = spark.createDataFrame(
        [(k, DAY0 + timedelta(days=d)) for k, d in rows], "k string, day date"
    )
    got = sorted(
        (r.k or "", (r.day - DAY0).days, r.island)
        for r in day_islands(df, ["k"], "day", 3).collect()
    )
    assert got == [
        ("", 1, 1),
        ("", 9, 2),
        ("a", 1, 1),
        ("a", 3, 1),
        ("a", 6, 2),
        ("a", 20, 3),
    ]


def _history(seed=5):
    rng = random.Random(seed)
    rows = {
        ("hot" if rng.random() < 0.6 else f"k{rng.randrange(5)}", rng.choice([None, *range(90)]), f"u{rng.randrange(60):02d}")
        for _ in range(600)
    }
    return sorted(rows, key=_null_low)


def test_previous_row_crosses_ranges(many_ranges):
    rows = _history()
    df = many_ranges.createDataFrame(rows, "k string, t int, who string").repartition(6)
    got = {
        (r.k, r.t, r.who): (r.prev_who, r.prev_t)
        for r in previous_row(df, "k", ["t", "who"], ["who", "t"], "prev_").collect()
    }
    expected, last = {}, {}
    for k, t, who in rows:
        expected[(k, t, who)] = last.get(k, (None, None))
        last[k] = (who, t)
    assert got == expected


def test_largest_from_here_includes_ties(many_ranges):
    rows = _history(seed=6)
    df = many_ranges.createDataFrame(rows, "k string, t int, who string").repartition(6)
    got = {(r.k, r.t): r.top for r in largest_from_here(df, "k", "t", "who", "top").collect()}
    for k, t, _ in rows:
        later = [w for kk, tt, w in rows if kk == k and _null_low((tt,)) >= _null_low((t,))]
        assert got[(k, t)] == max(later)


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        previous, row[0] = row[0], i
        for j, cb in enumerate(b, 1):
            previous, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, previous + (ca != cb))
    return row[-1]


def test_similar_text_pairs_equal_brute_force(spark):
    rng = random.Random(7)
    tail = " market street sydney 2000 nsw au"
    texts = ["", "a", "abc", "abcde", "abcdef", "abcdefg"]
    for _ in range(40):
        base = "".join(rng.choice("abcd123 ") for _ in range(rng.choice([3, 5, 7, 9, 12, 20])))
        base += rng.choice(["", tail])
        texts.append(base)
        for _ in range(3):
            copy = list(base)
            for _ in range(rng.randrange(8)):
                spot = rng.randrange(len(copy) + 1)
                if rng.random() < 0.5 or spot == len(copy):
                    copy.insert(spot, rng.choice("abxyz"))
                else:
                    del copy[spot]
            texts.append("".join(copy))
    ours, theirs = texts[::2], texts[1::2]
    left = spark.createDataFrame([(t,) for t in [*ours, None]], "l string")
    right = spark.createDataFrame([(t,) for t in [*theirs, None]], "r string")
    got = {(r.l, r.r) for r in similar_text_pairs(left, right, "l", "r", 5).collect()}
    expected = {(a, b) for a in ours for b in theirs if _edits(a, b) <= 5}
    assert got == expected
    assert any(len(a) > 30 for a, _ in expected)


def test_match_rules_skip_nulls_and_guarded_blanks(spark):
    left = spark.createDataFrame([(1, "a", ""), (2, None, "z")], "i int, le string, lp string")
    right = spark.createDataFrame([(7, "a", ""), (8, None, "z")], "j int, re string, rp string")
    rules = [
        MatchRule("email", [F.col("le")], [F.col("re")]),
        MatchRule("phone", [F.col("lp")], [F.col("rp")], F.col("lp") != ""),
    ]
    rows = match_by_rules(left, right, rules).collect()
    assert sorted((r.i, r.j, r.match_reason) for r in rows) == [(1, 7, "email"), (2, 8, "phone")]


def test_shared_key_groups_ignores_unusable_keys(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 2), ("b", 3), ("", 4), ("", 5), (None, 6), (None, 7)], "k string, v int"
    )
    rows = shared_key_groups(df, "k", F.col("k") != "").collect()
    assert sorted((r.k, r.v, r.group_number) for r in rows) == [("a", 1, 1), ("a", 2, 1)]


def test_first_per_key_and_ranked_columns(spark):
    df = spark.createDataFrame(
        [("a", 3, "x"), ("a", 1, "y"), ("a", 2, None), ("b", 1, "z")], "k string, t int, v string"
    )
    first = first_per_key(df, ["k"], [F.desc("t")])
    assert sorted((r.k, r.v) for r in first.collect()) == [("a", "x"), ("b", "z")]
    wide = ranked_columns(df, "k", "v", [F.asc("t")], ["v1", "v2"])
    assert sorted((r.k, r.v1, r.v2) for r in wide.collect()) == [
        ("a", "y", None),
        ("b", "z", None),
    ]


def test_rank_filters_limit_rows_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS t")
    plan = first_per_key(df, ["k"], [F.desc("t")])._jdf.queryExecution().executedPlan()
    assert "WindowGroupLimit" in plan.toString()


def test_peer_statistics_with_null_group(many_ranges):
    rng = random.Random(8)
    rows = [
        (rng.choice(["g1", "g1", "g2", None]), rng.choice([0, 0, 0, rng.randrange(50)]), Decimal(rng.randrange(9999)) / 100)
        for _ in range(400)
    ]
    df = many_ranges.createDataFrame(rows, "g string, x int, y decimal(18,2)").repartition(4)
    positions = peer_positions(df, "g", ["x", "y"])
    summary = {(r.g, r.feature): (r.median, r["mean"]) for r in peer_summary(positions, "g").collect()}
    below = {(r.g, r.feature, r.value): (r.below, r.peers) for r in positions.collect()}
    for group in ("g1", "g2", None):
        for i, feature in ((1, "x"), (2, "y")):
            values = [Decimal(r[i]) for r in rows if r[0] == group]
            median, mean = summary[(group, feature)]
            assert median == pytest.approx(float(statistics.median(values)))
            assert mean == pytest.approx(float(sum(values) / len(values)))
            for v in set(values):
                assert below[(group, feature, v)] == (sum(w < v for w in values), len(values))
