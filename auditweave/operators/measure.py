"""Row counts, null keys and fan-out, counted inside the jobs that run anyway.

A look-up that holds a key twice multiplies rows without an error, and sums over them then
count too much. A ``Meter`` attaches observations to DataFrames: Spark counts their rows while
a write passes over them and hands the numbers back with the write, so no job runs for it.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

#: Seconds to wait for a number after the job that counts it has ended.
PATIENCE = 10


@dataclass(frozen=True)
class Measure:
    """``rows``, how many of them have a null in each watched key, and for a join the rows
    that went in; all None if the job never reached the place (or was not run)."""

    rows: int | None
    nulls: dict[str, int]
    before: int | None = None

    @property
    def fan_out(self) -> float | None:
        """Rows that came out of a join per row that went in."""
        if self.before is None or self.rows is None:
            return None
        return self.rows / self.before if self.before else 1.0


class Meter:
    def __init__(self):
        self._watched: dict[str, tuple[Observation, list[str]]] = {}
        self._joins: dict[str, tuple[str, str]] = {}
        self._read: dict[str, dict | None] = {}

    def rows(self, df: DataFrame, label: str, *keys: str) -> DataFrame:
        """``df``, counted under ``label`` by the first action that reads it."""
        seen = Observation()
        names = [f"null{i}" for i in range(len(keys))]
        watched = df.observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            *[F.count_if(F.isnull(k)).alias(n) for n, k in zip(names, keys)],
        )
        self._watched[label] = (seen, list(keys))
        self._read.pop(label, None)
        return watched

    def join(self, left: DataFrame, label: str, joined, *keys: str) -> DataFrame:
        """``joined(left)``, with the rows of ``left`` and of the result counted.

        ``keys`` are columns of the result whose nulls tell rows without a partner.
        """
        before = f"{label} (before)"
        after = joined(self.rows(left, before))
        self._joins[label] = (before, label)
        return self.rows(after, label, *keys)

    def _numbers(self, label: str) -> dict | None:
        if label not in self._read:
            found: list[dict] = []
            seen, _ = self._watched[label]
            waiting = threading.Thread(target=lambda: found.append(seen.get), daemon=True)
            waiting.start()
            waiting.join(PATIENCE)
            self._read[label] = found[0] if found else None
        return self._read[label]

    def report(self, labels: list[str] | None = None) -> dict[str, Measure]:
        """What was counted; call it after the jobs."""
        report = {}
        inputs = {before for before, _ in self._joins.values()}
        for label in self._watched if labels is None else labels:
            if label in inputs:
                continue
            numbers, keys = self._numbers(label) or {}, self._watched[label][1]
            before = None
            if label in self._joins:
                before = (self._numbers(self._joins[label][0]) or {}).get("rows")
            nulls = {k: numbers[f"null{i}"] for i, k in enumerate(keys) if numbers}
            report[label] = Measure(numbers.get("rows"), nulls, before)
        return report


class NoMeter:
    """Counts nothing and leaves plans as they are."""

    def rows(self, df: DataFrame, label: str, *keys: str) -> DataFrame:
        return df

    def join(self, left: DataFrame, label: str, joined, *keys: str) -> DataFrame:
        return joined(left)

    def report(self, labels: list[str] | None = None) -> dict[str, Measure]:
        return {}
