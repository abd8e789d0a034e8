"""Results as catalog tables behind views that readers keep.

Every run writes tables of its own. A view of the plan's name stands before them, and views
are only turned to a run when all of its tables are whole. A run that fails on the way leaves
readers with the tables of the run before; turning a view is a change of the catalog alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from auditweave.book import AuditBook
from auditweave.plans.registry import AUDIT, PLANS

#: The catalog table with one row per plan of every whole run.
RUNS = "published_runs"
_BETWEEN = "__"


def _table(database: str, name: str, run: str) -> str:
    return f"{database}.{name}{_BETWEEN}{run}"


def publish(
    spark: SparkSession, book: AuditBook, database: str, names: Iterable[str] | None = None
) -> str:
    """Write each plan to a table of this run in ``database``, then turn the views; returns the
    run. Later plans read the written results of earlier ones. Any failure ends the run before
    a view is touched."""
    wanted = set(AUDIT if names is None else names)
    order = [name for name in PLANS if name in wanted]
    if unknown := wanted - set(order):
        raise KeyError(f"not a plan: {sorted(unknown)}")
    run = uuid.uuid4().hex[:12]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in order:
        book.plan(name).write.format("parquet").saveAsTable(_table(database, name, run))
        book.store(name, spark.table(_table(database, name, run)))
    rows = spark.createDataFrame([(run, n) for n in order], "run string, plan string")
    rows.withColumn("as_of", F.lit(book.today)).withColumn(
        "written_at", F.current_timestamp()
    ).coalesce(1).write.mode("append").format("parquet").saveAsTable(f"{database}.{RUNS}")
    turn_to(spark, database, run)
    return run


def runs(spark: SparkSession, database: str) -> list[str]:
    """Whole runs, the last one first."""
    try:
        table = spark.table(f"{database}.{RUNS}")
    except AnalysisException:
        return []
    found = table.groupBy("run").agg(F.max("written_at").alias("at")).orderBy(F.desc("at"), "run")
    return [r.run for r in found.collect()]


def _plans_of(spark: SparkSession, database: str, run: str) -> list[str]:
    rows = spark.table(f"{database}.{RUNS}").where(F.col("run") == run)
    return sorted(r.plan for r in rows.select("plan").distinct().collect())


def turn_to(spark: SparkSession, database: str, run: str) -> None:
    """Turn the views of a run's plans to its tables; also the way back to an earlier run, and
    the way on if a driver was lost between two views."""
    if run not in runs(spark, database):
        raise KeyError(f"no whole run {run!r} in {database}")
    for name in _plans_of(spark, database, run):
        spark.sql(
            f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT * FROM {_table(database, name, run)}"
        )


def _tables_in_use(spark: SparkSession, database: str) -> set[str]:
    """Tables that a view stands before."""
    used = set()
    for table in spark.catalog.listTables(database):
        if table.tableType == "VIEW":
            text = spark.sql(f"SHOW CREATE TABLE {database}.{table.name}").head()[0]
            used |= {word.strip("`;").lower() for word in text.replace(".", " ").split()}
    return used


def forget(spark: SparkSession, database: str, keep: int = 2) -> list[str]:
    """Drop the tables of all but the last ``keep`` whole runs, and those of runs that failed.

    Tables that a view still stands before stay. Not to be called during a run.
    """
    kept = set(runs(spark, database)[:keep])
    used = _tables_in_use(spark, database)
    dropped = []
    for table in spark.catalog.listTables(database):
        name, between, run = table.name.rpartition(_BETWEEN)
        if table.tableType == "VIEW" or not between or name not in PLANS:
            continue
        if run not in kept and table.name.lower() not in used:
            spark.sql(f"DROP TABLE {database}.{table.name}")
            dropped.append(table.name)
    return sorted(dropped)
