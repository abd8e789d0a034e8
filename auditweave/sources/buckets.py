"""Sources stored in buckets, so that joins on the bucket keys need not move them.

The ledger meets the spend cube by document and line in several views. Stored once in buckets by
these columns, it is joined where it lies: only the other side is shuffled, to the same number
of buckets. That pays for extracts that are landed once and read by many runs. Keys should
have no value with a large part of the rows: a bucket is one task, which no skew handling splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from auditweave.sources.catalog import Sources

#: A source's copies by bucket keys: ``{(source, keys): table}``.
Clusters = dict[tuple[str, tuple[str, ...]], str]


def store_clustered(rows: DataFrame, table: str, keys: tuple[str, ...], buckets: int) -> None:
    """Write ``rows`` as the catalog table ``table`` in ``buckets`` buckets by ``keys``.

    Rows are dealt to one task per bucket first, so a bucket is one file, sorted by the keys.
    """
    (
        rows.repartition(buckets, *keys)
        .write.format("parquet")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .mode("overwrite")
        .saveAsTable(table)
    )


def bind_clusters(spark: SparkSession, sources: Sources, clusters: Clusters) -> Sources:
    """Let plans read the bucketed copies where they join by their keys."""
    for (name, keys), table in clusters.items():
        sources.bind_clustered(name, keys, lambda table=table: spark.table(table))
    return sources
