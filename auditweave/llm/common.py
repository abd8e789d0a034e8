"""Small helpers that the operators share."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII letters to lower case and the ASCII white space \t \n \v \f \r to a space.
LOWER_SPACED = bytes(
    b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256)
)


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Exactly the columns ``names``, found by exact name.

    Further columns never take part, also not those that differ from a wanted one in case
    only, or that bear the name of a column which the operator makes itself.
    """
    flat = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return flat.select(*[flat[f"c{df.columns.index(n)}"].alias(n) for n in names])


#: Rows that a Python worker gets at once, where the session leaves Spark's default.
BATCH_ROWS = "1000"
_BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def short_batches(spark: SparkSession) -> None:
    """Whole texts are long rows: Spark's default number of them is too much at once."""
    if spark.conf.get(_BATCH_KEY, "10000") == "10000":
        spark.conf.set(_BATCH_KEY, BATCH_ROWS)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    short_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus


def py_id_remainder(value, modulus: int) -> int:
    """The same in a worker."""
    return zlib.crc32(b"" if value is None else str(value).encode()) % modulus


def plain_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, ASCII letters in lower case, as UTF-8."""
    return text.encode().translate(LOWER_SPACED).split() if text else []
