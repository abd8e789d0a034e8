"""Where the source extracts come from.

``Sources`` is a read-only mapping from source name to a lazy DataFrame. Nothing is read
until a plan asks for the source, and then only the columns and row groups it needs.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegralType,
    NumericType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from auditweave.sources.schemas import LAYOUTS, schema_of

# Formats whose columns get their types from the layout.
UNTYPED = {"csv", "json"}


class Sources:
    def __init__(self, readers: Mapping[str, Callable[[], DataFrame]]):
        unknown = sorted(set(readers) - set(LAYOUTS))
        if unknown:
            raise KeyError(f"not a known source: {unknown}")
        self._readers = dict(readers)
        self._frames: dict[str, DataFrame] = {}
        self._clustered: dict[tuple[str, tuple[str, ...]], Callable[[], DataFrame]] = {}

    @classmethod
    def from_paths(
        cls,
        spark: SparkSession,
        paths: Mapping[str, str],
        fmt: str = "parquet",
        renames: Mapping[str, Mapping[str, str]] | None = None,
        **options: str,
    ):
        """Bind each source to a directory of files (``fmt`` is any Spark file format).

        Formats without types of their own (csv, json) are read by the layout, under the
        names that ``renames[source]`` maps to the layout's; then no type is guessed and no
        leading zero is lost. Other formats bring their types, which must fit the layout.
        """
        renames = renames or {}

        def read(name: str, path: str) -> DataFrame:
            reader = spark.read.format(fmt).options(**options)
            names = dict(renames.get(name, {}))
            if fmt in UNTYPED:
                theirs = {ours: other for other, ours in names.items()}
                layout = StructType(
                    [StructField(theirs.get(f.name, f.name), f.dataType) for f in schema_of(name)]
                )
                header = {"header": "true", "enforceSchema": "false"} if fmt == "csv" else {}
                reader = spark.read.format(fmt).options(**(header | options)).schema(layout)
            return reader.load(path).withColumnsRenamed(names)

        return cls({name: (lambda n=name, p=path: read(n, p)) for name, path in paths.items()})

    @classmethod
    def from_tables(
        cls,
        spark: SparkSession,
        tables: Mapping[str, str],
        renames: Mapping[str, Mapping[str, str]] | None = None,
    ):
        """Bind each source to a catalog table; ``renames[source]`` maps its column names."""
        renames = renames or {}
        return cls(
            {
                name: (
                    lambda table=table, name=name: spark.table(table).withColumnsRenamed(
                        dict(renames.get(name, {}))
                    )
                )
                for name, table in tables.items()
            }
        )

    @classmethod
    def from_frames(cls, frames: Mapping[str, DataFrame]):
        return cls({name: (lambda df=df: df) for name, df in frames.items()})

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._frames:
            try:
                read = self._readers[name]
            except KeyError:
                raise AttributeError(f"source {name!r} is not bound") from None
            df = read()
            if wrong := misfits(name, df):
                raise TypeError(f"source {name!r} does not fit its layout: {'; '.join(wrong)}")
            self._frames[name] = df
        return self._frames[name]

    def bind_clustered(
        self, name: str, keys: tuple[str, ...], reader: Callable[[], DataFrame]
    ) -> None:
        """Bind a copy of a source that is stored in buckets by ``keys``, see ``buckets``."""
        if name not in LAYOUTS:
            raise KeyError(f"not a known source: {[name]}")
        self._clustered[name, tuple(keys)] = reader

    def clustered(self, name: str, *keys: str) -> DataFrame | None:
        """The copy of a source in buckets by ``keys``, if one is bound."""
        reader = self._clustered.get((name, keys))
        if reader is None:
            return None
        df = reader()
        if wrong := misfits(name, df):
            raise TypeError(f"source {name!r} does not fit its layout: {'; '.join(wrong)}")
        return df

    def names(self) -> list[str]:
        return sorted(self._readers)

    def probe(self) -> dict[str, str]:
        """Check every bound source: 'ok', 'empty', 'missing columns …', 'wrong types …' or
        the read error."""
        report = {}
        for name in self.names():
            try:
                df = self._readers[name]()
                wanted = [field.name for field in schema_of(name)]
                present = {c.lower() for c in df.columns}
                missing = [c for c in wanted if c not in present]
                if missing:
                    report[name] = "missing columns: " + ", ".join(missing)
                elif wrong := misfits(name, df):
                    report[name] = "wrong types: " + "; ".join(wrong)
                else:
                    report[name] = "ok" if df.select(F.lit(1)).head(1) else "empty"
            except Exception as error:  # the report is the product of this method
                report[name] = f"unreadable: {type(error).__name__}"
        return report


def misfits(name: str, df: DataFrame) -> list[str]:
    """Columns of ``df`` whose type the layout of the source cannot take without loss."""
    wanted = {field.name: field.dataType for field in schema_of(name)}
    found = []
    for field in df.schema:
        kind = wanted.get(field.name.lower())
        if kind is not None and not _fits(field.dataType, kind):
            found.append(
                f"{field.name} is {field.dataType.simpleString()}, not {kind.simpleString()}"
            )
    return found


def _fits(actual: DataType, wanted: DataType) -> bool:
    if actual.simpleString() == "void":
        return True
    if isinstance(wanted, StringType):
        return isinstance(actual, StringType)
    if isinstance(wanted, DecimalType):
        # the digits before the point are not checked: extracts declare them far too wide
        return isinstance(actual, IntegralType) or (
            isinstance(actual, DecimalType) and actual.scale <= wanted.scale
        )
    if isinstance(wanted, IntegralType):
        return isinstance(actual, IntegralType)
    if isinstance(wanted, DoubleType):
        return isinstance(actual, NumericType)
    if isinstance(wanted, (TimestampType, TimestampNTZType)):
        return isinstance(actual, (TimestampType, TimestampNTZType, DateType))
    return isinstance(actual, type(wanted))
