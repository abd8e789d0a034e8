"""Written intermediate tables.

A plan that is read several times, or whose rows must not be drawn twice, is written once
as Parquet and read back. That cuts its lineage, survives lost executors and gives the
planner true sizes. The folder lies under ``spark.checkpoint.dir``, which a cluster points
at shared storage; a local session without one gets a folder of its own. Tables stay until
the folder is emptied: storage that Spark writes to is the operator's to clean, by folder.

Nothing reads the shuffle files behind a written table again, so Spark removes them when the
write ends. Otherwise those of a whole audit would stay on the executors' disks together,
until the driver happens to collect its garbage. Likewise what a plan writes for itself can go
with the plan, when the caller says so (``passing``); tables that plans share stay.
"""

from __future__ import annotations

import itertools
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Spark's setting for what becomes of shuffle files at the end of a query
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# keys that share their beginnings with the key before take less room in version 2 pages
COMPACT = {"compression": "zstd", "parquet.writer.version": "v2"}


class Shelf:
    def __init__(self, spark: SparkSession):
        root = spark.conf.get("spark.checkpoint.dir", None)
        local = spark.conf.get("spark.master", "").startswith("local")
        if not root and not local:
            raise ValueError("set spark.checkpoint.dir to storage all executors share")
        root = root or tempfile.mkdtemp(prefix="auditweave-")
        self._spark = spark
        self.folder = f"{root.rstrip('/')}/auditweave-{uuid.uuid4().hex}"
        self._count = itertools.count(1)
        self._kept: dict[tuple, DataFrame] = {}
        self._building: dict[tuple, threading.RLock] = {}
        self._writers = 0
        self._before: str | None = None
        self._turn = threading.Lock()
        self._passing = threading.local()

    @contextmanager
    def cleaning(self):
        """Writes in here remove their shuffle files; several threads may write at a time."""
        conf = self._spark.conf
        with self._turn:
            if not self._writers:
                self._before = conf.get(CLEANUP, None)
                conf.set(CLEANUP, "true")
            self._writers += 1
        try:
            yield
        finally:
            with self._turn:
                self._writers -= 1
                if not self._writers:
                    conf.unset(CLEANUP) if self._before is None else conf.set(CLEANUP, self._before)

    def place(self, name: str) -> str:
        """A new folder for a table that its owner writes."""
        return f"{self.folder}/{next(self._count):05d}-{name}"

    def put(self, df: DataFrame, name: str = "table", noted: list[str] | None = None) -> DataFrame:
        """Write ``df`` and return the written table; ``noted`` takes its place, for ``remove``."""
        path = self.place(name)
        places = getattr(self._passing, "places", None) if noted is None else noted
        if places is not None:
            places.append(path)
        with self.cleaning():
            df.write.options(**COMPACT).parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    @contextmanager
    def _noting(self, places: list[str] | None):
        before = getattr(self._passing, "places", None)
        self._passing.places = places
        try:
            yield
        finally:
            self._passing.places = before

    @contextmanager
    def passing(self):
        """Tables that this thread puts here in the meantime are removed at the end, but for those
        that are kept under a key or put while ``lasting``. No plan read later may read them."""
        places: list[str] = []
        try:
            with self._noting(places):
                yield
        finally:
            self.remove(places)

    def lasting(self):
        """Tables put in here stay, also while others pass."""
        return self._noting(None)

    def remove(self, places: list[str]) -> None:
        """Remove tables that nothing reads again."""
        for path in places:
            place = self._spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(place, True)

    def keep(self, key: tuple, build) -> DataFrame:
        """The written table for ``key``, built on first use; what building it put here goes."""

        def write() -> DataFrame:
            with self.passing():
                return self.put(build(), str(key[-1]), noted=[])

        return self.hold(key, write)

    def hold(self, key: tuple, build):
        """What ``build`` returned on first use; it writes what it has to write itself."""
        # plans may be built by several threads; what they share is built by one of them
        with self._building.setdefault(key, threading.RLock()):
            if key not in self._kept:
                with self.lasting():
                    self._kept[key] = build()
            return self._kept[key]


_SHELVES: dict[str, Shelf] = {}


def shelf_of(spark: SparkSession) -> Shelf:
    """One shelf per Spark application."""
    app = spark.conf.get("spark.app.id")
    if app not in _SHELVES:
        _SHELVES[app] = Shelf(spark)
    return _SHELVES[app]


def pin(df: DataFrame, name: str = "pin") -> DataFrame:
    return shelf_of(df.sparkSession).put(df, name)
