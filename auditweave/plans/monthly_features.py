"""The look-back features of vendors from partial results by month.

Sums over a window are sums of monthly sums, but distinct counts do not add up: an invoice may
have lines in several months. So a month keeps, per vendor, a bitmap of the invoices that it
has met. Invoices are numbered per vendor by a dictionary that only grows; the months of a
window are joined by OR, and the count of bits is exact.

Months begin on the day of the month that runs are as of, so that every look-back window is a
whole number of them.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditweave.book import AuditBook
from auditweave.functions.anchors import months_before
from auditweave.operators.ordering import dense_numbers
from auditweave.plans.rolling import MONTH, MonthlyState, month_back, month_of
from auditweave.plans.vendor_tables import FEATURES, WINDOWS, vendor_windowed_features
from auditweave.sources.shelf import pin

#: The month of rows without a date: before all others, in no window but the whole history.
UNDATED = "0000-00"
#: Months that begin on one of the last days of a month would not be whole in every month.
LAST_ANCHOR_DAY = 28


def anchored_month(day: Column, as_of: date) -> Column:
    """The month of ``day`` if months begin on the day of ``as_of``."""
    if as_of.day > LAST_ANCHOR_DAY:
        raise ValueError(f"runs by month must be as of one of the first {LAST_ANCHOR_DAY} days")
    return F.coalesce(month_of(F.date_sub(day, as_of.day - 1)), F.lit(UNDATED))


def extend_dictionary(known: DataFrame | None, rows: DataFrame) -> DataFrame:
    """(vendor_number, invoice_id, number): numbers from 1 per vendor, old ones unchanged.

    ``rows`` has vendor_number, invoice_id and month. New invoices come after those known, in the
    order of their first month, so that the bits of a month lie close together.
    """
    pairs = (
        rows.where("vendor_number IS NOT NULL AND invoice_id IS NOT NULL")
        .groupBy("vendor_number", "invoice_id")
        .agg(F.min(MONTH).alias("_first"))
    )
    if known is not None:
        pairs = pairs.join(known, ["vendor_number", "invoice_id"], "left_anti")
    placed = pin(dense_numbers(pairs, ["vendor_number", "_first", "invoice_id"], "_number"), "new-ids")
    start = placed.groupBy("vendor_number").agg((F.min("_number") - 1).alias("_before"))
    if known is None:
        used = start.select("vendor_number", F.lit(0).cast("long").alias("_used"))
    else:
        used = known.groupBy("vendor_number").agg(F.max("number").alias("_used"))
    new = (
        placed.join(start, "vendor_number")
        .join(used, "vendor_number", "left")
        .select(
            "vendor_number",
            "invoice_id",
            (F.col("_number") - F.col("_before") + F.coalesce("_used", F.lit(0))).alias("number"),
        )
    )
    return new if known is None else known.unionByName(new)


def _bitmaps(rows: DataFrame) -> DataFrame:
    """Per vendor and month the invoices met, and those met with a payment date.

    ``rows`` has number. A bitmap spans 32,768 numbers; ``part`` tells which.
    """
    bit = F.bitmap_bit_position("number")
    return (
        rows.where("number IS NOT NULL")
        .groupBy(MONTH, "vendor_number", F.bitmap_bucket_number("number").alias("part"))
        .agg(
            F.bitmap_construct_agg(bit).alias("invoices"),
            F.bitmap_construct_agg(F.when(F.col("payment_date").isNotNull(), bit)).alias("paid"),
        )
    )


def _amounts(rows: DataFrame) -> DataFrame:
    return rows.groupBy(MONTH, "vendor_number").agg(
        F.sum("invoice_amount_excl_tax").alias("spend"),
        F.sum("payment_amount").alias("paid"),
        # a month that does not begin on the first has days of two calendar months
        F.min(F.trunc("invoice_date", "month")).alias("earlier"),
        F.max(F.trunc("invoice_date", "month")).alias("later"),
    )


def _orders(rows: DataFrame) -> DataFrame:
    """Order spend fans out over lines; smallest day and largest spend merge exactly."""
    return rows.groupBy(MONTH, "vendor_number", "po_number").agg(
        F.min("po_date").alias("po_date"), F.max("po_spend").alias("po_spend")
    )


class FeatureState:
    """Partial results of the features by month, under ``path``."""

    def __init__(self, spark: SparkSession, path: str, like: DataFrame, as_of: date):
        self._day = as_of.day
        self._dictionary: DataFrame | None = None
        empty = {
            "amounts": _amounts(self._dated(like.limit(0), "invoice_date", as_of)),
            "orders": _orders(self._dated(like.limit(0), "po_date", as_of)),
            "bitmaps": _bitmaps(
                self._dated(like.limit(0), "invoice_date", as_of).withColumn(
                    "number", F.lit(None).cast("long")
                )
            ),
        }
        partial = {"amounts": _amounts, "orders": _orders, "bitmaps": _bitmaps}
        self._states = {
            name: MonthlyState(spark, f"{path}/{name}", partial[name], empty[name].schema)
            for name in partial
        }

    @staticmethod
    def _dated(rows: DataFrame, day: str, as_of: date) -> DataFrame:
        return rows.where("vendor_number IS NOT NULL").withColumn(
            MONTH, anchored_month(F.col(day), as_of)
        )

    def advance(self, rows: DataFrame, as_of: date) -> dict[str, list[str]]:
        """Bring the state to ``as_of`` from ``rows`` of ``base_transaction``.

        Returns the months read. Rows without a date are read on every run, as they may get one.
        """
        if as_of.day != self._day:
            raise ValueError(f"this state's months begin on day {self._day}")
        invoices = self._dated(rows, "invoice_date", as_of)
        self._dictionary = pin(extend_dictionary(self._dictionary, invoices), "dictionary")
        numbered = invoices.join(self._dictionary, ["vendor_number", "invoice_id"], "left")
        sources = {
            "amounts": invoices,
            "orders": self._dated(rows, "po_date", as_of),
            "bitmaps": numbered,
        }
        return {
            name: state.advance(sources[name], as_of, UNDATED, again=[UNDATED]).read
            for name, state in self._states.items()
        }

    def features(self, as_of: date, like: DataFrame) -> DataFrame:
        """The features as of ``as_of``, with the columns and types of ``like``."""
        first = {w: UNDATED if m is None else month_back(as_of, m) for w, m in WINDOWS.items()}

        def inside(w: str) -> Column:
            return F.col(MONTH) >= first[w]

        amounts = self._states["amounts"].rows(UNDATED)
        sums = amounts.groupBy("vendor_number").agg(
            *[F.sum(F.when(inside(w), F.col("spend"))).alias(f"total_invoice_spend_{w}") for w in WINDOWS],
            *[F.sum(F.when(inside(w), F.col("paid"))).alias(f"total_payment_amount_{w}") for w in WINDOWS],
        )
        active = (
            amounts.select(MONTH, "vendor_number", F.explode(F.array("earlier", "later")).alias("_month"))
            .where("_month IS NOT NULL")
            .groupBy("vendor_number", "_month")
            .agg(F.max(MONTH).alias(MONTH))
            .groupBy("vendor_number")
            .agg(*[F.count_if(inside(w)).alias(f"vendor_active_months_{w}") for w in WINDOWS])
        )
        bits = {"invoice_count": "invoices", "paid_invoice_count": "paid"}
        counts = (
            self._states["bitmaps"]
            .rows(UNDATED)
            .groupBy("vendor_number", "part")
            .agg(
                *[
                    F.bitmap_count(F.bitmap_or_agg(F.when(inside(w), F.col(source)))).alias(f"{name}_{w}")
                    for name, source in bits.items()
                    for w in WINDOWS
                ]
            )
            .groupBy("vendor_number")
            .agg(*[F.sum(f"{name}_{w}").alias(f"{name}_{w}") for name in bits for w in WINDOWS])
        )
        orders = (
            self._states["orders"]
            .rows(UNDATED)
            .groupBy("vendor_number", "po_number")
            .agg(F.min("po_date").alias("po_date"), F.max("po_spend").alias("po_spend"))
        )

        def ordered(w: str) -> Column:
            months = WINDOWS[w]
            return F.lit(True) if months is None else F.col("po_date") >= months_before(as_of, months)

        spend = orders.groupBy("vendor_number").agg(
            *[F.sum(F.when(ordered(w), F.col("po_spend"))).alias(f"total_po_spend_{w}") for w in WINDOWS],
            *[F.count(F.when(ordered(w), F.col("po_number"))).alias(f"po_count_{w}") for w in WINDOWS],
        )
        whole = spend
        for part in (sums, active, counts):
            whole = whole.join(part, "vendor_number", "left")
        kinds = {f: like.schema[f].dataType for f in FEATURES}
        return whole.select(
            "vendor_number",
            *[
                F.coalesce(F.col(f).cast(kinds[f]), F.lit(0).cast(kinds[f])).alias(f)
                for f in FEATURES
            ],
        )


def vendor_windowed_features_monthly(book: AuditBook) -> DataFrame:
    """``vendor_windowed_features`` by two monthly runs; equal to its full rebuild."""
    rows, today = book.table("base_transaction"), book.local_today

    def build() -> FeatureState:
        state = FeatureState(book.spark, book.place("feature-state"), rows, today)
        before = book.spark.range(1).select(months_before(today, 1)).head()[0]
        for day in (before, today):
            state.advance(rows, day)
        return state

    state = book.once("feature_state", build)
    return state.features(today, vendor_windowed_features(book))
