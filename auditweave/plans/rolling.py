"""Rolling views kept as partial results by month.

A full rebuild of a 24-month view reads 24 months of its source on every run. Here each month
leaves a partial result in a fact table, from which the view follows by a further sum. A run
reads only the months that are new, or were still open when they were last read; the oldest
month is dropped. The view equals the full rebuild, whatever day of the month the run is as of:
partials keep the days that the bounds of the view are about.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from auditweave.book import AuditBook
from auditweave.functions.anchors import months_before
from auditweave.functions.keys import erp_date
from auditweave.plans import conformed
from auditweave.plans.scope import COMPANY
from auditweave.sources.facts import FactTable
from auditweave.sources.shelf import COMPACT, shelf_of

MONTH = "month"
#: A month whose rows have been dropped counts as never read.
NEVER = date(1900, 1, 1)


def month_of(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def month_back(day: date, months: int) -> str:
    """The month ``months`` before that of ``day``."""
    at = day.year * 12 + day.month - 1 - months
    return f"{at // 12:04d}-{at % 12 + 1:02d}"


def land_by_month(rows: DataFrame, month: Column, path: str) -> DataFrame:
    """Write ``rows`` partitioned by month; rows without one go to a month of their own.

    ``rebalance`` splits a month with many rows over several tasks and files; its shuffle files
    go when the table is written.
    """
    placed = rows.withColumn(MONTH, F.coalesce(month, F.lit("none")))
    with shelf_of(rows.sparkSession).cleaning():
        placed.hint("rebalance", MONTH).write.options(**COMPACT).partitionBy(MONTH).parquet(path)
    schema = StructType([*rows.schema.fields, *placed.schema[-1:]])
    return rows.sparkSession.read.schema(schema).parquet(path)


@dataclass
class Advance:
    """What a run did: the months that it read, and those that it dropped."""

    read: list[str] = field(default_factory=list)
    dropped: list[str] = field(default_factory=list)


class MonthlyState:
    """Partial results by month: ``partial`` turns source rows into them.

    ``partial`` must keep the column ``month``, and its result for some months must not depend on
    rows of others.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        partial: Callable[[DataFrame], DataFrame],
        schema: StructType,
    ):
        self._partial = partial
        self.facts = FactTable(spark, path, schema, MONTH)

    def _known(self) -> dict[str, date]:
        """As of which day each month was last read; one row per month."""
        try:
            return {r[MONTH]: r.as_of for r in self.facts.refreshed().collect()}
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":  # the first run
                return {}
            raise

    def advance(
        self, source: DataFrame, as_of: date, first: str, again: Iterable[str] = ()
    ) -> Advance:
        """Bring the state to ``as_of``; months before ``first`` are dropped.

        Read are months that were never read or that had not ended by the day they were read,
        and those in ``again``, for rows that came late into a month already ended. The months
        of ``source`` are its partitions: finding them reads no rows.
        """
        known = self._known()
        found = {r[MONTH] for r in source.select(MONTH).distinct().collect()}
        stale = sorted(
            m for m in found | set(known)
            if first <= m <= "9999-12" and (m in again or not _ended(m, known.get(m, NEVER)))
        )
        gone = sorted(m for m, day in known.items() if m < first and day > NEVER)
        if stale:
            rows = source.where(F.col(MONTH).isin(stale))
            self.facts.replace(self._partial(rows), stale, as_of)
        if gone:
            self.facts.replace(self.facts.rows().limit(0), gone, NEVER)
        return Advance(stale, gone)

    def rows(self, first: str) -> DataFrame:
        return self.facts.rows().where(F.col(MONTH) >= first)


def _ended(month: str, as_of: date) -> bool:
    return as_of.strftime("%Y-%m") > month


# --- payments ---------------------------------------------------------------------------


def payment_month(document_date: str = "h_document_date") -> Column:
    """The month of the later of a line's two dates: the last one by which a look-back bound
    on either date can let the line in."""
    return month_of(F.greatest(erp_date(document_date), F.col("h_posting_date").cast("date")))


#: What the partial results and the month of a ledger line are made of.
PAYMENT_COLUMNS = [
    "h_company_code",
    "h_document_type",
    *conformed.LINE_KEY,
    "h_document_date",
    "h_posting_date",
    "d_vendor",
    "d_gl_account",
    "d_amount_in_lc",
    "d_shkzg_debit_credit_ind",
    "d_clearing",
    "d_clrng_doc",
]


def _payment_partial(rows: DataFrame) -> DataFrame:
    """Distinct payment lines of each month, apart for either branch of the view.

    The branch by vendor needs no document number, the branch by document keeps the latest
    posting day, which alone decides whether any of the equal lines is inside the bound.
    """
    lines = rows.where(
        F.col("h_document_type").isin(conformed.PAYMENT_DOCS) & (F.col("h_company_code") == COMPANY)
    ).select(
        MONTH,
        *conformed.payment_shape(),
        "h_document_number",
        "d_buzei_line_item",
        F.col("h_posting_date").cast("date").alias("posted"),
        (F.col("d_clearing") != conformed.UNCLEARED).alias("cleared"),
    )
    shape = [c for c in lines.columns if c not in (*conformed.LINE_KEY, "posted", "cleared")]
    by_vendor = (
        lines.where("d_vendor IS NOT NULL AND payment_date IS NOT NULL").select(*shape).distinct()
    )
    by_document = lines.where("cleared AND posted IS NOT NULL").groupBy(*shape, *conformed.LINE_KEY)
    return by_vendor.withColumn("branch", F.lit("vendor")).unionByName(
        by_document.agg(F.max("posted").alias("posted")).withColumn("branch", F.lit("document")),
        allowMissingColumns=True,
    )


def payment_state(spark: SparkSession, ledger: DataFrame, path: str) -> MonthlyState:
    schema = _payment_partial(ledger.limit(0)).schema
    return MonthlyState(spark, path, _payment_partial, schema)


def payments_of(book: AuditBook, state: MonthlyState) -> DataFrame:
    """``base_payment`` from the state, as of the book's day."""
    start = months_before(book.today, 24)
    rows = state.rows(month_back(book.today, 24))
    by_vendor = rows.where((F.col("branch") == "vendor") & (F.col("payment_date") >= start))
    by_document = rows.where((F.col("branch") == "document") & (F.col("posted") > start))
    return conformed.payments_from(book, by_vendor, by_document)


# --- orders -----------------------------------------------------------------------------


def _order_partial(rows: DataFrame) -> DataFrame:
    """Orders of each month summed before any look-up: sums of sums give the view."""
    lines = conformed.order_lines(rows.where(F.col("purchasing_organization") == COMPANY), MONTH)
    return lines.groupBy(
        MONTH, "purchasing_document_number", "line_vendor", "purchasing_document_date", "document_currency"
    ).agg(*conformed.order_sums("gross_order_value", "net_order_value"))


def order_state(spark: SparkSession, lines: DataFrame, path: str) -> MonthlyState:
    return MonthlyState(spark, path, _order_partial, _order_partial(lines.limit(0)).schema)


def orders_of(book: AuditBook, state: MonthlyState) -> DataFrame:
    """``sap_po`` from the state, as of the book's day."""
    rows = state.rows(month_back(book.today, 24)).where(
        F.col("purchasing_document_date") >= months_before(book.today, 24)
    )
    return conformed.orders_from(book, rows, "po_amount_gross", "po_amount_net")


# --- plans ------------------------------------------------------------------------------


def _rolled(book: AuditBook, name: str, source: DataFrame, month: Column, open_state, view):
    """The view after a first run as of a month ago and one as of the book's day."""

    def build() -> tuple[MonthlyState, list[Advance]]:
        landed = land_by_month(source, month, book.place(f"{name}-by-month"))
        state = open_state(book.spark, landed, book.place(f"{name}-state"))
        before = book.spark.range(1).select(months_before(book.today, 1)).head()[0]
        runs = [
            state.advance(landed, day, month_back(day, 24))
            for day in (before, book.today)
        ]
        return state, runs

    return view(book, book.once(name, build)[0])


def base_payment_rolling(book: AuditBook) -> DataFrame:
    """``base_payment`` by two monthly runs; equal to its full rebuild."""
    lines = book.src.ledger.select(*PAYMENT_COLUMNS)
    return _rolled(book, "payments", lines, payment_month(), payment_state, payments_of)


def sap_po_rolling(book: AuditBook) -> DataFrame:
    """``sap_po`` by two monthly runs; equal to its full rebuild."""
    day = month_of(F.col("purchasing_document_date"))
    return _rolled(book, "orders", book.src.po_schedule_line, day, order_state, orders_of)
