"""The audit book: sources, the run's anchors and every plan built on them, by name."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from auditweave.functions.anchors import Anchors
from auditweave.operators.measure import Meter, NoMeter
from auditweave.sources.catalog import Sources
from auditweave.sources.shelf import shelf_of

# Plans that several others read. Their readers share one written table, as an audit run
# would keep them; asked for by name they are plans like any other.
SHARED = (
    "addressable_vendors",
    "ariba_po_invoice",
    "base_payment",
    "sap_invoices",
    "sap_po",
    "maximo_po",
    "ordered_requisitions",
    "first_approvers",
    "final_approver",
    "base_transaction",
    "vendor_windowed_features",
    "vendor_attributes",
    "vendor_employee_same_bank",
)


class AuditBook:
    def __init__(
        self,
        sources: Sources,
        anchors: Anchors | None = None,
        tag: str | None = None,
        exempt_vendors: tuple[str, ...] = (),
        automation_users: tuple[str, ...] = (),
        meter: Meter | NoMeter | None = None,
    ):
        """``tag`` names the sources' content; books with equal tag, anchors and parameters
        share their written tables. Without a tag a book shares with no other.

        ``exempt_vendors`` are ids whose repeated order amounts are expected.
        ``automation_users`` are parts of user names under which software keys invoices.
        ``meter`` counts rows on the way; a book with one should have no tag, as a table that
        is shared is not written, and so not counted, again.
        """
        self.src = sources
        self.anchors = anchors or Anchors.now()
        self.exempt_vendors = tuple(exempt_vendors)
        self.automation_users = tuple(automation_users)
        self.meter = meter or NoMeter()
        self._tag = (tag or uuid.uuid4().hex, self.exempt_vendors, self.automation_users)
        self._kept: dict[str, DataFrame] = {}

    @property
    def today(self):
        return self.anchors.today

    @property
    def local_today(self):
        return self.anchors.local_today

    def plan(self, name: str) -> DataFrame:
        """The named plan. Building it may already run jobs: what a plan reads several times
        is written first, on every call."""
        from auditweave.plans.registry import PLANS

        return PLANS[name](self)

    def store(self, name: str, df: DataFrame) -> None:
        """Use ``df`` wherever another plan reads ``name``."""
        self._kept[name] = df

    def table(self, name: str) -> DataFrame:
        """The named plan as an input of another plan."""
        if name not in self._kept:
            if name in SHARED:
                self._kept[name] = self._shared(name)
            else:
                # other plans may read it later, with what it has written
                with shelf_of(self.spark).lasting():
                    self._kept[name] = self.plan(name)
        return self._kept[name]

    def once_over(self, name: str) -> DataFrame:
        """The named plan for one reader; it is not kept unless it is shared or stored."""
        return self.table(name) if name in SHARED or name in self._kept else self.plan(name)

    @property
    def spark(self) -> SparkSession:
        # a thread of its own has no active session; the application's is the same one
        return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()

    def _shared(self, name: str) -> DataFrame:
        key = (self._tag, self.anchors, name)
        return shelf_of(self.spark).keep(key, lambda: self.plan(name))

    def place(self, name: str) -> str:
        """A new folder for a table that a plan writes itself."""
        return shelf_of(self.spark).place(name)

    def once(self, name: str, build):
        """What ``build`` returns; books that share their written tables share it too."""
        return shelf_of(self.spark).hold((self._tag, self.anchors, "once", name), build)
