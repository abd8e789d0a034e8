"""auditweave: procure-to-pay audit analytics expressed as Spark DataFrame plans."""

from auditweave.book import AuditBook
from auditweave.functions.anchors import Anchors
from auditweave.sources.catalog import Sources

__all__ = ["Anchors", "AuditBook", "Sources"]
