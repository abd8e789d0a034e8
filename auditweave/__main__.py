"""``python -m auditweave --sources DIR --out DIR``: run the audit over stored extracts."""

from __future__ import annotations

import argparse
import json
from datetime import date

from auditweave import session
from auditweave.book import AuditBook
from auditweave.functions.anchors import Anchors
from auditweave.plans.runner import run_audit
from auditweave.sources.catalog import Sources
from auditweave.sources.schemas import LAYOUTS


def main() -> None:
    parser = argparse.ArgumentParser(prog="auditweave")
    parser.add_argument("--sources", required=True, help="folder with one folder per source")
    parser.add_argument("--out", required=True, help="folder for the results")
    parser.add_argument("--format", default="parquet", help="file format of the sources")
    parser.add_argument("--as-of", type=date.fromisoformat, help="look back from this day")
    parser.add_argument("--only", default="", help="comma-separated plan names")
    parser.add_argument("--sort", action="store_true", help="sort reports for reading")
    parser.add_argument("--lenient", action="store_true", help="skip what lacks its sources")
    parser.add_argument("--exempt-vendors", default="", help="comma-separated vendor ids")
    parser.add_argument("--automation-users", default="", help="comma-separated parts of names")
    parser.add_argument("--probe", action="store_true", help="only check the sources")
    args = parser.parse_args()

    spark = session.build("auditweave")
    root = args.sources.rstrip("/")
    sources = Sources.from_paths(spark, {n: f"{root}/{n}" for n in LAYOUTS}, args.format)
    if args.probe:
        print(json.dumps(sources.probe(), indent=1))
        return
    anchors = Anchors.fixed(args.as_of) if args.as_of else Anchors.now()
    names = [n for n in args.only.split(",") if n] or None
    book = AuditBook(
        sources,
        anchors,
        exempt_vendors=tuple(v for v in args.exempt_vendors.split(",") if v),
        automation_users=tuple(u for u in args.automation_users.split(",") if u),
    )
    report = run_audit(spark, book, args.out, names, args.sort, strict=not args.lenient)
    print(json.dumps({"written": report.written, "skipped": report.skipped}, indent=1))
    if report.skipped:
        raise SystemExit(1)


if __name__ == "__main__":
    main()
