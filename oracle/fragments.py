"""Pieces of SQL text the statements share, and the WITH chain builder."""

from __future__ import annotations

import re

_NAME = re.compile(r"{(\w+)}")

# The sample data ends on this day; look-back bounds are written out.
TODAY = "DATE '2001-08-01'"
MONTHS_24 = "DATE '1999-08-01'"
MONTHS_12 = "DATE '2000-08-01'"
MONTHS_6 = "DATE '2001-02-01'"
MONTHS_3 = "DATE '2001-05-01'"

_SPANS = {
    "last_week": ("DATE '2001-07-25'", TODAY),
    "last_month": ("DATE '2001-07-01'", TODAY),
    "last_90_days": ("DATE '2001-05-03'", TODAY),
    "last_180_days": ("DATE '2001-02-02'", TODAY),
    "last_year": (MONTHS_12, TODAY),
}
_PRIOR = {
    "standard": (MONTHS_24, MONTHS_12),
    "cumulative": (MONTHS_24, TODAY),
    "same_as_last_year": (MONTHS_12, TODAY),
}


def flags(day: str, prior: str = "standard") -> str:
    spans = dict(_SPANS)
    if prior != "never":
        spans["last_last_year"] = _PRIOR[prior]
    parts = [
        f"CASE WHEN {day} BETWEEN {low} AND {high} THEN 'Y' ELSE 'N' END AS {name}"
        for name, (low, high) in spans.items()
    ]
    if prior == "never":
        parts.append("'N' AS last_last_year")
    return ", ".join(parts)


def labels(category: str, description: str, metric: str, unit: str = "Count") -> str:
    texts = zip(
        ("routine_category", "routine_description", "metric_description", "metric_unit"),
        (category, description, metric, unit),
    )
    return ", ".join(f"'{text}' AS {name}" for name, text in texts)


def with_chain(name: str, definitions: dict[str, str]) -> str:
    """One statement for ``name``; every relation it needs becomes a CTE, inputs first."""
    ordered: list[str] = []

    def visit(node: str) -> None:
        for dep in _NAME.findall(definitions[node]):
            if dep in definitions and dep not in ordered:
                visit(dep)
        if node not in ordered:
            ordered.append(node)

    visit(name)
    body = {n: _NAME.sub(lambda m: m.group(1), definitions[n]).strip() for n in ordered}
    ctes = ",\n".join(f"{n} AS (\n{body[n]}\n)" for n in ordered[:-1])
    return (f"WITH {ctes}\n" if ctes else "") + body[name]
