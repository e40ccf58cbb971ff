"""Ordered reasons, and rules compiled from a schema."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def reasons(*rules: tuple[Column, Column | str]) -> Column:
    """The reasons whose condition is true, in order; empty when nothing is against."""
    parts = [F.when(c, r if isinstance(r, Column) else F.lit(r)) for c, r in rules]
    return F.filter(F.array(*parts), lambda r: r.isNotNull())


def blocking(found: Column) -> Column:
    """The reasons without the notes, which don't block."""
    return F.filter(found, lambda r: ~F.startswith(r, F.lit("note:")))


def ordered_distinct(*parts: Column) -> Column:
    """Arrays joined, nulls gone, the first of equal entries kept."""
    return F.array_distinct(F.filter(F.concat(*parts), lambda x: x.isNotNull()))


def schema_rules(schema: dict[str, Any], required: Sequence[str] = ()) -> list[tuple[Column, Column | str]]:
    """Rules (condition of the fault, message) of a flat object schema over typed columns. Understands enum,
    pattern, minLength, maxLength, minimum, maximum, minItems, maxItems and format date; ``schema.faults`` is for nested
    documents and their types."""
    out: list[tuple[Column, Column | str]] = []
    for name in required:
        out.append((F.col(name).isNull(), f"<root>: '{name}' is a required property"))
    for name, node in schema.items():
        v = F.col(name)
        if "enum" in node:
            out.append((v.isNotNull() & ~v.isin(list(node["enum"])), F.concat(F.lit(f"{name}: "), v.cast("string"), F.lit(" is not one of the values"))))
        if "pattern" in node:
            out.append((~v.rlike(node["pattern"]), f"{name}: does not match {node['pattern']}"))
        if "minLength" in node:
            out.append((F.char_length(v) < node["minLength"], f"{name}: is too short"))
        if "maxLength" in node:
            out.append((F.char_length(v) > node["maxLength"], f"{name}: is too long"))
        if "minimum" in node:
            out.append((v < node["minimum"], f"{name}: is less than the minimum of {node['minimum']}"))
        if "maximum" in node:
            out.append((v > node["maximum"], f"{name}: is greater than the maximum of {node['maximum']}"))
        if "minItems" in node:
            out.append((v.isNotNull() & (F.size(v) < node["minItems"]), f"{name}: has too few items"))
        if "maxItems" in node:
            out.append((v.isNotNull() & (F.size(v) > node["maxItems"]), f"{name}: has too many items"))
        if node.get("format") == "date":
            out.append((v.isNotNull() & F.try_to_date(v, "yyyy-MM-dd").isNull(), f"{name}: is not a date"))
    return out
