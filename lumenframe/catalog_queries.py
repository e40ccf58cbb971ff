"""All catalog queries with their SQL: importing the modules of ``plans`` registers them."""

from __future__ import annotations

from lumenframe.plans import ORACLE_SQL, QUERIES, gating, linking, monitoring, running, scanning, selection, tallies, validation, volumes

__all__ = ["ORACLE_SQL", "QUERIES", "gating", "linking", "monitoring", "running", "scanning", "selection", "tallies", "validation", "volumes"]
