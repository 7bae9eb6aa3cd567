"""Every operator as a named query over the given tables, with the SQL that must agree with it."""

from __future__ import annotations

from importlib import import_module

from veriloom.catalog.registry import ORACLES, QUERIES

SUBJECTS = ("ingest", "quality", "marts", "kpi", "fraud", "series", "forecast", "queue", "audit", "reconcile",
            "anomaly", "streams", "edges")


def load() -> None:
    for subject in SUBJECTS:
        import_module(f"veriloom.catalog.{subject}")


__all__ = ["ORACLES", "QUERIES", "load"]
