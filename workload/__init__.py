"""The operators applied to the supplied tables, each with the SQL that must give the same rows."""

from __future__ import annotations

import importlib

MODULES = ("sources", "projections", "joins", "aggregates", "dimensions", "learning", "forecasting")


def load_all() -> None:
    """Import every module that registers queries."""
    for name in MODULES:
        importlib.import_module(f"workload.{name}")
