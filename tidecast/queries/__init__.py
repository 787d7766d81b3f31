"""All registered queries, in the order of the operator inventory."""

from __future__ import annotations

import importlib

from tidecast.queries.base import REGISTRY, Lab, Query

_MODULES = [
    "reports", "projections", "joins", "aggregates", "functions", "tables", "learning", "checks",
]

for _name in _MODULES:
    importlib.import_module(f"tidecast.queries.{_name}")

__all__ = ["REGISTRY", "Lab", "Query"]
