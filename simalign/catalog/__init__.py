"""All registered queries."""

import importlib

from simalign.catalog.base import QUERIES, Query

for _module in ("corpus", "text", "neighbours", "lsh", "series", "models", "stems"):
    importlib.import_module(f"simalign.catalog.{_module}")

__all__ = ["QUERIES", "Query"]
