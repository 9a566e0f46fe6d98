"""Every operator on the generated tables, each with the same result stated in SQL.

Conditions on keys give the rows of a table their roles - target or source, known
or unknown, loaded before or arriving now.  Between the roles every row is used.
"""

from __future__ import annotations

import importlib

from cases.base import CASES

for _module in ("lookups", "keyed", "merges", "files", "members", "cash_sales", "feeds", "loyalty", "quality", "storage", "jobs"):
    importlib.import_module(f"cases.{_module}")

__all__ = ["CASES"]
