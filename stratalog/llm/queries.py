"""All queries of the subpackage and their SQL."""

from __future__ import annotations

from importlib import import_module

MODULES = ["seen", "ledger", "listings", "encoding", "names", "packing", "mixing", "sentences"]

QUERIES: dict = {}
SQL: dict = {}
for _m in MODULES:
    _x = import_module(f"stratalog.llm.{_m}")
    QUERIES |= _x.QUERIES
    SQL |= _x.SQL
