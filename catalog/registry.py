"""All registered queries."""

from __future__ import annotations

import importlib

from catalog.query import Query

_MODULES = ["star", "rules", "analyses", "platform", "streams"]

QUERIES: dict[str, Query] = {}
for _name in _MODULES:
    QUERIES.update(importlib.import_module(f"catalog.{_name}").QUERIES)
