"""Named queries over the given tables, each beside the SQL that checks it."""

from __future__ import annotations

import importlib
import pkgutil

from alertweave.plans.registry import QUERIES, Query

_SHARED = {"registry", "sql", "fixtures"}


def load() -> dict[str, Query]:
    """Import every plan module and return the registered queries."""
    for module in sorted(m.name for m in pkgutil.iter_modules(__path__)):
        if module not in _SHARED:
            importlib.import_module(f"{__name__}.{module}")
    return QUERIES
