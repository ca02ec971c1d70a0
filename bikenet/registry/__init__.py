"""Named queries over the driver's tables, each with the SQL it is checked against."""

from __future__ import annotations

from importlib import import_module
from types import ModuleType

_GROUPS = ("cleaning_queries", "serving_queries", "spatial_queries", "layer_queries")


def load() -> ModuleType:
    """The registry with all query groups registered."""
    for group in _GROUPS:
        import_module(f"{__name__}.{group}")
    return import_module(f"{__name__}.core")
