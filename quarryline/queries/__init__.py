"""Named queries over the test tables."""

from __future__ import annotations

import importlib

MODULES = (
    "tables",
    "profiling",
    "evaluation",
    "trials",
    "registry",
    "features",
    "search",
    "models",
)


def load_all() -> None:
    """Import every query module, which registers its queries."""
    for module in MODULES:
        importlib.import_module(f"{__name__}.{module}")
