"""Every operator as a query over the test tables, with an independent SQL statement of the result."""

from __future__ import annotations

from importlib import import_module

MODULES = ("profiles", "display", "variables", "discovery", "models", "checks")


def all_queries() -> dict:
    """{name: (function of (spark, sf_dir), SQL or None)}"""
    out = {}
    for name in MODULES:
        out.update(import_module(f"showcase.{name}").QUERIES)
    return out
