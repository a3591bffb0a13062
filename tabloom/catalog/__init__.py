"""Queries over the driver tables, each with the SQL it must agree with."""

from __future__ import annotations

from importlib import import_module

from tabloom.catalog.base import ORACLE, QUERIES

MODULES = ("sources", "rows", "stats", "encodings", "ranks", "scores", "training", "sets")


def load() -> None:
    """Import every module, which registers its queries."""
    for name in MODULES:
        import_module(f"tabloom.catalog.{name}")


__all__ = ["ORACLE", "QUERIES", "load"]
