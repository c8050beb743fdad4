"""Whole runs chained from operators, and the registered queries over the driver tables."""

from importlib import import_module

MODULES = ["scalars", "scans", "upkeep", "linking", "enriching", "reporting", "running"]


def load_all() -> None:
    """Import every module that registers queries."""
    for name in MODULES:
        import_module(f"feedloom.plans.{name}")
