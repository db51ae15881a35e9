"""Registered queries, grouped by theme, each with an oracle where SQL can express it."""

from importlib import import_module

MODULES = ("relational", "aggregates", "scalars", "cleaning", "storage", "streams", "learning", "layout")


def load_all() -> None:
    """Import every plan module, which registers its queries."""
    for module in MODULES:
        import_module(f"tidewater.plans.{module}")
