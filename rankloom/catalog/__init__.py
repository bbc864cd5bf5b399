"""Queries over the driver's tables, one or more per operator."""

from importlib import import_module

MODULES = ("sources", "cleaning", "links", "summaries", "rating", "similarity", "streams")


def load():
    """Import every query module and return the registry."""
    for name in MODULES:
        import_module(f"rankloom.catalog.{name}")
    return import_module("rankloom.catalog.base")
