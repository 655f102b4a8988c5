"""Registered queries, each with the SQL that must give the same rows."""

from importlib import import_module

SECTIONS = [
    "sources", "scalars", "filtering", "joining", "reporting", "longitudinal", "risk", "modelling",
]


def load():
    """Import all sections and return the book they registered in."""
    for name in SECTIONS:
        import_module(f"keptvisit.queries.{name}")
    return import_module("keptvisit.queries.book")
