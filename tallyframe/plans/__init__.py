"""Operators bound to tables, as named queries."""

from importlib import import_module

from . import base

MODULES = [
    "voting", "layouts", "conflicts", "merging", "comparing", "auditing", "outlines", "normalising", "captures", "streams", "files",
]


def _load():
    for name in MODULES:
        import_module(f"{__name__}.{name}")


def all_queries():
    _load()
    return dict(base.QUERIES)


def all_oracles():
    _load()
    return dict(base.ORACLES)
