"""Registered queries over the driver tables, each with its SQL where there is one."""

from importlib import import_module

MODULES = (
    "cleaning",
    "populations",
    "usage",
    "ranking",
    "priors",
    "encoding",
    "texts",
    "sequences",
    "assembly",
    "learning",
    "bayes",
    "boosted",
    "blocks",
    "routing",
    "tables",
)


def _registry():
    for name in MODULES:
        import_module(f"tallyloom.suite.{name}")
    return import_module("tallyloom.suite.registry")


def all_queries():
    return dict(_registry().QUERIES)


def all_sql():
    return dict(_registry().SQL)
