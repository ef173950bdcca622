"""Queries over the given tables, one or more per operator."""

from importlib import import_module

MODULES = ("sources_sinks", "scalars", "joins", "aggregates", "windows", "ordering", "learning", "streams")


def load_all() -> None:
    for name in MODULES:
        import_module(f"leadtime.checks.{name}")
