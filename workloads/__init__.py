"""Queries over the given tables, one module per operator family."""

from importlib import import_module

MODULES = (
    "fields",
    "sources",
    "changes",
    "sinks",
    "functions",
    "flows",
)


def load_all() -> None:
    """Import every family, which registers its queries."""
    for name in MODULES:
        import_module(f"workloads.{name}")
