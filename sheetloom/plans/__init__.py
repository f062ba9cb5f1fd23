"""Inputs, queries and whole runs."""

from types import ModuleType


def load_registry() -> ModuleType:
    """The registry with every query module imported."""
    from sheetloom.plans import clean_queries, grid_queries, merge_queries  # noqa: F401
    from sheetloom.plans import registry, report_queries, requirement_queries, stream_queries  # noqa: F401

    return registry
