"""Registered queries over the driver tables."""

from importlib import import_module

PARTS = ["event_queries", "structure_queries", "join_queries", "group_queries", "sequence_queries", "statistics_queries", "reader_queries"]


def load() -> None:
    for part in PARTS:
        import_module(f"spliceloom.plans.{part}")
