"""Named queries over the given tables, each with its SQL where SQL can say it."""

from tallyloom.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "load_all"]


def load_all() -> None:
    """Import the modules that register queries."""
    from tallyloom.catalog import access, basics, custom, entities, recommend, texts  # noqa: F401
