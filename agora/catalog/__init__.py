"""Registered queries over the test tables, each with its SQL twin where SQL can express it."""

from agora.catalog.registry import QUERIES, SQL


def load_all():
    """Import every query module; returns the queries and their SQL."""
    from agora.catalog import raw, star, streams, tables, text  # noqa: F401

    return QUERIES, SQL
