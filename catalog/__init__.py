"""Registered queries over the given tables."""

from __future__ import annotations


def load():
    """All queries and SQL twins, registered by importing the topic modules."""
    from catalog import backtests, base, business, checks, files, fits, learned, panels, sales  # noqa: F401

    return base.QUERIES, base.ORACLES
