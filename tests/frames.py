"""Helpers of the tests."""

from __future__ import annotations


def rows(df, *columns):
    """Sorted row tuples."""
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())
