"""Registered queries: importing this package fills the registry."""

from weirworks.plans import (  # noqa: F401
    aggregates,
    analytic,
    joins,
    patterns,
    projections,
    rankings,
    sources,
    state,
    triggers,
    windowing,
)
from weirworks.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
