"""Registered queries.  Importing this package fills REGISTRY."""

from recspark.plans.registry import REGISTRY, Query, register  # noqa: F401
from recspark.plans import core, basic, profiling, models, tuning, streams  # noqa: F401

__all__ = ["REGISTRY", "Query", "register"]
