"""Importing this module registers every query."""

from larkspur.plans import (  # noqa: F401
    projections,
    joins,
    aggregates,
    ordering,
    texts,
    vectors,
    files,
    evaluation,
    features,
    models,
)
from larkspur.plans.registry import ORACLES, QUERIES  # noqa: F401
