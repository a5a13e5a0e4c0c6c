"""Queries over the given tables, one or more per operator."""

from feedloom.registry import (  # noqa: F401  (each module registers its queries)
    grouping,
    joining,
    loading,
    nesting,
    pipelines,
    scalars,
    shaping,
    sourcing,
    streams,
)
from feedloom.registry import loads  # noqa: E402, F401  (builds on the others' SQL)
from feedloom.registry.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
