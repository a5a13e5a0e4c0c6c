"""Dimension replication."""

from __future__ import annotations

from pyspark.sql import DataFrame

from feedloom.operators.headers import canonical_headers
from feedloom.sinks import append, fan_out

# Fixed value: rows per file of the copied dimension.
COPY_ROWS = 100_000


def replicate(dim: DataFrame, paths: list[str], mode: str = "refresh") -> list[DataFrame]:
    """Copy a dimension to every target.

    ``mode="append"`` adds a copy on each run, as the feeds' own jobs do, and so doubles
    the rows of a target that is not emptied first.
    """
    if mode == "refresh":
        return fan_out(dim, paths)
    return [append(canonical_headers(dim, "upper"), path, COPY_ROWS) for path in paths]
