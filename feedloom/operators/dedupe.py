"""Duplicates.

Keeping one row per key is an aggregate here, not a numbered window: each task
first reduces its own rows to one per key, so a key that holds a third of the
table costs no more to move than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import digits
from feedloom.operators.filters import drop_blank_keys


def _keep_one(
    df: DataFrame, key: Sequence[str] | Column, order: Sequence[str | Column], pick
) -> DataFrame:
    # A key that is a plain column need not travel a second time inside the row.
    plain = [] if isinstance(key, Column) else list(key)
    groups = [key.alias("_key")] if isinstance(key, Column) else plain
    rest = [c for c in df.columns if c not in plain]
    rank = F.struct(*order)
    kept = df.groupBy(*groups).agg(pick(F.struct(*rest), rank).alias("_row"))
    return kept.select(*plain, "_row.*").select(*df.columns)


def dedupe_first(
    df: DataFrame, key: Sequence[str] | Column, order: Sequence[str | Column]
) -> DataFrame:
    """One row per key: the lowest by ``order``, which must tell all rows of a key apart."""
    return _keep_one(df, key, order, F.min_by)


def dedupe_last(
    df: DataFrame, key: Sequence[str] | Column, order: Sequence[str | Column]
) -> DataFrame:
    """One row per key: the highest by ``order``, which must tell all rows of a key apart."""
    return _keep_one(df, key, order, F.max_by)


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def distinct_keys(
    df: DataFrame, column: str, clean=digits, sentinels: Sequence[str] = ("-1",)
) -> DataFrame:
    """The distinct keys left after cleaning and after dropping blanks."""
    keys = df.select(clean(column).alias(column))
    return drop_blank_keys(keys, column, sentinels).distinct()
