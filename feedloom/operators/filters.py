"""Row filters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import contains_norm, map_value

# What a person erased for privacy looks like.
ERASED_EMAIL = "EXCLUIDO@EXCLUIDO.COM"
ERASED_NAME = "PRIVACIDADE EXCLUIDO"


def filter_contains(df: DataFrame, column: str, token: str) -> DataFrame:
    return df.where(contains_norm(column, token))


def exclude_patterns(
    df: DataFrame, patterns: Mapping[str, str], values: Mapping[str, str] | None = None
) -> DataFrame:
    """Drop rows equal to a value or matching a pattern; null subjects stay."""
    # One pattern per column, so that a computed column is worked out once for the test.
    excluded = {name: [pattern] for name, pattern in patterns.items()}
    for name, value in (values or {}).items():
        excluded.setdefault(name, []).append(f"^\\Q{value}\\E\\z")
    for name, alternatives in excluded.items():
        df = df.where(~F.coalesce(F.col(name).rlike("|".join(alternatives)), F.lit(False)))
    return df


def exclude_ilike(df: DataFrame, column: str, patterns: Iterable[str]) -> DataFrame:
    """``NOT ILIKE`` for every pattern; null subjects are dropped, as in SQL."""
    for pattern in patterns:
        df = df.where(~F.col(column).ilike(pattern))
    return df


def exclude_values(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    """``NOT IN`` a literal list; null subjects are dropped, as in SQL."""
    return df.where(~F.col(column).isin(*values))


def keep_ids(df: DataFrame, column: str, ids: Sequence[object] | DataFrame) -> DataFrame:
    """Rows whose id is listed; a table of ids is joined, never collected."""
    if isinstance(ids, DataFrame):
        return df.join(ids.select(F.col(ids.columns[0]).alias(column)), column, "left_semi")
    return df.where(F.col(column).isin(*ids))


def drop_blank_keys(df: DataFrame, column: str, sentinels: Sequence[str] = ("-1",)) -> DataFrame:
    key = F.col(column)
    return df.where(key.isNotNull() & ~key.isin("", *sentinels))


def map_and_keep(
    df: DataFrame, column: str, mapping: Mapping[str, str], default: str, keep: str
) -> DataFrame:
    """Replace the status by its code and keep one code."""
    code = map_value(F.upper(F.col(column)), mapping, default)
    return df.withColumn(column, code).where(F.col(column) == keep)


def drop_erased(df: DataFrame, email: str = "email", name: str = "nome") -> DataFrame:
    erased: Column = (F.col(email) == ERASED_EMAIL) | (F.col(name) == ERASED_NAME)
    return df.where(~F.coalesce(erased, F.lit(False)))


def related_to(df: DataFrame, base_column: str, base_id: object) -> DataFrame:
    return df.where(F.col(base_column) == F.lit(base_id))
