"""E-commerce exports: typed and renamed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from feedloom.operators.headers import STYLES, canonical_headers, rename_map
from feedloom.operators.shape import TableSpec, apply_spec, stack_frames
from feedloom.sources import read_delimited
from feedloom.specs.ecommerce import CUSTOMERS, ORDERS


def read_exports(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Export files stacked; each may have its own columns."""
    return stack_frames(*[read_delimited(spark, path) for path in paths])


def _typed(df: DataFrame, spec: TableSpec, style: str) -> DataFrame:
    names = {STYLES[style](field.source): field.target for field in spec.fields}
    return rename_map(canonical_headers(apply_spec(df, spec), style), names)


def ecommerce_orders(df: DataFrame) -> DataFrame:
    return _typed(df, ORDERS, "csv")


def ecommerce_customers(df: DataFrame) -> DataFrame:
    return _typed(df, CUSTOMERS, "csv_plain")
