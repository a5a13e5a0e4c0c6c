"""Membership shop: nested orders and users to flat tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from feedloom.functions import json_text
from feedloom.operators.headers import canonical_headers
from feedloom.operators.nested import first_of, flatten_structs, last_of
from feedloom.operators.shape import quoted
from feedloom.specs import shop

OPENERS = {"first": first_of, "last": last_of}


def _open_lists(df: DataFrame, lists: Sequence[tuple[str, str, str]]) -> DataFrame:
    flat = flatten_structs(df)
    for column, prefix, element in lists:
        flat = OPENERS[element](flat, column, prefix)
    return flat


def _lists_as_json(df: DataFrame) -> DataFrame:
    """Lists that are left over become JSON text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    texts = {f.name: json_text(quoted(f.name)) for f in df.schema.fields if isinstance(f.dataType, nested)}
    return df.withColumns(texts) if texts else df


def shop_orders(df: DataFrame) -> DataFrame:
    return canonical_headers(_lists_as_json(_open_lists(df, shop.ORDER_LISTS)), "json")


def shop_users(df: DataFrame) -> DataFrame:
    return canonical_headers(_open_lists(df, shop.USER_LISTS), "json_user")
