"""Nested data: structs, arrays of structs, key-value arrays, record lists in page text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions import squash, strip, strip_prefix
from feedloom.operators.shape import quoted


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()):
    for field in schema.fields:
        here = (*path, field.name)
        if isinstance(field.dataType, T.StructType):
            yield from _leaves(field.dataType, here)
        else:
            yield here


def flatten_structs(df: DataFrame, separator: str = ".") -> DataFrame:
    """Every struct leaf as a column named by its path.  Arrays stay as they are."""
    return df.select([
        F.col(".".join(map(quoted, path))).alias(separator.join(path))
        for path in _leaves(df.schema)
    ])


def _spread(df: DataFrame, column: str, prefix: str, element) -> DataFrame:
    """Replace an array of structs by the leaves of one element; a missing column is a no-op."""
    if column not in df.columns:
        return df
    kind = df.schema[column].dataType
    struct = kind.elementType if isinstance(kind, T.ArrayType) else None
    if not isinstance(struct, T.StructType):
        raise TypeError(f"{column} is not an array of structs")
    chosen = element(F.col(quoted(column)))
    leaves = [chosen_leaf(chosen, path).alias(prefix + ".".join(path)) for path in _leaves(struct)]
    return df.select(*[quoted(c) for c in df.columns if c != column], *leaves)


def chosen_leaf(value: Column, path: Sequence[str]) -> Column:
    for name in path:
        value = value.getField(name)
    return value


def first_of(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """First element of an array of structs as prefixed columns; nulls when there is none."""
    return _spread(df, column, prefix, lambda c: F.get(c, F.lit(0)))


def last_of(df: DataFrame, column: str, prefix: str) -> DataFrame:
    return _spread(df, column, prefix, lambda c: F.try_element_at(c, F.lit(-1)))


def param(params: Column, key: str, member: str) -> Column:
    """One value of a key-value array."""
    return F.get(F.filter(params, lambda p: p["key"] == key), F.lit(0))["value"][member]


def pivot_params(df: DataFrame, column: str, keys: Mapping[str, tuple[str, str]]) -> DataFrame:
    """One column per wanted key: ``keys`` maps the new name to (key, member).

    The array is read once into a map of the wanted keys.  A wanted key that occurs
    twice in one row is an error, as a scalar lookup with two results is.
    """
    wanted = sorted({key for key, _ in keys.values()})
    entries = F.filter(F.col(column), lambda p: p["key"].isin(*wanted))
    looked_up = df.withColumn(
        "_params", F.map_from_entries(F.transform(entries, lambda p: F.struct(p["key"], p["value"])))
    )
    return looked_up.withColumns({
        name: F.try_element_at(F.col("_params"), F.lit(key))[member]
        for name, (key, member) in keys.items()
    }).drop("_params")


def only_item(items: Column, field: str, on_many: str = "error") -> Column:
    """A field of the only element.  More than one is an error unless ``on_many="first"``."""
    value = F.get(items, F.lit(0))[field]
    if on_many == "first":
        return value
    return F.when(F.size(items) > 1, F.raise_error(F.lit(f"more than one item for {field}"))).otherwise(value)


def label_text(page: Column, pattern: str, prefix: str = "") -> Column:
    """Squashed text of the page's first match, without a leading prefix."""
    return strip(strip_prefix(squash(F.regexp_extract(page, pattern, 1)), prefix))


def html_records(
    df: DataFrame,
    block: Column,
    keep: Sequence[str],
    fields: Mapping[str, int],
    always: int,
    remove: Sequence[str] = (),
    record_separator: str = ";",
    field_separator: str = ", ",
) -> DataFrame:
    """Records written inside page text, one row each.

    ``block`` is the text that holds them; ``remove`` lists wrappers to delete.  Fields
    are positions; those from ``always`` on are empty when the record is short.
    """
    for wrapper in remove:
        block = F.replace(block, F.lit(wrapper), F.lit(""))
    records = F.filter(F.split(strip(block), f"\\Q{record_separator}\\E"), lambda r: strip(r) != "")
    rows = df.select(*keep, F.posexplode(records).alias("record", "_text"))
    parts = F.split(strip(F.regexp_replace("_text", "['()]", "")), f"\\Q{field_separator}\\E")
    rows = rows.withColumn("_parts", parts)

    def field(position: int) -> Column:
        value = F.get("_parts", F.lit(position))
        if position < always:
            return value
        return F.when(F.size("_parts") > always, value).otherwise(F.lit(""))

    return rows.select(
        *keep, "record", *[field(position).alias(name) for name, position in fields.items()]
    )
