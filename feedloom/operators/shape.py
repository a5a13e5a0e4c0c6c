"""Projections: declared types, fixed column lists, constants, nested paths."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions import (
    clean_text,
    strip,
    to_bool,
    to_float,
    to_int,
    to_utc_ms,
    truncate,
)
from feedloom.functions.flags import ENTRY_WORDS

# How each declared kind is read.  "raw" columns pass through.
SHOP_KINDS: dict[str, Callable[[str], Column]] = {
    "text": clean_text,
    "date": to_utc_ms,
    "float": to_float,
    "int": to_int,
    "bool": to_bool,
    "raw": F.col,
}
ENTRY_KINDS: dict[str, Callable[[str], Column]] = {
    # The feed's empty texts are null already; a text of spaces ends up empty.
    "text": lambda c: F.upper(strip(c)),
    "float": lambda c: to_float(c, ptbr=False),
    "int": lambda c: to_int(c, ptbr=False),
    "bool": lambda c: to_bool(c, ENTRY_WORDS),
    "raw": F.col,
}


@dataclass(frozen=True)
class Field:
    source: str
    kind: str
    target: str


@dataclass(frozen=True)
class TableSpec:
    """Columns of a feed: header in the file, kind, name in the table."""

    fields: tuple[Field, ...]
    kinds: Mapping[str, Callable[[str], Column]]

    @classmethod
    def parse(cls, table: str, kinds: Mapping[str, Callable[[str], Column]]) -> TableSpec:
        """Read ``header ; kind ; name`` lines."""
        rows = [line.split(";") for line in table.strip().splitlines()]
        return cls(tuple(Field(*(cell.strip() for cell in row)) for row in rows), kinds)

    def kind_of(self, header: str) -> str:
        return next((f.kind for f in self.fields if f.source == header), "raw")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def apply_spec(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Type every declared column in one projection; undeclared ones pass through."""
    return df.select([
        spec.kinds[spec.kind_of(name.strip())](quoted(name)).alias(name.strip())
        for name in df.columns
    ])


def conform(df: DataFrame, columns: Mapping[str, str | T.DataType]) -> DataFrame:
    """Exactly these columns, in this order: missing ones null, others dropped."""
    present = set(df.columns)
    return df.select([
        (F.col(quoted(name)) if name in present else F.lit(None)).cast(kind).alias(name)
        for name, kind in columns.items()
    ])


def with_lineage(df: DataFrame, source: str, day: str | None = None) -> DataFrame:
    inserted = F.lit(day) if day else F.date_format(F.current_date(), "yyyy-MM-dd")
    return df.withColumns({"data_insercao": inserted, "fonte": F.lit(source)})


def project_paths(df: DataFrame, paths: Mapping[str, str]) -> DataFrame:
    """Flat columns from nested paths; Parquet reads only the leaves named."""
    return df.select([F.col(path).alias(alias) for alias, path in paths.items()])


def truncate_all(df: DataFrame, length: int = 250) -> DataFrame:
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({name: truncate(quoted(name), length) for name in texts})


def overwrite_where(df: DataFrame, condition: Column, values: Mapping[str, object]) -> DataFrame:
    """Set columns to constants where the condition holds; a null condition does not."""
    return df.withColumns({
        name: F.when(condition, F.lit(value)).otherwise(F.col(name))
        for name, value in values.items()
    })


def stack_frames(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows; columns are matched by name and filled with null where absent."""
    stacked = first
    for other in others:
        stacked = stacked.unionByName(other, allowMissingColumns=True)
    return stacked
