"""Predicates that cut a remote table into parts of about equal size.

A database is asked for each part by one query, so the parts have to be told apart by predicates, hold about the
same number of rows, and together hold each row once, rows without a value included.  Equal widths between a least
and a largest value do none of that for skewed columns.  Here the cuts are quantiles of a sample of whole tuples:
where one value of the first column is too frequent for a part, the next columns cut it.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLED = 256  # rows a part is expected to have in the sample
# Texts are left out: a database may sort them in another order than the one they were cut by.
ORDERED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _literal(value: object) -> str:
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, date):
        return f"DATE '{value:%Y-%m-%d}'"
    if isinstance(value, int | Decimal):
        return str(value)
    return repr(float(value))


def _below(columns: Sequence[str], cut: Sequence[object]) -> str:
    """SQL that is true for tuples before a cut and false for all others, never unknown; nulls come first."""
    name, value = columns[0], cut[0]
    later = _below(columns[1:], cut[1:]) if len(cut) > 1 else None
    if value is None:
        return f"({name} IS NULL AND {later})" if later else "(1 = 0)"
    less = f"{name} IS NULL OR {name} < {_literal(value)}"
    return f"({less} OR ({name} = {_literal(value)} AND {later}))" if later else f"({less})"


def plan_parts(table: DataFrame, columns: Sequence[str], parts: int) -> list[str]:
    """At most ``parts`` predicates over ``columns``, the first of which cuts first.

    ``table`` is what the cuts are taken from: the table itself, or as much of it as is at hand.  The columns
    together should tell rows apart: rows alike in all of them stay in one part.
    """
    wrong = [c for c in columns if not isinstance(table.schema[c].dataType, ORDERED)]
    if wrong:
        raise ValueError(f"only numbers, dates and times have one order everywhere, not {wrong}")
    # NaN, which databases sort each in their own way, counts as a missing value does and is cut by no predicate
    finite = [F.when(~F.isnan(c), F.col(c)).alias(c) if isinstance(table.schema[c].dataType, T.FloatType | T.DoubleType) else F.col(c) for c in columns]
    rows = table.select(*finite)
    share = SAMPLED * parts / max(table.count(), 1)
    hashed = F.shiftrightunsigned(F.xxhash64(*columns), 11)
    found = [tuple(row) for row in rows.where(hashed < share * 2.0**53).distinct().collect()]
    sample = sorted(found, key=lambda row: tuple((v is not None, 0 if v is None else v) for v in row))
    n = len(sample)
    cuts = [row for i, row in enumerate(sample[:-1]) if (i + 1) * parts // n > i * parts // n]
    below = [_below(columns, cut) for cut in cuts]
    if not below:
        return ["1 = 1"]
    return [below[0], *[f"{b} AND NOT {a}" for a, b in zip(below, below[1:])], f"NOT {below[-1]}"]
