"""Positions inside groups, and the first and last rows of an order.

A window over a group puts the whole group into one task.  Here the table is cut into ranges of
(group, order), compared as whole tuples, so rows that agree in the leading columns are cut as well.
Most groups lie in one range, and there a window numbers them.  A group that is cut has one of the cuts
inside, so there are fewer of them than cuts: only their rows are counted by range, and what stands in
earlier ranges is added.  There is one path for all sizes.  Counting and sampling the table run while the
query is built; the cuts, some dozens of rows, are part of its expressions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 64
SAMPLED = 32  # rows a range is expected to have in the sample


def _rising(column: Column, kind: T.DataType) -> Column | None:
    """A number or text that rises with the column, nulls first as Spark sorts them."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(column.cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(column)
    if isinstance(kind, T.BooleanType):
        return column.cast("int")
    return column if isinstance(kind, T.NumericType | T.StringType) else None


def _falling(column: Column, kind: T.DataType) -> Column | None:
    """Something that rises, or stays, where the column falls."""
    if isinstance(kind, T.StringType):
        # hexadecimal digits turned around, and an end that comes after all of them
        digits = F.hex(F.encode(column, "UTF-8"))
        return F.concat(F.translate(digits, "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))
    if isinstance(kind, T.DecimalType):
        return -column
    if isinstance(kind, T.FractionalType):
        return F.when(F.isnan(column), F.lit(float("-inf"))).otherwise(-column.cast("double"))
    rising = _rising(column, kind)
    return None if rising is None else F.bitwise_not(rising.cast("long"))


def _fields(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> list[Column]:
    """Group and order as a tuple of columns that all rise.  Groups go by a hash: any order of them will do."""
    fields = [F.xxhash64(*by)] if by else []
    for name in order:
        down, name = name.startswith("-"), name.removeprefix("-")
        turned = (_falling if down else _rising)(F.col(name), df.schema[name].dataType)
        if turned is None:
            break  # ranges are then cut by the columns before
        fields += [F.col(name).isNull().cast("int"), turned] if down else [turned]
    return fields or [F.lit(0)]


def _sorted_by(order: Sequence[str]) -> list[Column]:
    return [F.col(c[1:]).desc() if c.startswith("-") else F.col(c).asc() for c in order]


def _cuts(df: DataFrame, fields: Sequence[Column], ranges: int) -> list[tuple]:
    """``ranges - 1`` tuples at most that cut the table into about equal shares, from a sample by hash."""
    names = [f"f{i}" for i in range(len(fields))]
    rows = df.select(*[f.alias(n) for f, n in zip(fields, names)])
    share = SAMPLED * ranges / max(df.count(), 1)
    # equal tuples have equal hashes, and one of them stands for all, so the sample stays small
    hashed = F.shiftrightunsigned(F.xxhash64(*names), 11)
    sample = sorted((tuple(row) for row in rows.where(hashed < share * 2.0**53).distinct().collect()), key=_as_sorted)
    n = len(sample)  # of each share but the last one, the last row
    return [row for i, row in enumerate(sample[:-1]) if (i + 1) * ranges // n > i * ranges // n]


def _as_sorted(row: tuple) -> tuple:
    """Nulls first, then numbers or texts, NaN last."""
    return tuple((v is not None, v != v, 0 if v is None or v != v else v) for v in row)


def _below(fields: Sequence[Column], cut: Sequence[object]) -> Column:
    """Whether a row's tuple comes before a cut; nulls come first."""
    *first, last = zip(fields, cut)
    below = _less(*last)
    for field, value in reversed(first):
        below = _less(field, value) | (field.eqNullSafe(F.lit(value)) & below)
    return below


def _less(field: Column, value: object) -> Column:
    return F.lit(False) if value is None else field.isNull() | (field < F.lit(value))


def _range_of(fields: Sequence[Column], cuts: Sequence[tuple]) -> Column:
    """How many cuts are not above a row's tuple, found by halves.

    A cut is compared as far as it differs from the ones beside it, mostly by its first field.
    """

    def differs(a: tuple, b: tuple) -> int:
        return next((i + 1 for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))

    depth = [max([differs(cut, other) for other in cuts[max(i - 1, 0):i + 2] if other is not cut], default=len(cut)) for i, cut in enumerate(cuts)]

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        below = _below(fields[:depth[middle]], cuts[middle])
        return F.when(below, search(low, middle)).otherwise(search(middle + 1, high))

    return search(0, len(cuts))


def with_position(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    name: str = "position",
    sums: Mapping[str, str] | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """1, 2, 3, … in each group, in a given order.  An empty ``by`` ranks the whole table.

    ``order`` names columns, a leading ``-`` turns one around.  It has to tell the rows of a
    group apart: rows alike in all of it are numbered in any order, and by one task.
    ``sums`` adds group totals of columns under new names.
    """
    by, order, sums = list(by), list(order), dict(sums or {})
    fields = _fields(df, by, order)
    cuts = _cuts(df, fields, buckets)
    held = [f"_field_{i}" for i in range(len(fields))]
    placed = df.select("*", *[f.alias(n) for f, n in zip(fields, held)])
    placed = placed.withColumn("_bucket", _range_of([F.col(n) for n in held], cuts)).drop(*held)
    cut = fields[0].isin(sorted({c[0] for c in cuts})) if by else F.lit(True)
    totals = [F.sum(c).alias(f"_sum_{n}") for n, c in sums.items()]
    counted = placed.where(cut).groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n"), *totals)
    group = Window.partitionBy(*by)
    earlier = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counted.select(
        *[F.col(c).alias(f"_by_{i}") for i, c in enumerate(by)], F.col("_bucket").alias("_at"),
        F.sum("_n").over(earlier).alias("_before"), *[F.sum(f"_sum_{n}").over(group).alias(f"_total_{n}") for n in sums],
    )
    same = F.col("_bucket") == F.col("_at")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{i}"))
    whole = Window.partitionBy(*by, "_bucket")
    numbered = placed.withColumn("_inside", F.row_number().over(whole.orderBy(*_sorted_by(order))))
    numbered = numbered.withColumns({f"_own_{n}": F.sum(c).over(whole) for n, c in sums.items()}) if sums else numbered
    # two rows a cut at most, whatever the table: a cut group has one more range than cuts inside
    joined = numbered.join(F.broadcast(before), same, "left")
    return joined.select(
        *df.columns, (F.col("_inside") + F.coalesce("_before", F.lit(0))).cast("bigint").alias(name),
        *[F.when(F.col("_at").isNull(), F.col(f"_own_{n}")).otherwise(F.col(f"_total_{n}")).alias(n) for n in sums],
    )


def top_bottom(
    df: DataFrame, order: Sequence[str], n_first: int = 5, n_last: int = 4
) -> DataFrame:
    """The first and the last rows of an order, marked; two top-n passes, no full sort."""
    first = df.orderBy(*order).limit(n_first)
    last = df.orderBy(*[F.col(c).desc() for c in order]).limit(n_last)
    return first.withColumn("side", F.lit("first")).unionByName(last.withColumn("side", F.lit("last")))


def next_upcoming(df: DataFrame, moment: str, now: str | Column, ties: Sequence[str] = ()) -> DataFrame:
    """The nearest row at or after ``now``."""
    start = F.to_timestamp(F.lit(now)) if isinstance(now, str) else now
    return df.where(F.col(moment) >= start).orderBy(moment, *ties).limit(1)
