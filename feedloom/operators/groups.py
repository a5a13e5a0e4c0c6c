"""Aggregates.  All have a partial form, so hot groups are reduced before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.operators.ranks import with_position


def two_level(
    df: DataFrame, inner: Sequence[str], outer: Sequence[str],
    first: Mapping[str, Column], second: Mapping[str, Column],
) -> DataFrame:
    """Aggregate per ``inner`` group, then aggregate those rows per ``outer`` group."""
    per_inner = df.groupBy(*inner).agg(*[e.alias(n) for n, e in first.items()])
    return per_inner.groupBy(*outer).agg(*[e.alias(n) for n, e in second.items()])


def distinct_sessions(
    df: DataFrame, by: Sequence[str], parts: Sequence[str], separator: str = "-",
    name: str = "sessions",
) -> DataFrame:
    """Distinct concatenations of the parts; a null part leaves the row out of the count."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.lit(separator), F.col(part).cast("string")]
    return df.groupBy(*by).agg(F.count_distinct(F.concat(*pieces[1:])).alias(name))


def distinct_if(
    df: DataFrame, by: Sequence[str], column: str, condition: Column, name: str
) -> DataFrame:
    return df.groupBy(*by).agg(F.count_distinct(F.when(condition, F.col(column))).alias(name))


def sum_or_zero(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0))


def high_water(df: DataFrame, moment: str, condition: Column) -> DataFrame:
    return df.where(condition).agg(F.max(moment).alias("high_water"))


def profile_counts(df: DataFrame, column: str) -> DataFrame:
    """How often each value occurs; null is one of the values."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def count_ifs(df: DataFrame, conditions: Mapping[str, Column], mean: str | None = None) -> DataFrame:
    counts = [F.count_if(c).alias(name) for name, c in conditions.items()]
    if mean:
        counts.append(F.avg(mean).alias(f"mean_{mean}"))
    return df.agg(*counts)


def quality_counters(
    df: DataFrame, removed: Mapping[str, Column], flagged: Mapping[str, Column]
) -> DataFrame:
    """One row: rows in, rows out, rows removed by each rule, rows out with each flag.

    Rules apply in order: a row counts for the first rule that removes it.
    """
    gone = F.lit(False)
    counters = [F.count(F.lit(1)).alias("rows_in")]
    for name, rule in removed.items():
        hit = F.coalesce(rule, F.lit(False))
        counters.append(F.count_if(~gone & hit).alias(f"removed_{name}"))
        gone = gone | hit
    counters.append(F.count_if(~gone).alias("rows_out"))
    counters += [F.count_if(~gone & rule).alias(f"flagged_{name}") for name, rule in flagged.items()]
    return df.agg(*counters)


def base_row(
    df: DataFrame, by: Sequence[str], prefer: Column, order: str, take: Mapping[str, str]
) -> DataFrame:
    """Write the group's base row onto every row of the group.

    The base row is the lowest by ``order`` among the preferred rows, else among all;
    ``take`` maps its columns to the new names.  Rows with a null in ``by`` get none,
    because a null never meets the join.
    """
    rank = F.struct((~F.coalesce(prefer, F.lit(False))).alias("later"), F.col(order).alias("place"))
    base = df.groupBy(*by).agg(F.min_by(F.struct(*take), rank).alias("_base"))
    base = base.select(*by, *[F.col(f"_base.{old}").alias(new) for old, new in take.items()])
    return df.join(base, list(by), "left").select(*df.columns, *take.values())


def extremes(df: DataFrame, value: str) -> DataFrame:
    """The rows with the highest and with the lowest value, all ties included."""
    highest, lowest = df.agg(F.max(value)).scalar(), df.agg(F.min(value)).scalar()
    marks = F.array_compact(F.array(
        F.when(F.col(value) == highest, F.lit("highest")), F.when(F.col(value) == lowest, F.lit("lowest"))
    ))
    return df.select("*", F.explode(marks).alias("extreme"))


def above_mean(df: DataFrame, value: str) -> DataFrame:
    return df.where(F.col(value) > df.agg(F.avg(value)).scalar())


def entity_totals(df: DataFrame, entity: str, value: str, order: Sequence[str]) -> DataFrame:
    """Every entry with its position in the entity's list and the entity's total.

    The list stays in rows, so an entity may have any number of entries.
    """
    return with_position(df, [entity], order, sums={"total": value})


def ranking(df: DataFrame, by: Sequence[str], value: str, ties: Sequence[str]) -> DataFrame:
    """Descending places; ``ties`` settles equal values."""
    return with_position(df, by, [f"-{value}", *ties], "place")


def summary_bands(
    df: DataFrame, by: Sequence[str], value: str, bands: Sequence[tuple[float, str]], rest: str
) -> DataFrame:
    """Count, extremes and mean per group, and the first band whose floor the mean reaches."""
    summary = df.groupBy(*by).agg(
        F.count(value).alias("total"), F.max(value).alias("highest"),
        F.min(value).alias("lowest"), F.avg(value).alias("average"),
    )
    reached = [F.when(F.col("average") >= floor, F.lit(label)) for floor, label in bands]
    return summary.withColumn("situation", F.coalesce(*reached, F.lit(rest)))


def array_stats(df: DataFrame, array: str, keep, place: int) -> DataFrame:
    """Sum of the entries that pass ``keep``, entry at ``place`` (from 0), and the maximum."""
    entries = F.col(array)
    total = F.aggregate(F.filter(entries, keep), F.lit(0.0), lambda sum_, x: sum_ + x.cast("double"))
    return df.withColumns({
        "kept_sum": total, "entry": F.get(entries, F.lit(place)), "highest": F.array_max(entries),
    })
