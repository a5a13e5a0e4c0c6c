"""What a table holds after a batch is loaded, as a DataFrame.

Plain Parquet has no row-level delete, so each strategy is "rows that stay" plus
"rows that come".  ``feedloom.sinks.versions`` applies them to the files that a batch
concerns; ``feedloom.sinks.tables`` writes whole tables and partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.operators.joins import new_rows


class DuplicateKeys(ValueError):
    """A batch holds one key twice where the load needs it once."""


def verify_unique(batch: DataFrame, key: str) -> DataFrame:
    repeated = batch.groupBy(key).count().where((F.col("count") > 1) & F.col(key).isNotNull())
    found = repeated.limit(5).collect()
    if found:
        raise DuplicateKeys(f"{key} is not unique in the batch, for example {found[0][0]!r}")
    return batch


def _without(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    return target.join(batch.select(key).distinct(), key, "left_anti").select(*target.columns)


def replace_by_key(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the batch give way to the batch; null keys are never deleted."""
    return _without(target, batch, key).unionByName(batch)


def replace_where(target: DataFrame, batch: DataFrame, key: str, keep: Column) -> DataFrame:
    """As ``replace_by_key``, but only batch rows that pass ``keep`` are put back."""
    return _without(target, batch, key).unionByName(batch.where(keep))


def outside_window(moment: Column, start: str, end: str | None, drop_null: bool) -> Column:
    """Whether a moment lies outside the days of a window; an unreadable one does, unless it is to be dropped."""
    outside = moment < F.to_timestamp(F.lit(start))
    if end is not None:
        after = F.to_timestamp(F.date_add(F.to_date(F.lit(end)), 1))
        outside = outside | (moment >= after)
    return F.coalesce(outside, F.lit(not drop_null))


def replace_by_window(
    target: DataFrame, batch: DataFrame, moment: str | Column, start: str, end: str | None,
    drop_null: bool = False,
) -> DataFrame:
    """Rows from ``start`` to the end of day ``end`` give way to the batch.

    Rows without a readable moment are outside every window and stay, so loading them
    again doubles them; ``drop_null`` removes them with the window.
    """
    moment = F.col(moment).try_cast("timestamp") if isinstance(moment, str) else moment
    return target.where(outside_window(moment, start, end, drop_null)).unionByName(batch)


def replace_tail(
    target: DataFrame, batch: DataFrame, moment: str | Column, start: str, drop_null: bool = False
) -> DataFrame:
    """Everything from ``start`` on gives way to the batch."""
    return replace_by_window(target, batch, moment, start, None, drop_null)


def merge_upsert(
    target: DataFrame,
    batch: DataFrame,
    key: str,
    compare: Sequence[str],
    null_safe: bool = False,
) -> DataFrame:
    """Update matched rows that changed in a compared column; insert unmatched ones.

    Columns that are not compared are written on insert only.  Unless ``null_safe``,
    a change from or to null does not count as a change, but once a row has changed
    all its compared columns are taken over, nulls included.

    This is a left join plus the unmatched part of the batch, not a full outer join:
    against a small batch the target is then joined by broadcast and never shuffled.
    """
    incoming = batch.select(
        key, *[F.col(c).alias(f"_new_{c}") for c in compare], F.lit(True).alias("_matched")
    ).where(F.col(key).isNotNull())

    def differs(column: str) -> Column:
        old, new = F.col(column), F.col(f"_new_{column}")
        return ~old.eqNullSafe(new) if null_safe else F.coalesce(old != new, F.lit(False))

    changed = differs(compare[0])
    for column in compare[1:]:
        changed = changed | differs(column)
    take = F.col("_matched").isNotNull() & changed
    merged = target.join(incoming, key, "left").select([
        F.when(take, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in compare else F.col(c)
        for c in target.columns
    ])
    return merged.unionByName(new_rows(batch, target, key).select(*target.columns))


def insert_new(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The target plus the batch rows whose key it lacks."""
    return target.unionByName(new_rows(batch, target, key).select(*target.columns))
