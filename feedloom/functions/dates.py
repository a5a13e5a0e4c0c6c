"""Date expressions.  The session zone is UTC (see ``feedloom.session``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions._column import ColumnLike, as_column
from feedloom.functions.text import strip_text

# The formats the feeds use.  One-letter fields take one or two digits.
MINUTE_FORMAT = "d/M/yyyy H:m"
DAY_FORMAT = "d/M/yyyy"
SHARD_FORMAT = "yyyyMMdd"


def parse_dt(c: ColumnLike, fmt: str = MINUTE_FORMAT) -> Column:
    """Timestamp in a fixed format; anything else gives null."""
    return F.try_to_timestamp(as_column(c), F.lit(fmt))


def combine_dt(day: ColumnLike, time: ColumnLike, fmt: str = MINUTE_FORMAT) -> Column:
    return parse_dt(F.concat(as_column(day), F.lit(" "), as_column(time)), fmt)


def to_utc_ms(c: ColumnLike) -> Column:
    """Any timestamp text (or timestamp) as UTC text cut to the millisecond."""
    return F.date_format(strip_text(c).try_cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSS")


def day_range(c: ColumnLike, start: str, end: str) -> Column:
    """Rows from ``start`` to the end of day ``end``, as a half-open range on the
    bare column so that it reaches the Parquet reader."""
    moment = as_column(c)
    first = F.to_timestamp(F.lit(start))
    after = F.to_timestamp(F.date_add(F.to_date(F.lit(end)), 1))
    return (moment >= first) & (moment < after)
