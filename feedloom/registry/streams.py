"""Growing feeds.  The given event table is the landed feed; a query runs until all of it is loaded."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.registry.base import query, stamp
from feedloom.session import work_path
from feedloom.streaming import (
    Days, daily_backfill, fold, read_merged, read_refreshed, stream_backfill, stream_dedupe, stream_dedupe_within, stream_deltas, stream_files, stream_refresh,
)


def _landed(t):
    # As a pattern, the path may be one file or a folder of many.
    return stream_files(t.spark, t.path("events")[:-1] + "?", t.events.schema)


def _clean(df):
    return df.where(F.col("event_type") != "error").select(
        "event_id", "ts", "user_id", F.upper("event_type").alias("event_type"), "value"
    )


def _shown(rows):
    return rows.select(
        "event_id", stamp("ts").alias("ts"), "user_id", "event_type", "value",
        F.date_format("day", "yyyy-MM-dd").alias("day"),
    )


CLEANED = """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, upper(event_type) AS event_type, value,
    strftime(ts, '%Y-%m-%d') AS day FROM events WHERE event_type <> 'error'"""


def _by_day():
    return Days(day=F.to_date("ts"), key="event_id")


@query("stream_refresh", CLEANED)
def stream_refresh_query(t):
    path = work_path(t.spark, "events")
    stream_refresh(_landed(t), path, path + "-state", _by_day(), _clean).awaitTermination()
    return _shown(read_refreshed(t.spark, path))


@query("stream_backfill", f"{CLEANED} AND ts < TIMESTAMP '2024-01-20'")
def stream_backfill_query(t):
    path = work_path(t.spark, "events")
    stream_backfill(
        _landed(t), "2024-01-20", "ts", path=path, checkpoint=path + "-state", by=_by_day(), transform=_clean
    ).awaitTermination()
    return _shown(read_refreshed(t.spark, path))


@query("stream_dedupe", """
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, value FROM events""")
def stream_dedupe_query(t):
    path = work_path(t.spark, "events")
    twice = _landed(t).unionByName(_landed(t))
    stream_dedupe(twice, path, path + "-state", "event_id").awaitTermination()
    rows = t.spark.read.parquet(path)
    return rows.select("event_id", stamp("ts").alias("ts"), "user_id", "event_type", "value")


@query("daily_backfill", f"{CLEANED} AND ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-21'")
def daily_backfill_query(t):
    path = work_path(t.spark, "events")
    daily_backfill(t.events, path, "ts", "2024-01-03", "2024-01-20", _clean)
    return _shown(t.spark.read.parquet(path))


def _land(t, slices):
    """Slices of the events written one after the other, as files that come in over time."""
    folder = work_path(t.spark, "landing")
    for rows in slices:
        rows.write.mode("append").parquet(folder)
    return folder


@query("stream_merge", """
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, upper(event_type) AS event_type, value, strftime(ts, '%Y-%m-%d') AS day
    FROM (SELECT event_id, user_id, value, CASE WHEN event_id % 10 = 0 THEN ts + INTERVAL 30 HOUR ELSE ts END AS ts,
        CASE WHEN event_id % 10 = 0 AND event_id % 20 <> 0 THEN 'moved' WHEN event_id % 20 = 0 THEN 'error' ELSE event_type END AS event_type FROM events)
    WHERE event_type <> 'error'""")
def stream_merge(t):
    """Four files of events, then a tenth of them again under another day, half of those to be dropped; folded once in between."""
    path = work_path(t.spark, "events")
    state = path + "-state"
    last = F.when(F.col("event_id") % 20 == 0, F.lit("error")).otherwise(F.lit("moved"))
    moved = t.events.where("event_id % 10 = 0").withColumn("ts", F.col("ts") + F.expr("INTERVAL 30 HOURS")).withColumn("event_type", last)
    folder = _land(t, [t.events.where(F.col("event_id") % 4 == n) for n in range(4)])
    source = stream_files(t.spark, folder, t.events.schema, files_per_cycle=2)
    stream_deltas(source, path, state, _by_day(), _clean).awaitTermination()
    fold(t.spark, path, _by_day())
    moved.write.mode("append").parquet(folder)
    stream_deltas(source, path, state, _by_day(), _clean).awaitTermination()
    return _shown(read_merged(t.spark, path, _by_day()))


@query("stream_dedupe_within", """
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, value FROM events""")
def stream_dedupe_within_query(t):
    """Weeks that come in one after the other, each with the last half day of the one before again."""
    path = work_path(t.spark, "events")
    at = lambda day, hours=0: F.lit(day).cast("timestamp_ntz") - F.expr(f"INTERVAL {hours} HOURS")
    days = ["1900-01-01", "2024-01-08", "2024-01-15", "2024-01-22", "2100-01-01"]
    folder = _land(t, [t.events.where((F.col("ts") >= at(a, 12)) & (F.col("ts") < at(b))) for a, b in zip(days, days[1:])])
    source = stream_files(t.spark, folder, t.events.schema, files_per_cycle=1)
    stream_dedupe_within(source, path, path + "-state", "event_id", "ts", "40 days").awaitTermination()
    return t.spark.read.parquet(path).select("event_id", stamp("ts").alias("ts"), "user_id", "event_type", "value")
