"""The near-real-time load: every cycle replaces what its input touches.

A cycle is a micro-batch of landed files.  What a table holds does not depend on how the
files were cut into cycles or on the order in which they came: every record has an order
(its landing, unless the feed says otherwise), the newest of a key or of a day's snapshots
wins, inside a batch as against the table, and a record that the transform drops leaves a
mark so that an older copy cannot come back.  ``read_refreshed`` shows the table without
orders and marks.

A cycle's rows are first written beside the table under the cycle's number and only then
swapped in.  A cycle repeated after a crash finds them and finishes the swap; it does not
read partitions that may be half replaced.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, time
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from feedloom.functions import day_range
from feedloom.sinks.tables import days_between, path_exists, remove, replace_partitions, swap_partitions

# The cycle and the hour the loop ends.
CYCLE = "300 seconds"
CLOSING_TIME = time(23, 55)

ZONE = ZoneInfo("America/Sao_Paulo")

LANDED, ORDER, LIVE = "_landed", "_order", "_live"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

Transform = Callable[[DataFrame], DataFrame]


def stream_files(
    spark: SparkSession, path: str, schema: T.StructType, files_per_cycle: int | None = None
) -> DataFrame:
    """Landed Parquet files as a stream; ``path`` may be a folder or a pattern.

    ``_landed`` orders records by the time and name of the file they came in.
    """
    reader = spark.readStream.schema(schema)
    if files_per_cycle:
        reader = reader.option("maxFilesPerTrigger", files_per_cycle)
    stamp = F.date_format("_metadata.file_modification_time", "yyyyMMddHHmmss.SSS")
    return reader.parquet(path).withColumn(LANDED, F.concat_ws(" ", stamp, "_metadata.file_name"))


def _same(df: DataFrame) -> DataFrame:
    return df


@dataclass(frozen=True)
class Days:
    """How records are dated and told apart, as landed and as loaded.

    ``day`` and ``key`` are read from the landed record; ``loaded_day`` and ``loaded_key``
    from the transformed one, and default to the same columns.  ``order`` is larger for the
    newer one of two records of a key, or of two snapshots of a day.
    """

    day: Column
    loaded_day: Column | None = None
    key: str | None = None
    loaded_key: str | None = None
    column: str = "day"
    order: Column | None = None


def newest(rows: DataFrame, unit: list[str], single: bool) -> DataFrame:
    """Of each unit the rows of the newest order; of a key, one of them."""
    if single:
        whole = F.struct(*rows.columns)
        best = rows.groupBy(*unit).agg(F.max_by(whole, F.struct(ORDER, F.xxhash64(*rows.columns))).alias("_best"))
        return best.select("_best.*")
    last = rows.groupBy(*unit).agg(F.max(ORDER).alias("_last"))
    same = F.col(ORDER) == F.col("_last")
    for i, c in enumerate(unit):
        last = last.withColumnRenamed(c, f"_unit_{i}")
        same = same & F.col(c).eqNullSafe(F.col(f"_unit_{i}"))
    return rows.join(last, same, "left_semi")


def changes(batch: DataFrame, transform: Transform, by: Days) -> tuple[DataFrame, DataFrame]:
    """What a batch brings, marks included, and the days and keys it touches."""
    order = F.col(LANDED) if by.order is None else by.order
    landed = batch.withColumns({by.column: by.day, ORDER: order})
    unit = [by.column] if by.key is None else [by.column, by.key]
    fresh = newest(landed, unit, by.key is not None)
    loaded_key = by.loaded_key or by.key
    loaded_day = by.day if by.loaded_day is None else by.loaded_day
    given = fresh.drop(ORDER) if by.column in batch.columns else fresh.drop(ORDER, by.column)
    made = transform(given).drop(LANDED).withColumn(by.column, loaded_day)
    units = fresh.select(F.col(by.column).alias("_day"), *([F.col(by.key).alias("_key")] if by.key else []), ORDER).distinct()
    at = F.col(by.column).eqNullSafe(F.col("_day"))
    at = at & F.col(loaded_key).eqNullSafe(F.col("_key")) if by.key else at
    live = made.join(units, at).select(*made.columns, ORDER).withColumn(LIVE, F.lit(True))
    gone = units.join(made, at, "left_anti")
    blank = {f.name: F.lit(None).cast(f.dataType) for f in made.schema}
    blank |= {by.column: F.col("_day").cast(made.schema[by.column].dataType)} | ({loaded_key: F.col("_key").cast(made.schema[loaded_key].dataType)} if by.key else {})
    marks = gone.select(*(c.alias(name) for name, c in blank.items()), ORDER).withColumn(LIVE, F.lit(False))
    return live.unionByName(marks), units


def _cycle_rows(batch: DataFrame, path: str, transform: Transform, by: Days) -> DataFrame:
    """What the days that the batch touches hold after it."""
    rows, units = changes(batch, transform, by)
    loaded_key = by.loaded_key or by.key
    if path_exists(batch.sparkSession, path):
        touched = units.select("_day").distinct()
        table = batch.sparkSession.read.schema(rows.schema).parquet(path)
        rows = table.join(touched, F.col(by.column).eqNullSafe(F.col("_day")), "left_semi").unionByName(rows)
    return newest(rows, [by.column] if by.key is None else [by.column, loaded_key], by.key is not None)


def _load_cycle(batch: DataFrame, path: str, transform: Transform, by: Days, number: int) -> None:
    spark = batch.sparkSession
    aside = f"{path}__cycles/{number}"
    if not path_exists(spark, f"{aside}/_SUCCESS"):
        if batch.isEmpty():
            return
        _cycle_rows(batch, path, transform, by).write.mode("overwrite").parquet(aside)
    swap_partitions(spark.read.parquet(aside), path, by.column)
    remove(spark, aside)


def stream_refresh(
    source: DataFrame,
    path: str,
    checkpoint: str,
    by: Days,
    transform: Transform = _same,
    cycle: str | None = None,
) -> StreamingQuery:
    """Load a stream into a table partitioned by day; ``read_refreshed`` reads it.

    Without a key, the records of one order are a snapshot of each day they hold, and the
    newest snapshot replaces the day.  With a key they are increments: the newest record of
    a key stays, and the day's other records too.  A record must not change its day.

    ``cycle`` (for example ``CYCLE``) polls until stopped; by default everything that
    has landed is loaded and the query ends.
    """
    trigger = {"processingTime": cycle} if cycle else {"availableNow": True}

    def load(batch: DataFrame, batch_id: int) -> None:
        _load_cycle(batch, path, transform, by, batch_id)

    return (
        source.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def read_refreshed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where(LIVE).drop(ORDER, LIVE)


def stream_backfill(source: DataFrame, before: str, moment: str, **refresh) -> StreamingQuery:
    """The history before a day, loaded by the same path before the polling starts."""
    return stream_refresh(source.where(F.col(moment) < F.to_timestamp(F.lit(before))), **refresh)


def run_until(query: StreamingQuery, closing: time = CLOSING_TIME, now: datetime | None = None) -> bool:
    """Let a polling query run until the closing time of the day, in the feed's zone, then stop it."""
    now = now or datetime.now(ZONE).replace(tzinfo=None)
    left = (datetime.combine(now.date(), closing) - now).total_seconds()
    ended = query.awaitTermination(int(left)) if left > 0 else False
    if not ended:
        query.stop()
    return ended


def stream_dedupe(source: DataFrame, path: str, checkpoint: str, key: str, order: Column | None = None) -> StreamingQuery:
    """Add the records whose key the table lacks, however late they are, and one of each key.

    Copies are the same record.  A cycle's rows are a folder of the table of their own, which
    a repeated cycle overwrites, and it looks for keys in the other cycles' folders only.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        spark, folder = batch.sparkSession, f"{path}/cycle={batch_id}"
        columns = [c for c in batch.columns if c != LANDED]
        first = F.struct(F.col(LANDED) if order is None else order, F.xxhash64(*columns))
        rows = batch.groupBy(F.col(key).alias("_key")).agg(F.min_by(F.struct(*columns), first).alias("_first")).select("_first.*")
        if path_exists(spark, path):
            stored = spark.read.schema(rows.schema.add("cycle", "long")).parquet(path).where(F.col("cycle") != batch_id)
            rows = rows.join(stored.select(F.col(key).alias("_key")), F.col(key).eqNullSafe(F.col("_key")), "left_anti")
        rows.write.mode("overwrite").parquet(folder)

    return source.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_dedupe_within(
    source: DataFrame, path: str, checkpoint: str, key: str, moment: str, delay: str = "1 day", order_column: str = LANDED
) -> StreamingQuery:
    """Add one record of each key, remembering keys for ``delay`` behind the newest moment only.

    Keys are held in a RocksDB state store and leave it as the watermark passes them, so a cycle reads neither the
    table nor the history.  Copies have to come within ``delay`` of each other.  A record whose moment lies behind
    the watermark of its cycle, ``delay`` before the newest moment of the cycles before, is left out and counted
    (``left_out``); ``daily_backfill`` brings such days in.  ``stream_dedupe`` takes records however late.
    """
    source.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    timed = source.withColumn(moment, F.col(moment).cast("timestamp")).withWatermark(moment, delay)
    rows = timed.dropDuplicatesWithinWatermark([key]).drop(order_column)
    return rows.writeStream.format("parquet").outputMode("append").option("path", path).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()


def left_out(query: StreamingQuery) -> int:
    """How many records the latest cycles of a query have found behind their watermark."""
    return sum(state.numRowsDroppedByWatermark for progress in query.recentProgress for state in progress.stateOperators)


def daily_backfill(
    df: DataFrame, path: str, moment: str, start: str, end: str, transform: Transform = _same,
    day_column: str = "day",
) -> None:
    """Reload a range of days in one job: the days are partitions, not loop turns."""
    window = df.where(day_range(moment, start, end))
    rows = transform(window).withColumn(day_column, F.to_date(moment))
    replace_partitions(rows, path, day_column, days_between(start, end))
