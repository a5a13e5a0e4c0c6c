"""Writers.

A lost executor or a repeated task leaves no trace: Spark moves files into place
when the job commits.  A job repeated after a failure gives the same table, except
for ``append``, which adds its rows again.  Tables that loads change by key or day are in
``feedloom.sinks.versions``.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.headers import canonical_headers

# Where Spark files the rows whose partition value is null.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
# What a table's new rows are called until they take its place.
NEXT = "__next"


def _file_system(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def path_exists(spark: SparkSession, path: str) -> bool:
    files, location = _file_system(spark, path)
    return files.exists(location)


def _by_partition(df: DataFrame, column: str | None):
    """A writer; rows of a partitioned table are first gathered by partition, and adaptive
    execution splits a partition that holds too much into several files."""
    if column is None:
        return df.write
    return df.hint("rebalance", column).write.partitionBy(column)


def _swapped(spark: SparkSession, path: str) -> None:
    """Finish or undo a replacement that was interrupted.

    New rows lie complete beside the table before anything of it goes: if they are whole they become
    the table, if not they go.
    """
    aside = f"{path}{NEXT}"
    files, location = _file_system(spark, aside)
    if not files.exists(location):
        return
    if path_exists(spark, f"{aside}/_SUCCESS"):
        remove(spark, path)
        move(spark, aside, path)
    else:
        remove(spark, aside)


def full_refresh(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Replace the table; returns it as written.

    The rows are written beside the table, so they may come from it, and take its place when they are
    whole.  Stopped at any point, the table is the old one or the new one as soon as it is next loaded or
    read by ``read_if_there``.
    """
    spark = df.sparkSession
    aside = f"{path}{NEXT}"
    # One that is whole is the table; the rows may be about to be read from it.
    _swapped(spark, path)
    _by_partition(df, partition_by).mode("overwrite").parquet(aside)
    _swapped(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def rewrite(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """``full_refresh`` by rows that may read the table itself."""
    return full_refresh(df, path, partition_by)


def read_if_there(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The table, or no rows of the same columns before its first load."""
    _swapped(spark, path)
    if path_exists(spark, path):
        return spark.read.schema(like.schema).parquet(path)
    return like.where(F.lit(False))


def append(df: DataFrame, path: str, max_rows: int = 0, partition_by: str | None = None) -> DataFrame:
    """Add the rows; ``max_rows`` bounds the rows per file, not the rows written."""
    _swapped(df.sparkSession, path)
    writer = _by_partition(df, partition_by).mode("append")
    if max_rows:
        writer = writer.option("maxRecordsPerFile", max_rows)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fan_out(df: DataFrame, paths: list[str], upper_headers: bool = True) -> list[DataFrame]:
    """The same table at several places.

    The source is read once; the other copies are made from the first one, so nothing
    has to be held in memory between the writes.
    """
    first = full_refresh(canonical_headers(df, "upper") if upper_headers else df, paths[0])
    return [first, *[full_refresh(first, path) for path in paths[1:]]]


def remove(spark: SparkSession, path: str) -> None:
    files, location = _file_system(spark, path)
    files.delete(location, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    files, location = _file_system(spark, path)
    if not files.rename(location, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"{path} can't be moved to {to}")


def swap_partitions(df: DataFrame, path: str, column: str) -> None:
    """Replace the partitions that these rows have values of; all others stay."""
    writer = df.hint("rebalance", column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(column).parquet(path)


def replace_partitions(df: DataFrame, path: str, column: str, touched: Iterable[object]) -> None:
    """Rewrite the touched partitions of a table with these rows, leaving all others alone.

    ``df`` may read the same path: Spark writes beside it and swaps partitions at commit.
    Touched partitions that get no row are dropped.
    Values are dates or whole numbers; ``None`` is the partition of null values.
    """
    spark = df.sparkSession
    seen = Observation()
    name = F.coalesce(F.col(column).cast("string"), F.lit(NULL_PARTITION))
    # Observed above the shuffle: below it, the node is lost when no row comes through.
    rows = df.hint("rebalance", column).observe(seen, F.collect_set(name).alias("written"))
    (
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(column).parquet(path)
    )
    written = set(seen.get["written"] or [])
    for value in touched:
        partition = NULL_PARTITION if value is None else str(value)
        if partition not in written:
            files, location = _file_system(spark, f"{path}/{column}={partition}")
            if files.exists(location):
                files.delete(location, True)


def days_between(start: str, end: str) -> list[date]:
    first, last = date.fromisoformat(start), date.fromisoformat(end)
    return [first + timedelta(days=n) for n in range((last - first).days + 1)]


def replace_window_in_place(
    batch: DataFrame, path: str, moment: str | Column, day_column: str, start: str, end: str
) -> None:
    """``replace_by_window`` on a table partitioned by day, without reading the table.

    The window's days are rewritten from the batch.  Batch rows of other days, or of
    none, are added to their partitions, since the window does not cover them.
    """
    moment = F.col(moment).try_cast("timestamp") if isinstance(moment, str) else moment
    rows = batch.withColumn(day_column, F.to_date(moment))
    inside = F.coalesce(F.col(day_column).between(F.lit(start).cast("date"), F.lit(end).cast("date")),
                        F.lit(False))
    replace_partitions(rows.where(inside), path, day_column, days_between(start, end))
    outside = rows.where(~inside)
    if not outside.isEmpty():
        append(outside, path, partition_by=day_column)


def export_delimited(df: DataFrame, path: str, sep: str = ",") -> None:
    """Delimited text with a header; values are quoted only where they need it."""
    writer = df.write.mode("overwrite").option("header", True).option("sep", sep)
    writer = writer.option("escape", '"').option("emptyValue", "")
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.csv(path)


RUN_SCHEMA = (
    "programa string, tabela string, duracao double, logs string, erro string, "
    "data_processamento timestamp"
)


LOG_FILES = 64


def log_run(
    spark: SparkSession, path: str, program: str, table: str, seconds: float, logs: str, error: str, most_files: int = LOG_FILES
) -> DataFrame:
    """Append one run record; the duration is in seconds.  A log of more than ``most_files`` files becomes one."""
    record = (program, table, float(seconds), logs, error, datetime.now())
    written = append(spark.createDataFrame([record], RUN_SCHEMA).coalesce(1), path)
    files, location = _file_system(spark, path)
    if sum(f.getPath().getName().endswith(".parquet") for f in files.listStatus(location)) > most_files:
        return full_refresh(written.coalesce(1), path)
    return written


def run_logged(
    df: DataFrame,
    write: Callable[[DataFrame], object],
    log_path: str,
    program: str,
    table: str,
    counters: Mapping[str, Column],
) -> DataFrame:
    """Write a table and log the run with counters taken while the rows pass through."""
    observed = Observation()
    started = time.monotonic()
    logs, error = "", "N"
    try:
        write(df.observe(observed, *[c.alias(name) for name, c in counters.items()]))
        logs = " | ".join(f"{name}={value}" for name, value in observed.get.items())
    except Exception as failure:
        logs, error = str(failure), "S"
        raise
    finally:
        record = log_run(df.sparkSession, log_path, program, table, time.monotonic() - started, logs, error)
    return record
