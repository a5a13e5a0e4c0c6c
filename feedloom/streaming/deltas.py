"""The near-real-time load with days that are merged when they are read.

A cycle writes what its files bring, and no more: a folder of its own, which a cycle repeated after a crash writes
again.  ``read_merged`` takes the newest record of each key from the folded table and the cycles since; rows whose
key no cycle has are passed on as they are.  ``fold`` brings the cycles into the table, at the close of a day or
whenever there are many: only files of the days they concern are written again.

A key may change its day.  ``places`` keeps the days that a key may stand in; a fold looks its keys up there, and
so finds the files of the day that a record has left.  A fold can be stopped anywhere and repeated: the table's
version says which cycles it holds, and ``places`` names old and new days until that version is out.

What the table holds does not depend on how files were cut into cycles, nor on when it is folded: every record has
an order (see ``refresh``), and of equal orders of a key one is taken by its content.  Records that the transform
drops leave a mark.  Rows without a key count as one key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedloom.sinks import versions
from feedloom.sinks.tables import path_exists, remove
from feedloom.streaming.refresh import LIVE, ORDER, Days, Transform, _same, changes, newest

CYCLES, TABLE, PLACES = "cycles", "table", "places"


def stream_deltas(source: DataFrame, path: str, checkpoint: str, by: Days, transform: Transform = _same, cycle: str | None = None) -> StreamingQuery:
    """Load a stream of keyed records; each cycle adds a folder of the size of its input."""
    if by.key is None:
        raise ValueError("records without a key can't be told apart when they are read")

    def load(batch: DataFrame, batch_id: int) -> None:
        rows, _ = changes(batch, transform, by)
        rows.write.mode("overwrite").parquet(f"{path}/{CYCLES}/{batch_id}")

    trigger = {"processingTime": cycle} if cycle else {"availableNow": True}
    return source.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _cycles(spark: SparkSession, path: str) -> list[int]:
    """The cycles that are written whole."""
    names = [status.getPath().getName() for status in versions._listed(spark, f"{path}/{CYCLES}")]
    return sorted(int(n) for n in names if n.isdigit() and path_exists(spark, f"{path}/{CYCLES}/{n}/_SUCCESS"))


def _state(spark: SparkSession, path: str) -> tuple[versions.Version | None, list[int], int]:
    """The folded table, the cycles it lacks, and the last one it has."""
    at = versions.version(spark, f"{path}/{TABLE}")
    last = at.note["cycle"] if at else -1
    return at, [n for n in _cycles(spark, path) if n > last], last


def _read(spark: SparkSession, path: str, at: versions.Version | None, cycles: list[int]) -> DataFrame:
    reader = spark.read if at is None else spark.read.schema(at.schema)
    return reader.parquet(*[f"{path}/{CYCLES}/{n}" for n in cycles])


def _loaded_key(by: Days) -> str:
    return by.loaded_key or by.key


def read_merged(spark: SparkSession, path: str, by: Days) -> DataFrame:
    """The table as of the last cycle, without orders and marks."""
    at, cycles, _ = _state(spark, path)
    if at is None and not cycles:
        raise FileNotFoundError(path)
    key = _loaded_key(by)
    if not cycles:
        rows = versions.read_table(spark, f"{path}/{TABLE}")
    else:
        rows = deltas = _read(spark, path, at, cycles)
        if at is not None:
            table = versions.read_table(spark, f"{path}/{TABLE}", at.number)
            touched = deltas.select(F.col(key).alias("_touched")).distinct()
            same = F.col(key).eqNullSafe(F.col("_touched"))
            apart = table.join(touched, same, "left_anti")
            rows = newest(deltas.unionByName(table.join(touched, same, "left_semi")), [key], True).unionByName(apart)
        else:
            rows = newest(rows, [key], True)
    return rows.where(LIVE).drop(ORDER, LIVE)


def fold(spark: SparkSession, path: str, by: Days) -> None:
    """Bring the cycles into the table; the folders they lie in go, and so does what was read from them."""
    at, cycles, last = _state(spark, path)
    table, places, key, days = f"{path}/{TABLE}", f"{path}/{PLACES}", _loaded_key(by), versions.ByDay(by.column)
    if cycles:
        found = versions.stage(newest(_read(spark, path, at, cycles), [key], True), table)
        here = found.select(key, by.column)
        files = []
        if at is not None:
            held = versions.version(spark, places)
            near = versions.rows_of(spark, places, held, versions.holding(spark, places, held, here, key)) if held else here.limit(0)
            left = near.join(here.select(key).distinct(), key, "left_semi").select(by.column)
            files = versions.sharing(spark, table, at, left.union(here.select(by.column)), days)
            found = newest(versions.rows_of(spark, table, at, files).unionByName(found), [key], True)
            found = versions.stage(found, table)
        # both days until the table is out: a fold that dies in between is repeated with all of them
        versions.load_more(here, places, versions.ByKey(key))
        versions.exchange(found, table, files, days, {"cycle": cycles[-1]})
        settled = found.join(here.select(key).distinct(), key, "left_semi").select(key, by.column)
        versions.load_by_key(settled, places, key)
        last = cycles[-1]
    for number in _cycles(spark, path):
        if number <= last:
            remove(spark, f"{path}/{CYCLES}/{number}")
    for name in (table, places):
        if cycles:
            versions.vacuum(spark, name)
