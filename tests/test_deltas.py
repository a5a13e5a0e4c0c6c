"""Streams that write what their cycles bring, and duplicates by a state store."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from feedloom.sinks import versions
from feedloom.streaming import Days, deltas, fold, left_out, read_merged, stream_dedupe_within, stream_deltas, stream_files
from tests.conftest import rows
from tests.test_versions import Stopped, stop_at

SCHEMA = "id int, at timestamp, kind string, seq int"

# day and kind of a ticket, cycle by cycle: 1 moves twice, 2 is dropped and an older copy comes late, 3 stays
CYCLES = [
    [(1, 1, "a", 1), (2, 1, "a", 1), (3, 1, "a", 1), (4, 9, "z", 1)],
    [(1, 2, "b", 2), (2, 1, "drop", 5)],
    [(1, 3, "c", 3), (2, 2, "late", 4), (5, 3, "n", 1)],
    [(5, 1, "n2", 2), (6, 3, "m", 1)],
]
EXPECTED = [(1, "c", 3), (3, "a", 1), (4, "z", 9), (5, "n2", 1), (6, "m", 3)]


def by():
    return Days(day=F.to_date("at"), key="id", order=F.col("seq"))


def clean(df):
    return df.where("kind <> 'drop'")


def land(spark, folder, cycle):
    data = [(i, datetime(2024, 1, day, 12), kind, seq) for i, day, kind, seq in cycle]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def load(spark, folder, path):
    stream_deltas(stream_files(spark, folder, spark.createDataFrame([], SCHEMA).schema), path, path + "-state", by(), clean).awaitTermination()


def found(spark, path):
    return rows(read_merged(spark, path, by()).select("id", "kind", F.dayofmonth("day").alias("d")))


@pytest.mark.parametrize("folds", [(), (0,), (1, 2), (0, 1, 2, 3), (3,)])
def test_a_record_stands_once_whatever_the_folds(spark, tmp_path, folds):
    folder, path = str(tmp_path / "in"), str(tmp_path / "out")
    for n, cycle in enumerate(CYCLES):
        land(spark, folder, cycle)
        load(spark, folder, path)
        if n in folds:
            fold(spark, path, by())
    assert found(spark, path) == EXPECTED
    fold(spark, path, by())
    assert found(spark, path) == EXPECTED and deltas._cycles(spark, path) == []
    held = versions.read_table(spark, f"{path}/{deltas.PLACES}")
    assert rows(held.groupBy("id").count().where("count > 1")) == []


def test_a_cycle_writes_its_input_and_a_fold_its_days(spark, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "out")
    land(spark, folder, CYCLES[0])
    load(spark, folder, path)
    fold(spark, path, by())
    table = f"{path}/{deltas.TABLE}"
    listed = lambda: {r["file"] for r in versions.manifest(spark, table, versions.version(spark, table)).collect()}
    before = listed()
    for cycle in CYCLES[1:]:
        land(spark, folder, cycle)
        load(spark, folder, path)
    written = [spark.read.parquet(f"{path}/{deltas.CYCLES}/{n}").count() for n in deltas._cycles(spark, path)]
    assert written == [2, 3, 2] and listed() == before
    fold(spark, path, by())
    assert found(spark, path) == EXPECTED


def test_a_fold_stopped_anywhere_and_repeated(spark, tmp_path):
    folder = str(tmp_path / "in")
    land(spark, folder, CYCLES[0])
    first = len(list((tmp_path / "in").glob("*.parquet")))
    assert first
    for at in range(40):
        path, source = str(tmp_path / f"out{at}"), str(tmp_path / f"in{at}")
        for n, cycle in enumerate(CYCLES):
            land(spark, source, cycle)
            load(spark, source, path)
            if n == 0:
                fold(spark, path, by())
        with pytest.MonkeyPatch.context() as patched:
            # every third point between operations; test_versions stops at all of those of a single load
            stop_at(patched, versions, ("write_rows", "write_manifest", "publish_marker"), at * 3)
            stop_at(patched, deltas, ("remove",), 2 * at)
            try:
                fold(spark, path, by())
                done = True
            except Stopped:
                done = False
        assert found(spark, path) == EXPECTED
        fold(spark, path, by())
        assert found(spark, path) == EXPECTED
        if done:
            break
    assert done and at >= 3


def test_keys_are_required(spark, tmp_path):
    with pytest.raises(ValueError):
        stream_deltas(spark.readStream.format("rate").load(), str(tmp_path / "t"), str(tmp_path / "s"), Days(day=F.current_date()))


def test_duplicates_leave_the_state_as_the_watermark_passes(spark, tmp_path):
    folder, path, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    start = datetime(2024, 1, 1)
    schema = spark.createDataFrame([], "id int, at timestamp").schema
    dropped, held = 0, []
    for n in range(6):
        data = [(10 * n + i, start + timedelta(days=2 * n, hours=i)) for i in range(10)]
        data += [(10 * n, start + timedelta(days=2 * n))]  # a copy in the same cycle
        data += [(10 * (n - 1) + 9, start + timedelta(days=2 * (n - 1), hours=9))] * (n == 3)  # a copy that is still remembered
        data += [(10 * n - 100, start - timedelta(days=30))] * (n == 4)  # far behind it
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(folder)
        query = stream_dedupe_within(stream_files(spark, folder, schema), path, state, "id", "at", "1 day")
        query.awaitTermination()
        dropped += left_out(query)
        held.append(query.lastProgress["stateOperators"][0]["numRowsTotal"] if query.lastProgress["stateOperators"] else 0)
    loaded = rows(spark.read.parquet(path), "id")
    assert loaded == [(i,) for i in range(60)]
    assert dropped == 1 and max(held) <= 20
