from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from feedloom import sinks
from feedloom.plans import replicate
from feedloom.sinks.merge import DuplicateKeys
from feedloom.sources import read_delimited
from feedloom.streaming import daily_backfill
from tests.conftest import rows


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [(1, "ana", "x", "t1"), (2, "bia", None, "t2"), (3, "caio", "z", "t3"), (None, "none", "n", "t")],
        "cpf int, nome string, email string, telefone string")


@pytest.fixture
def batch(spark):
    return spark.createDataFrame(
        [(1, "ana", "x", "new"), (2, "bia", "now", "new"), (3, "caio b", None, "new"), (4, "dora", "w", "new"), (None, "again", "n", "t")],
        "cpf int, nome string, email string, telefone string")


def test_upsert_sees_no_change_from_or_to_null(people, batch):
    found = sinks.merge_upsert(people, batch, "cpf", ["nome", "email"])
    assert rows(found) == [
        (None, "again", "n", "t"), (None, "none", "n", "t"), (1, "ana", "x", "t1"), (2, "bia", None, "t2"),
        (3, "caio b", None, "t3"), (4, "dora", "w", "new")]
    safe = sinks.merge_upsert(people, batch, "cpf", ["nome", "email"], null_safe=True)
    assert (2, "bia", "now", "t2") in rows(safe)


def test_upsert_refuses_a_batch_with_repeated_keys(batch):
    with pytest.raises(DuplicateKeys):
        sinks.verify_unique(batch.union(batch), "cpf")
    assert sinks.verify_unique(batch, "cpf") is batch


@pytest.mark.parametrize("load", [
    lambda t, b: sinks.replace_by_key(t, b, "cpf"),
    lambda t, b: sinks.replace_where(t, b, "cpf", F.col("nome") != "dora"),
    lambda t, b: sinks.merge_upsert(t, b, "cpf", ["nome", "email"]),
    lambda t, b: sinks.insert_new(t, b, "cpf"),
])
def test_loading_twice_equals_loading_once(people, batch, load):
    keyed = batch.where("cpf IS NOT NULL")
    once = load(people, keyed)
    assert rows(load(once, keyed)) == rows(once)


def test_replace_where_drops_rows_that_are_not_put_back(people, batch):
    found = sinks.replace_where(people, batch, "cpf", F.col("nome") == "ana")
    assert rows(found, "cpf", "telefone") == [(None, "t"), (1, "new")]


@pytest.fixture
def sales(spark):
    return spark.createDataFrame(
        [(1, "2024-01-01 10:00:00"), (2, "2024-01-02 00:00:00"), (3, "2024-01-02 23:59:59"), (4, "2024-01-03 00:00:00"), (5, "bad"), (6, None)],
        "id int, sold string")


def test_window_is_half_open_and_unreadable_dates_stay(sales):
    none = sales.where("false")
    assert rows(sinks.replace_by_window(sales, none, "sold", "2024-01-02", "2024-01-02"), "id") == [(1,), (4,), (5,), (6,)]
    assert rows(sinks.replace_by_window(sales, none, "sold", "2024-01-02", "2024-01-02", drop_null=True), "id") == [(1,), (4,)]
    assert rows(sinks.replace_tail(sales, none, "sold", "2024-01-02"), "id") == [(1,), (5,), (6,)]


def test_window_in_place_rewrites_only_its_days(spark, sales, tmp_path):
    path = str(tmp_path / "sales")
    moment = F.col("sold").try_cast("timestamp")
    sinks.full_refresh(sales.withColumn("day", F.to_date(moment)), path, partition_by="day")
    untouched = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "sales" / "day=2024-01-01").iterdir()}
    batch = spark.createDataFrame([(30, "2024-01-02 12:00:00")], "id int, sold string")
    for _ in range(2):
        sinks.replace_window_in_place(batch, path, "sold", "day", "2024-01-02", "2024-01-03")
    assert rows(spark.read.parquet(path), "id") == [(1,), (5,), (6,), (30,)]
    assert untouched == {p.name: p.stat().st_mtime_ns for p in (tmp_path / "sales" / "day=2024-01-01").iterdir()}
    sinks.replace_window_in_place(batch.where("false"), path, "sold", "day", "2024-01-01", "2024-01-03")
    assert rows(spark.read.parquet(path), "id") == [(5,), (6,)]


def test_partitions_may_be_rewritten_from_their_own_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.full_refresh(spark.range(10).withColumn("p", F.col("id") % 3), path, partition_by="p")
    kept = spark.read.parquet(path).where("p < 2 AND id > 4")
    sinks.replace_partitions(kept, path, "p", [0, 1])
    assert rows(spark.read.parquet(path), "id") == [(2,), (5,), (6,), (7,), (8,), (9,)]


def test_null_partition_can_be_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.createDataFrame([(1, date(2024, 1, 1)), (2, None)], "id int, day date")
    sinks.full_refresh(frame, path, partition_by="day")
    sinks.replace_partitions(frame.where("id = 2").withColumn("id", F.lit(3)), path, "day", [None])
    assert rows(spark.read.parquet(path), "id") == [(1,), (3,)]
    sinks.replace_partitions(frame.where("false"), path, "day", [None])
    assert rows(spark.read.parquet(path), "id") == [(1,)]


def test_refresh_append_and_copies(spark, tmp_path):
    dim = spark.range(3).withColumnRenamed("id", "code")
    paths = [str(tmp_path / n) for n in "ab"]
    for _ in range(2):
        first, second = replicate(dim, paths)
    assert rows(first) == rows(second) == [(0,), (1,), (2,)] and first.columns == ["CODE"]
    for _ in range(2):
        (copy,) = replicate(dim, [str(tmp_path / "c")], mode="append")
    assert copy.count() == 6


def test_export_round_trip(spark, tmp_path):
    path = str(tmp_path / "csv")
    data = [('a;"b"', " x "), ("ção", None), ("NA", "n/a"), ("NONE", "")]
    sinks.export_delimited(spark.createDataFrame(data, "t string, u string"), path, sep=";")
    assert rows(read_delimited(spark, path, ["t", "u"])) == [
        (None, None), ("NONE", None), ('a;"b"', " x "), ("ção", None)]


def test_failed_runs_are_logged_too(spark, tmp_path):
    log = str(tmp_path / "log")
    counters = {"rows": F.count(F.lit(1))}
    sinks.run_logged(spark.range(4), lambda df: sinks.full_refresh(df, str(tmp_path / "t")), log, "JOB", "t", counters)
    sinks.run_logged(spark.range(0), lambda df: sinks.full_refresh(df, str(tmp_path / "e")), log, "JOB", "e", counters)

    def fail(df):
        raise ValueError("no room")

    with pytest.raises(ValueError):
        sinks.run_logged(spark.range(4), fail, log, "JOB", "f", counters)
    found = rows(spark.read.parquet(log), "tabela", "logs", "erro")
    assert found == [("e", "rows=0", "N"), ("f", "no room", "S"), ("t", "rows=4", "N")]


def test_a_log_of_many_files_becomes_one(spark, tmp_path):
    path = tmp_path / "log"
    for n in range(4):
        logged = sinks.log_run(spark, str(path), "JOB", f"t{n}", 1.0, "", "N", most_files=3)
    assert rows(logged, "tabela") == [("t0",), ("t1",), ("t2",), ("t3",)] and len(list(path.glob("*.parquet"))) == 1


def test_daily_backfill_is_repeatable(spark, tmp_path):
    path = str(tmp_path / "days")
    events = spark.createDataFrame([(i, datetime(2024, 1, 1 + i % 4, 12)) for i in range(20)], "id int, ts timestamp")
    for _ in range(2):
        daily_backfill(events, path, "ts", "2024-01-02", "2024-01-03", lambda df: df.where("id <> 1"))
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [i for i in range(20) if i % 4 in (1, 2) and i != 1]
