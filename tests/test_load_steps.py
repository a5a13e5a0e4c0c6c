from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from feedloom import plans, sinks
from tests.conftest import rows


def test_windows_replace_and_repeat(spark, tmp_path):
    path = str(tmp_path / "shop")
    frame = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (3, None)], "id int, at string")
    plans.load_window(path, frame, "at", "2024-01-01", "2024-01-31")
    later = spark.createDataFrame([(9, "2024-01-02")], "id int, at string")
    for _ in range(2):
        found = plans.load_window(path, later, "at", "2024-01-02", "2024-01-31")
        assert rows(found) == [(1, "2024-01-01"), (9, "2024-01-02")]


def test_dimension_grows_once(spark, tmp_path):
    path = str(tmp_path / "dim")
    fact = spark.createDataFrame([("a", "cup", "x", 1), ("b", "Tour da casa", "y", 2), (None, "cup", "z", 3)], "idapresentacao string, campeonato string, partida string, dthr_apresentacao int")
    for _ in range(2):
        assert rows(plans.load_dim_entries(path, fact)) == [("a", "cup", "x", 1)]
    more = fact.union(spark.createDataFrame([("c", "cup", "w", 4)], fact.schema))
    assert rows(plans.load_dim_entries(path, more), "idapresentacao") == [("a",), ("c",)]


def test_a_table_is_rewritten_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.full_refresh(spark.range(5), path)
    doubled = spark.read.parquet(path).select((F.col("id") * 2).alias("id"))
    assert rows(sinks.rewrite(doubled, path)) == [(0,), (2,), (4,), (6,), (8,)]
    assert not sinks.path_exists(spark, path + "__next")


@pytest.mark.parametrize("partition", [None, "day"])
def test_no_rows_before_the_first_load(spark, tmp_path, partition):
    like = spark.createDataFrame([(1, datetime(2024, 1, 1))], "id int, day timestamp")
    assert sinks.read_if_there(spark, str(tmp_path / "none"), like).count() == 0
    sinks.full_refresh(like, str(tmp_path / "some"), partition)
    assert rows(sinks.read_if_there(spark, str(tmp_path / "some"), like), "id") == [(1,)]


def test_matches_of_chosen_days(spark):
    catalogue = spark.createDataFrame([("1", "2024-01-01"), ("1", "2024-01-01"), ("2", "2024-01-02")], "COD_EVENTO string, DT_EVENTO string")
    assert rows(plans.events_of_dates(catalogue, ["2024-01-01"])) == [("1",)]
