"""What the planner makes of the operators."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from feedloom.operators import joins
from feedloom.operators.dedupe import dedupe_last
from feedloom.registry import QUERIES
from feedloom.registry.base import Tables
from feedloom.sources import read_day

SF = "/root/testdata/sf0.001"
# These stand for a stored table in the middle of the query, not for an operator's plan.
EAGER = ("stream_", "load_", "replace_window_in_place", "run_log", "daily_backfill", "replicate_dims")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, SF)


@pytest.mark.parametrize("key", [k for k in QUERIES if not k.startswith(EAGER)])
def test_no_python_no_cross_join(spark, key):
    text = plan(QUERIES[key](spark, SF))
    for word in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_days_reach_the_reader(tables):
    text = plan(read_day(tables.events, "ts", "2024-01-10").select("event_id"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-10" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_report_reads_the_events_once(spark, tables):
    text = plan(QUERIES["crm_daily"](spark, SF))
    assert text.count("FileScan") == 1 and "Join" not in text
    assert plan(QUERIES["outer_join_chain"](spark, SF)).count("FileScan") == 4


def test_deduplication_reduces_before_the_shuffle(tables):
    text = plan(dedupe_last(tables.events, ["user_id"], ["ts", "event_id"]))
    assert "Window" not in text and text.count("partial_max_by") == 1


def test_new_rows_do_not_shuffle_the_target_for_a_small_batch(tables):
    batch = tables.part.where("p_size = 3").select(F.col("p_partkey").alias("l_partkey"))
    text = plan(joins.new_rows(batch, tables.lineitem, "l_partkey"))
    assert re.search(r"BroadcastHashJoin [^\n]*LeftSemi", text) and "ReadSchema: struct<l_partkey:bigint>" in text


def test_nested_paths_are_pruned(spark, tmp_path):
    frame = spark.createDataFrame([(1, (("p", "q"), "r"))], "id int, s struct<a struct<b string, c string>, d string>")
    frame.write.parquet(str(tmp_path / "n"))
    from feedloom.operators.shape import project_paths

    text = plan(project_paths(spark.read.parquet(str(tmp_path / "n")), {"x": "s.a.b"}))
    assert re.search(r"ReadSchema: struct<s:struct<a:struct<b:string>>>", text)


def test_hot_join_key_is_split(spark):
    """A third of the rows under one key: adaptive execution cuts that partition up."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in changed}
    try:
        for name, value in changed.items():
            spark.conf.set(name, value)
        key = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 997)
        fact = spark.range(0, 400_000, 1, 8).select(key.alias("cpf"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
        dim = spark.range(-1, 997).select(F.col("id").alias("cpf"), F.lit(None).cast("string").alias("end"), (F.col("id") * 2).alias("sk"))
        joined = joins.join_current(fact, dim, "cpf", "end", ["sk"])
        counted = joined.groupBy("x").agg(F.max("sk").alias("sk")).agg(F.count(F.lit(1)), F.count("sk"))
        assert counted.collect() == [(400_000, 400_000)]
        assert "skew=true" in plan(counted)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
