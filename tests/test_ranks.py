from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from feedloom.operators import ranks
from feedloom.operators.dedupe import dedupe_first, dedupe_last
from feedloom.operators.groups import base_row, entity_totals, extremes, quality_counters
from feedloom.operators.ranks import with_position
from tests.conftest import rows


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows; values repeat, and some rows are the same throughout."""
    dice = random.Random(7)
    data = [("hot" if dice.random() < 0.6 else dice.choice(["a", "b", None]), dice.randrange(40), i // 2) for i in range(4000)]
    return data, spark.createDataFrame(data, "g string, v int, id int").repartition(6)


@pytest.mark.parametrize("buckets", [2, 7, 256])
def test_positions_agree_with_brute_force(skewed, buckets):
    data, frame = skewed
    groups = defaultdict(list)
    for g, v, i in data:
        groups[g].append((-v, i))
    expected = [(g, -v, i, n) for g, entries in groups.items() for n, (v, i) in enumerate(sorted(entries), 1)]
    placed = with_position(frame, ["g"], ["-v", "id"], buckets=buckets)
    found = [tuple(r) for r in placed.collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "boolean", "double"])
@pytest.mark.parametrize("down", [False, True])
def test_positions_follow_sparks_order_of_any_kind(spark, kind, down):
    values = {
        "string": ["", "b", "a", "abcdefgh", "abcdefgg", "é", None], "boolean": [True, False, None],
        "date": ["2024-01-02", "1960-05-01", None], "timestamp": ["2024-01-02 03:04:05", "1960-05-01 00:00:00", None], "double": ["1.5", "-3", "0", None, "1e300"],
    }[kind]
    frame = spark.createDataFrame([(v, i) for i, v in enumerate(values * 3)], f"v {'boolean' if kind == 'boolean' else 'string'}, id int").withColumn("v", F.col("v").cast(kind))
    order = F.col("v").desc() if down else F.col("v").asc()
    wanted = [r.id for r in frame.orderBy(order, "id").collect()]
    placed = with_position(frame, [], ["-v" if down else "v", "id"], buckets=4)
    assert [r.id for r in placed.orderBy("position").collect()] == wanted


def test_positions_leave_no_group_in_one_task(skewed):
    """Rows are shuffled by group and range."""
    _, frame = skewed
    placed = with_position(frame, ["g"], ["v", "id"], buckets=8)
    assert placed.count() == frame.count()
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(g" in plan and "_bucket" in plan.split("hashpartitioning(g", 1)[1][:60]


@pytest.mark.parametrize("by", [[], ["g"]])
def test_one_value_for_all_rows_is_cut_as_well(spark, by):
    frame = spark.range(20_000).select(F.lit("all").alias("g"), F.lit(5).alias("v"), "id")
    placed = with_position(frame, by, ["-v", "id"], sums={"total": "v"}, buckets=16)
    assert placed.where("position <> id + 1 or total <> 100000").isEmpty()
    fields = ranks._fields(frame, by, ["-v", "id"])
    sizes = [r["count"] for r in frame.groupBy(ranks._range_of(fields, ranks._cuts(frame, fields, 16))).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 20_000 / 16 * 2


def test_overall_ranking(skewed):
    data, frame = skewed
    found = with_position(frame, [], ["v", "id"]).select("v", "id", "position").collect()
    expected = [(v, i, n) for n, (v, i) in enumerate(sorted((v, i) for _, v, i in data), 1)]
    assert sorted(map(tuple, found), key=lambda r: r[2]) == expected
    assert with_position(frame.where("false"), [], ["v", "id"]).count() == 0


def test_dedupe_treats_null_as_a_key(spark):
    frame = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), ("k", 3, None), ("k", 4, "d")], "k string, n int, x string")
    assert rows(dedupe_first(frame, ["k"], ["n"])) == [(None, 1, "a"), ("k", 3, None)]
    assert rows(dedupe_last(frame, ["k"], ["n"])) == [(None, 2, "b"), ("k", 4, "d")]
    key = F.coalesce("k", F.lit("k"))
    assert rows(dedupe_last(frame, key, ["n"])) == [("k", 4, "d")]


def test_base_row_prefers_a_class_and_skips_null_groups(spark):
    frame = spark.createDataFrame(
        [("d", 3, "G"), ("d", 2, "P"), ("d", 4, "G"), ("e", 9, "P"), ("e", 8, None), (None, 1, "G")], "day string, id int, kind string")
    found = base_row(frame, ["day"], F.col("kind") == "G", "id", {"id": "base", "kind": "base_kind"})
    assert rows(found, "id", "base", "base_kind") == [
        (1, None, None), (2, 3, "G"), (3, 3, "G"), (4, 3, "G"), (8, 8, None), (9, 8, None)]


def test_entity_totals_and_extremes(spark):
    frame = spark.createDataFrame([("p", 2, 1), ("p", 0, 2), ("q", 2, 1)], "player string, goals int, game int")
    assert rows(entity_totals(frame, "player", "goals", ["game"]), "player", "position", "goals", "total") == [
        ("p", 1, 2, 2), ("p", 2, 0, 2), ("q", 1, 2, 2)]
    assert rows(extremes(frame, "goals"), "player", "game", "extreme") == [
        ("p", 1, "highest"), ("p", 2, "lowest"), ("q", 1, "highest")]


def test_counters_count_a_row_for_its_first_rule(spark):
    frame = spark.createDataFrame([(1, True), (2, None), (3, True), (4, False)], "n int, f boolean")
    counted = quality_counters(frame, {"low": F.col("n") < 2, "flagged": F.col("f")}, {"big": F.col("n") > 1})
    assert counted.first().asDict() == {
        "rows_in": 4, "removed_low": 1, "removed_flagged": 1, "rows_out": 2, "flagged_big": 2}
