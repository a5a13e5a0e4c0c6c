from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from feedloom.sources import plan_parts


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one value, some without one, and a long tail."""
    dice = random.Random(3)
    rows = [(i, None if i % 20 == 0 else 7 if i % 3 == 0 else int(dice.paretovariate(0.5)) % 10**6, dice.random()) for i in range(12_000)]
    return spark.createDataFrame(rows, "id int, v int, x double").withColumn("at", F.timestamp_seconds("id")).withColumn("day", F.to_date("at"))


@pytest.mark.parametrize("columns", [["v", "id"], ["v", "at"], ["day", "id"], ["x"], ["v", "x", "id"]])
def test_parts_are_even_and_hold_each_row_once(skewed, columns):
    parts = plan_parts(skewed, columns, 10)
    counts = [skewed.where(part).count() for part in parts]
    assert len(parts) == 10 and sum(counts) == 12_000 and max(counts) < 2 * 1200
    together = F.lit(0)
    for part in parts:
        together = together + F.coalesce(F.expr(part).cast("int"), F.lit(-100))
    assert skewed.where(together != 1).isEmpty()


def test_few_rows_and_none(spark):
    frame = spark.createDataFrame([(1, None), (1, None), (None, 2.5), (3, float("nan"))], "a int, b double")
    for rows in (frame, frame.where("false")):
        parts = plan_parts(rows, ["a", "b"], 5)
        assert sum(rows.where(part).count() for part in parts) == rows.count()


def test_texts_have_no_order_of_their_own(spark):
    with pytest.raises(ValueError):
        plan_parts(spark.createDataFrame([("a",)], "t string"), ["t"], 2)
