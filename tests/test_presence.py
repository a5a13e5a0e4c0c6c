from __future__ import annotations

import random

from pyspark.sql import functions as F

from feedloom import plans
from feedloom.operators.presence import count_presence, number_members, presence
from tests.conftest import rows

COLUMNS = "event_date string, campaign_name_cross string, city string, user_pseudo_id string, ga_session_id long, event_name string, is_active_user boolean, purchase_revenue double"


def events(spark, days):
    dice = random.Random(11)
    pick = lambda *v: dice.choice(v)
    data = [
        (pick(*days), pick("a", "b", None), pick("x", None), pick(None, *(f"u{i}" for i in range(12))), pick(None, 1, 2, 3),
         pick("page_view", "add_to_cart", "purchase", "other"), pick(True, False, None), pick(None, 1.5, 2.0))
        for _ in range(900)
    ]
    return spark.createDataFrame(data, COLUMNS)


def test_counts_over_days_are_unions(spark):
    data = [(i % 4, i * 7919 % 50_000, i % 3) for i in range(4000)] + [(0, None, 1)]
    frame = spark.createDataFrame(data, "day int, member long, g int")
    found = presence(frame, ["day", "g"], "member")
    for by in (["day", "g"], ["g"], []):
        wanted = frame.groupBy(*by).agg(F.count_distinct("member").alias("n"))
        assert rows(count_presence(found, by, "n")) == rows(wanted)


def test_numbers_stay_dense(spark):
    first = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "m string")
    known = number_members(first, "m")
    assert rows(known) == [("a", 0), ("b", 1)]
    more = number_members(spark.createDataFrame([("0",), ("b",), ("c",)], "m string"), "m", known)
    assert rows(more) == [("0", 2), ("c", 3)]


def test_a_report_that_is_kept_equals_the_whole_after_each_day(spark, tmp_path):
    days = ["20240101", "20240102", "20240103"]
    folder, data = str(tmp_path / "crm"), events(spark, days)
    for n, day in enumerate([*days, days[1]]):  # the last one is loaded again
        plans.load_crm_day(folder, data.where(F.col("event_date") == day))
        seen = data.where(F.col("event_date").isin(days[:n + 1]))
        assert rows(plans.read_crm(spark, folder)) == rows(plans.crm_daily_fused(seen))
    by = ["campaign_name_cross"]
    whole = data.groupBy(*by).agg(
        F.count_if(F.col("event_name") == "page_view"), F.count_distinct(F.concat("user_pseudo_id", F.lit("-"), F.col("ga_session_id").cast("string"))),
        F.count_distinct(F.when(F.col("is_active_user"), F.col("user_pseudo_id"))), F.count_if(F.col("event_name") == "add_to_cart"),
        F.count_distinct(F.when(F.col("event_name") == "purchase", F.col("user_pseudo_id"))), F.sum("purchase_revenue"))
    assert rows(plans.read_crm(spark, folder, by)) == rows(whole)
