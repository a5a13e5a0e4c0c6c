"""What loads and lookups shuffle and hold as their tables grow."""

from __future__ import annotations

import re
from itertools import count

import pytest
from pyspark.sql import functions as F

from feedloom import functions as fn
from feedloom import plans
from feedloom.functions.text import LATIN_LETTERS, NOT_KEPT, WHITESPACE, WHITE_RANGES
from feedloom.operators import joins
from feedloom.sinks import versions
from tests.conftest import rows


@pytest.mark.parametrize("few", [versions.FEW_KEYS, 0])
def test_rows_beside_a_batch_are_written_without_a_second_shuffle(spark, tmp_path, monkeypatch, few):
    """Few keys are broadcast and the rest stays in file order; many keys meet the rows by bucket, one shuffle."""
    monkeypatch.setattr(versions, "FEW_KEYS", few)
    path, plans, written = str(tmp_path / "t"), [], versions._written
    table = spark.createDataFrame([(i % 50 if i % 7 else None, f"old{i}") for i in range(300)], "id int, name string")
    batch = spark.createDataFrame([(i, "new") for i in (3, 4, 3, 100, None)], "id int, name string")
    versions.load_full(table, path, versions.ByKey("id"))

    def seen(frame, *args):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return written(frame, *args)

    monkeypatch.setattr(versions, "_written", seen)
    setting = spark.conf.get(versions.ALL_KEYS)
    loaded = versions.load_by_key(batch, path, "id")
    kept = table.where(~F.coalesce(F.col("id").isin(3, 4, 100), F.lit(False)))
    assert rows(loaded) == rows(kept.union(batch))
    rest = next(plan for plan in plans if "LeftAnti" in plan)
    assert rest.count("Exchange hashpartitioning") == (0 if few else 2)  # the rows' and the keys' own
    assert "rebalance" not in rest.lower()
    assert spark.conf.get(versions.ALL_KEYS) == setting


def test_a_staged_window_is_loaded_without_a_shuffle(spark, tmp_path, monkeypatch):
    """Rows are gathered by day once, as they are staged; each load writes the staged files one by one."""
    path, plans_seen, written = str(tmp_path / "t"), [], versions._written
    table = spark.createDataFrame([(i, f"2024-01-{1 + i % 9:02d}" if i % 10 else None) for i in range(300)], "id int, at string")

    def seen(frame, *args):
        plans_seen.append(frame._jdf.queryExecution().executedPlan().toString())
        return written(frame, *args)

    monkeypatch.setattr(versions, "_written", seen)
    setting = spark.conf.get(versions.OPEN_COST)
    staged = plans.stage_window(path, table, "at")
    assert plans_seen.pop().count("Exchange hashpartitioning") == 1
    plans.load_window(path, staged.where("at < '2024-01-05'"), "at", "2024-01-01", "2024-01-04", gathered=True)
    for _ in range(2):
        loaded = plans.load_window(path, staged, "at", "2024-01-01", "2024-01-31", gathered=True)
        assert rows(loaded) == rows(table)
    assert len(plans_seen) == 5 and not any("Exchange" in plan for plan in plans_seen)  # three batches, twice the rest
    assert len(loaded.inputFiles()) == len(staged.inputFiles())
    assert spark.conf.get(versions.OPEN_COST) == setting


def test_facts_are_shuffled_once_for_all_dimensions_of_a_key(spark):
    fact = spark.createDataFrame([(i, str(i % 5) if i % 6 else None) for i in range(60)], "n int, cpf string")
    first = spark.createDataFrame([("1", "a"), ("1", "b"), ("3", "c"), (None, "z")], "cpf string, x string")
    second = spark.createDataFrame([("1", 7), ("2", 8)], "cpf string, y int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joins.left_joins_salted(fact, [first, second], "cpf", ["1"])
        assert rows(joined) == rows(fact.join(first, "cpf", "left").join(second, "cpf", "left"))
        assert joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange hashpartitioning") == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_events_of_one_title_are_looked_up_once(spark):
    """The index holds titles, not events."""
    ids = count()
    events = spark.createDataFrame([(next(ids), title, day) for title in ("Fla X Flu", "Time X Vasco") for day in (1, 2) for _ in range(40)], "id int, title string, day int")
    probes = spark.createDataFrame([("a x flu", 1), ("b X Vasco", 2), ("c X %", 1), ("d X none", 1)], "name string, on int")
    found = joins.match_suffixes(events, "id", "title", F.col("day"), probes, "name", F.col("on"), separator=" X ")
    seen = {(r.name, r.on) for r in found.collect()}
    assert seen == {("a x flu", 1), ("b X Vasco", 2), ("c X %", 1)}
    assert found.where("name = 'b X Vasco'").count() == 40 and found.where("name = 'c X %'").count() == 80
    index = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [_on" in index.split("Generate")[-1]


def test_white_ranges_are_the_white_space(column):
    texts = [chr(code) for code in range(0x3100)]
    kept = "".join(x or "" for x in column(fn.letters_only, *texts))
    assert [c for c in texts if c in WHITESPACE] == [c for c in kept if not c.isalpha()]
    assert len(WHITE_RANGES) < 90


def test_only_characters_beyond_latin_1_come_to_the_ranges(column):
    """What is not kept is the complement of letters and white space; up to U+00FF it is told by one table."""
    plain = f"[{LATIN_LETTERS}{WHITE_RANGES}]"
    texts = [chr(code) for code in range(1, 0x3100)] + ["\U0001f600", "\U0010ffff", "a\U0001f600\u2003b-1"]
    assert column(fn.letters_only, *texts) == ["".join(re.findall(plain, text)) for text in texts]
    low = NOT_KEPT[1:].split("[")[0]
    assert "-" not in low and len(low) == 4 * sum(not re.match(plain, chr(code)) for code in range(0x100))
