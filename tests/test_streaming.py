from __future__ import annotations

import time
from datetime import datetime
from datetime import time as clock

import pytest
from pyspark.sql import functions as F

from feedloom.plans import clean_tickets, refresh_tickets
from feedloom.streaming import Days, read_refreshed, refresh, run_until, stream_backfill, stream_dedupe, stream_files, stream_refresh
from tests.conftest import rows

SCHEMA = "id int, ts timestamp, status string"


@pytest.fixture
def feed(spark, tmp_path):
    class Feed:
        path, table, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")

        def land(self, *records):
            data = [(i, datetime(2024, 1, day, 12), status) for i, day, status in records]
            spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
            time.sleep(0.05)

        def source(self, **options):
            return stream_files(spark, self.path, spark.createDataFrame([], SCHEMA).schema, **options)

        def load(self, key="id", state=None, files=1, **options):
            by = Days(day=F.to_date("ts"), key=key)
            stream_refresh(
                self.source(files_per_cycle=files), self.table, state or self.state, by, lambda df: df.where("status <> 'cancelled'"), **options
            ).awaitTermination(120)

        def content(self):
            return rows(read_refreshed(spark, self.table).select("id", F.dayofmonth("day"), "status"))

    return Feed()


def test_increments_replace_records_and_cancelled_ones_go(feed):
    feed.land((1, 1, "new"), (2, 1, "new"), (3, 2, "new"))
    feed.land((1, 1, "used"), (2, 1, "cancelled"), (4, 2, "new"))
    feed.load()
    assert feed.content() == [(1, 1, "used"), (3, 2, "new"), (4, 2, "new")]
    feed.land((3, 2, "cancelled"), (4, 2, "cancelled"))
    feed.load()
    assert feed.content() == [(1, 1, "used")]


def test_repeating_all_cycles_changes_nothing(feed):
    feed.land((1, 1, "new"), (2, 2, "new"))
    feed.land((2, 2, "used"))
    feed.load()
    before = feed.content()
    feed.load(state=feed.state + "-again")
    assert feed.content() == before == [(1, 1, "new"), (2, 2, "used")]


def test_snapshots_replace_their_days(feed):
    feed.land((1, 1, "new"), (2, 1, "new"), (3, 2, "new"))
    feed.land((2, 1, "used"))
    feed.load(key=None)
    assert feed.content() == [(2, 1, "used"), (3, 2, "new")]


def test_backfill_then_polling(feed):
    feed.land((1, 1, "new"), (2, 2, "new"), (3, 3, "new"))
    by = Days(day=F.to_date("ts"), key="id")
    stream_backfill(feed.source(), "2024-01-03", "ts", path=feed.table, checkpoint=feed.state + "-history", by=by).awaitTermination(120)
    assert [r[0] for r in feed.content()] == [1, 2]
    query = stream_refresh(feed.source(), feed.table, feed.state, by, cycle="1 second")
    query.processAllAvailable()
    assert run_until(query, clock(23, 55), now=datetime(2024, 1, 1, 23, 56)) is False
    assert not query.isActive
    assert [r[0] for r in feed.content()] == [1, 2, 3]


@pytest.mark.parametrize("key", ["id", None])
@pytest.mark.parametrize("files", [1, 2, None])
def test_cuts_into_cycles_change_nothing(feed, key, files):
    feed.land((1, 1, "new"), (2, 1, "new"), (3, 2, "new"))
    feed.land((1, 1, "used"), (2, 1, "cancelled"))
    feed.land((1, 1, "used again"), (5, 3, "cancelled"))
    feed.load(key=key, files=files)
    assert feed.content() == {
        "id": [(1, 1, "used again"), (3, 2, "new")],
        None: [(1, 1, "used again"), (3, 2, "new")],
    }[key]


@pytest.mark.parametrize("files", [1, None])
def test_records_out_of_order(feed, spark, files):
    """The status carries the order; older copies come after newer ones, one of which was dropped."""
    feed.land((1, 1, "3 used"), (2, 1, "2 cancelled"))
    feed.land((1, 1, "1 new"), (2, 1, "1 new"), (4, 9, "1 new"))
    feed.land((3, 1, "1 new"), (1, 1, "2 open"))
    by = Days(day=F.to_date("ts"), key="id", order=F.substring("status", 1, 1).cast("int"))
    stream_refresh(
        feed.source(files_per_cycle=files), feed.table, feed.state, by, lambda df: df.where("status not like '%cancelled'")
    ).awaitTermination(120)
    assert feed.content() == [(1, 1, "3 used"), (3, 1, "1 new"), (4, 9, "1 new")]


def test_a_cycle_killed_before_its_swap_is_finished(feed, monkeypatch):
    feed.land((1, 1, "new"), (2, 1, "new"))
    feed.load()
    feed.land((2, 1, "used"), (3, 1, "new"))

    def dies(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patched:
        patched.setattr(refresh, "swap_partitions", dies)
        with pytest.raises(Exception, match="killed"):
            feed.load()
    assert feed.content() == [(1, 1, "new"), (2, 1, "new")]
    with monkeypatch.context() as patched:
        patched.setattr(refresh, "_cycle_rows", dies)  # what was written aside is enough
        feed.load()
    assert feed.content() == [(1, 1, "new"), (2, 1, "used"), (3, 1, "new")]


@pytest.mark.parametrize("files", [1, None])
def test_dedupe_keeps_late_records(spark, feed, files):
    for records in ([(1, 28, "a")], [(4, 29, "a"), (4, 29, "a")], [(5, 30, "a"), (1, 28, "a")], [(2, 3, "a")], [(3, 30, "a")]):
        feed.land(*records)
    for _ in range(2):  # a second run finds nothing new
        stream_dedupe(feed.source(files_per_cycle=files), feed.table, feed.state, "id").awaitTermination(120)
        assert rows(spark.read.parquet(feed.table), "id") == [(1,), (2,), (3,), (4,), (5,)]
    stream_dedupe(feed.source(), feed.table, feed.state + "-again", "id").awaitTermination(120)
    assert rows(spark.read.parquet(feed.table), "id") == [(1,), (2,), (3,), (4,), (5,)]


def test_ticket_stream_equals_the_batch(spark, tmp_path):
    def ticket(i, status, minute):
        return (str(i), status, f"0{i % 3 + 1}/01/2024 10:{minute}", "Ana", "12345678901")

    schema = "ticket_id string, order_status string, payment_date string, name string, document string"
    source, table = str(tmp_path / "in"), str(tmp_path / "out")
    first = [ticket(i, "Pago", "00") for i in range(6)]
    second = [ticket(1, "Pago", "30"), ticket(2, "Cancelado", "30"), ticket(9, "PAGO", "30")]
    for part in (first, second):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        time.sleep(0.05)
    frame = spark.createDataFrame([], schema)
    refresh_tickets(stream_files(spark, source, frame.schema, 1), table, str(tmp_path / "s")).awaitTermination(120)
    latest = {t[0]: t for t in [*first, *second]}
    expected = clean_tickets(spark.createDataFrame(list(latest.values()), schema))
    columns = expected.columns
    assert rows(read_refreshed(spark, table), *columns) == rows(expected, *columns)
    assert expected.count() == 6
