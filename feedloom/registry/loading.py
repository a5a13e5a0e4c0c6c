"""Load strategies.  Tables are written to the session's work folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom import sinks
from feedloom.functions import to_float, to_int
from feedloom.operators.shape import stack_frames
from feedloom.registry.base import query, stamp
from feedloom.session import work_path
from feedloom.sources import read_delimited


@query("load_full_refresh", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def load_full_refresh(t):
    path = work_path(t.spark, "supplier")
    sinks.full_refresh(t.supplier.withColumn("s_name", F.lit("old")), path)
    return sinks.full_refresh(t.supplier, path)


@query("load_append", "SELECT * FROM supplier UNION ALL SELECT * FROM supplier")
def load_append(t):
    path = work_path(t.spark, "supplier")
    sinks.append(t.supplier, path, 100_000)
    return sinks.append(t.supplier, path, 100_000)


@query("load_fan_out", """
    SELECT p_partkey AS P_PARTKEY, p_name AS P_NAME, 'first' AS target FROM part
    UNION ALL SELECT p_partkey, p_name, 'second' FROM part""")
def load_fan_out(t):
    paths = [work_path(t.spark, "part") for _ in range(2)]
    copies = sinks.fan_out(t.part.select("p_partkey", "p_name"), paths)
    return stack_frames(*[c.withColumn("target", F.lit(n)) for c, n in zip(copies, ["first", "second"])])


def _order_batch(t):
    """Closed orders with a changed price, and the same orders again under new keys."""
    closed = t.orders.where(F.col("o_orderstatus") == "F").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return stack_frames(closed, closed.withColumn("o_orderkey", -F.col("o_orderkey") - 1))


ORDER_BATCH = """batch AS (
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority
    FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice + 1, o_orderdate, o_orderpriority
    FROM orders WHERE o_orderstatus = 'F')"""
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]


@query("replace_by_key", f"""
    WITH {ORDER_BATCH}, merged AS (SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch) UNION ALL SELECT * FROM batch)
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM merged""")
def replace_by_key(t):
    return sinks.replace_by_key(t.orders, _order_batch(t), "o_orderkey").select(*ORDER_COLUMNS)


@query("replace_where", f"""
    WITH {ORDER_BATCH}, merged AS (SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch)
        UNION ALL SELECT * FROM batch WHERE o_orderpriority = '1-URGENT')
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM merged""")
def replace_where(t):
    keep = F.col("o_orderpriority") == "1-URGENT"
    return sinks.replace_where(t.orders, _order_batch(t), "o_orderkey", keep).select(*ORDER_COLUMNS)


EVENT_IN = """SELECT event_id, CASE WHEN user_id % 20 <> 0 THEN ts END AS ts, event_type, value FROM events"""
EVENT_OUT = "event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_type, value"
WINDOW = ("2024-01-10", "2024-01-14")


def _dated(t):
    return t.events.select(
        "event_id", F.when(F.col("user_id") % 20 != 0, F.col("ts")).alias("ts"), "event_type", "value"
    )


def _shown(df):
    return df.select("event_id", stamp("ts").alias("ts"), "event_type", "value")


@query("replace_by_window", f"""
    WITH target AS ({EVENT_IN}), batch AS (SELECT event_id, ts, 'again' AS event_type, value FROM target
        WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-15' AND event_type <> 'error')
    SELECT {EVENT_OUT} FROM target WHERE ts IS NULL OR ts < TIMESTAMP '2024-01-10' OR ts >= TIMESTAMP '2024-01-15'
    UNION ALL SELECT {EVENT_OUT} FROM batch""")
def replace_by_window(t):
    target = _dated(t)
    window = (F.col("ts") >= "2024-01-10") & (F.col("ts") < "2024-01-15")
    batch = target.where(window & (F.col("event_type") != "error")).withColumn("event_type", F.lit("again"))
    return _shown(sinks.replace_by_window(target, batch, "ts", *WINDOW))


@query("replace_window_in_place", f"""
    WITH target AS ({EVENT_IN}), batch AS (SELECT event_id, ts, 'again' AS event_type, value FROM target
        WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-13')
    SELECT {EVENT_OUT} FROM target WHERE ts IS NULL OR ts < TIMESTAMP '2024-01-10' OR ts >= TIMESTAMP '2024-01-15'
    UNION ALL SELECT {EVENT_OUT} FROM batch""")
def replace_window_in_place(t):
    path = work_path(t.spark, "events")
    target = _dated(t)
    sinks.full_refresh(target.withColumn("day", F.to_date("ts")), path, partition_by="day")
    window = (F.col("ts") >= "2024-01-10") & (F.col("ts") < "2024-01-13")
    batch = target.where(window).withColumn("event_type", F.lit("again"))
    # Days 13 and 14 are in the window and have no row in the batch: they end up empty.
    sinks.replace_window_in_place(batch, path, "ts", "day", *WINDOW)
    return _shown(t.spark.read.parquet(path))


@query("replace_tail", f"""
    WITH target AS ({EVENT_IN})
    SELECT {EVENT_OUT} FROM target WHERE ts IS NULL OR ts < TIMESTAMP '2024-01-25'
    UNION ALL SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S'), 'tail', value FROM target WHERE ts >= TIMESTAMP '2024-01-25'""")
def replace_tail(t):
    target = _dated(t)
    batch = target.where(F.col("ts") >= "2024-01-25").withColumn("event_type", F.lit("tail"))
    return _shown(sinks.replace_tail(target, batch, "ts", "2024-01-25"))


@query("merge_upsert", """
    WITH a AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, CASE WHEN c_nationkey <> 4 THEN c_mktsegment END AS c_mktsegment
        FROM customer WHERE c_mktsegment <> 'BUILDING'),
    b AS (SELECT c_custkey, CASE WHEN c_nationkey < 12 THEN c_name || '*' ELSE c_name END AS c_name, c_nationkey + 100 AS c_nationkey,
          c_acctbal, CASE WHEN c_nationkey <> 13 THEN lower(c_mktsegment) END AS c_mktsegment FROM customer WHERE c_acctbal < 6000),
    j AS (SELECT a.*, b.c_name AS n, b.c_mktsegment AS s, b.c_custkey IS NOT NULL AND
          (coalesce(a.c_name <> b.c_name, false) OR coalesce(a.c_mktsegment <> b.c_mktsegment, false)) AS changed
          FROM a LEFT JOIN b USING (c_custkey))
    SELECT c_custkey, CASE WHEN changed THEN n ELSE c_name END AS c_name, c_nationkey, c_acctbal,
           CASE WHEN changed THEN s ELSE c_mktsegment END AS c_mktsegment FROM j
    UNION ALL SELECT * FROM b WHERE c_custkey NOT IN (SELECT c_custkey FROM a)""")
def merge_upsert(t):
    target, batch = customer_versions(t)
    return sinks.merge_upsert(target, batch, "c_custkey", ["c_name", "c_mktsegment"])


def customer_versions(t):
    """The customers as loaded, and a batch of changed and new ones."""
    nation = F.col("c_nationkey")
    target = t.customer.where(F.col("c_mktsegment") != "BUILDING").withColumn(
        "c_mktsegment", F.when(nation != 4, F.col("c_mktsegment"))
    )
    batch = t.customer.where("c_acctbal < 6000").select(
        "c_custkey", F.when(nation < 12, F.concat("c_name", F.lit("*"))).otherwise(F.col("c_name")).alias("c_name"),
        (nation + 100).alias("c_nationkey"), "c_acctbal",
        F.when(nation != 13, F.lower("c_mktsegment")).alias("c_mktsegment"),
    )
    return target, batch


@query("insert_new", """
    SELECT p_partkey, p_name, p_size FROM part WHERE p_type <> 'PROMO'
    UNION ALL SELECT p_partkey, upper(p_name), p_size FROM part WHERE p_size > 30 AND p_type = 'PROMO'""")
def insert_new(t):
    parts = t.part.select("p_partkey", "p_name", "p_size")
    target = t.part.where(F.col("p_type") != "PROMO").select("p_partkey", "p_name", "p_size")
    batch = parts.where("p_size > 30").withColumn("p_name", F.upper("p_name"))
    return sinks.insert_new(target, batch, "p_partkey")


@query("export_delimited", """
    SELECT p_partkey, p_name || ', "' || p_type || '"; ' AS label, p_retailprice FROM part""")
def export_delimited(t):
    path = work_path(t.spark, "part-csv")
    label = F.concat("p_name", F.lit(', "'), "p_type", F.lit('"; '))
    sinks.export_delimited(t.part.select("p_partkey", label.alias("label"), "p_retailprice"), path)
    texts = read_delimited(t.spark, path, ["p_partkey", "label", "p_retailprice"], sep=",")
    return texts.select(
        to_int("p_partkey").alias("p_partkey"), "label",
        to_float("p_retailprice", ptbr=False).alias("p_retailprice"),
    )


@query("run_log", """
    SELECT 'REGISTRY' AS programa, 'orders' AS tabela, 'rows=' || count(*) || ' | open=' || count(*) FILTER (o_orderstatus = 'O') AS logs, 'N' AS erro FROM orders""")
def run_log(t):
    """Without the two columns that hold times."""
    target, log = work_path(t.spark, "orders"), work_path(t.spark, "runs")
    logged = sinks.run_logged(
        t.orders, lambda df: sinks.full_refresh(df, target), log, "REGISTRY", "orders",
        {"rows": F.count(F.lit(1)), "open": F.count_if(F.col("o_orderstatus") == "O")},
    )
    return logged.drop("duracao", "data_processamento")
