"""Reading feeds."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions import day_range, to_float, to_int
from feedloom.operators.shape import stack_frames
from feedloom.registry.base import query, stamp
from feedloom.session import work_path
from feedloom.sinks import export_delimited
from feedloom.sources import PagesMissing, check_pages, missing_pages, plan_parts, read_day, read_delimited, read_table, unwrap_pages


@query("read_delimited", """
    SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def read_delimited_query(t):
    path = work_path(t.spark, "customer-csv")
    brazilian = F.replace(F.col("c_acctbal").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))
    export_delimited(t.customer.withColumn("c_acctbal", brazilian), path, sep=";")
    texts = read_delimited(t.spark, path, t.customer.columns)
    return texts.select(
        to_int("c_custkey").alias("c_custkey"), "c_name", to_int("c_nationkey").alias("c_nationkey"),
        to_float("c_acctbal").alias("c_acctbal"), "c_mktsegment",
    )


@query("table_scan", "SELECT * FROM part")
def table_scan(t):
    return read_table(t.spark, t.path("part"))


@query("read_day", """
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_type FROM events
    WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11'""")
def read_day_query(t):
    return read_day(t.events, "ts", "2024-01-10").select("event_id", stamp("ts").alias("ts"), "event_type")


@query("day_range", """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders
    WHERE o_orderdate >= TIMESTAMP '1996-02-01' AND o_orderdate < TIMESTAMP '1996-06-01'""")
def day_range_query(t):
    rows = t.orders.where(day_range("o_orderdate", "1996-02-01", "1996-05-31"))
    return rows.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"))


RECORD = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
    T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
])


@query("unwrap_pages", """
    SELECT conv_id, turn, role, text FROM conversations WHERE (conv_id + turn) % 7 <> 6
    UNION ALL SELECT conv_id, turn, 'copy', NULL FROM conversations WHERE (conv_id + turn) % 7 <> 6""")
def unwrap_pages_query(t):
    record = F.to_json(F.struct("conv_id", "turn", "role", "text"))
    copy = F.to_json(F.struct("conv_id", "turn", F.lit("copy").alias("role")))
    rows = F.concat(F.lit("["), record, F.lit(", "), copy, F.lit("]"))

    def around(left, right):
        return F.concat(F.lit(left), rows, F.lit(right))

    style = (F.col("conv_id") + F.col("turn")) % 7
    text_result = F.to_json(F.struct(F.lit("").alias("error"), around('{"rows": ', "}").alias("result")))
    body = (
        F.when(style == 0, rows)
        .when(style == 1, around('{"tickets": ', "}"))
        .when(style == 2, around('[{"tickets": ', "}]"))
        .when(style == 3, around('{"id": 1, "error": null, "result": {"rows": ', "}}"))
        .when(style == 4, text_result)
        .when(style == 5, around('{"pagination": {"pages": 3}, "orders": ', "}"))
        .otherwise(F.lit('{"data": []}'))
    )
    return unwrap_pages(t.conversations.select(body.alias("body")), "body", RECORD)


@query("missing_pages", """
    WITH m AS (SELECT l_orderkey, max(l_linenumber) AS pages FROM lineitem GROUP BY l_orderkey),
    e AS (SELECT l_orderkey, unnest(generate_series(1, pages)) AS l_linenumber FROM m)
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber FROM e
    WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = e.l_orderkey AND l.l_linenumber = e.l_linenumber)""")
def missing_pages_query(t):
    return missing_pages(t.lineitem, "l_orderkey", "l_linenumber")


@query("check_pages", """
    SELECT conv_id, turn + 1 AS page, role FROM conversations""")
def check_pages_query(t):
    pages = t.conversations.select("conv_id", (F.col("turn") + 1).alias("page"), "role")
    return check_pages(pages, "conv_id", "page")


@query("check_pages_gaps", """
    WITH landed AS (SELECT conv_id, turn + 1 AS page, role FROM conversations WHERE turn <> 1)
    SELECT conv_id, CAST(2 AS BIGINT) AS page FROM landed GROUP BY conv_id HAVING max(page) > 2""")
def check_pages_gaps_query(t):
    """A feed without its second pages: the check refuses it, and what is missing is the result."""
    pages = t.conversations.where("turn <> 1").select("conv_id", (F.col("turn") + 1).alias("page"), "role")
    try:
        check_pages(pages, "conv_id", "page")
    except PagesMissing:
        return missing_pages(pages, "conv_id", "page")
    raise AssertionError("a feed with gaps passed the check")


@query("plan_parts", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def plan_parts_query(t):
    """The parts that a remote reader would ask for, put together again."""
    parts = [t.orders.where(part) for part in plan_parts(t.orders, ["o_orderdate", "o_custkey", "o_orderkey"], 8)]
    return stack_frames(*parts).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
