"""Aggregates, duplicates and order."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.functions import digits
from feedloom.operators import dedupe, groups, ranks
from feedloom.registry.base import query, rounded, stamp

CAMPAIGN_IN = "nullif(json_extract_string(props, '$.k'), '7')"


def _campaign():
    return F.nullif(F.get_json_object("props", "$.k"), F.lit("7")).alias("campaign")


@query("views_by_group", f"""
    SELECT campaign, CAST(sum(n) AS BIGINT) AS views FROM
        (SELECT {CAMPAIGN_IN} AS campaign, user_id, count(CASE WHEN event_type = 'view' THEN 1 END) AS n
         FROM events GROUP BY ALL) GROUP BY campaign""")
def views_by_group(t):
    rows = t.events.select(_campaign(), "user_id", "event_type")
    return groups.two_level(
        rows, ["campaign", "user_id"], ["campaign"],
        {"n": F.count_if(F.col("event_type") == "view")}, {"views": F.sum("n")},
    )


@query("sessions_by_group", f"""
    SELECT event_type, count(DISTINCT CAST(user_id AS VARCHAR) || '-' || {CAMPAIGN_IN}) AS sessions
    FROM events GROUP BY event_type""")
def sessions_by_group(t):
    rows = t.events.select("event_type", "user_id", _campaign())
    return groups.distinct_sessions(rows, ["event_type"], ["user_id", "campaign"])


@query("active_users_by_group", f"""
    SELECT campaign, count(DISTINCT u) AS active_users FROM
        (SELECT {CAMPAIGN_IN} AS campaign, user_id, max(CASE WHEN value > 10 THEN user_id END) AS u
         FROM events GROUP BY ALL) GROUP BY campaign""")
def active_users_by_group(t):
    rows = t.events.select(_campaign(), "user_id", "value")
    return groups.distinct_if(rows, ["campaign"], "user_id", F.col("value") > 10, "active_users")


@query("revenue_by_group", f"""
    SELECT campaign, CAST(sum(carts) AS BIGINT) AS add_to_cart, count(DISTINCT buyer) AS total_purchasers,
           round(coalesce(sum(paid), 0), 2) AS revenue FROM
        (SELECT {CAMPAIGN_IN} AS campaign, user_id, sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS carts,
                max(CASE WHEN event_type = 'purchase' THEN user_id END) AS buyer,
                sum(CASE WHEN event_type = 'purchase' THEN value END) AS paid
         FROM events GROUP BY ALL) GROUP BY campaign""")
def revenue_by_group(t):
    rows = t.events.select(_campaign(), "user_id", "event_type", "value")
    bought = F.col("event_type") == "purchase"
    parts = groups.two_level(
        rows, ["campaign", "user_id"], ["campaign"],
        {
            "carts": F.count_if(F.col("event_type") == "click"),
            "buyer": F.max(F.when(bought, F.col("user_id"))),
            "paid": F.sum(F.when(bought, F.col("value"))),
        },
        {
            "add_to_cart": F.sum("carts"), "total_purchasers": F.count_distinct("buyer"),
            "revenue": groups.sum_or_zero(F.col("paid")),
        },
    )
    return parts.withColumn("revenue", rounded("revenue"))


@query("base_row", """
    WITH k AS (SELECT *, CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE o_custkey END AS g FROM orders)
    SELECT o_orderkey, g, CASE WHEN g IS NOT NULL THEN
               first_value(o_orderkey) OVER w END AS base_id,
           CASE WHEN g IS NOT NULL THEN first_value(o_orderpriority) OVER w END AS base_title
    FROM k WINDOW w AS (PARTITION BY g ORDER BY (o_orderstatus = 'P') DESC, o_orderkey)""")
def base_row(t):
    rows = t.orders.select(
        "o_orderkey", "o_orderpriority", "o_orderstatus",
        F.when(F.col("o_custkey") % 50 != 0, F.col("o_custkey")).alias("g"),
    )
    based = groups.base_row(
        rows, ["g"], F.col("o_orderstatus") == "P", "o_orderkey",
        {"o_orderkey": "base_id", "o_orderpriority": "base_title"},
    )
    return based.select("o_orderkey", "g", "base_id", "base_title")


@query("high_water", """
    SELECT strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS high_water FROM orders
    WHERE o_orderstatus = 'F' AND o_orderdate <= TIMESTAMP '1998-06-30'""")
def high_water(t):
    condition = (F.col("o_orderstatus") == "F") & (F.col("o_orderdate") <= "1998-06-30")
    return groups.high_water(t.orders, "o_orderdate", condition).select(stamp("high_water").alias("high_water"))


@query("profile_counts", """
    SELECT nullif(o_orderstatus, 'P') AS status, count(*) AS n FROM orders GROUP BY ALL""")
def profile_counts(t):
    return groups.profile_counts(t.orders.select(F.nullif("o_orderstatus", F.lit("P")).alias("status")), "status")


@query("quality_counters", """
    SELECT count(*) AS rows_in, count(*) FILTER (n_chars < 400) AS removed_short,
           count(*) FILTER (n_chars >= 400 AND coalesce(quality = 0, false)) AS removed_poor,
           count(*) FILTER (n_chars >= 400 AND NOT coalesce(quality = 0, false)) AS rows_out,
           count(*) FILTER (n_chars >= 400 AND NOT coalesce(quality = 0, false) AND toxic = 1) AS flagged_toxic
    FROM documents LEFT JOIN labels USING (doc_id)""")
def quality_counters(t):
    rows = t.documents.select("doc_id", "n_chars").join(t.labels, "doc_id", "left")
    return groups.quality_counters(
        rows, {"short": F.col("n_chars") < 400, "poor": F.col("quality") == 0}, {"toxic": F.col("toxic") == 1}
    )


@query("count_ifs", """
    SELECT count(*) FILTER (c_acctbal > 5000) AS rich, count(*) FILTER (c_mktsegment = 'BUILDING') AS builders,
           count(*) FILTER (c_mktsegment = 'FURNITURE' AND c_acctbal < 0) AS indebted, round(avg(c_acctbal), 4) AS mean_c_acctbal
    FROM customer""")
def count_ifs(t):
    counted = groups.count_ifs(t.customer, {
        "rich": F.col("c_acctbal") > 5000,
        "builders": F.col("c_mktsegment") == "BUILDING",
        "indebted": (F.col("c_mktsegment") == "FURNITURE") & (F.col("c_acctbal") < 0),
    }, mean="c_acctbal")
    return counted.withColumn("mean_c_acctbal", rounded("mean_c_acctbal", 4))


@query("extremes_with_ties", """
    SELECT p_partkey, p_size, 'highest' AS extreme FROM part WHERE p_size = (SELECT max(p_size) FROM part)
    UNION ALL SELECT p_partkey, p_size, 'lowest' FROM part WHERE p_size = (SELECT min(p_size) FROM part)""")
def extremes_with_ties(t):
    return groups.extremes(t.part.select("p_partkey", "p_size"), "p_size")


@query("above_mean", """
    SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_acctbal > (SELECT avg(s_acctbal) FROM supplier)""")
def above_mean(t):
    return groups.above_mean(t.supplier, "s_acctbal").select("s_suppkey", "s_name", "s_acctbal")


@query("entity_totals", """
    SELECT l_orderkey, l_partkey, l_quantity,
           row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS position,
           sum(l_quantity) OVER (PARTITION BY l_orderkey) AS total
    FROM lineitem""")
def entity_totals(t):
    totals = groups.entity_totals(
        t.lineitem, "l_orderkey", "l_quantity", ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    )
    return totals.select("l_orderkey", "l_partkey", "l_quantity", "position", "total")


@query("ranking", """
    SELECT c_nationkey, c_custkey, c_acctbal,
           row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS place
    FROM customer""")
def ranking(t):
    rows = t.customer.select("c_nationkey", "c_custkey", "c_acctbal")
    return groups.ranking(rows, ["c_nationkey"], "c_acctbal", ["c_custkey"])


@query("ranking_overall", """
    SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS place FROM customer""")
def ranking_overall(t):
    return groups.ranking(t.customer.select("c_custkey", "c_acctbal"), [], "c_acctbal", ["c_custkey"])


@query("summary_bands", """
    SELECT l_partkey, count(l_quantity) AS total, max(l_quantity) AS highest, min(l_quantity) AS lowest,
           avg(l_quantity) AS average,
           CASE WHEN avg(l_quantity) >= 30 THEN 'Excellent!' WHEN avg(l_quantity) >= 26 THEN 'Good!'
                WHEN avg(l_quantity) >= 20 THEN 'Fair.' ELSE 'Fail.' END AS situation
    FROM lineitem GROUP BY l_partkey""")
def summary_bands(t):
    bands = [(30, "Excellent!"), (26, "Good!"), (20, "Fair.")]
    return groups.summary_bands(t.lineitem, ["l_partkey"], "l_quantity", bands, "Fail.")


@query("array_stats", """
    SELECT vec_id, round(list_sum(list_transform(list_filter(embedding, lambda x: x > 0), lambda x: CAST(x AS DOUBLE))), 6) AS kept_sum,
           embedding[3] AS entry, list_max(embedding) AS highest
    FROM embeddings""")
def array_stats(t):
    stats = groups.array_stats(t.embeddings, "embedding", lambda x: x > 0, 2)
    return stats.select("vec_id", rounded("kept_sum", 6).alias("kept_sum"), "entry", "highest")


@query("dedupe_first", """
    SELECT doc_id, text, lang, source, n_chars FROM documents
    QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""")
def dedupe_first(t):
    return dedupe.dedupe_first(t.documents, ["text"], ["doc_id"])


@query("dedupe_last", """
    SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def dedupe_last(t):
    rows = t.events.select("event_id", "user_id", "event_type", "ts")
    return dedupe.dedupe_last(rows, ["user_id"], ["ts", "event_id"]).withColumn("ts", stamp("ts"))


@query("distinct_rows", "SELECT DISTINCT p_brand, p_type, p_size FROM part")
def distinct_rows(t):
    return dedupe.distinct_rows(t.part, ["p_brand", "p_type", "p_size"])


@query("distinct_keys", r"""
    SELECT DISTINCT host FROM (SELECT regexp_extract(url, '^https?://([^/?#]+)', 1) AS host FROM pages)
    WHERE host <> ''""")
def distinct_keys(t):
    hosts = t.pages.select(F.col("url").alias("host"))
    return dedupe.distinct_keys(hosts, "host", lambda c: F.regexp_extract(c, "^https?://([^/?#]+)", 1))


@query("distinct_documents", """
    SELECT DISTINCT d AS document FROM (SELECT regexp_replace(c_mktsegment || CAST(c_custkey % 97 AS VARCHAR), '[^0-9]', '', 'g') AS d FROM customer)
    WHERE d NOT IN ('', '-1')""")
def distinct_documents(t):
    made = F.concat("c_mktsegment", (F.col("c_custkey") % 97).cast("string"))
    return dedupe.distinct_keys(t.customer.select(made.alias("document")), "document", digits)


@query("next_upcoming", """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate FROM orders
    WHERE o_orderdate >= TIMESTAMP '1997-03-15 12:00:00' ORDER BY orders.o_orderdate, o_orderkey LIMIT 1""")
def next_upcoming(t):
    rows = t.orders.select("o_orderkey", "o_orderdate")
    return ranks.next_upcoming(rows, "o_orderdate", "1997-03-15 12:00:00", ["o_orderkey"]).withColumn(
        "o_orderdate", stamp("o_orderdate")
    )


@query("top_bottom", """
    (SELECT p_name, p_partkey, 'first' AS side FROM part ORDER BY p_name, p_partkey LIMIT 5) UNION ALL
    (SELECT p_name, p_partkey, 'last' FROM part ORDER BY p_name DESC, p_partkey DESC LIMIT 4)""")
def top_bottom(t):
    return ranks.top_bottom(t.part.select("p_name", "p_partkey"), ["p_name", "p_partkey"])
