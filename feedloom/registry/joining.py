"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.operators import joins, ranks
from feedloom.operators.shape import stack_frames
from feedloom.plans.crm import crm_parts
from feedloom.registry.base import query, rounded, stamp
from feedloom.registry.pipelines import CRM_EVENTS, CRM_GROUPS, crm_events, crm_measures


def people(t):
    """Two versions of each customer: one closed, one open (but none open in one segment)."""
    base = t.customer.select(
        F.col("c_custkey").alias("cpf"), F.col("c_custkey").alias("sk_pessoa"), F.col("c_name").alias("nome"),
        F.when(F.col("c_custkey") % 4 != 0, F.concat("c_name", F.lit("@mail.com"))).alias("email"), "c_mktsegment",
    )
    closed = base.withColumn("load_end_date", F.lit("1997-01-01")).withColumn("sk_pessoa", -F.col("sk_pessoa"))
    current = base.where(F.col("c_mktsegment") != "FURNITURE").withColumn("load_end_date", F.lit(None).cast("string"))
    return stack_frames(closed, current).drop("c_mktsegment")


PEOPLE = """people AS (
    SELECT c_custkey AS cpf, -c_custkey AS sk_pessoa, c_name AS nome,
           CASE WHEN c_custkey % 4 <> 0 THEN c_name || '@mail.com' END AS email, '1997-01-01' AS load_end_date FROM customer
    UNION ALL SELECT c_custkey, c_custkey, c_name, CASE WHEN c_custkey % 4 <> 0 THEN c_name || '@mail.com' END, NULL
    FROM customer WHERE c_mktsegment <> 'FURNITURE')"""


@query("join_current", f"""
    WITH {PEOPLE} SELECT o_orderkey, o_custkey AS cpf, sk_pessoa, email FROM orders
    LEFT JOIN people ON o_custkey = cpf AND load_end_date IS NULL""")
def join_current(t):
    fact = t.orders.select("o_orderkey", F.col("o_custkey").alias("cpf"))
    return joins.join_current(fact, people(t), "cpf", "load_end_date", ["sk_pessoa", "email"])


@query("join_latest", """
    WITH latest AS (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
    SELECT c_custkey, c_name, o_orderkey, o_orderstatus FROM customer LEFT JOIN latest ON c_custkey = o_custkey""")
def join_latest(t):
    orders = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    people_ = t.customer.select("c_custkey", "c_name")
    return joins.join_latest(people_, orders, "c_custkey", ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_orderstatus"])


@query("enrich_priority", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderstatus,
           coalesce(c_name, s_name, l_returnflag) AS label, coalesce(c_nationkey, s_nationkey) AS country
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 5000
    LEFT JOIN supplier ON l_suppkey = s_suppkey AND s_acctbal > 5000""")
def enrich_priority(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus")
    customers = t.customer.where("c_acctbal > 5000").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey"
    )
    suppliers = t.supplier.where("s_acctbal > 5000").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey"
    )
    joined = joins.enrich_priority(
        lines, orders, "l_orderkey", [(customers, "o_custkey"), (suppliers, "l_suppkey")],
        {"label": ["c_name", "s_name", "l_returnflag"], "country": ["c_nationkey", "s_nationkey"]},
    )
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_orderstatus", "label", "country")


@query("anti_join_new", """
    SELECT p_partkey, p_name FROM part LEFT JOIN (SELECT DISTINCT l_partkey FROM lineitem WHERE l_quantity > 45) ON p_partkey = l_partkey
    WHERE l_partkey IS NULL""")
def anti_join_new(t):
    known = t.lineitem.where("l_quantity > 45").select("l_partkey")
    return joins.new_rows(t.part.select("p_partkey", "p_name"), known, "p_partkey", "l_partkey")


@query("not_in_null_aware", """
    SELECT c_custkey, 'no null' AS right_side FROM customer WHERE nullif(c_custkey, 3) NOT IN
        (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)
    UNION ALL SELECT c_custkey, 'with null' FROM customer WHERE c_custkey NOT IN
        (SELECT nullif(o_custkey, 5) FROM orders)
    UNION ALL SELECT c_custkey, 'empty' FROM customer WHERE nullif(c_custkey, 3) NOT IN
        (SELECT o_custkey FROM orders WHERE o_totalprice < 0)""")
def not_in_null_aware(t):
    customers = t.customer.select("c_custkey", F.nullif("c_custkey", F.lit(3)).alias("key"))
    dear = t.orders.where("o_totalprice > 450000")
    none = t.orders.where("o_totalprice < 0")
    holed = t.orders.select(F.nullif("o_custkey", F.lit(5)).alias("o_custkey"))
    results = {
        "no null": joins.not_in(customers, dear, "key", "o_custkey"),
        "with null": joins.not_in(customers, holed, "key", "o_custkey"),
        "empty": joins.not_in(customers, none, "key", "o_custkey"),
    }
    return stack_frames(*[
        df.select("c_custkey", F.lit(name).alias("right_side")) for name, df in results.items()
    ])


@query("theta_like_join", """
    WITH probe AS (SELECT p_name, p_size FROM part WHERE p_size >= 20 ORDER BY p_size, p_partkey LIMIT 1)
    SELECT p.p_partkey, p.p_name FROM part p CROSS JOIN probe
    WHERE upper(p.p_name) LIKE '%' || upper(split_part(probe.p_name, ' ', 2)) || '%' AND p.p_size = probe.p_size""")
def theta_like_join(t):
    probe = t.part.where("p_size >= 20").orderBy("p_size", "p_partkey").limit(1)
    matched = joins.match_by_suffix(
        t.part, "p_name", F.col("p_size"), probe, "p_name", F.col("p_size"), separator=" "
    )
    return matched.select("p_partkey", "p_name")


@query("next_match_events", """
    WITH game AS (SELECT o_orderpriority AS title, CAST(o_orderdate AS DATE) AS day FROM orders
        WHERE o_orderdate >= TIMESTAMP '1997-03-15 12:00:00' ORDER BY o_orderdate, o_orderkey LIMIT 1)
    SELECT o_orderkey, o_orderpriority FROM orders CROSS JOIN game
    WHERE contains(upper(o_orderpriority), upper(split_part(title, '-', 2))) AND CAST(o_orderdate AS DATE) = day""")
def next_match_events(t):
    game = ranks.next_upcoming(t.orders, "o_orderdate", "1997-03-15 12:00:00", ["o_orderkey"])
    day = F.to_date("o_orderdate")
    matched = joins.match_by_suffix(
        t.orders, "o_orderpriority", day, game, "o_orderpriority", day, separator="-", require_suffix=True
    )
    return matched.select("o_orderkey", "o_orderpriority")


@query("outer_join_chain", f"""
    WITH {CRM_EVENTS}, {CRM_GROUPS}
    SELECT event_date, campaign_name_cross, city, {crm_measures('NULL')} FROM shown""")
def outer_join_chain(t):
    parts = crm_parts(crm_events(t))
    chained = joins.outer_chain(list(parts.values()), ["event_date", "campaign_name_cross", "city"])
    return chained.withColumn("revenue", rounded("revenue"))


@query("attach_parent", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def attach_parent(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    orders = t.orders.withColumnRenamed("o_orderkey", "l_orderkey")
    attached = joins.attach_parent(lines, orders, "l_orderkey", ["o_orderstatus", "o_orderdate"])
    return attached.withColumn("o_orderdate", stamp("o_orderdate"))


@query("expand_by_ids", """
    SELECT event_id, user_id, event_type FROM events WHERE user_id IN
        (SELECT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-05 06:00:00')""")
def expand_by_ids(t):
    window = (F.col("ts") >= "2024-01-05") & (F.col("ts") < "2024-01-05 06:00:00")
    return joins.expand_by_ids(t.events.select("event_id", "user_id", "event_type", "ts"), window, "user_id").drop("ts")


@query("join_hot_keys", """
    SELECT o_orderkey, f.c_custkey, c_name, c_nationkey
    FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS c_custkey FROM orders) f
    LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) c ON f.c_custkey = c.c_custkey""")
def join_hot_keys(t):
    """A customer who holds a third of the orders, found and spread without being named."""
    key = F.when(F.col("o_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("o_custkey")).cast("long")
    fact = t.orders.select("o_orderkey", key.alias("c_custkey"))
    dim = t.customer.where("c_acctbal >= 0").select("c_custkey", "c_name", "c_nationkey")
    return joins.left_join_salted(fact, dim, "c_custkey", joins.hot_keys(fact, "c_custkey")).select("o_orderkey", "c_custkey", "c_name", "c_nationkey")


@query("match_suffixes", """
    SELECT b.probe_name, b.probe_size, e.p_partkey FROM part e
    JOIN (SELECT DISTINCT p_name AS probe_name, p_size AS probe_size FROM part) b
      ON e.p_size = b.probe_size AND upper(e.p_name) LIKE '%' || upper(split_part(b.probe_name, ' ', 2)) || '%'""")
def match_suffixes(t):
    """Every name as a probe among the names of its size."""
    probes = t.part.select(F.col("p_name").alias("probe_name"), F.col("p_size").alias("probe_size"))
    return joins.match_suffixes(t.part, "p_partkey", "p_name", F.col("p_size"), probes, "probe_name", F.col("probe_size"), separator=" ")
