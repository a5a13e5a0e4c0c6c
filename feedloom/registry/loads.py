"""Load steps: the result is the table after two runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom import plans
from feedloom.registry import pipelines as feeds
from feedloom.registry.base import ORACLE, query, rounded
from feedloom.registry.loading import EVENT_IN, EVENT_OUT, ORDER_COLUMNS, WINDOW, _dated, _order_batch, _shown, customer_versions
from feedloom.session import work_path
from feedloom.sinks import versions

FACT_SQL = ORACLE["ticket_fact"]


def _closed(t):
    return t.orders.where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").cast("string").alias("cod_evento"))


def _stage(t):
    return feeds.shaped(t, feeds.STAGE_IN)


def _people(t):
    return feeds.shaped(t, feeds.PEOPLE_IN)


@query("load_fact", FACT_SQL[:FACT_SQL.index("WHERE cod_evento IN")])
def load_fact(t):
    """All matches, then those of closed orders again."""
    path = work_path(t.spark, "fact")
    for events in (None, _closed(t)):
        loaded = plans.load_fact(path, _stage(t), _people(t), feeds._contracts(t), events)
    return loaded


@query("load_integration", ORACLE["integration_feed"])
def load_integration(t):
    path = work_path(t.spark, "integration")
    for events in (None, _closed(t)):
        loaded = plans.load_integration(path, _stage(t), feeds.catalogue_in(t), _people(t), feeds._shop_clients(t), events)
    return loaded


@query("load_dim", f"""
    WITH {feeds.CATALOGUE}
    SELECT COD_EVENTO AS sk_partida, PARTIDA AS partida, CAMPEONATO || ' ' || CAST(year(CAST(DT_EVENTO AS DATE)) AS VARCHAR) AS campeonato,
        DT_EVENTO || ' ' || HR_EVENTO AS dthr_partida
    FROM catalogue WHERE upper(PARTIDA) NOT LIKE '%ESPACO%' AND upper(PARTIDA) NOT LIKE '%FLA+%' AND upper(PARTIDA) NOT LIKE '%ESTACIONAMENTO%'""")
def load_dim(t):
    """Half of the catalogue first, then all of it."""
    path, catalogue = work_path(t.spark, "dim"), feeds.catalogue_in(t)
    plans.load_dim(path, catalogue.where("CAST(COD_EVENTO AS bigint) % 2 = 0"))
    return plans.load_dim(path, catalogue)


@query("load_dim_entries", """
    SELECT DISTINCT p_brand || '-' || p_size AS idapresentacao, p_name AS campeonato, p_type AS partida, p_size AS dthr_apresentacao FROM part
    WHERE p_name NOT ILIKE '%tour da%' AND p_name NOT ILIKE '%estacionamento%'""")
def load_dim_entries(t):
    path = work_path(t.spark, "dim")
    ids = F.concat("p_brand", F.lit("-"), F.col("p_size").cast("string")).alias("idapresentacao")
    fact = t.part.select(ids, F.col("p_name").alias("campeonato"), F.col("p_type").alias("partida"), F.col("p_size").alias("dthr_apresentacao"))
    return [plans.load_dim_entries(path, fact) for _ in range(2)][-1]


def _twice(t, name, build, moment):
    """The years before 1995 once, then all years over the whole window twice; the rows are computed once."""
    path = work_path(t.spark, name)
    rows = plans.stage_window(path, build(t), moment)
    plans.load_window(path, rows.where(F.col(moment) < "1995-01-01"), moment, "1990-01-01", "1994-12-31", gathered=True)
    return [plans.load_window(path, rows, moment, "1990-01-01", "2030-12-31", gathered=True) for _ in range(2)][-1]


@query("load_shop_orders", ORACLE["shop_orders"])
def load_shop_orders(t):
    return _twice(t, "shop-orders", feeds.shop_orders_query, "SALE_DATE")


@query("load_shop_users", ORACLE["shop_users"])
def load_shop_users(t):
    return _twice(t, "shop-users", feeds.shop_users_query, "DATE_CREATED")


@query("load_ecommerce", ORACLE["ecommerce_orders"].replace("l_suppkey AS SUPPLIER_CODE", "CAST(l_suppkey AS VARCHAR) AS SUPPLIER_CODE"))
def load_ecommerce(t):
    """From export files, two of them: what is not declared stays text."""
    folder, path = work_path(t.spark, "exports"), work_path(t.spark, "ecommerce")
    export = feeds.ecommerce_export(t)
    files = [f"{folder}/{n}" for n in range(2)]
    for n, file in enumerate(files):
        export.where(F.col("Order").cast("bigint") % 2 == n).write.option("header", True).option("sep", ";").csv(file)
    return [plans.load_ecommerce(t.spark, path, files, plans.ecommerce_orders) for _ in range(2)][-1]


@query("load_web_day", ORACLE["event_base"])
def load_web_day(t):
    """All days, then one day again."""
    path, export = work_path(t.spark, "web"), feeds.web_export(t)
    plans.load_web_day(path, export)
    return plans.load_web_day(path, export, "20240105")


@query("load_all", ORACLE["load_fact"])
def load_all(t):
    """The chain, then the matches of chosen days again; the fact of the last run.  The catalogue is computed once."""
    folder = work_path(t.spark, "chain")
    catalogue = versions.stage(feeds.catalogue_in(t), folder)
    inputs = (_stage(t), catalogue, _people(t), feeds._contracts(t), feeds._shop_clients(t))
    plans.load_all(folder, *inputs)
    days = plans.events_of_dates(catalogue, ["1995-03-01", "1996-07-14"])
    return plans.load_all(folder, *inputs, days)["fact"]


ROWS = 2_000  # of a file, so that the given tables have several


@query("load_by_key", ORACLE["replace_by_key"])
def load_by_key(t):
    """The orders, then the closed ones changed and under new keys, twice."""
    path = work_path(t.spark, "orders")
    versions.load_full(t.orders, path, versions.ByKey("o_orderkey"), ROWS)
    for _ in range(2):
        loaded = versions.load_by_key(_order_batch(t), path, "o_orderkey", ROWS)
    return loaded.select(*ORDER_COLUMNS)


@query("load_where", ORACLE["replace_where"])
def load_where(t):
    path = work_path(t.spark, "orders")
    versions.load_full(t.orders, path, versions.ByKey("o_orderkey"), ROWS)
    for _ in range(2):
        loaded = versions.load_where(_order_batch(t), path, "o_orderkey", F.col("o_orderpriority") == "1-URGENT", ROWS)
    return loaded.select(*ORDER_COLUMNS)


@query("load_days", ORACLE["replace_by_window"])
def load_days(t):
    """The events, then the days of the window again, without errors."""
    path, target = work_path(t.spark, "events"), _dated(t)
    versions.load_full(target, path, versions.ByDay("ts"), ROWS)
    window = (F.col("ts") >= WINDOW[0]) & (F.col("ts") < "2024-01-15")
    batch = target.where(window & (F.col("event_type") != "error")).withColumn("event_type", F.lit("again"))
    for _ in range(2):
        loaded = versions.load_days(batch, path, "ts", *WINDOW, max_rows=ROWS)
    return _shown(loaded)


@query("load_tail", ORACLE["replace_tail"])
def load_tail(t):
    path, target = work_path(t.spark, "events"), _dated(t)
    versions.load_full(target, path, versions.ByDay("ts"), ROWS)
    batch = target.where(F.col("ts") >= "2024-01-25").withColumn("event_type", F.lit("tail"))
    for _ in range(2):
        loaded = versions.load_days(batch, path, "ts", "2024-01-25", None, max_rows=ROWS)
    return _shown(loaded)


@query("load_upsert", ORACLE["merge_upsert"])
def load_upsert(t):
    path = work_path(t.spark, "customer")
    target, batch = customer_versions(t)
    versions.load_full(target, path, versions.ByKey("c_custkey"), ROWS)
    for _ in range(2):
        loaded = versions.load_upsert(batch, path, "c_custkey", ["c_name", "c_mktsegment"], max_rows=ROWS)
    return loaded


@query("load_new", ORACLE["insert_new"])
def load_new(t):
    """New parts are appended; afterwards small files are written together."""
    path = work_path(t.spark, "part")
    target = t.part.where(F.col("p_type") != "PROMO").select("p_partkey", "p_name", "p_size")
    batch = t.part.select("p_partkey", "p_name", "p_size").where("p_size > 30").withColumn("p_name", F.upper("p_name"))
    versions.load_full(target, path, versions.ByKey("p_partkey"), ROWS)
    for _ in range(2):
        versions.load_new(batch, path, "p_partkey", ROWS)
    return versions.compact(t.spark, path, versions.ByKey("p_partkey"), ROWS)


@query("load_crm_day", ORACLE["crm_daily_fused"])
def load_crm_day(t):
    """The report kept day by day: the first days, the others, and one of them again."""
    folder, events = work_path(t.spark, "crm"), feeds.crm_events(t)
    for days in (F.col("event_date") < "20240112", F.col("event_date") >= "20240112", F.col("event_date") == "20240105"):
        plans.load_crm_day(folder, events.where(days))
    return plans.read_crm(t.spark, folder).withColumn("revenue", rounded("revenue"))


@query("load_crm_campaigns", f"""
    WITH {feeds.CRM_EVENTS}
    SELECT campaign_name_cross, count(*) FILTER (event_name = 'page_view') AS views,
           count(DISTINCT user_pseudo_id || '-' || CAST(ga_session_id AS VARCHAR)) AS sessions,
           count(DISTINCT CASE WHEN is_active_user THEN user_pseudo_id END) AS active_users,
           count(*) FILTER (event_name = 'add_to_cart') AS add_to_cart,
           count(DISTINCT CASE WHEN event_name = 'purchase' THEN user_pseudo_id END) AS total_purchasers,
           round(coalesce(sum(purchase_revenue), 0), 2) AS revenue
    FROM crm GROUP BY campaign_name_cross""")
def load_crm_campaigns(t):
    """Each person once in a campaign over all days, from what the days have kept."""
    folder, events = work_path(t.spark, "crm"), feeds.crm_events(t)
    plans.load_crm_day(folder, events.where("event_date < '20240112'"))
    plans.load_crm_day(folder, events.where("event_date >= '20240112'"))
    return plans.read_crm(t.spark, folder, ["campaign_name_cross"]).withColumn("revenue", rounded("revenue"))
