"""Composed pipelines, on the given tables put into the shape of each feed."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.operators.joins import latest_per_key
from feedloom.plans import (
    build_fact,
    build_integration,
    clean_clients,
    clean_events,
    clean_tickets,
    crm_daily,
    crm_daily_fused,
    crm_shape,
    ecommerce_customers,
    ecommerce_orders,
    entry_tickets,
    event_base,
    extend_dim,
    extend_dim_entries,
    load_clients,
    load_entries,
    replicate,
    shop_orders,
    shop_users,
    ticket_counters,
)
from feedloom.registry.base import query, rounded, stamp
from feedloom.registry.nesting import key_value
from feedloom.registry.scalars import MEDIUM_IN
from feedloom.session import work_path


def crm_events(t):
    """Events as the web export has them: a campaign (sometimes none), a city, a session."""
    k = F.col("k")
    made = t.events.withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    return made.select(
        F.date_format("ts", "yyyyMMdd").alias("event_date"),
        F.when(k % 7 != 0, F.concat(F.lit("campaign "), (k % 7).cast("string"))).alias("campaign_name_cross"),
        F.when(F.col("user_id") % 11 != 0, F.concat(F.lit("city "), (F.col("user_id") % 5).cast("string"))).alias("city"),
        F.when(k != 13, F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("user_pseudo_id"),
        F.when(k != 21, k % 4).alias("ga_session_id"),
        F.when(F.col("event_type") == "view", F.lit("page_view"))
        .when(F.col("event_type") == "click", F.lit("add_to_cart")).otherwise(F.col("event_type")).alias("event_name"),
        F.when(k != 34, k % 3 == 0).alias("is_active_user"),
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("purchase_revenue"),
    )


def crm_export(t):
    """The same events nested as the export nests them."""
    flat = crm_events(t)
    source = F.struct(F.struct(F.col("campaign_name_cross").alias("campaign_name")).alias("cross_channel_campaign"))
    params = F.array(key_value("page_title", text=F.lit("page")), key_value("ga_session_id", number=F.col("ga_session_id")))
    return flat.select(
        "event_date", "event_name", "user_pseudo_id", "is_active_user", source.alias("session_traffic_source_last_click"),
        F.struct("city").alias("geo"), params.alias("event_params"), F.struct("purchase_revenue").alias("ecommerce"),
    )


CRM_EVENTS = """crm AS (
    SELECT strftime(ts, '%Y%m%d') AS event_date,
           CASE WHEN k % 7 <> 0 THEN 'campaign ' || CAST(k % 7 AS VARCHAR) END AS campaign_name_cross,
           CASE WHEN user_id % 11 <> 0 THEN 'city ' || CAST(user_id % 5 AS VARCHAR) END AS city,
           CASE WHEN k <> 13 THEN 'u' || CAST(user_id AS VARCHAR) END AS user_pseudo_id,
           CASE WHEN k <> 21 THEN k % 4 END AS ga_session_id,
           CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart' ELSE event_type END AS event_name,
           CASE WHEN k <> 34 THEN k % 3 = 0 END AS is_active_user,
           CASE WHEN event_type = 'purchase' THEN value END AS purchase_revenue
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))"""

# One grouped pass gives all measures.  In the report's terms they are four results put side by side by
# day, campaign and city, and a null never equals a null: such a group shows once per result.
CRM_GROUPS = """grouped AS (
    SELECT event_date, campaign_name_cross, city, campaign_name_cross IS NULL OR city IS NULL AS apart,
        count(*) FILTER (event_name = 'page_view') AS views,
        count(DISTINCT user_pseudo_id || '-' || CAST(ga_session_id AS VARCHAR)) AS sessions,
        count(DISTINCT user_pseudo_id) FILTER (is_active_user) AS active_users,
        count(*) FILTER (event_name = 'add_to_cart') AS add_to_cart,
        count(DISTINCT user_pseudo_id) FILTER (event_name = 'purchase') AS total_purchasers,
        round(coalesce(sum(purchase_revenue), 0), 2) AS revenue
    FROM crm GROUP BY event_date, campaign_name_cross, city),
shown AS (SELECT *, unnest(CASE WHEN apart THEN [1, 2, 3, 4] ELSE [0] END) AS result FROM grouped)"""


def crm_measures(missing: str) -> str:
    """The measures of the results a row stands for; the others are missing."""
    results = {"views": 1, "sessions": 2, "active_users": 3, "add_to_cart": 4, "total_purchasers": 4, "revenue": 4}
    return ", ".join(f"CASE WHEN result IN (0, {n}) THEN {name} ELSE {missing} END AS {name}" for name, n in results.items())


@query("crm_daily", f"""
    WITH {CRM_EVENTS}, {CRM_GROUPS}
    SELECT strftime(strptime(event_date, '%Y%m%d'), '%Y-%m-%d') AS EVENT_BR_TIMESTAMP,
           campaign_name_cross AS CAMPAIGN_NAME_CROSS, city AS CITY, {crm_measures('0')} FROM shown""")
def crm_daily_query(t):
    return crm_daily(crm_shape(crm_export(t))).withColumn("revenue", rounded("revenue"))


@query("crm_daily_fused", f"""
    WITH {CRM_EVENTS}
    SELECT event_date, campaign_name_cross, city, count(*) FILTER (event_name = 'page_view') AS views,
           count(DISTINCT user_pseudo_id || '-' || CAST(ga_session_id AS VARCHAR)) AS sessions,
           count(DISTINCT CASE WHEN is_active_user THEN user_pseudo_id END) AS active_users,
           count(*) FILTER (event_name = 'add_to_cart') AS add_to_cart,
           count(DISTINCT CASE WHEN event_name = 'purchase' THEN user_pseudo_id END) AS total_purchasers,
           round(coalesce(sum(purchase_revenue), 0), 2) AS revenue
    FROM crm GROUP BY event_date, campaign_name_cross, city""")
def crm_daily_fused_query(t):
    return crm_daily_fused(crm_events(t)).withColumn("revenue", rounded("revenue"))


# The feeds' shapes are written in SQL that both sides run; only the cleaning differs.
def shaped(t, sql: str):
    named = [name for name in TABLES if "{" + name + "}" in sql]
    # The first table named is the one whose rows are cleaned; the others are looked up.
    tables = {name: getattr(t, name) for name in named}
    return t.spark.sql(sql, **tables)


def shape_sql(sql: str) -> str:
    return sql.format(**{name: name for name in TABLES})


TABLES = ["lineitem", "orders", "customer", "nation", "part", "supplier", "events"]


def day_text(date: str) -> str:
    return (
        f"lpad(CAST(day({date}) AS VARCHAR(2)), 2, '0') || '/' || lpad(CAST(month({date}) AS VARCHAR(2)), 2, '0') "
        f"|| '/' || CAST(year({date}) AS VARCHAR(4))"
    )


# ---- web events -------------------------------------------------------------------

@query("event_base", f"""
    WITH v AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
    SELECT strftime(ts, '%Y%m%d') AS EVENT_DATE, strftime(ts, '%Y-%m-%d') AS EVENT_BR_TIMESTAMP, event_type AS EVENT_NAME,
        CAST(user_id AS VARCHAR) AS USER_ID, 'p' || CAST(user_id AS VARCHAR) AS USER_PSEUDO_ID,
        't' || CAST(event_id AS VARCHAR) AS TRANSACTION_ID, CAST(NULL AS VARCHAR) AS PAGE_REFERRER,
        substr(repeat('/' || event_type, 60), 1, 250) AS PAGE_LOCATION, CAST(NULL AS VARCHAR) AS PAGE_TITLE,
        CAST(NULL AS VARCHAR) AS BTN_PLANO, CAST(NULL AS VARCHAR) AS BTN_TEXT, CAST(NULL AS VARCHAR) AS BTN_SECTION,
        CAST(NULL AS VARCHAR) AS SECTION, CAST(NULL AS VARCHAR) AS SOURCE_PLATFORM, 'true' AS HAS_CREDIT_CARD,
        CAST(NULL AS VARCHAR) AS HAS_ADDRESS,
        CASE WHEN k < 20 THEN 'BOLETO' WHEN k % 2 = 0 THEN 'PIX' WHEN k % 3 = 0 THEN 'CARTÃO DE CRÉDITO' ELSE 'unknown' END AS PAYMENT_TYPE,
        k AS GA_SESSION_ID, 'mobile' AS CATEGORY, 'brand ' || CAST(k % 5 AS VARCHAR) AS MOBILE_BRAND_NAME,
        CAST(NULL AS VARCHAR) AS MOBILE_MARKETING_NAME, 'os' AS OPERATING_SYSTEM, CAST(k AS VARCHAR) AS OPERATING_SYSTEM_VERSION,
        'browser ' || CAST(k % 3 AS VARCHAR) AS BROWSER, 'city ' || CAST(user_id % 5 AS VARCHAR) AS CITY, 'Brasil' AS COUNTRY,
        CAST(NULL AS VARCHAR) AS SUB_CONTINENT, 'name' AS TRAFFIC_SOURCE_NAME, 'medium' AS TRAFFIC_SOURCE_MEDIUM,
        'source' AS TRAFFIC_SOURCE_SOURCE, CAST(k AS VARCHAR) AS COLLECTED_CAMPAIGN_ID, event_type AS COLLECTED_CAMPAIGN,
        CAST(NULL AS VARCHAR) AS COLLECTED_SOURCE, CAST(NULL AS VARCHAR) AS COLLECTED_MEDIUM,
        CAST(k % 7 AS VARCHAR) AS CROSS_CHANNEL_CAMPAIGN_ID, 'campaign ' || CAST(k % 7 AS VARCHAR) AS CROSS_CHANNEL_CAMPAIGN,
        'crm' AS CROSS_CHANNEL_SOURCE,
        CASE WHEN k % 5 IN (0, 1) THEN NULL ELSE 'item ' || CAST(k AS VARCHAR) END AS ITEM_NAME,
        CASE WHEN k % 5 IN (0, 1) THEN NULL ELSE 'mensal' END AS PERIODICITY, CAST(NULL AS VARCHAR) AS OPERATION,
        CASE WHEN k % 5 IN (0, 1) THEN NULL ELSE 'C' || CAST(user_id AS VARCHAR) END AS COUPON,
        CASE event_type WHEN 'view' THEN 'SEM REFERENCIA' WHEN 'click' THEN 'MIDIA PAGA' WHEN 'purchase' THEN 'ORGÂNICO'
            ELSE 'SPFCTICKET' END AS CROSS_CHANNEL_MEDIUM
    FROM v WHERE event_type <> 'error'""")
def event_base_query(t):
    return event_base(web_export(t))


def web_export(t):
    """Web events nested as the export nests them."""

    def text(column):
        return column.cast("string")

    def struct(**members):
        return F.struct(*[
            (F.lit(None).cast("string") if value is None else F.lit(value) if isinstance(value, str) else value).alias(name)
            for name, value in members.items()
        ])

    made = t.events.withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    k, user = F.col("k"), text(F.col("user_id"))
    item = struct(item_name=F.concat(F.lit("item "), text(k)), item_category3="mensal", item_category4=None,
                  coupon=F.concat(F.lit("C"), user))
    campaign = struct(campaign_id=text(k % 7), campaign_name=F.concat(F.lit("campaign "), text(k % 7)), source="crm",
                      medium=F.expr(MEDIUM_IN))
    return made.select(
        F.date_format("ts", "yyyyMMdd").alias("event_date"),
        F.when(F.col("event_type") == "error", F.lit("file_download")).otherwise(F.col("event_type")).alias("event_name"),
        user.alias("user_id"), F.concat(F.lit("p"), user).alias("user_pseudo_id"),
        F.array(
            key_value("transaction_id", text=F.concat(F.lit("t"), text(F.col("event_id")))),
            key_value("page_location", text=F.repeat(F.concat(F.lit("/"), "event_type"), F.lit(60))),
            key_value("engagement", number=k),
            key_value("payment_type", text=F.when(k < 20, F.lit("BOLETO"))),
            key_value("is_pix", text=text(k % 2 == 0)),
            key_value("is_credit_card", text=text(k % 3 == 0)),
            key_value("has_credit_card", text=F.lit("true")),
            key_value("ga_session_id", number=k),
        ).alias("event_params"),
        F.when(k % 5 > 1, F.array(item)).when(k % 5 == 0, F.filter(F.array(item), lambda x: F.lit(False))).alias("items"),
        struct(category="mobile", mobile_brand_name=F.concat(F.lit("brand "), text(k % 5)), mobile_marketing_name=None,
               operating_system="os", operating_system_version=text(k),
               web_info=struct(browser=F.concat(F.lit("browser "), text(k % 3)))).alias("device"),
        struct(city=F.concat(F.lit("city "), text(F.col("user_id") % 5)), country="Brasil", sub_continent=None).alias("geo"),
        struct(name="name", medium="medium", source="source").alias("traffic_source"),
        struct(manual_campaign_id=text(k), manual_campaign_name=F.col("event_type"), manual_source=None,
               manual_medium=None).alias("collected_traffic_source"),
        struct(cross_channel_campaign=campaign).alias("session_traffic_source_last_click"),
    )


# ---- tickets ----------------------------------------------------------------------

TICKETS_IN = f"""
SELECT CAST(l_partkey AS VARCHAR(20)) AS event,
    CASE WHEN l_linenumber = 2 THEN ' ' WHEN l_linenumber = 3 THEN NULL ELSE c_name || ' da Conceição-' || l_linestatus END AS name,
    CASE CAST(l_suppkey % 6 AS INT) WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN 'nan' WHEN 3 THEN '123.456.789-' || lpad(CAST(l_linenumber AS VARCHAR(9)), 2, '0')
        WHEN 4 THEN ' ' || lpad(CAST(o_custkey AS VARCHAR(20)), 11, '7') ELSE CAST(o_custkey AS VARCHAR(20)) END AS document,
    replace(CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS VARCHAR(30)), '.', ',') AS amount,
    CASE WHEN l_linenumber = 1 THEN ' Pedido de Cortesia' WHEN l_linenumber = 2 THEN 'Carga' ELSE o_orderpriority END AS payment_method,
    CASE WHEN l_linenumber = 7 AND l_returnflag = 'N' THEN '31/02/2020 10:00' ELSE {day_text("l_shipdate")} || ' 1' || CAST(l_linenumber AS VARCHAR(9)) || ':0' || CAST(l_linenumber AS VARCHAR(9)) END AS payment_date,
    CASE o_orderstatus WHEN 'F' THEN 'Pago' WHEN 'O' THEN 'PAGO' ELSE 'Cancelado' END AS order_status,
    CASE l_returnflag WHEN 'R' THEN 'True' WHEN 'A' THEN 'false' END AS used,
    'h' || CAST(l_orderkey AS VARCHAR(20)) || '-' || CAST(l_linenumber AS VARCHAR(9)) AS ticket_hash,
    'Portão ' || CAST(l_linenumber AS VARCHAR(9)) AS gate,
    CASE l_linenumber WHEN 3 THEN '  ' WHEN 4 THEN NULL WHEN 5 THEN '123' ELSE ' Setor  Leste-É ' || l_linestatus END AS sector,
    'f' || CAST(l_suppkey AS VARCHAR(20)) AS "row",
    CASE WHEN l_linenumber = 6 THEN 'None' WHEN l_linenumber = 5 THEN NULL ELSE CAST(l_linenumber AS VARCHAR(9)) END AS seat,
    CAST(l_orderkey AS VARCHAR(20)) AS order_id,
    CASE l_linenumber WHEN 6 THEN 'VENDA PROIBIDA FLAMENGO' WHEN 7 THEN 'PDV FLAMENGO' ELSE 'site' END AS sale_from,
    CAST(l_suppkey AS VARCHAR(20)) AS ticket_id,
    CASE WHEN l_returnflag = 'R' THEN {day_text("l_shipdate")} || ' 21:45' END AS used_time,
    CASE CAST(o_custkey % 4 AS INT) WHEN 0 THEN '' WHEN 1 THEN 'None' WHEN 2 THEN 'x1' ELSE CAST(o_custkey AS VARCHAR(20)) END AS member_fc_id,
    CAST(o_custkey AS VARCHAR(20)) AS client_id,
    CASE WHEN l_linenumber = 4 THEN NULL ELSE 'Documento: ' || c_name END AS ticket_name,
    CASE CAST(l_suppkey % 3 AS INT) WHEN 0 THEN lpad(CAST(o_custkey AS VARCHAR(20)), 11, '0') WHEN 1 THEN 'RG 12' END AS ticket_document,
    CASE CAST(l_partkey % 3 AS INT) WHEN 0 THEN ' Sócio 10%' WHEN 1 THEN '50%' END AS discount,
    CASE WHEN l_linenumber > 1 THEN '3,50' END AS convenience_fee,
    CASE WHEN l_linenumber < 6 THEN 'ev' || CAST(l_partkey AS VARCHAR(20)) END AS event_id_original,
    'b' || CAST(l_partkey AS VARCHAR(20)) AS event_id_jogo_base, 'Jogo' AS tipo_evento, l_returnflag AS partida_base
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey JOIN {{customer}} ON o_custkey = c_custkey"""

SHOWN = "CASE WHEN {0} IS NULL OR {0} IN ('nan', 'None') THEN '' ELSE upper({0}) END"


def _shown_as(expression: str, name: str) -> str:
    return f"{SHOWN.format('(' + expression + ')')} AS {name}"


LETTERS = r"'[^A-Za-zÀ-ÖØ-öø-ÿ\s]', '', 'g'"

CLEAN_TICKETS = rf"""
    WITH raw AS ({shape_sql(TICKETS_IN)}),
    marked AS (SELECT * REPLACE (CASE WHEN sale_from = 'VENDA PROIBIDA FLAMENGO' THEN '-1' ELSE document END AS document,
        CASE WHEN sale_from = 'VENDA PROIBIDA FLAMENGO' THEN 'CORTESIA' ELSE name END AS name) FROM raw WHERE upper(order_status) = 'PAGO'),
    v AS (SELECT *, regexp_replace(trim(CASE WHEN document IN ('None', 'nan', 'NaN', '') THEN NULL ELSE document END), '[^0-9]', '', 'g') AS d,
        CASE WHEN upper(trim(payment_method)) IN ('PEDIDO DE CORTESIA', 'CARGA') THEN '-1'
             WHEN ticket_document IN ('None', 'nan', 'NaN', '') THEN NULL ELSE trim(ticket_document) END AS holder,
        regexp_replace(trim(CASE WHEN trim(coalesce(name, '')) <> '' THEN upper(name) ELSE ticket_name END), {LETTERS}) AS n,
        substr(regexp_replace(upper(trim(coalesce(discount, ''))), {LETTERS}), 1, 200) AS disc,
        regexp_replace({SHOWN.format("strip_accents(sector)")}, {LETTERS}) AS sect FROM marked)
    SELECT {_shown_as("coalesce(event_id_original, event)", "cod_evento")},
        CASE WHEN d IS NULL OR d IN ('', '1') THEN '-1' ELSE substr(d, 1, 11) END AS cpf,
        substr({SHOWN.format("n")}, 1, 100) AS nome, {_shown_as("ticket_hash", "ingresso")}, 'PA' AS status_ingresso,
        {_shown_as("replace(amount, ',', '.')", "valor")},
        strftime(try_strptime(payment_date, '%d/%m/%Y %H:%M'), '%Y-%m-%d %H:%M:%S') AS data_pagamento,
        {_shown_as("payment_method", "forma_pagamento")}, coalesce(lower(used) = 'true', false) AS usado,
        trim(regexp_replace(CASE WHEN sect = '' THEN 'NAO_INFORMADO' ELSE sect END, '\s+', ' ', 'g')) AS setor,
        {_shown_as("strip_accents(gate)", "portao_acesso")}, {_shown_as('"row"', "fileira")}, {_shown_as("seat", "assento")},
        {_shown_as("order_id", "order_id")}, {_shown_as("sale_from", "sale_from")}, '' AS subsector,
        {_shown_as("ticket_id", "ticket_id")},
        strftime(try_strptime(used_time, '%d/%m/%Y %H:%M'), '%Y-%m-%d %H:%M:%S') AS used_time,
        CASE WHEN regexp_full_match(member_fc_id, '[0-9]+') THEN TRY_CAST(member_fc_id AS DOUBLE) END AS member_fc_id,
        CAST(client_id AS DOUBLE) AS client_id, CAST(NULL AS DOUBLE) AS member_unique_id, '' AS ipe_comprou_ano_vigente,
        CASE WHEN disc = '' THEN 'NÃO INFORMADO' ELSE disc END AS desconto,
        {_shown_as("replace(convenience_fee, ',', '.')", "taxa_conveniencia")},
        {_shown_as("trim(replace(ticket_name, 'Documento: ', ''))", "ticket_name")},
        {_shown_as("holder", "documento_portador")}, coalesce(regexp_full_match(holder, '[0-9]{{11}}'), false) AS flag_cpf_portador,
        {_shown_as("tipo_evento", "tipo_evento")}, {_shown_as("event_id_jogo_base", "event_id_jogo_base")},
        {_shown_as("partida_base", "partida_base")}
    FROM v"""


def tickets_in(t):
    return shaped(t, TICKETS_IN.replace('"row"', "`row`"))


@query("clean_tickets", CLEAN_TICKETS)
def clean_tickets_query(t):
    return clean_tickets(tickets_in(t)).withColumn("data_pagamento", stamp("data_pagamento"))


@query("ticket_counters", f"""
    WITH raw AS ({shape_sql(TICKETS_IN)})
    SELECT count(*) AS rows_in, count(*) FILTER (upper(order_status) <> 'PAGO') AS removed_status,
        count(*) FILTER (upper(order_status) = 'PAGO') AS rows_out,
        count(*) FILTER (upper(order_status) = 'PAGO' AND upper(trim(payment_method)) IN ('PEDIDO DE CORTESIA', 'CARGA')) AS flagged_courtesy
    FROM raw""")
def ticket_counters_query(t):
    return ticket_counters(tickets_in(t))


# ---- clients ----------------------------------------------------------------------

CLIENTS_IN = """
SELECT c_custkey * 2 AS seq, lpad(CAST(c_custkey AS VARCHAR(20)), 11, '0') AS document, c_name || ' José' AS first_name,
    CASE WHEN c_nationkey % 3 = 0 THEN NULL ELSE 'D''Ávila 2º' END AS last_name,
    CASE WHEN c_nationkey = 5 THEN 'excluido@excluido.com' WHEN c_nationkey = 6 THEN NULL ELSE c_name || '@mail.com' END AS email,
    'Rua ' || c_mktsegment || ', 10' AS address, CASE WHEN c_nationkey = 7 THEN NULL ELSE 'São Paulo' END AS city, 'sp' AS state,
    CAST(NULL AS VARCHAR(9)) AS district, CASE WHEN c_nationkey = 8 THEN NULL ELSE '01000-' || lpad(CAST(c_nationkey AS VARCHAR(9)), 3, '0') END AS cep
FROM {customer}
UNION ALL
SELECT c_custkey * 2 + 1, CASE WHEN c_nationkey < 8 THEN lpad(CAST(c_custkey AS VARCHAR(20)), 11, '0') WHEN c_nationkey < 16 THEN lpad(CAST(c_custkey AS VARCHAR(20)), 9, '0') || '-' || '00'
    WHEN c_nationkey < 20 THEN '0' || '.' || lpad(CAST(c_custkey AS VARCHAR(20)), 10, '0') ELSE 'sem' END,
    CASE WHEN c_nationkey = 9 THEN 'Privacidade' ELSE 'Outro' END, CASE WHEN c_nationkey = 9 THEN 'Excluido' ELSE c_name END,
    c_mktsegment || '@mail.com', NULL, 'Rio', 'rj', 'Gávea', '22000-000'
FROM {customer} WHERE c_nationkey > 2"""

CLEAN_CLIENTS = rf"""
    WITH raw AS ({shape_sql(CLIENTS_IN)}),
    latest AS (SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY document ORDER BY seq DESC) = 1),
    v AS (SELECT seq, upper(coalesce(email, '')) AS email, substr(regexp_replace(document, '[^0-9]', '', 'g'), 1, 11) AS cpf,
        regexp_replace(upper(coalesce(address, 'NAO_INFORMADO')), {LETTERS}) AS endereco,
        regexp_replace(upper(trim(coalesce(first_name, '') || ' ' || coalesce(last_name, ''))), {LETTERS}) AS nome,
        'NAO_INFORMADO' AS telefone, regexp_replace(upper(coalesce(city, 'NAO_INFORMADO')), {LETTERS}) AS cidade,
        regexp_replace(upper(coalesce(district, 'NAO_INFORMADO')), {LETTERS}) AS bairro,
        regexp_replace(upper(coalesce(state, 'NAO_INFORMADO')), {LETTERS}) AS estado,
        replace(coalesce(cep, 'NAO_INFORMADO'), '-', '') AS cep, '2026-01-05' AS data_insercao, 'FUTEBOLCARD' AS fonte FROM latest)
    SELECT * EXCLUDE (seq) FROM v WHERE cpf <> '' AND email <> 'EXCLUIDO@EXCLUIDO.COM' AND nome <> 'PRIVACIDADE EXCLUIDO'
    QUALIFY row_number() OVER (PARTITION BY cpf ORDER BY seq DESC) = 1"""


@query("clean_clients", CLEAN_CLIENTS)
def clean_clients_query(t):
    return clean_clients(shaped(t, CLIENTS_IN), ["seq"], "2026-01-05")


@query("load_clients", f"""
    WITH b AS ({CLEAN_CLIENTS}), a AS (SELECT * REPLACE (cidade || 'X' AS cidade, '11' AS telefone, '2025-01-01' AS data_insercao)
        FROM b WHERE email LIKE '%MAIL.COM')
    SELECT b.* REPLACE (coalesce(a.telefone, b.telefone) AS telefone, coalesce(a.data_insercao, b.data_insercao) AS data_insercao)
    FROM b LEFT JOIN a USING (cpf)""")
def load_clients_query(t):
    clients = clean_clients(shaped(t, CLIENTS_IN), ["seq"], "2026-01-05")
    known = clients.where(F.col("email").like("%MAIL.COM")).withColumns({
        "cidade": F.concat("cidade", F.lit("X")), "telefone": F.lit("11"), "data_insercao": F.lit("2025-01-01"),
    })
    return load_clients(known, clients)


# ---- catalogue --------------------------------------------------------------------

EVENTS_IN = f"""
SELECT CAST(o_orderkey AS VARCHAR(20)) AS event_id, CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE {day_text("o_orderdate")} END AS event_date,
    CASE WHEN o_orderpriority < '3' THEN '16:00' ELSE '21:30' END AS event_time,
    CASE CAST(o_orderkey % 8 AS INT) WHEN 0 THEN 'Estacionamento - Jogo' WHEN 1 THEN 'Espaço Premium' WHEN 2 THEN 'Fla+ Lounge' WHEN 3 THEN 'Fla  Plus'
        WHEN 4 THEN 'Pacote de jogos' WHEN 5 THEN NULL ELSE 'São João x Time ' || CAST(o_custkey AS VARCHAR(20)) END AS "match",
    CASE o_orderstatus WHEN 'F' THEN 'Maracanã' WHEN 'O' THEN ' estádio do maracanã ' ELSE 'Outro' END AS stadium,
    CASE CAST(o_custkey % 7 AS INT) WHEN 0 THEN 'nbb' WHEN 1 THEN 'Copa Teste' WHEN 2 THEN NULL WHEN 3 THEN 'Copa Fla Maracanã' ELSE 'Brasileirão' END AS championship,
    {day_text("o_orderdate")} AS sales_start_date, CASE WHEN o_custkey % 2 = 0 THEN '9:05' END AS sales_start_time,
    {day_text("o_orderdate")} AS public_sale_start_date, '10:00' AS public_sale_start_time,
    CASE WHEN o_custkey % 3 = 0 THEN 'a definir' ELSE {day_text("o_orderdate")} || ' 18:30' END AS sales_end
FROM {{orders}}"""

CATALOGUE = rf"""
    raw AS ({shape_sql(EVENTS_IN)}),
    n AS (SELECT *, coalesce(strip_accents(upper(trim("match"))), '') AS m, coalesce(strip_accents(upper(trim(championship))), '') AS c FROM raw
        WHERE contains(strip_accents(upper(stadium)), 'MARACANA')),
    k AS (SELECT *, CASE WHEN contains(m, 'ESTACIONAMENTO') THEN 'ESTACIONAMENTO'
            WHEN contains(m, 'ESPACO') OR contains(m, 'FLA+') OR contains(m, 'FLA PLUS') THEN 'FLA_PLUS' ELSE 'JOGO' END AS kind FROM n
        WHERE c <> 'NBB' AND NOT regexp_matches(c, 'TESTE|PACOTE|FUTEBOLCARD|TREINO|BCLA|COPA FLA MARACA|FLA FEST')
          AND NOT regexp_matches(m, 'TESTE|PACOTE')),
    b AS (SELECT *, CASE WHEN event_date IS NOT NULL THEN first_value(event_id) OVER w END AS base_id,
            CASE WHEN event_date IS NOT NULL THEN first_value("match") OVER w END AS base_match FROM k
        WINDOW w AS (PARTITION BY event_date, event_time ORDER BY (kind = 'JOGO') DESC, CAST(event_id AS BIGINT))),
    catalogue AS (SELECT event_id AS COD_EVENTO, strftime(try_strptime(event_date, '%d/%m/%Y'), '%Y-%m-%d') AS DT_EVENTO, event_time AS HR_EVENTO,
        upper(strip_accents(coalesce("match", 'None'))) AS PARTIDA, upper(strip_accents(stadium)) AS ESTADIO,
        upper(strip_accents(coalesce(championship, 'None'))) AS CAMPEONATO, kind AS TIPO_EVENTO, coalesce(base_id, 'None') AS COD_EVENTO_BASE,
        upper(strip_accents(coalesce(base_match, 'None'))) AS PARTIDA_BASE,
        strftime(try_strptime(sales_start_date || ' ' || sales_start_time, '%d/%m/%Y %H:%M'), '%Y-%m-%d %H:%M:%S') AS DATA_INICIO_VENDAS,
        strftime(try_strptime(public_sale_start_date || ' ' || public_sale_start_time, '%d/%m/%Y %H:%M'), '%Y-%m-%d %H:%M:%S') AS DATA_INICIO_VENDAS_PUBLICO,
        strftime(try_strptime(sales_end, '%d/%m/%Y %H:%M'), '%Y-%m-%d %H:%M:%S') AS DATA_FINAL_VENDAS_PUBLICO FROM b)"""


def catalogue_in(t):
    return clean_events(shaped(t, EVENTS_IN.replace('"match"', "`match`")))


@query("clean_events", f"WITH {CATALOGUE} SELECT * FROM catalogue")
def clean_events_query(t):
    moments = ["DATA_INICIO_VENDAS", "DATA_INICIO_VENDAS_PUBLICO", "DATA_FINAL_VENDAS_PUBLICO"]
    return catalogue_in(t).withColumns({name: stamp(name) for name in moments})


@query("extend_dim", f"""
    WITH {CATALOGUE}, dim AS (SELECT CAST(o_orderkey AS VARCHAR) AS sk_partida FROM orders WHERE o_totalprice < 100000)
    SELECT COD_EVENTO AS sk_partida, PARTIDA AS partida, CAMPEONATO || ' ' || CAST(year(CAST(DT_EVENTO AS DATE)) AS VARCHAR) AS campeonato,
        DT_EVENTO || ' ' || HR_EVENTO AS dthr_partida
    FROM catalogue LEFT JOIN dim ON COD_EVENTO = sk_partida WHERE sk_partida IS NULL AND upper(PARTIDA) NOT LIKE '%ESPACO%'
        AND upper(PARTIDA) NOT LIKE '%FLA+%' AND upper(PARTIDA) NOT LIKE '%ESTACIONAMENTO%'""")
def extend_dim_query(t):
    dim = t.orders.where("o_totalprice < 100000").select(F.col("o_orderkey").cast("string").alias("sk_partida"))
    return extend_dim(catalogue_in(t), dim)


@query("extend_dim_entries", """
    WITH f AS (SELECT DISTINCT p_brand || '-' || p_size AS idapresentacao, p_name AS campeonato, p_type AS partida, p_size AS dthr_apresentacao FROM part),
    d AS (SELECT DISTINCT p_brand || '-' || p_size AS idapresentacao FROM part WHERE p_retailprice > 1500)
    SELECT f.* FROM f LEFT JOIN d USING (idapresentacao) WHERE d.idapresentacao IS NULL AND campeonato NOT ILIKE '%tour da%'
        AND campeonato NOT ILIKE '%estacionamento%'""")
def extend_dim_entries_query(t):
    ids = F.concat("p_brand", F.lit("-"), F.col("p_size").cast("string")).alias("idapresentacao")
    fact = t.part.select(
        ids, F.col("p_name").alias("campeonato"), F.col("p_type").alias("partida"), F.col("p_size").alias("dthr_apresentacao")
    )
    return extend_dim_entries(fact, t.part.where("p_retailprice > 1500").select(ids))


# ---- facts ------------------------------------------------------------------------

STAGE_IN = """
SELECT CAST(l_orderkey AS VARCHAR(20)) AS cod_evento, CAST(l_suppkey * 10 AS VARCHAR(20)) AS cpf, 'ticket ' || l_returnflag AS nome,
    CAST(l_partkey AS VARCHAR(20)) || '-' || CAST(l_linenumber AS VARCHAR(9)) AS ingresso, 'PA' AS status_ingresso, CAST(l_extendedprice AS VARCHAR(30)) AS valor,
    l_linestatus AS data_pagamento, l_returnflag AS forma_pagamento, l_linestatus = 'F' AS usado, 'N' AS setor, 'G1' AS portao_acesso, 'A' AS fileira,
    CAST(l_linenumber AS VARCHAR(9)) AS assento, CAST(l_orderkey AS VARCHAR(20)) AS order_id, 'SITE' AS sale_from, '' AS subsector,
    CAST(l_partkey AS VARCHAR(20)) AS ticket_id, CAST(NULL AS VARCHAR(20)) AS used_time, l_tax AS member_fc_id, l_discount AS client_id,
    CASE l_returnflag WHEN 'A' THEN '' WHEN 'N' THEN 'null' ELSE 'M' || l_linestatus END AS member_unique_id, '' AS ipe_comprou_ano_vigente, 'X' AS desconto,
    '3.50' AS taxa_conveniencia, 'HOLDER' AS ticket_name, '-1' AS documento_portador, false AS flag_cpf_portador
FROM {lineitem}"""

PEOPLE_IN = """
SELECT CAST(c_custkey AS VARCHAR(20)) AS cpf, c_custkey AS sk_pessoa, c_name AS nome, CASE WHEN c_nationkey > 12 THEN c_name || '@mail.com' END AS email,
    CAST(NULL AS VARCHAR(20)) AS load_end_date FROM {customer} WHERE c_mktsegment <> 'MACHINERY'
UNION ALL SELECT CAST(c_custkey AS VARCHAR(20)), -c_custkey, 'old', 'old@mail.com', '1999-01-01' FROM {customer}"""


def _contracts(t):
    orders = t.orders.select(
        F.col("o_custkey").cast("string").alias("cpf"), F.col("o_orderkey").alias("sk_contrato"), "o_orderdate"
    )
    return latest_per_key(orders, "cpf", ["o_orderdate", "sk_contrato"], ["sk_contrato"])


@query("ticket_fact", f"""
    WITH stage AS ({shape_sql(STAGE_IN)}), people AS ({shape_sql(PEOPLE_IN)}),
    contracts AS (SELECT CAST(o_custkey AS VARCHAR) AS cpf, o_orderkey AS sk_contrato FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
    SELECT cod_evento AS sk_partida, sk_pessoa, ingresso, a.cpf, valor, data_pagamento, forma_pagamento, usado, setor, portao_acesso, fileira, assento,
        desconto, taxa_conveniencia, sk_contrato, used_time AS data_acesso, ticket_name AS nome_portador, documento_portador, flag_cpf_portador
    FROM stage a LEFT JOIN people p ON a.cpf = p.cpf AND load_end_date IS NULL LEFT JOIN contracts c ON a.cpf = c.cpf
    WHERE cod_evento IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'F')""")
def ticket_fact_query(t):
    batch = t.orders.where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").cast("string").alias("cod_evento"))
    return build_fact(shaped(t, STAGE_IN), shaped(t, PEOPLE_IN), _contracts(t), batch)


FEED_SQL = f"""
    WITH {CATALOGUE}, stage AS ({shape_sql(STAGE_IN)}), people AS ({shape_sql(PEOPLE_IN)}),
    known AS (SELECT cpf, nome, email FROM people WHERE load_end_date IS NULL AND email IS NOT NULL),
    clients AS (SELECT CAST(s_suppkey * 10 AS VARCHAR) AS cpf, s_name AS nome, s_name || '@shop' AS email FROM supplier WHERE s_nationkey > 5),
    ticket AS (SELECT s.*, PARTIDA, DT_EVENTO FROM stage s JOIN catalogue c ON c.COD_EVENTO = s.cod_evento),
    named AS (SELECT ticket.*, coalesce(known.nome, clients.nome, ticket.nome) AS best_name, coalesce(known.email, clients.email) AS best_email
        FROM ticket LEFT JOIN known USING (cpf) LEFT JOIN clients USING (cpf))
    SELECT cpf, best_name AS nome, best_email AS email, cod_evento AS event, PARTIDA AS partida, DT_EVENTO AS data_realizacao,
        ticket_id, ingresso, order_id, client_id, member_fc_id, nullif(nullif(member_unique_id, ''), 'null') AS member_unique_id,
        valor, desconto, taxa_conveniencia, data_pagamento AS payment_date, forma_pagamento AS payment_method, 'PAGO' AS order_status,
        portao_acesso AS tipo_acesso, setor, subsector, fileira AS "row", assento AS seat, usado AS used, used_time, sale_from,
        ticket_name, documento_portador, flag_cpf_portador, ipe_comprou_ano_vigente, 'NAO_INFORMADO' AS descricao, 'FCARD' AS ticketeira
    FROM named"""


def _shop_clients(t):
    return t.supplier.select(
        (F.col("s_suppkey") * 10).cast("string").alias("cpf"), F.col("s_name").alias("nome"),
        F.when(F.col("s_nationkey") > 5, F.concat("s_name", F.lit("@shop"))).alias("email"),
    )


@query("integration_feed", FEED_SQL)
def integration_feed_query(t):
    return build_integration(shaped(t, STAGE_IN), catalogue_in(t), shaped(t, PEOPLE_IN), _shop_clients(t))


# ---- second ticketing feed --------------------------------------------------------

ENTRIES_IN = """
SELECT l_orderkey * 100000000 + l_partkey * 1000 + l_linenumber AS seq, l_suppkey AS seq2, l_extendedprice AS seq3,
    CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN 'a' || CAST(l_orderkey AS VARCHAR(20)) ELSE 'b' || CAST(l_partkey AS VARCHAR(20)) END AS idacesso,
    CASE WHEN l_linenumber = 1 AND l_returnflag = 'R' THEN NULL ELSE CAST(l_suppkey AS VARCHAR(20)) END AS idapresentacao,
    CAST(l_partkey AS VARCHAR(20)) AS codigo, ' Copa ' || l_linestatus AS titulo, CASE WHEN l_returnflag = 'A' THEN '' ELSE 'a x b ' END AS dscapresentacao,
    'inteira' AS dscinterna, l_returnflag AS dsctipoproduto, CASE l_returnflag WHEN 'N' THEN 'pa' ELSE 'ca' END AS status,
    CASE WHEN l_linenumber = 4 THEN 'x' ELSE CAST(l_quantity AS VARCHAR(20)) END AS valor, CAST(l_tax AS VARCHAR(20)) AS valor_taxa,
    CASE WHEN l_linenumber = 5 THEN 'n/a' ELSE CAST(l_suppkey AS VARCHAR(20)) END AS cartao,
    CASE l_linenumber WHEN 1 THEN 's' WHEN 2 THEN 'N' WHEN 3 THEN '1' WHEN 4 THEN 'sim' END AS acesso_entrou, l_discount AS extra,
    CASE WHEN l_returnflag = 'A' THEN '' ELSE ' livre' END AS nota
FROM {lineitem}"""

ENTRIES = f"""
    e AS ({shape_sql(ENTRIES_IN)}),
    d AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY coalesce(idacesso, coalesce(idapresentacao, 'None') || '|' || codigo) ORDER BY seq, seq2, seq3) = 1),
    entries AS (SELECT upper(trim(idacesso)) AS IDACESSO, upper(idapresentacao) AS IDAPRESENTACAO, codigo AS CODIGO, upper(trim(titulo)) AS CAMPEONATO,
        upper(trim(nullif(dscapresentacao, ''))) AS PARTIDA, 'INTEIRA' AS TIPO_INGRESSO, dsctipoproduto AS TIPO_PRODUTO, upper(status) AS STATUS,
        TRY_CAST(valor AS DOUBLE) AS VALOR, CAST(valor_taxa AS DOUBLE) AS VALOR_TAXA, TRY_CAST(cartao AS BIGINT) AS CARTAO,
        CASE WHEN acesso_entrou IN ('s', '1') THEN true WHEN acesso_entrou = 'N' THEN false END AS ACESSO_ENTROU, extra AS EXTRA,
        nullif(nota, '') AS NOTA FROM d)"""


def entries_in(t):
    return entry_tickets(shaped(t, ENTRIES_IN), ["seq", "seq2", "seq3"], drop=["seq", "seq2", "seq3"])


@query("entry_tickets", f"WITH {ENTRIES} SELECT * FROM entries")
def entry_tickets_query(t):
    return entries_in(t)


@query("load_entries", f"""
    WITH {ENTRIES}, target AS (SELECT * REPLACE ('OLD' AS PARTIDA, CODIGO || CASE WHEN CARTAO < 50 THEN '' ELSE '-old' END AS CODIGO) FROM entries)
    SELECT * FROM target WHERE CODIGO NOT IN (SELECT CODIGO FROM entries) UNION ALL SELECT * FROM entries WHERE STATUS = 'PA'""")
def load_entries_query(t):
    batch = entries_in(t)
    code = F.when(F.col("CARTAO") < 50, F.col("CODIGO")).otherwise(F.concat("CODIGO", F.lit("-old")))
    return load_entries(batch.withColumns({"PARTIDA": F.lit("OLD"), "CODIGO": code}), batch)


# ---- membership shop --------------------------------------------------------------

@query("shop_orders", """
    SELECT l_orderkey AS ID, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS SALE_DATE, o_totalprice AS TOTAL_VALUE, c_name AS BUYER_FULL_NAME,
        CASE WHEN l_linenumber < 6 THEN '["' || l_returnflag || '","' || l_linestatus || '"]' END AS TAG_LIST,
        CASE WHEN l_linenumber <> 3 THEN o_orderpriority END AS PAYMENTS_METHOD_NAME, CASE WHEN l_linenumber <> 3 THEN l_tax END AS PAYMENTS_FEE_VALUE,
        o_orderstatus AS STATUSES_NAME, l_shipdate_text AS SHIPPINGS_SENT_DATE, CAST(l_partkey AS BIGINT) AS SHIPPINGS_PRODUCTS_ID,
        l_quantity AS SHIPPINGS_PRODUCTS_QUANTITY, CASE WHEN l_linenumber = 2 THEN 'shirt ' || l_returnflag END AS SHIPPINGS_PRODUCTS_CUSTOM_PRINT_NAME,
        CASE WHEN l_discount > CAST(0.05 AS DOUBLE) THEN 'promo' END AS BENEFIT_PROMOTIONS_CODE, l_suppkey AS SHIPPINGS_PRODUCTS_STAMPS_ID,
        'size' AS SHIPPINGS_PRODUCTS_ALL_CONFIGURATIONS_KEY
    FROM (SELECT *, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate_text FROM lineitem) JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""")
def shop_orders_query(t):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        t.customer, F.col("o_custkey") == F.col("c_custkey")
    )

    def record(**members):
        return F.struct(*[(F.lit(v) if isinstance(v, str) else v).alias(name) for name, v in members.items()])

    def only_if(condition, one):
        return F.when(condition, F.array(one)).otherwise(F.filter(F.array(one), lambda x: F.lit(False)))

    line = F.col("l_linenumber")
    product = record(
        id=F.col("l_partkey"), quantity=F.col("l_quantity"),
        custom=F.when(line == 2, F.array(record(printName=F.concat(F.lit("shirt "), "l_returnflag")))),
        stamps=F.array(record(id=F.col("l_suppkey"))), allConfigurations=F.array(record(key="size"), record(key="color")),
    )
    shipping = record(sentDate=F.date_format("l_shipdate", "yyyy-MM-dd"), products=F.array(product))
    nested = joined.select(
        F.col("l_orderkey").alias("id"), stamp("o_orderdate").alias("saleDate"), F.col("o_totalprice").alias("totalValue"),
        record(fullName=F.col("c_name")).alias("buyer"),
        F.when(line < 6, F.array("l_returnflag", "l_linestatus")).alias("tagList"),
        only_if(line != 3, record(methodName=F.col("o_orderpriority"), fee=record(value=F.col("l_tax")))).alias("payments"),
        F.array(record(name="created"), record(name=F.col("o_orderstatus"))).alias("statuses"),
        F.array(shipping).alias("shippings"),
        record(promotions=only_if(F.col("l_discount") > 0.05, record(code="promo"))).alias("benefit"),
    )
    return shop_orders(nested)


@query("shop_users", """
    SELECT c_custkey AS ID, strftime(TIMESTAMP '2024-01-01', '%Y-%m-%d') AS DATE_CREATED, c_name AS PERSON_FULL_NAME, c_acctbal AS UPDATES_BALANCE,
        CASE WHEN c_nationkey <> 3 THEN n_name END AS ADDRESS_COUNTRY_NAME, CASE WHEN c_nationkey <> 3 THEN n_regionkey END AS ADDRESS_REGION_ID,
        CASE WHEN c_nationkey <> 4 THEN c_mktsegment END AS ACTIVE_ADDRESS_STREET, CAST(c_nationkey AS VARCHAR) AS PHONE_AREA_CODE
    FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def shop_users_query(t):
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    address = F.struct(F.col("n_name").alias("countryName"), F.struct(F.col("n_regionkey").alias("id")).alias("region"))
    active = F.struct(F.col("c_mktsegment").alias("street"))
    phone = F.struct(F.col("c_nationkey").cast("string").alias("areaCode"))
    nested = joined.select(
        F.col("c_custkey").alias("id"), F.lit("2024-01-01").alias("dateCreated"),
        F.struct(F.col("c_name").alias("fullName"), F.array(phone).alias("phones")).alias("person"),
        F.struct(F.struct(F.col("c_acctbal").alias("balance")).alias("dates")).alias("updates"),
        F.when(F.col("c_nationkey") != 3, F.array(address, address)).alias("addresses"),
        F.when(F.col("c_nationkey") != 4, F.array(active)).alias("activeAddresses"),
    )
    return shop_users(nested)


# ---- e-commerce -------------------------------------------------------------------

@query("ecommerce_orders", """
    SELECT CAST(l_orderkey AS VARCHAR) AS ID_PEDIDO, CAST(l_linenumber AS BIGINT) AS SEQUENCIA_ITEM,
        strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%g') AS DT_CRIACAO_PEDIDO, upper(c_name) AS NOME, CAST(NULL AS VARCHAR) AS CUPOM_DESCONTO,
        CASE o_orderstatus WHEN 'F' THEN 'FATURADO' ELSE 'PENDENTE' END AS STATUS_PEDIDO, CAST(l_quantity AS BIGINT) AS QTD_SKU,
        CAST(l_partkey AS VARCHAR) AS ID_SKU, l_extendedprice AS VL_VENDA_SKU, l_tax AS VL_SERVICO,
        CASE l_returnflag WHEN 'R' THEN true WHEN 'A' THEN false END AS FLAG_ENTREGUE, l_linestatus AS STATUS_BRUTO, l_suppkey AS SUPPLIER_CODE
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""")
def ecommerce_orders_query(t):
    return ecommerce_orders(ecommerce_export(t))


def ecommerce_export(t):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        t.customer, F.col("o_custkey") == F.col("c_custkey")
    )

    def brazilian(column):
        return F.replace(F.col(column).cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))

    word = F.when(F.col("l_returnflag") == "R", F.lit("Sim")).when(F.col("l_returnflag") == "A", F.lit("Não"))
    return joined.select(
        F.col("l_orderkey").cast("string").alias("Order"), F.col("l_linenumber").cast("string").alias("Sequence "),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("Creation Date"), F.col("c_name").alias("Client Name"),
        F.lit(" NaN").alias("Coupon"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Faturado ")).otherwise(F.lit("pendente")).alias("Status"),
        F.concat(F.col("l_quantity").cast("bigint").cast("string"), F.lit(",00")).alias("Quantity_SKU"),
        F.col("l_partkey").cast("string").alias("ID_SKU"), F.concat(F.lit("R$ "), brazilian("l_extendedprice")).alias("SKU Selling Price"),
        brazilian("l_tax").alias("Service (Price/ Selling Price)"), word.alias("Delivered"),
        F.col("l_linestatus").alias("Status raw value (temporary)"), F.col("l_suppkey").alias("Supplier-Code"),
    )


@query("ecommerce_customers", """
    SELECT upper(c_name) || '@MAIL.COM' AS EMAIL, upper(c_name) AS NOME, lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS CPF,
        c_acctbal AS VALOR_ULTIMO_CARRINHO, 'Cart ' || c_mktsegment AS ID_ULTIMO_CARRINHO, CAST(c_nationkey AS BIGINT) AS MES_NASCIMENTO,
        c_nationkey > 12 AS FLAG_EMPRESA, '2024-03-01 13:00:00.250' AS DATA_CRIACAO, c_mktsegment AS TAG_PRODUTO_VISITADO_SEM_ESTOQUE
    FROM customer""")
def ecommerce_customers_query(t):
    balance = F.replace(F.col("c_acctbal").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))
    export = t.customer.select(
        F.concat("c_name", F.lit("@mail.com ")).alias("email"), F.col("c_name").alias(" firstName"),
        F.lpad(F.col("c_custkey").cast("string"), 11, "0").alias("document"), balance.alias("rclastcartvalue"),
        F.concat(F.lit("Cart "), "c_mktsegment").alias("rclastcart"), F.col("c_nationkey").cast("string").alias("birthDateMonth"),
        (F.col("c_nationkey") > 12).cast("string").alias("isCorporate"), F.lit("2024-03-01T10:00:00.2509-03:00").alias("createdIn"),
        F.col("c_mktsegment").alias("visitedProductWithStockOutSkusTag"),
    )
    return ecommerce_customers(export)


# ---- dimensions -------------------------------------------------------------------

@query("replicate_dims", """
    SELECT s_suppkey AS S_SUPPKEY, s_name AS S_NAME, 'refresh' AS target FROM supplier
    UNION ALL SELECT s_suppkey, s_name, 'append' FROM supplier UNION ALL SELECT s_suppkey, s_name, 'append' FROM supplier""")
def replicate_dims(t):
    dim = t.supplier.select("s_suppkey", "s_name")
    once, twice = work_path(t.spark, "dim"), work_path(t.spark, "dim")
    refreshed = [replicate(dim, [once]) for _ in range(2)][-1][0]
    appended = [replicate(dim, [twice], mode="append") for _ in range(2)][-1][0]
    return refreshed.withColumn("target", F.lit("refresh")).unionByName(
        appended.withColumn("target", F.lit("append"))
    )
