"""Projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.operators import filters
from feedloom.operators.headers import canonical_headers, rename_map
from feedloom.operators.shape import (
    SHOP_KINDS,
    TableSpec,
    apply_spec,
    conform,
    project_paths,
    stack_frames,
    with_lineage,
)
from feedloom.registry.base import query


@query("canonical_headers", """
    SELECT c_custkey AS ORDER_ID, c_name AS CLIENT_FIRST_NAME, c_nationkey AS SKU_QUANTITY,
           c_acctbal AS SERVICE_PRICE_SELLING_PRICE_, c_mktsegment AS MARKETING_TAGS
    FROM customer""")
def canonical_headers_csv(t):
    messy = t.customer.toDF(
        " Order", "Client Name ", "Quantity_SKU", "Service (Price/ Selling Price)", "marketingTags"
    )
    return canonical_headers(messy, "csv")


@query("canonical_headers_json", """
    SELECT o_orderkey AS ID, o_custkey AS BUYER_PERSON_ID, o_orderstatus AS STATUS_CODE,
           o_totalprice AS TOTAL_VALUE_BRL, strftime(o_orderdate, '%Y-%m-%d') AS SALE_DATE, o_orderpriority AS PRIORITY_LEVEL
    FROM orders""")
def canonical_headers_json(t):
    text = t.orders.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    messy = text.toDF(
        "id_m12", "buyer.personId", "status__Code", "totalValueBRL", "saleDate_x", "_priority.Level_"
    )
    return canonical_headers(messy, "json")


@query("canonical_headers_user", """
    SELECT s_suppkey AS ID_X, s_name AS ADDRESS_STREET, s_nationkey AS PHONE_AREA_CODE, s_acctbal AS UPDATES_LAST_LOGIN
    FROM supplier""")
def canonical_headers_user(t):
    messy = t.supplier.toDF("id_x", "addresses_street", "person.phones_areaCode", "updates.dates.lastLogin")
    return canonical_headers(messy, "json_user")


@query("canonical_headers_lower", """
    SELECT r_regionkey AS codigo, r_name AS "regiao do cliente", r_count AS n FROM
        (SELECT r_regionkey, r_name, count(*) AS r_count FROM region JOIN nation ON r_regionkey = n_regionkey
         JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL)""")
def canonical_headers_lower(t):
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    counted = joined.groupBy("r_regionkey", "r_name").agg(F.count(F.lit(1)).alias("n"))
    return canonical_headers(counted.toDF("Código ", "REGIÃO do Cliente", "N"), "lower")


@query("rename_map", """
    SELECT p_partkey AS id, p_name AS title, p_brand, p_type, p_size, p_retailprice AS price FROM part""")
def rename(t):
    return rename_map(
        t.part, {"p_partkey": "id", "p_name": "title", "p_retailprice": "price", "p_absent": "absent"}
    )


@query("conform_columns", """
    SELECT s_name, CAST(NULL AS VARCHAR) AS s_comment, s_suppkey, CAST(NULL AS DOUBLE) AS s_discount FROM supplier""")
def conform_columns(t):
    return conform(
        t.supplier, {"s_name": "string", "s_comment": "string", "s_suppkey": "bigint", "s_discount": "double"}
    )


LINE_SPEC = TableSpec.parse("""
Order Key; int; id
Ship Date; date; shipped
Unit Price; float; price
Returned; bool; returned
Return Flag; text; flag
""", SHOP_KINDS)


@query("apply_spec", """
    SELECT l_orderkey AS "Order Key", l_partkey AS part, l_suppkey AS supplier, l_linenumber AS line,
           strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%g') AS "Ship Date", l_extendedprice AS "Unit Price",
           CASE l_returnflag WHEN 'R' THEN true WHEN 'A' THEN false END AS "Returned",
           CASE WHEN l_returnflag = 'N' THEN NULL ELSE 'FLAG ' || l_returnflag END AS "Return Flag"
    FROM lineitem""")
def apply_line_spec(t):
    price = F.regexp_replace(F.col("l_extendedprice").cast("decimal(18,2)").cast("string"), r"\.", ",")
    flag = F.when(F.col("l_returnflag") == "N", F.lit(" NaN")).otherwise(
        F.concat(F.lit(" flag "), F.lower("l_returnflag"))
    )
    word = F.when(F.col("l_returnflag") == "R", F.lit("SIM")).when(F.col("l_returnflag") == "A", F.lit("não"))
    texts = t.lineitem.select(
        F.col("l_orderkey").cast("string").alias(" Order Key"), F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supplier"), F.col("l_linenumber").alias("line"),
        F.col("l_shipdate").cast("string").alias("Ship Date"), F.concat(F.lit("R$ "), price).alias("Unit Price"),
        F.coalesce(word, F.lit("?")).alias("Returned"), flag.alias("Return Flag"),
    )
    return apply_spec(texts, LINE_SPEC)


@query("with_lineage", """
    SELECT *, '2026-01-05' AS data_insercao, 'CRM' AS fonte FROM customer""")
def lineage(t):
    return with_lineage(t.customer, "CRM", "2026-01-05")


@query("project_paths", """
    SELECT c_custkey AS id, c_mktsegment AS segment, n_name AS country, c_acctbal AS balance
    FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def paths(t):
    geo = F.struct(F.col("n_name").alias("country"), F.struct(F.col("n_regionkey").alias("id")).alias("region"))
    account = F.struct(F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    packed = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.struct(account.alias("account"), geo.alias("geo")).alias("person")
    )
    return project_paths(packed, {
        "id": "c_custkey", "segment": "person.account.segment", "country": "person.geo.country",
        "balance": "person.account.balance",
    })


@query("stack_frames", """
    SELECT o_orderkey, o_custkey, CAST(NULL AS DOUBLE) AS o_totalprice, CAST(NULL AS VARCHAR) AS o_orderstatus
    FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'
    UNION ALL SELECT o_orderkey, CAST(NULL AS BIGINT), o_totalprice, NULL FROM orders
    WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'
    UNION ALL SELECT o_orderkey, o_custkey, NULL, o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'""")
def stack(t):
    day = F.col("o_orderdate")
    return stack_frames(
        t.orders.where(day < "1996-01-01").select("o_orderkey", "o_custkey"),
        t.orders.where((day >= "1996-01-01") & (day < "1998-01-01")).select("o_totalprice", "o_orderkey"),
        t.orders.where(day >= "1998-01-01").select("o_orderkey", "o_custkey", "o_orderstatus"),
    )


@query("filter_contains", """
    SELECT p_partkey, p_name FROM part WHERE contains(upper(p_name), 'BOLT')""")
def filter_contains(t):
    return filters.filter_contains(t.part, "p_name", "BOLT").select("p_partkey", "p_name")


@query("exclude_patterns", """
    SELECT p_partkey, nullif(p_type, 'LARGE') AS type FROM part
    WHERE p_type IN ('LARGE') OR (p_type <> 'PROMO' AND NOT regexp_matches(p_type, 'SMALL|MEDI'))""")
def exclude_patterns(t):
    made = t.part.select("p_partkey", F.nullif("p_type", F.lit("LARGE")).alias("type"))
    return filters.exclude_patterns(made, {"type": "SMALL|MEDI"}, {"type": "PROMO"})


@query("exclude_ilike", """
    SELECT p_partkey, nullif(p_name, 'red bolt') AS name FROM part
    WHERE nullif(p_name, 'red bolt') NOT ILIKE '%BLUE%' AND nullif(p_name, 'red bolt') NOT ILIKE '%gear'""")
def exclude_ilike(t):
    made = t.part.select("p_partkey", F.nullif("p_name", F.lit("red bolt")).alias("name"))
    return filters.exclude_ilike(made, "name", ["%BLUE%", "%gear"])


@query("exclude_values", """
    SELECT event_id, nullif(event_type, 'view') AS type FROM events
    WHERE nullif(event_type, 'view') NOT IN ('error', 'signup')""")
def exclude_values(t):
    made = t.events.select("event_id", F.nullif("event_type", F.lit("view")).alias("type"))
    return filters.exclude_values(made, "type", ["error", "signup"])


@query("keep_ids", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') AND l_returnflag IN ('A', 'R')""")
def keep_ids(t):
    closed = t.orders.where(F.col("o_orderstatus") == "F").select("o_orderkey")
    rows = filters.keep_ids(t.lineitem, "l_orderkey", closed)
    rows = filters.keep_ids(rows, "l_returnflag", ["A", "R"])
    return rows.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


BLANK_IN = """CASE WHEN doc_id % 4 = 0 THEN '' WHEN doc_id % 4 = 1 THEN CAST(NULL AS VARCHAR(9))
    WHEN doc_id % 4 = 2 AND lang = 'en' THEN '-1' ELSE source END"""


@query("drop_blank_keys", f"""
    WITH v AS (SELECT doc_id, {BLANK_IN} AS source FROM documents)
    SELECT * FROM v WHERE source IS NOT NULL AND source NOT IN ('', '-1')""")
def drop_blank_keys(t):
    return filters.drop_blank_keys(t.documents.select("doc_id", F.expr(BLANK_IN).alias("source")), "source")


@query("status_filter", """
    SELECT o_orderkey, 'PA' AS o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'P')""")
def status_filter(t):
    rows = t.orders.select("o_orderkey", F.lower("o_orderstatus").alias("o_orderstatus"), "o_totalprice")
    return filters.map_and_keep(rows, "o_orderstatus", {"F": "PA", "P": "PA"}, "CA", "PA")


@query("drop_erased", """
    SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE upper(c_name) || '@MAIL.COM' END AS email, upper(c_name) AS nome
    FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')""")
def drop_erased(t):
    email = F.when(F.col("c_mktsegment") == "BUILDING", F.lit(filters.ERASED_EMAIL)).when(
        F.col("c_custkey") % 3 != 0, F.concat(F.upper("c_name"), F.lit("@MAIL.COM"))
    )
    name = F.when(F.col("c_mktsegment") == "MACHINERY", F.lit(filters.ERASED_NAME)).otherwise(F.upper("c_name"))
    return filters.drop_erased(t.customer.select("c_custkey", email.alias("email"), name.alias("nome")))


@query("related_to", """
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_suppkey = 7""")
def related_to(t):
    return filters.related_to(t.lineitem, "l_suppkey", 7).select("l_orderkey", "l_linenumber", "l_partkey")
