"""Nested data.  Arrays are made from each row's own columns, so no group is collected."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.operators import nested
from feedloom.registry.base import query


@query("flatten_structs", """
    SELECT c_custkey AS id, c_name AS person_name, c_acctbal AS person_account_balance,
           c_mktsegment AS person_account_segment, n_name AS geo_country
    FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def flatten_structs(t):
    account = F.struct(F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    packed = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("id"),
        F.struct(F.col("c_name").alias("name"), account.alias("account")).alias("person"),
        F.struct(F.col("n_name").alias("country")).alias("geo"),
    )
    return nested.flatten_structs(packed, "_")


def _payments():
    def payment(method, value):
        card = F.struct(F.col("l_returnflag").alias("brand"))
        return F.struct(method.alias("method"), value.alias("value"), card.alias("card"))

    one = payment(F.col("l_linestatus"), F.col("l_extendedprice"))
    two = payment(F.lit("second"), F.col("l_quantity"))
    return (
        F.when(F.col("l_linenumber") == 1, F.array(one))
        .when(F.col("l_linenumber") == 2, F.array(one, two))
        .when(F.col("l_linenumber") == 3, F.filter(F.array(one), lambda x: F.lit(False)))
        .when(F.col("l_linenumber") >= 5, F.array(two, one, two))
    ).alias("payments")


LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query("array_first", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CASE WHEN l_linenumber IN (1, 2) THEN l_linestatus WHEN l_linenumber >= 5 THEN 'second' END AS payments_method,
           CASE WHEN l_linenumber IN (1, 2) THEN l_extendedprice WHEN l_linenumber >= 5 THEN l_quantity END AS payments_value,
           CASE WHEN l_linenumber IN (1, 2) OR l_linenumber >= 5 THEN l_returnflag END AS payments_card_brand
    FROM lineitem""")
def array_first(t):
    opened = nested.first_of(t.lineitem.select(*LINE, _payments()), "payments", "payments_")
    return opened.withColumnRenamed("payments_card.brand", "payments_card_brand")


@query("array_last", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CASE WHEN l_linenumber = 1 THEN l_linestatus WHEN l_linenumber = 2 OR l_linenumber >= 5 THEN 'second' END AS statuses_method,
           CASE WHEN l_linenumber = 1 THEN l_extendedprice WHEN l_linenumber = 2 OR l_linenumber >= 5 THEN l_quantity END AS statuses_value,
           CASE WHEN l_linenumber IN (1, 2) OR l_linenumber >= 5 THEN l_returnflag END AS statuses_card_brand
    FROM lineitem""")
def array_last(t):
    opened = nested.last_of(t.lineitem.select(*LINE, _payments()), "payments", "statuses_")
    return opened.withColumnRenamed("statuses_card.brand", "statuses_card_brand")


def key_value(key, text=None, number=None):
    """One entry of a key-value array."""
    value = F.struct(
        (F.lit(None) if text is None else text).cast("string").alias("string_value"),
        (F.lit(None) if number is None else number).cast("bigint").alias("int_value"),
    )
    return F.struct(F.lit(key).alias("key"), value.alias("value"))


@query("pivot_params", """
    SELECT conv_id, turn, role AS speaker, CASE WHEN role = 'user' THEN text END AS question,
           CAST(length(text) AS BIGINT) AS size
    FROM conversations""")
def pivot_params(t):
    entries = F.array(
        key_value("unused", text=F.lit("x")),
        key_value("role", text=F.col("role")),
        key_value("size", number=F.length("text")),
    )
    asked = F.concat(F.array(key_value("question", text=F.col("text"))), entries)
    params = F.when(F.col("role") == "user", asked).otherwise(entries)
    rows = t.conversations.select("conv_id", "turn", params.alias("params"))
    return nested.pivot_params(rows, "params", {
        "speaker": ("role", "string_value"), "question": ("question", "string_value"),
        "size": ("size", "int_value"),
    }).drop("params")


@query("only_item", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS item,
           CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END AS first_item
    FROM orders""")
def only_item(t):
    item = F.struct(F.col("o_orderpriority").alias("name"))
    single = F.when(F.col("o_orderstatus") == "F", F.array(item)).when(
        F.col("o_orderstatus") == "P", F.filter(F.array(item), lambda x: F.lit(False))
    )
    double = F.when(F.col("o_orderstatus") != "O", F.array(item, F.struct(F.lit("other").alias("name"))))
    rows = t.orders.select("o_orderkey", single.alias("single"), double.alias("double"))
    return rows.select(
        "o_orderkey", nested.only_item(F.col("single"), "name").alias("item"),
        nested.only_item(F.col("double"), "name", on_many="first").alias("first_item"),
    )


@query("html_records", r"""
    WITH p AS (SELECT page_id, trim(regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '\s+', ' ', 'g')) AS title,
            regexp_extract(html, '<nav><ul>(.*?)</ul></nav>', 1, 's') AS block FROM pages),
    r AS (SELECT page_id, title, unnest(string_split(replace(replace(block, '<li>', ''), '<a href="/', ''), '</a></li>')) AS record FROM p)
    SELECT page_id, CASE WHEN starts_with(title, 'De') THEN trim(substr(title, 3)) ELSE title END AS title,
           split_part(regexp_replace(record, '[''()]', '', 'g'), '">', 1) AS target,
           split_part(regexp_replace(record, '[''()]', '', 'g'), '">', 2) AS label
    FROM r WHERE trim(record) <> ''""")
def html_records(t):
    pages = t.pages.select(
        "page_id", nested.label_text(F.col("html"), "<title>([^<]*)</title>", "De").alias("title"), "html"
    )
    block = F.regexp_extract("html", "(?s)<nav><ul>(.*?)</ul></nav>", 1)
    records = nested.html_records(
        pages, block, ["page_id", "title"], {"target": 0, "label": 1}, always=1,
        remove=["<li>", '<a href="/'], record_separator="</a></li>", field_separator='">',
    )
    return records.drop("record")
