"""Column expressions.

Where a column lacks the case an expression is about, the query makes it from the row
(an ``…_IN`` text used by both sides), so all rows take part.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom import functions as fn
from feedloom.functions.flags import ENTRY_WORDS, TICKET_WORDS
from feedloom.operators.shape import overwrite_where, truncate_all
from feedloom.registry.base import query, stamp

SOURCE_IN = """CASE CAST(doc_id % 6 AS INT) WHEN 0 THEN '  ' || source || ' ' WHEN 1 THEN 'NA'
    WHEN 2 THEN '' WHEN 3 THEN ' None ' WHEN 4 THEN CAST(NULL AS VARCHAR(9)) ELSE source || ' sã' END"""


@query("clean_text", f"""
    WITH v AS (SELECT doc_id, trim({SOURCE_IN}) AS s, text FROM documents)
    SELECT doc_id, CASE WHEN s IN ('', 'NA', 'NaN', 'None') THEN NULL ELSE upper(s) END AS cleaned,
           trim(text, chr(9) || chr(10) || chr(13) || ' ') AS body
    FROM v""")
def clean_text(t):
    made = t.documents.select("doc_id", F.expr(SOURCE_IN).alias("s"), "text")
    return made.select(
        "doc_id", fn.clean_text("s").alias("cleaned"), fn.clean_text("text", upper=False).alias("body")
    )


PRICE_IN = "replace(CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS VARCHAR(30)), '.', ',')"


@query("parse_number_ptbr", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
           CASE WHEN l_linenumber <= 4 THEN l_extendedprice
                WHEN l_linenumber = 5 THEN -l_extendedprice ELSE NULL END AS price
    FROM lineitem""")
def parse_number_ptbr(t):
    price = F.expr(PRICE_IN)
    marked = F.regexp_replace(price, "([0-9])([0-9]{3}),", "$1.$2,")
    text = (
        F.when(F.col("l_linenumber") == 1, F.concat(F.lit("R$ "), marked))
        .when(F.col("l_linenumber") == 2, F.concat(price, F.lit(" ")))
        .when(F.col("l_linenumber") == 3, F.replace(price, F.lit(","), F.lit(".")))
        .when(F.col("l_linenumber") == 4, F.concat(marked, F.lit(" BRL")))
        .when(F.col("l_linenumber") == 5, F.concat(F.lit("-"), marked))
        .when(F.col("l_linenumber") == 6, F.lit("n/d"))
        .otherwise(F.lit("1-2"))
    )
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", fn.to_float(text).alias("price")
    )


@query("parse_int", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
           CASE WHEN l_linenumber <= 2 THEN CAST(l_quantity AS BIGINT)
                WHEN l_linenumber = 3 THEN CAST(l_quantity AS BIGINT) + 1000
                WHEN l_linenumber = 4 THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS brazilian,
           CASE WHEN l_linenumber IN (3, 4) THEN NULL
                WHEN l_linenumber = 2 THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS plain
    FROM lineitem""")
def parse_int(t):
    whole = F.col("l_quantity").cast("bigint").cast("string")
    text = (
        F.when(F.col("l_linenumber") == 1, F.col("l_quantity").cast("string"))
        .when(F.col("l_linenumber") == 2, F.concat(whole, F.lit(",75")))
        .when(F.col("l_linenumber") == 3, F.concat(F.lit("1.0"), F.lpad(whole, 2, "0"), F.lit(",0")))
        .when(F.col("l_linenumber") == 4, F.lit("sem"))
        .otherwise(whole)
    )
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        fn.to_int(text).alias("brazilian"), fn.to_int(text, ptbr=False).alias("plain"),
    )


WORD_IN = """CASE CAST(doc_id % 5 AS INT) WHEN 0 THEN CASE WHEN quality = 1 THEN ' Sim' ELSE 'NÃO ' END
    WHEN 1 THEN CASE WHEN quality = 1 THEN 'True' ELSE 'false' END
    WHEN 2 THEN CASE WHEN quality = 1 THEN '1' ELSE '0' END
    WHEN 3 THEN CASE WHEN quality = 1 THEN 'S' ELSE 'n' END ELSE 'talvez' END"""


@query("parse_bool", """
    SELECT doc_id, CASE WHEN doc_id % 5 = 4 THEN NULL ELSE quality = 1 END AS shop,
           CASE WHEN doc_id % 5 IN (0, 4) THEN NULL ELSE quality = 1 END AS entry,
           doc_id % 5 = 1 AND quality = 1 AS ticket
    FROM labels""")
def parse_bool(t):
    made = t.labels.select("doc_id", F.expr(WORD_IN).alias("word"))
    return made.select(
        "doc_id", fn.to_bool("word").alias("shop"), fn.to_bool("word", ENTRY_WORDS).alias("entry"),
        fn.to_bool("word", TICKET_WORDS, default=False).alias("ticket"),
    )


@query("utc_ms_text", """
    SELECT event_id, CASE WHEN event_id % 4 = 3 THEN NULL ELSE
        strftime(CASE WHEN event_id % 4 = 1 THEN ts - INTERVAL 3 HOUR ELSE ts END, '%Y-%m-%d %H:%M:%S.%g') END AS utc
    FROM events""")
def utc_ms_text(t):
    text = F.col("ts").cast("string")
    kind = F.col("event_id") % 4
    made = (
        F.when(kind == 0, F.concat(F.lit(" "), text))
        .when(kind == 1, F.concat(text, F.lit("+03:00")))
        .when(kind == 2, F.concat(F.replace(text, F.lit(" "), F.lit("T")), F.lit("Z")))
        .otherwise(F.lit("ontem"))
    )
    return t.events.select("event_id", fn.to_utc_ms(made).alias("utc"))


@query("normalize_text", """
    SELECT doc_id, coalesce(strip_accents(upper(replace(trim(
        CASE WHEN doc_id % 9 = 0 THEN NULL ELSE text END,
        chr(9) || chr(10) || chr(13) || ' '), 'ß', 'ss'))), '') AS normal
    FROM documents""")
def normalize_text(t):
    text = F.when(F.col("doc_id") % 9 != 0, F.col("text"))
    return t.documents.select("doc_id", fn.normalize_text(text).alias("normal"))


@query("parse_datetime", """
    SELECT o_orderkey,
           CASE WHEN o_orderkey % 4 = 3 THEN NULL
                ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS minute,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS day,
           strftime(o_orderdate, '%Y-%m-%d') AS shard
    FROM orders""")
def parse_datetime(t):
    date = F.col("o_orderdate")
    kind = F.col("o_orderkey") % 4
    minute = (
        F.when(kind == 0, F.date_format(date, "dd/MM/yyyy HH:mm"))
        .when(kind == 1, F.date_format(date, "d/M/yyyy H:mm"))
        .when(kind == 2, F.date_format(date, "d/MM/yyyy H:m"))
        .otherwise(F.date_format(date, "'32'/MM/yyyy HH:mm"))
    )
    return t.orders.select(
        "o_orderkey",
        stamp(fn.parse_dt(minute)).alias("minute"),
        stamp(fn.parse_dt(F.date_format(date, "dd/MM/yyyy"), "d/M/yyyy")).alias("day"),
        F.date_format(fn.parse_dt(F.date_format(date, "yyyyMMdd"), "yyyyMMdd"), "yyyy-MM-dd").alias("shard"),
    )


@query("combine_datetime", """
    SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL
        ELSE strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') END AS moment
    FROM events""")
def combine_datetime(t):
    time = F.when(F.col("event_id") % 7 != 0, F.date_format("ts", "HH:mm"))
    return t.events.select(
        "event_id", stamp(fn.combine_dt(F.date_format("ts", "dd/MM/yyyy"), time)).alias("moment")
    )


DOCUMENT_IN = """CASE CAST(c_custkey % 6 AS INT) WHEN 0 THEN c_name WHEN 1 THEN '123.456.789-01' || c_name
    WHEN 2 THEN '' WHEN 3 THEN CAST(NULL AS VARCHAR(9)) WHEN 4 THEN '-1' ELSE 'sem número' END"""


@query("clean_document", f"""
    WITH v AS (SELECT c_custkey, regexp_replace({DOCUMENT_IN}, '[^0-9]', '', 'g') AS d FROM customer)
    SELECT c_custkey, CASE WHEN d IS NULL OR d IN ('', '1') THEN '-1' ELSE substr(d, 1, 11) END AS document
    FROM v""")
def clean_document(t):
    made = t.customer.select("c_custkey", F.expr(DOCUMENT_IN).alias("d"))
    return made.select("c_custkey", fn.clean_document("d").alias("document"))


@query("letters_only", r"""
    SELECT doc_id, regexp_replace(text, '[^A-Za-zÀ-ÖØ-öø-ÿ\s]', '', 'g') AS letters FROM documents""")
def letters_only(t):
    return t.documents.select("doc_id", fn.letters_only("text").alias("letters"))


@query("squash_spaces", r"""
    SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS line FROM documents""")
def squash_spaces(t):
    return t.documents.select("doc_id", fn.squash("text").alias("line"))


@query("comma_to_dot", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
           CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS VARCHAR) AS amount
    FROM lineitem""")
def comma_to_dot(t):
    made = t.lineitem.withColumn("text", F.expr(PRICE_IN))
    return made.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", fn.comma_to_dot("text").alias("amount")
    )


@query("truncate_all", """
    SELECT doc_id, substr(text, 1, 250) AS text, substr(lang, 1, 250) AS lang,
           substr(source, 1, 250) AS source, n_chars
    FROM documents""")
def truncate_documents(t):
    return truncate_all(t.documents, 250)


@query("default_text", f"""
    SELECT doc_id, CASE WHEN {SOURCE_IN} IS NULL OR {SOURCE_IN} = '' THEN 'NAO_INFORMADO'
                        ELSE {SOURCE_IN} END AS blank_too,
           coalesce({SOURCE_IN}, 'NÃO INFORMADO') AS null_only
    FROM documents""")
def default_text(t):
    made = t.documents.select("doc_id", F.expr(SOURCE_IN).alias("s"))
    return made.select(
        "doc_id", fn.default_text("s", "NAO_INFORMADO").alias("blank_too"),
        fn.default_text("s", "NÃO INFORMADO", blank=False).alias("null_only"),
    )


DIGITS_IN = """CASE WHEN o_orderkey % 10 = 0 THEN CAST(NULL AS VARCHAR(9)) WHEN o_orderkey % 10 = 1 THEN '1234567890x'
    ELSE lpad(CAST(o_orderkey AS VARCHAR(20)), CAST(9 + o_orderkey % 4 AS INT), '0') END"""


@query("is_document_flag", """
    SELECT o_orderkey, o_orderkey % 10 > 1 AND o_orderkey % 4 = 2 AS flag FROM orders""")
def is_document_flag(t):
    return t.orders.select("o_orderkey", fn.is_document(F.expr(DIGITS_IN)).alias("flag"))


@query("overwrite_where", """
    SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN '-1' ELSE CAST(o_custkey AS VARCHAR) END AS document,
           CASE WHEN o_orderpriority = '1-URGENT' THEN 'CORTESIA' ELSE o_orderstatus END AS name
    FROM orders""")
def overwrite_where_query(t):
    made = t.orders.select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("document"),
        F.col("o_orderstatus").alias("name"), "o_orderpriority",
    )
    condition = F.col("o_orderpriority") == "1-URGENT"
    return overwrite_where(made, condition, {"document": "-1", "name": "CORTESIA"}).drop("o_orderpriority")


@query("first_filled", """
    SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_brand
        WHEN p_partkey % 3 = 1 AND p_partkey % 2 = 0 THEN p_brand ELSE p_name END AS label
    FROM part""")
def first_filled(t):
    blank = F.when(F.col("p_partkey") % 2 == 0, F.lit("  ")).otherwise(F.col("p_name"))
    name = F.when(F.col("p_partkey") % 3 == 1, blank).when(F.col("p_partkey") % 3 == 2, F.col("p_name"))
    return t.part.select("p_partkey", fn.first_filled(name, "p_brand").alias("label"))


@query("full_name", """
    SELECT p_partkey, upper(trim(CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_brand END || ' ' ||
        CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_type END)) AS label
    FROM part""")
def full_name(t):
    first = F.when(F.col("p_partkey") % 4 != 0, F.col("p_brand"))
    last = F.when(F.col("p_partkey") % 5 != 0, F.col("p_type"))
    return t.part.select("p_partkey", fn.full_name(first, last).alias("label"))


@query("classify_text", """
    SELECT p_partkey, CASE WHEN p_name LIKE '%bolt%' THEN 'FASTENER'
        WHEN p_name LIKE '%ring%' OR p_name LIKE '%rod%' THEN 'SHAFT' ELSE 'OTHER' END AS class
    FROM part""")
def classify_text(t):
    rules = [("FASTENER", ["BOLT"]), ("SHAFT", ["RING", "ROD"])]
    return t.part.select("p_partkey", fn.classify("p_name", rules, "OTHER").alias("class"))


MEDIUM_IN = """CASE event_type WHEN 'view' THEN '(none)' WHEN 'click' THEN ' cpc_' || CAST(user_id AS VARCHAR(20))
    WHEN 'purchase' THEN 'Organic' WHEN 'signup' THEN 'botao_rodape'
    ELSE CASE WHEN user_id % 2 = 0 THEN CAST(NULL AS VARCHAR(9)) ELSE 'Parceiro (x)' END END"""


@query("map_channel", """
    SELECT event_id, CASE event_type WHEN 'view' THEN 'SEM REFERENCIA' WHEN 'click' THEN 'MIDIA PAGA'
        WHEN 'purchase' THEN 'ORGÂNICO' WHEN 'signup' THEN 'SPFCTICKET'
        ELSE CASE WHEN user_id % 2 = 0 THEN NULL ELSE 'Parceiro (x)' END END AS channel
    FROM events""")
def map_channel(t):
    return t.events.select("event_id", fn.map_channel(F.expr(MEDIUM_IN)).alias("channel"))


@query("case_priority", """
    WITH v AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
    SELECT event_id, CASE WHEN k < 20 THEN 'BOLETO' WHEN k % 2 = 0 THEN 'PIX'
        WHEN k % 3 = 0 THEN 'CARTÃO DE CRÉDITO' ELSE 'unknown' END AS payment
    FROM v""")
def case_priority(t):
    made = t.events.select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))
    return made.select("event_id", fn.payment_type(
        F.when(F.col("k") < 20, F.lit("BOLETO")),
        F.when(F.col("k") % 2 == 0, F.lit("true")),
        (F.col("k") % 3 == 0).cast("string"),
    ).alias("payment"))


@query("label_year", """
    SELECT o_orderkey, o_orderpriority || ' ' || CAST(year(o_orderdate) AS VARCHAR) AS label FROM orders""")
def label_year(t):
    return t.orders.select("o_orderkey", fn.label_year("o_orderpriority", "o_orderdate").alias("label"))


TOKEN_IN = """CASE CAST(doc_id % 6 AS INT) WHEN 0 THEN 'null' WHEN 1 THEN '' WHEN 2 THEN 'NONE' WHEN 3 THEN source
    WHEN 4 THEN CAST(n_chars AS VARCHAR(20)) || '.50' ELSE 'NAN' END"""


@query("null_tokens", """
    SELECT doc_id, CASE CAST(doc_id % 6 AS INT) WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN 'NONE' WHEN 3 THEN source
               WHEN 4 THEN CAST(n_chars AS VARCHAR) || '.50' ELSE 'NAN' END AS token,
           CASE WHEN doc_id % 6 = 4 THEN n_chars + CAST(0.5 AS DOUBLE) ELSE NULL END AS number
    FROM documents""")
def null_tokens(t):
    made = t.documents.select("doc_id", F.expr(TOKEN_IN).alias("s"))
    return made.select(
        "doc_id", fn.null_tokens("s", ["", "null"]).alias("token"), fn.to_number_or_null("s").alias("number")
    )


@query("json_text", """
    SELECT doc_id, CAST(to_json({'lang': lang, 'origin': {'source': source, 'size': n_chars, 'text': text}}) AS VARCHAR) AS json
    FROM documents""")
def json_text(t):
    origin = F.struct("source", F.col("n_chars").alias("size"), "text")
    return t.documents.select("doc_id", fn.json_text(F.struct("lang", origin.alias("origin"))).alias("json"))


@query("strip_prefix", """
    SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN substr(s_name, 10) ELSE 'x' || s_name END AS name
    FROM supplier""")
def strip_prefix(t):
    name = F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")).otherwise(F.concat(F.lit("x"), "s_name"))
    return t.supplier.select("s_suppkey", fn.strip_prefix(name, "Supplier#").alias("name"))


@query("name_parts", """
    SELECT p_partkey, split_part(p_name, ' ', 1) AS first_word, split_part(p_name, ' ', 2) AS last_word,
           CAST(length(replace(p_name, ' ', '')) AS BIGINT) AS letters,
           CAST(length(split_part(p_name, ' ', 1)) AS BIGINT) AS first_letters
    FROM part""")
def name_parts(t):
    parts = fn.name_parts(F.concat(F.lit(" "), F.replace("p_name", F.lit(" "), F.lit("  "))))
    parts |= {name: parts[name].cast("bigint") for name in ["letters", "first_letters"]}
    return t.part.select("p_partkey", *[c.alias(name) for name, c in parts.items()])
