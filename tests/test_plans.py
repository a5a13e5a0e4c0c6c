from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from feedloom.operators.shape import stack_frames
from feedloom.plans import (
    clean_clients,
    clean_events,
    clean_tickets,
    crm_daily,
    crm_daily_fused,
    crm_parts,
    crm_shape,
    ecommerce_orders,
    entry_tickets,
    read_exports,
    shop_orders,
    ticket_counters,
)
from feedloom.specs.tickets import CLEANED
from tests.conftest import rows

EXPORT = """
    event_date string, event_name string, user_pseudo_id string, is_active_user boolean,
    event_params array<struct<key string, value struct<string_value string, int_value bigint>>>,
    geo struct<city string>, session_traffic_source_last_click struct<cross_channel_campaign struct<campaign_name string>>,
    ecommerce struct<purchase_revenue double>"""


def event(name, user, session, campaign="c", city="x", active=True, revenue=None):
    params = [("ga_session_id", (None, session))] if session is not None else []
    return ("20240105", name, user, active, params, (city,), ((campaign,),), (revenue,))


def test_daily_report_splits_groups_with_a_null_key(spark):
    events = spark.createDataFrame([
        event("page_view", "u", 1), event("page_view", "u", 2), event("add_to_cart", "v", 1, active=None), event("purchase", "u", 1, revenue=2.5),
        event("purchase", None, 1, revenue=1.0), event("page_view", "w", None, active=False),
        event("page_view", "u", 1, campaign=None), event("purchase", "u", 1, campaign=None, revenue=4.0)], EXPORT)
    flat = crm_shape(events)
    day = "2024-01-05"
    assert rows(crm_daily(flat)) == [
        (day, None, "x", 0, 0, 0, 0, 1, 4.0), (day, None, "x", 0, 0, 1, 0, 0, 0.0), (day, None, "x", 0, 1, 0, 0, 0, 0.0),
        (day, None, "x", 1, 0, 0, 0, 0, 0.0), (day, "c", "x", 3, 3, 1, 1, 1, 3.5)]
    assert rows(crm_daily_fused(flat)) == [("20240105", None, "x", 1, 1, 1, 0, 1, 4.0), ("20240105", "c", "x", 3, 3, 1, 1, 1, 3.5)]
    assert rows(crm_parts(flat)["sessions"], "campaign_name_cross", "sessions") == [(None, 1), ("c", 3)]
    assert crm_daily(flat.where("false")).collect() == []


def tickets(spark, *records):
    columns = sorted({name for r in records for name in r})
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in records], ", ".join(f"`{c}` string" for c in columns))


def cleaned(spark, box_office=False, **record):
    frame = tickets(spark, {"order_status": "Pago", "name": "Ana", "document": "12345678901", "ticket_name": "x", "setor": None,
                            "ticket_document": "1", "payment_method": "pix", "sale_from": "site", "sector": "a"} | record)
    found = clean_tickets(frame, box_office).collect()
    return found[0].asDict() if found else None


def test_ticket_columns_and_types(spark):
    frame = clean_tickets(tickets(spark, {"order_status": "PAGO"}))
    assert frame.columns == CLEANED
    assert dict(frame.dtypes)["data_pagamento"] == "timestamp" and dict(frame.dtypes)["client_id"] == "double"
    assert clean_tickets(tickets(spark, {"order_status": None})).collect() == []


def test_ticket_rules(spark):
    assert cleaned(spark, order_status="Cancelado") is None
    assert cleaned(spark, order_status=None) is None
    assert cleaned(spark)["status_ingresso"] == "PA"
    courtesy = cleaned(spark, sale_from="VENDA PROIBIDA FLAMENGO")
    assert (courtesy["cpf"], courtesy["nome"]) == ("-1", "CORTESIA")
    paid = cleaned(spark, payment_method=" carga ", ticket_document="12345678901")
    assert (paid["documento_portador"], paid["flag_cpf_portador"]) == ("-1", False)
    assert cleaned(spark, ticket_document=" 12345678901 ")["flag_cpf_portador"] is True
    assert cleaned(spark, document="1")["cpf"] == "-1"
    assert cleaned(spark, document="nan")["cpf"] == "-1"
    # A sector of spaces passes the blank test and is emptied afterwards.
    assert [cleaned(spark, sector=s)["setor"] for s in ("  ", "123", None, " Leste  é ")] == ["", "NAO_INFORMADO", "NAO_INFORMADO", "LESTE E"]
    assert cleaned(spark, name=None, ticket_name=None)["nome"] == ""
    assert cleaned(spark, name=" ", ticket_name="joão 2")["nome"] == "JOÃO "
    assert cleaned(spark, ticket_name="Documento: ana")["ticket_name"] == "ANA"
    assert cleaned(spark, discount="50%")["desconto"] == "NÃO INFORMADO"
    assert cleaned(spark, event="1", event_id_original="2")["cod_evento"] == "2"
    assert cleaned(spark, payment_date="5/1/2024 9:05")["data_pagamento"] == datetime(2024, 1, 5, 9, 5)
    assert cleaned(spark, used="TRUE", used_time="05/01/2024 21:00")["used_time"] == "2024-01-05 21:00:00"


def test_box_office_rule_is_off_unless_asked_for(spark):
    sale = {"sale_from": "PDV FLAMENGO", "document": "", "name": "Ana"}
    assert cleaned(spark, **sale)["nome"] == "ANA"
    assert cleaned(spark, box_office=True, **sale)["nome"] == "PDV"
    assert cleaned(spark, box_office=True, **(sale | {"document": "5"}))["nome"] == "ANA"


def test_ticket_counters(spark):
    frame = tickets(spark, {"order_status": "Pago", "payment_method": "Carga"}, {"order_status": "x"}, {"order_status": None})
    assert ticket_counters(frame).first().asDict() == {"rows_in": 3, "removed_status": 2, "rows_out": 1, "flagged_courtesy": 1}


def test_erased_person_does_not_come_back(spark):
    def client(seq, document, email, first="Ana"):
        return (seq, document, first, None, email, None, None, None, None, "01000-000")

    schema = ("seq int, document string, first_name string, last_name string, email string, address string, city string, "
              "state string, district string, cep string")
    frame = spark.createDataFrame([
        client(1, "111", "old@x"), client(2, "111", "excluido@excluido.com"), client(3, "22-2", "a@x"), client(4, "222", "b@x", "Bia 2"),
        client(5, "222", "c@x"), client(6, None, "d@x"), client(7, "abc", "e@x"), client(8, "333", None)], schema)
    found = rows(clean_clients(frame, ["seq"], "2024-01-05"), "cpf", "email", "nome", "endereco", "cep", "data_insercao")
    assert found == [
        ("222", "C@X", "ANA", "NAOINFORMADO", "01000000", "2024-01-05"), ("333", "", "ANA", "NAOINFORMADO", "01000000", "2024-01-05")]


def test_catalogue(spark):
    def match(i, title, day="01/02/2024", stadium="Maracanã", cup="Brasileirão"):
        return (i, title, day, "16:00", stadium, cup, "01/01/2024", "9:00", None, "10:00", "x")

    schema = ("event_id string, match string, event_date string, event_time string, stadium string, championship string, sales_start_date string, "
              "sales_start_time string, public_sale_start_date string, public_sale_start_time string, sales_end string")
    frame = spark.createDataFrame([
        match("10", "Estacionamento"), match("9", "A x B"), match("11", "C x D"), match("8", "Espaço"), match("7", "E x F", stadium="Outro"),
        match("6", "E x F", cup="nbb"), match("5", "E x F", cup="Treino aberto"), match("4", None, day=None), match("10", "again")], schema)
    found = rows(clean_events(frame, order=["match"]), "COD_EVENTO", "TIPO_EVENTO", "COD_EVENTO_BASE", "PARTIDA_BASE", "PARTIDA")
    assert found == [
        ("10", "ESTACIONAMENTO", "9", "A X B", "ESTACIONAMENTO"), ("11", "JOGO", "9", "A X B", "C X D"),
        ("4", "JOGO", "None", "NONE", "NONE"), ("8", "FLA_PLUS", "9", "A X B", "ESPACO"), ("9", "JOGO", "9", "A X B", "A X B")]


def test_entries_keep_the_first_of_each_key(spark):
    frame = spark.createDataFrame(
        [(1, "a", "p", "c1", "", "pa", "1.5", "S"), (2, "a", "p", "c2", "t", "pa", "x", "N"), (3, None, "p", "c1", " t ", "ca", "2", "sim"),
         (4, None, "p", "c1", "t", "ca", "2", "1"), (5, None, None, "c1", "t", "ca", "2", None)],
        "n int, idacesso string, idapresentacao string, codigo string, titulo string, status string, valor string, acesso_entrou string")
    found = rows(entry_tickets(frame, ["n"], drop=["n"]))
    assert found == [
        (None, None, "C1", "T", "CA", 2.0, None), (None, "P", "C1", "T", "CA", 2.0, None), ("A", "P", "C1", None, "PA", 1.5, True)]


def test_shop_orders_are_typed_even_when_empty(spark):
    schema = """id int, buyer struct<fullName string>, payments array<struct<value double>>, statuses array<struct<name string>>,
        shippings array<struct<price double, products array<struct<sku string, custom array<struct<a string>>, tags array<string>>>>>,
        benefit struct<promotions array<struct<code string>>>, notes array<string>"""
    order = (1, ("Ana",), [(1.0,), (2.0,)], [("a",), ("b",)], [(3.0, [("s", [("c",)], ["t", "ç"])])], (None,), [])
    frame = spark.createDataFrame([order, (2, None, None, [], None, None, None)], schema)
    flat = shop_orders(frame)
    assert flat.columns == [
        "ID", "BUYER_FULL_NAME", "NOTES", "PAYMENTS_VALUE", "STATUSES_NAME", "SHIPPINGS_PRICE", "SHIPPINGS_PRODUCTS_SKU",
        "SHIPPINGS_PRODUCTS_TAGS", "SHIPPINGS_PRODUCTS_CUSTOM_A", "BENEFIT_PROMOTIONS_CODE"]
    assert rows(flat) == [
        (1, "Ana", "[]", 1.0, "b", 3.0, "s", '["t","ç"]', "c", None), (2, None, None, None, None, None, None, None, None, None)]
    empty = shop_orders(frame.where("false"))
    assert empty.columns == flat.columns and empty.collect() == []


def test_export_files_with_different_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Order;Quantity_SKU;SKU Value;Delivered;Obs\n1;1.000,0;"R$ 1.234,5";Sim;n/a\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text("Order ;Creation Date;Obs\n2;2024-01-05T10:00:00.5-03:00; olá \n", encoding="utf-8")
    found = ecommerce_orders(read_exports(spark, [str(tmp_path / "a.csv")])), ecommerce_orders(read_exports(spark, [str(tmp_path / "b.csv")]))
    assert rows(stack_frames(*found), "ID_PEDIDO", "QTD_SKU", "VL_SKU", "FLAG_ENTREGUE", "OBSERVACAO", "DT_CRIACAO_PEDIDO") == [
        ("1", 1000, 1234.5, True, None, None), ("2", None, None, None, "OLÁ", "2024-01-05 13:00:00.500")]
