from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.operators.nested import first_of, html_records, label_text, last_of, only_item, pivot_params
from feedloom.sources import PagesMissing, check_pages, missing_pages, unwrap_pages
from feedloom.sources import pages as pages_module
from tests.conftest import rows

RECORD = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])


def opened(spark, *bodies):
    frame = spark.createDataFrame([(b if isinstance(b, str) else json.dumps(b, ensure_ascii=False),) for b in bodies], "body string")
    return rows(unwrap_pages(frame, "body", RECORD))


def test_every_envelope(spark):
    a, b = {"id": 1, "name": "ção"}, {"id": 2, "name": None, "more": [1]}
    expected = [(1, "ção"), (2, None)]
    for body in (
        [a, b], {"tickets": [a, b]}, [{"tickets": [a, b]}], {"id": 9, "error": None, "result": {"rows": [a, b]}},
        {"result": json.dumps({"rows": [a, b]}, ensure_ascii=False), "error": ""}, {"orders": [a, b], "pagination": {"pages": 1}},
        {"users": [a, b]}, {"data": [a, b]}, {"events": [a, b]}, {"rows": [a, b]},
    ):
        assert opened(spark, body) == expected, body
    assert opened(spark, [], {"tickets": []}, {"result": {"rows": []}}, {"data": []}) == []


def test_reported_error_stops_the_job(spark):
    with pytest.raises(Exception, match="page reports error: denied"):
        opened(spark, {"error": "denied", "result": {"rows": []}})
    with pytest.raises(Exception, match="page reports error: .*code"):
        opened(spark, {"error": {"code": 7}, "tickets": [{"id": 1}]})
    assert opened(spark, {"error": False, "tickets": [{"id": 1}]}) == [(1, None)]


@pytest.mark.parametrize("body", ["", "not json", '{"message": "hello"}', '{"tickets": '])
def test_page_without_a_list_stops_the_job(spark, body):
    with pytest.raises(Exception, match="page holds no record list"):
        opened(spark, body)


def test_page_without_a_list_can_be_passed_over(spark):
    frame = spark.createDataFrame([("{}",), ('[{"id": 1}]',)], "body string")
    schema = T.StructType([T.StructField("id", T.IntegerType())])
    assert rows(unwrap_pages(frame, "body", schema, strict=False)) == [(1,)]


def test_empty_list_gives_way_to_the_next(spark):
    assert opened(spark, {"orders": [], "data": [{"id": 3}]}) == [(3, None)]


@pytest.mark.parametrize("chunk", [2, 10_000])
def test_missing_pages(spark, monkeypatch, chunk):
    monkeypatch.setattr(pages_module, "CHUNK", chunk)
    landed = spark.createDataFrame(
        [("a", 1, 7), ("a", 3, 7), ("a", 3, 7), ("b", 1, 2), ("b", 2, 2), ("c", 2, 0)], "feed string, page int, pages int")
    assert rows(missing_pages(landed, "feed", "page", "pages")) == [("a", p) for p in (2, 4, 5, 6, 7)]
    with pytest.raises(PagesMissing):
        check_pages(landed, "feed", "page", "pages")
    assert check_pages(landed, "feed", "page", "pages", on_missing="skip").count() == 6
    whole = landed.where("feed = 'b'")
    assert check_pages(whole, "feed", "page", "pages").count() == 2


def test_list_elements(spark):
    frame = spark.sql(
        "SELECT 1 AS id, array(named_struct('a', 1, 'b', named_struct('c', 'x')), named_struct('a', 2, 'b', named_struct('c', 'y'))) AS l "
        "UNION ALL SELECT 2, array() UNION ALL SELECT 3, null")
    assert rows(first_of(frame, "l", "l_")) == [(1, 1, "x"), (2, None, None), (3, None, None)]
    assert rows(last_of(frame, "l", "z_")) == [(1, 2, "y"), (2, None, None), (3, None, None)]
    assert first_of(frame, "absent", "x_") is frame
    with pytest.raises(TypeError):
        first_of(frame, "id", "x_")
    with pytest.raises(Exception, match="more than one item"):
        frame.select(only_item(F.col("l"), "a")).collect()
    assert rows(frame.select("id", only_item(F.col("l"), "a", "first"))) == [(1, 1), (2, None), (3, None)]


def test_repeated_wanted_key_is_an_error_and_others_are_not(spark):
    frame = spark.sql(
        "SELECT array(named_struct('key', 'k', 'value', named_struct('s', 'a')), named_struct('key', 'o', 'value', named_struct('s', 'b')), "
        "named_struct('key', 'o', 'value', named_struct('s', 'c'))) AS p")
    assert pivot_params(frame, "p", {"x": ("k", "s"), "y": ("absent", "s")}).select("x", "y").first() == ("a", None)
    with pytest.raises(Exception, match="[Dd]uplicat"):
        pivot_params(frame, "p", {"x": ("o", "s")}).collect()


def test_permit_page(spark):
    page = """<label id="lblSituacao">  Situação:
        CLCB   Vigente </label><script>//<![CDATA[
        inicializarMapa('Rua A', '10', 'Centro', 'Campinas', 'R1', '01/02/2024', 'x', 'y', 'z', 'Bar');criarMarcador('Rua B', 's/n', 'Sul', 'Santos');
        //]]></script>"""
    frame = spark.createDataFrame([(page,)], "html string")
    labelled = frame.select(
        label_text(F.col("html"), r'(?s)id="lblSituacao">(.*?)</label>', "Situação:").alias("situacao"), "html")
    records = html_records(
        labelled, F.regexp_extract("html", r"(?s)<script>(.*?)</script>", 1), ["situacao"],
        {"endereco": 0, "numero": 1, "bairro": 2, "cidade": 3, "registro": 4, "data": 5, "categoria": 9}, always=4,
        remove=["//<![CDATA[", "//]]>", "inicializarMapa", "criarMarcador"])
    assert rows(records.drop("record")) == [
        ("CLCB Vigente", "Rua A", "10", "Centro", "Campinas", "R1", "01/02/2024", "Bar"),
        ("CLCB Vigente", "Rua B", "s/n", "Sul", "Santos", "", "", "")]
