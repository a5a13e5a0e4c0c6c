from __future__ import annotations

import pytest

from feedloom.operators.headers import HeaderCollision, STYLES, canonical_headers, csv_header
from feedloom.operators.shape import conform, stack_frames
from feedloom.specs.ecommerce import CUSTOMERS, ORDERS


@pytest.mark.parametrize("raw, canonical", [
    (" Order ", "ORDER_ID"), ("Order Id", "ORDER_ID"), ("Quantity_SKU", "SKU_QUANTITY"), ("UtmiPage", "UTMI_PAGE"),
    ("Service (Price/ Selling Price)", "SERVICE_PRICE_SELLING_PRICE_"), ("Client Last Name", "CLIENT_LAST_NAME"),
    ("Status raw value (temporary)", "STATUS_RAW_VALUE_TEMP_"), ("Is Marketplace cetified", "IS_MARKETPLACE_CERTIFIED"),
    ("Preço-médio", "PREO_MDIO"),
])
def test_export_headers(raw, canonical):
    assert STYLES["csv"](raw) == canonical


def test_customer_headers_drop_brackets_instead_of_spacing_them():
    assert csv_header("a(b)", spaced="") == "AB"
    assert STYLES["csv_plain"]("visitedProductWithStockOutSkusTag") == "VISITED_PRODUCT_WITH_STOCK_OUT_SKUS_TAG"


@pytest.mark.parametrize("raw, style, canonical", [
    ("buyer.personHTTPId", "json", "BUYER_PERSON_HTTP_ID"), ("total_m12", "json", "TOTAL"), ("axis_x", "json", "AXIS"),
    ("axis_x", "json_user", "AXIS_X"), ("addresses_zipCode", "json_user", "ADDRESS_ZIP_CODE"),
    ("active_addresses_city", "json_user", "ACTIVE_ADDRESS_CITY"), ("Código Único ", "lower", "codigo unico"),
])
def test_record_headers(raw, style, canonical):
    assert STYLES[style](raw) == canonical


def test_colliding_headers_are_refused(spark):
    frame = spark.createDataFrame([(1, 2)], "`pos_x` int, pos int")
    with pytest.raises(HeaderCollision):
        canonical_headers(frame, "json")


def test_export_specs_reach_every_target():
    for spec, style, size in [(ORDERS, "csv", 94), (CUSTOMERS, "csv_plain", 53)]:
        names = {STYLES[style](f.source) for f in spec.fields}
        assert len(names) == len({f.target for f in spec.fields}) == len(spec.fields) == size


def test_conform_and_stack(spark):
    a, b = spark.createDataFrame([(1, "x")], "a int, b string"), spark.createDataFrame([(2.5, 2)], "c double, a int")
    assert conform(a, {"b": "string", "z": "double"}).collect() == [("x", None)]
    assert sorted(map(tuple, stack_frames(a, b).collect())) == [(1, "x", None), (2, None, 2.5)]
