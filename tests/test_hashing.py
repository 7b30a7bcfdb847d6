from __future__ import annotations

import hashlib

import pytest

from tallyvault.functions.hashing import canonical_text, hub_key, md5_of
from tallyvault.functions.parsers import MONEY
from tallyvault.model import CUSTOMERS, EVENTS, LINKS, ORDERS, PAYMENTS, PRODUCTS
from tallyvault.operators.cleaning import with_row_hash
from tallyvault.operators.links import checked_ids, linked_ids, new_link_rows
from tallyvault.operators.satellites import new_sat_rows

from .support import DAY_1, accepted, raw

# Known hashes of whole rows.
NAME = "Милица Степановна Федорова"
ROWS = {
    CUSTOMERS: ("463", NAME, "elizarabramov@yandex.ru", "UNKNOWN", "ст. Вязьма", "2023-08-27"),
    PRODUCTS: ("536", "Коллектив", "Clothing", "360.25", "USD", "False"),
    PAYMENTS: ("667", "858", None, "861.19", "USD", "2024-10-06 18:49:34"),
    ORDERS: ("1101", "151", "235", "1", "109.91", "EUR", "2024-10-12 23:22:19", "processing"),
    EVENTS: ("1423", "298", "logout", "2025-08-19 14:21:50", "229"),
}
ROW_HASHES = {
    CUSTOMERS: "0047f7494a3e820e715edef3ea0c8579",
    PRODUCTS: "00bb92fbbc92764986b10e0ab0f57dc3",
    PAYMENTS: "0052c3f5dea44714569e13078d359c23",
    ORDERS: "0040fa78c5314d30e6e3117631c5e93e",
    EVENTS: "007badac1ddddc2a9cf3045e8e1fa37b",
}
HASH_DIFFS = {
    CUSTOMERS: "e8980c17aecff0292c2b72632fcaf5ef",
    PRODUCTS: "fb3dab8848a9368b102a250c04d74b20",
    PAYMENTS: "9e26cf42bac7dce3c3feeafb9317bcf2",
    ORDERS: "1b81d460bfcc3c3928319c65c85804c1",
    EVENTS: "cdf982726ce7c1c309c59ae8e6e41dc1",
}
LINK_KEYS = {
    "link_payment_order": "64c7eaa57ea7336066a3edf7ff57057c",
    "link_event_customer_product": "c55a71e3fba327cc28351134784fe4af",
    "link_order_customer_product": "fb72ffabbf18cf84f6b17877d3dac4c8",
}
ENTITIES = {e.name: e for e in ROWS}


def value(spark, expression):
    return spark.range(1).selectExpr(f"{expression} AS x").first()["x"]


@pytest.mark.parametrize("name", ENTITIES)
def test_row_hash(spark, name):
    entity = ENTITIES[name]
    hashed = with_row_hash(raw(spark, entity, [ROWS[entity]]), entity)
    assert hashed.first()["row_hash"] == ROW_HASHES[entity]


@pytest.mark.parametrize("name", ENTITIES)
def test_hash_diff(spark, name):
    entity = ENTITIES[name]
    rows = accepted(spark, entity, [ROWS[entity]])
    assert new_sat_rows(rows, entity, DAY_1).first()["hash_diff"] == HASH_DIFFS[entity]


def test_json_null_text_in_a_row_hash(spark):
    row = ("511", "None", "577", "5", "336.83", "EUR", "2026-03-08 08:04:01", "completed")
    hashed = with_row_hash(raw(spark, ORDERS, [row]), ORDERS)
    assert hashed.first()["row_hash"] == "00ea0cc20a00be268c57b52de83d7455"
    sat = new_sat_rows(accepted(spark, ORDERS, [row]), ORDERS, DAY_1)
    assert sat.first()["hash_diff"] == "e2b85ab44cf7599b913baab7dc8db856"


def test_hub_key(spark):
    assert value(spark, hub_key("255")) == "fe131d7f5a6b38b23cc967316c13dae2"


@pytest.mark.parametrize("name", LINK_KEYS)
def test_link_key(spark, name):
    link = LINKS[name]
    checked = checked_ids(linked_ids(accepted(spark, link.entity, [ROWS[link.entity]]), link), link, {})
    assert new_link_rows(checked, link, DAY_1).first()["link_hk"] == LINK_KEYS[name]


def test_null_and_empty_hash_alike_and_keep_their_separator(spark):
    expected = hashlib.md5(b"a||||b").hexdigest()
    assert value(spark, md5_of(["'a'", "NULL", "'b'"])) == expected
    assert value(spark, md5_of(["'a'", "''", "'b'"])) == expected


@pytest.mark.parametrize(
    "number, text",
    [("59.9", "59.9"), ("59.90", "59.9"), ("100", "100"), ("0", "0"), ("-1.2300", "-1.23"), ("0.00000001", "0.00000001")],
)
def test_money_text_has_no_trailing_zeros(spark, number, text):
    rows = spark.range(1).selectExpr(f"cast('{number}' AS decimal(38,18)) AS price")
    found = rows.selectExpr(f"{canonical_text('price', MONEY)} AS x")
    assert found.first()["x"] == text
