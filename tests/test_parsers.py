from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyvault.functions.parsers import money, phone_code
from tallyvault.model import CUSTOMERS, ENTITIES, EVENTS, ORDERS, PAYMENTS, PRODUCTS


def run(spark, parser, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, raw string")
    valued = rows.selectExpr("i", "raw", f"{parser.value('trim(raw)')} AS v", f"{wide_text(parser)} AS w")
    tagged = valued.selectExpr("i", "v", "w", f"{parser.tag('trim(raw)', HELD)} AS tag")
    return [(r["v"] if r["w"] is None else r["w"], r["tag"]) for r in tagged.orderBy("i").collect()]


HELD = "coalesce(cast(v AS string), w)"


def wide_text(parser):
    return parser.wide("trim(raw)", money("trim(raw)")) if parser.wide else "cast(NULL AS string)"


CASES = {
    (CUSTOMERS, "full_name"): [
        (None, None, "invalid null"),
        ("   ", None, "invalid empty"),
        ("  ivan IVANOV ", None, "invalid placeholder"),
        ("ivan   ivanov", None, "invalid placeholder"),
        ("тов. Иван Иванов", "Иван Иванов", "valid with prefix"),
        ("mr. John Smith", "John Smith", "valid with prefix"),
        ("John Smith", "John Smith", "valid"),
        ("John  Smith", "John  Smith", "valid"),
        ("Anna Maria Lee", "Anna Maria Lee", "valid"),
        ("Anna Maria Lee Fox", None, "invalid"),
        ("J. R. Tolkien", "J. R. Tolkien", "valid"),
        ("Jean-Pierre Melville", "Jean-Pierre Melville", "valid"),
        ("\tIvan Petrov", "Ivan Petrov", "valid"),
        ("John", None, "invalid"),
        ("john smith", None, "invalid"),
        ("John Smith2", None, "invalid"),
        ("UNKNOWN", None, "invalid"),
    ],
    (CUSTOMERS, "email"): [
        (None, None, "invalid null"),
        ("", None, "invalid empty"),
        ("UNKNOWN", None, "invalid unknown"),
        (" a.b@x.io ", "a.b@x.io", "valid"),
        ("A_B%+-@Sub.Example.ORG", "A_B%+-@Sub.Example.ORG", "valid"),
        ("a@b", None, "invalid"),
        ("a@b.c", None, "invalid"),
        ("a b@x.io", None, "invalid"),
        ("a@x.io\n", None, "invalid"),
    ],
    (CUSTOMERS, "phone"): [
        (None, None, "invalid null"),
        ("", None, "invalid empty"),
        ("UNKNOWN", None, "invalid unknown"),
        ("+7 (900) 123-45-67", "9001234567", "valid"),
        ("9001234567", "9001234567", "valid"),
        ("123-45", None, "invalid short"),
        ("8x9001234567", None, "invalid symb"),
        ("-+()", None, "invalid short"),
    ],
    (CUSTOMERS, "city"): [
        (None, None, "invalid null"),
        (" ", None, "invalid empty"),
        ("UNKNOWN", None, "invalid unknown"),
        (" Oslo ", "Oslo", "valid"),
    ],
    (CUSTOMERS, "created_at"): [
        (None, None, "invalid null"),
        ("", None, "invalid empty"),
        ("UNKNOWN", None, "invalid unknown"),
        ("2023-08-27", date(2023, 8, 27), "yyyy-mm-dd"),
        ("27.08.2023", date(2023, 8, 27), "dd.mm.yyyy"),
        ("31.02.2024", None, "invalid"),
        ("2025-99-99", None, "invalid"),
        ("2024-1-2", None, "invalid"),
        ("0000-01-01", None, "invalid"),
        ("2024-01-02 10:00:00", None, "invalid"),
    ],
    (PRODUCTS, "product_name"): [
        (None, None, "null"),
        ("  ", None, "empty"),
        ("  red lamp ", "red lamp", "valid"),
    ],
    (PRODUCTS, "category"): [
        (None, None, "null"),
        ("", None, "empty"),
        ("Home", "Home", "valid"),
        ("home", None, "invalid"),
        ("Toys", None, "invalid"),
    ],
    (PRODUCTS, "price"): [
        (None, None, "null"),
        ("", None, "empty"),
        ("N/A", None, "na"),
        ("-5", Decimal("-5.0000"), "valid"),
        ("360.25", Decimal("360.2500"), "valid"),
        ("1e2", Decimal("100.0000"), "valid"),
        ("1.00005", Decimal("1.00005"), "valid"),
        ("-.5", Decimal("-0.5"), "valid"),
        ("123456789012345.5", Decimal("123456789012345.5"), "valid"),
        ("0.0000000000000000010", Decimal("1e-18"), "valid"),
        ("0.0000000000000000001", "0.0000000000000000001", "valid"),
        ("1e-19", "0.0000000000000000001", "valid"),
        ("-123456789012345678901.50", "-123456789012345678901.5", "valid"),
        ("+0123456789012345678901", "123456789012345678901", "valid"),
        ("1e40", "1" + "0" * 40, "valid"),
        ("0e99", "0", "valid"),
        ("1e131072", None, "invalid"),
        ("1e-16384", None, "invalid"),
        ("1e99999999999", None, "invalid"),
        ("1" * 45 + "." + "2" * 45, "1" * 45 + "." + "2" * 45, "valid"),
        (".", None, "invalid"),
        ("NaN", None, "invalid"),
        ("12,5", None, "invalid"),
    ],
    (PRODUCTS, "currency"): [
        (None, None, "null"),
        ("", None, "empty"),
        (" USD ", "USD", "valid"),
        ("usd", None, "invalid"),
        ("GBP", None, "invalid"),
    ],
    (PRODUCTS, "is_active"): [
        (None, None, "null"),
        ("", None, "empty"),
        ("YES", True, "valid"),
        ("1", True, "valid"),
        ("False", False, "valid"),
        ("0", False, "valid"),
        ("no", False, "valid"),
        ("maybe", None, "invalid"),
    ],
    (PAYMENTS, "order_id"): [
        (None, None, "null"),
        ("", None, "empty"),
        ("12", 12, "valid"),
        (" +5 ", 5, "valid"),
        ("0", None, "invalid"),
        ("-1", None, "invalid"),
        ("x", None, "invalid"),
        ("5.0", None, "invalid"),
        ("1e2", None, "invalid"),
        ("0x1F", None, "invalid"),
        ("3000000000", 3000000000, "valid"),
    ],
    (PAYMENTS, "payment_method"): [
        (None, None, "null"),
        ("", None, "empty"),
        ("card", "card", "valid"),
        ("Card", None, "invalid"),
        ("cash", None, "invalid"),
    ],
    (PAYMENTS, "amount"): [
        (None, None, "null"),
        ("", None, "empty"),
        ("error_amount", None, "error_amount"),
        ("861.19", Decimal("861.1900"), "valid"),
        ("0.00004", Decimal("0.00004"), "valid"),
        ("1e-20", "0.00000000000000000001", "valid"),
        ("6e19", Decimal("6e19"), "valid"),
        ("6e20", "600000000000000000000", "valid"),
        ("-6e20", None, "invalid"),
        ("\u0663", None, "invalid"),
        ("-1e-20", None, "invalid"),
        ("0", None, "invalid"),
        ("-3", None, "invalid"),
        ("ten", None, "invalid"),
    ],
    (PAYMENTS, "payment_timestamp"): [
        (None, None, "null"),
        ("", None, "empty"),
        ("2024-10-06 18:49:34", datetime(2024, 10, 6, 18, 49, 34), "yyyy-mm-dd hh24:mi:ss"),
        ("02.01.2024", datetime(2024, 1, 2), "dd.mm.yyyy"),
        ("13/45/2025", None, "invalid"),
        ("32.01.2024", None, "invalid"),
        ("2024-01-02", None, "invalid"),
        ("2024-01-02 25:00:00", None, "invalid"),
    ],
    (ORDERS, "quantity"): [
        ("3", 3, "valid"),
        ("0", None, "invalid"),
        ("3000000000", None, "invalid"),
    ],
    (ORDERS, "unit_price"): [
        (None, None, "null"),
        ("", None, "empty"),
        ("109.91", Decimal("109.9100"), "valid"),
        ("N/A", None, "invalid"),
        ("0.00", None, "invalid"),
    ],
    (ORDERS, "order_timestamp"): [
        (None, None, "null"),
        ("", None, "empty"),
        ("2025-99-99", None, "placeholder_date"),
        ("2025-99-98", None, "invalid"),
        ("2024-01-02", datetime(2024, 1, 2), "yyyy-mm-dd"),
        ("2024-01-02 03:04:05", datetime(2024, 1, 2, 3, 4, 5), "yyyy-mm-dd hh24:mi:ss"),
        ("02.01.2024", None, "invalid"),
    ],
    (ORDERS, "status"): [
        (None, None, "null"),
        ("", None, "empty"),
        ("completed", "completed", "valid"),
        ("Completed", None, "invalid"),
    ],
    (EVENTS, "event_id"): [
        (None, None, "null"),
        ("", None, "empty"),
        ("BAD_ID", None, "bad_id"),
        ("7", 7, "valid"),
        ("0", None, "invalid"),
    ],
    (EVENTS, "event_type"): [
        (None, None, "null"),
        ("", None, "empty"),
        ("view", "view", "valid"),
        ("signup", None, "invalid"),
    ],
    (EVENTS, "event_timestamp"): [
        (None, None, "null"),
        ("", None, "empty"),
        ("broken-date", None, "broken-date"),
        ("2024-01-02", None, "invalid"),
        ("2025-08-19 14:21:50", datetime(2025, 8, 19, 14, 21, 50), "yyyy-mm-dd hh24:mi:ss"),
    ],
}


@pytest.mark.parametrize("entity, column", CASES, ids=lambda x: getattr(x, "name", x))
def test_values_and_tags(spark, entity, column):
    cases = CASES[(entity, column)]
    found = run(spark, entity.parsers[column], [text for text, _, _ in cases])
    assert found == [(value, tag) for _, value, tag in cases]


def test_every_parser_of_the_same_kind_is_shared():
    assert PAYMENTS.parsers["order_id"] is ORDERS.parsers["order_id"]
    assert EVENTS.parsers["customer_id"] is ORDERS.parsers["customer_id"]
    assert EVENTS.parsers["product_id"] is ORDERS.parsers["product_id"]
    assert ORDERS.parsers["currency"] is PAYMENTS.parsers["currency"] is PRODUCTS.parsers["currency"]


def test_phone_code(spark):
    texts = ["+7 (900) 123-45-67", "9001234567", "0079001234567", "123", "x", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    codes = rows.selectExpr("i", f"{phone_code('trim(t)')} AS code").orderBy("i").collect()
    assert [r["code"] for r in codes] == ["7", None, "007", None, None, None]


PIECES = st.sampled_from(
    ["", " ", "0", "1", "9", "-", ".", ":", "+", "@", "a", "Z", "Ж", "ж", "x.io", "UNKNOWN", "N/A"]
    + ["2024-01-02", "02.01.2024", " 10:00:00", "view", "card", "Home", "USD", "true", "\n", "'"]
)
TEXTS = st.lists(
    st.one_of(st.none(), st.text(max_size=12), st.lists(PIECES, max_size=5).map("".join)),
    min_size=1,
    max_size=60,
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=TEXTS)
def test_a_value_comes_with_an_accepted_tag_and_only_then(spark, texts):
    texts = [t if t is None else t.replace("\x00", "") for t in texts]
    texts = [t if t is None else t.encode("utf-8", "ignore").decode() for t in texts]
    parsers = {f"{e.name}_{c}": p for e in ENTITIES.values() for c, p in e.parsers.items()}
    rows = spark.createDataFrame([(t,) for t in texts], "raw string")
    value = "coalesce(cast({} AS string), {})"
    valued = rows.selectExpr(
        "raw", *[f"{value.format(p.value('trim(raw)'), wide_text(p))} AS {n}" for n, p in parsers.items()]
    )
    tagged = valued.selectExpr(
        "*", *[f"{p.tag('trim(raw)', n)} AS {n}_tag" for n, p in parsers.items()]
    )
    for row in tagged.collect():
        for name, parser in parsers.items():
            value, tag = row[name], row[f"{name}_tag"]
            assert tag is not None, (name, row["raw"])
            assert (value is not None) == (tag in parser.accepted), (name, row["raw"], value, tag)
