from __future__ import annotations

import json

from tallyvault.model import CUSTOMERS, EVENTS, ORDERS, PAYMENTS, PRODUCTS
from tallyvault.operators.cleaning import cleaned_rows
from tallyvault.operators.rejects import fatal_rejects, one_row_per_copy, warn_rejects

from .support import DAY_1, customer, details, event, order, parsed, payment, product, tuples


def test_copies_are_counted_and_kept_once(spark):
    rows = parsed(spark, PRODUCTS, [product("1"), product("1"), product("1"), product("2")])
    assert tuples(rows, "product_id", "copies", "duplicate_count") == [(1, 3, 3), (2, 1, 1)]
    assert tuples(cleaned_rows(rows, PRODUCTS), "product_id") == [(1,), (2,)]


def test_null_and_empty_share_a_hash_but_keep_their_own_log_entry(spark):
    null_city, empty_city = customer("1", city=None), customer("1", city="")
    rows = parsed(spark, CUSTOMERS, [null_city, null_city, empty_city])
    assert tuples(rows, "city_format", "copies", "duplicate_count") == [
        ("invalid empty", 1, 3),
        ("invalid null", 2, 3),
    ]
    assert cleaned_rows(rows, CUSTOMERS).count() == 1
    logged = warn_rejects(rows, CUSTOMERS, DAY_1).collect()
    assert sorted(repr(json.loads(r["raw_payload"])["city"]) for r in logged) == [
        "''",
        "None",
        "None",
    ]
    assert {json.loads(r["error_details"])["details"]["num_duplicates"] for r in logged} == {3}


def test_fatal_keys_by_entity(spark):
    rows = parsed(
        spark,
        CUSTOMERS,
        [customer(None), customer(""), customer("UNKNOWN"), customer("abc"), customer("0")],
    )
    assert tuples(cleaned_rows(rows, CUSTOMERS), "customer_id") == [(0,)]
    reasons = [d["reason"] for d in details(fatal_rejects(rows, CUSTOMERS, DAY_1))]
    assert reasons == ["invalid_customer_id"] + ["missing_or_null_customer_id"] * 3

    # only customers treat UNKNOWN as missing; elsewhere it is a key that does not cast
    rows = parsed(spark, PAYMENTS, [payment("UNKNOWN", "1"), payment("", "1")])
    reasons = [d["reason"] for d in details(fatal_rejects(rows, PAYMENTS, DAY_1))]
    assert reasons == ["invalid_payment_id", "missing_or_null_payment_id"]


def test_the_key_is_tested_untrimmed(spark):
    rows = parsed(spark, ORDERS, [order(" ", "1", "1"), order("", "1", "1")])
    assert tuples(cleaned_rows(rows, ORDERS), "order_id") == [(None,)]


def test_a_bad_parsed_key_is_a_warning_and_the_row_stays(spark):
    rows = parsed(spark, EVENTS, [event("BAD_ID", "1", "1"), event("5", "1", "1")])
    assert tuples(cleaned_rows(rows, EVENTS), "event_id") == [(5,), (None,)]
    assert fatal_rejects(rows, EVENTS, DAY_1).count() == 0
    (warning,) = details(warn_rejects(rows, EVENTS, DAY_1))
    assert warning["reason"] == "invalid_descriptive_attributes"
    assert list(warning["details"]) == [
        "customer_id_format",
        "event_type_format",
        "event_timestamp_format",
        "product_id_format",
        "num_duplicates",
    ]


def test_warnings_list_all_tags_and_the_whole_row(spark):
    bad = ("7", "John", None, "123", "UNKNOWN", "2024-01-31")
    rows = parsed(spark, CUSTOMERS, [bad, customer("8")])
    (record,) = warn_rejects(rows, CUSTOMERS, DAY_1).collect()
    assert record["source_table"] == "customers"
    assert record["load_datetime"] == DAY_1
    payload = json.loads(record["raw_payload"])
    assert payload.pop("row_hash")
    assert payload == dict(zip(CUSTOMERS.columns, bad))
    assert json.loads(record["error_details"]) == {
        "level": "warn",
        "reason": "invalid_descriptive_attributes",
        "details": {
            "full_name_format": "invalid",
            "email_format": "invalid null",
            "phone_format": "invalid short",
            "city_format": "invalid unknown",
            "created_at_format": "yyyy-mm-dd",
            "num_duplicates": 1,
        },
    }


def test_good_duplicates_are_warned_once_per_row(spark):
    rows = parsed(spark, CUSTOMERS, [customer("1"), customer("1"), customer("2")])
    assert warn_rejects(rows, CUSTOMERS, DAY_1).count() == 2


def test_fatal_duplicates_are_logged_once_per_row(spark):
    rows = parsed(spark, CUSTOMERS, [customer(None)] * 3)
    assert fatal_rejects(rows, CUSTOMERS, DAY_1).count() == 3


def test_many_copies_are_written_in_chunks(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 4), ("c", 5), ("d", 23)], "row_hash string, copies long")
    found = one_row_per_copy(rows, per_task=4).groupBy("row_hash").count()
    assert tuples(found, "row_hash", "count") == [("a", 1), ("b", 4), ("c", 5), ("d", 23)]
