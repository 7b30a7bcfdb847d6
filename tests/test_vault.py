from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyvault.model import CUSTOMERS, ENTITIES, LINKS, ORDERS, PAYMENTS, PRODUCTS, VAULT_SCHEMAS
from tallyvault.operators.cleaning import cleaned_rows
from tallyvault.operators.hubs import new_hub_rows
from tallyvault.operators.links import checked_ids, linked_ids, missing_references, new_link_rows
from tallyvault.operators.satellites import conflicting_versions, latest_version, new_sat_rows
from tallyvault.operators.skew import hot_keys, lookup_join
from tallyvault.plans.analytics import top_customers
from tallyvault.plans.pipeline import Load
from tallyvault.plans.staging import Staging
from tallyvault.plans.vault import StoredVault, planned_vault

from .support import (
    DAY_1,
    DAY_2,
    DAY_3,
    accepted,
    batch,
    customer,
    details,
    event,
    order,
    parsed,
    payment,
    product,
    tuples,
)


def load(spark, vault, day, **rows):
    staging = Staging(spark)
    Load(spark, vault, day, staging, again=True).run(batch(spark, **rows))
    staging.drop()


def counts(vault):
    return {name: vault[name].count() for name in VAULT_SCHEMAS}


BATCH = {
    "customers": [customer("1"), customer("2"), customer("2"), customer("UNKNOWN")],
    "products": [product("10"), product("11")],
    "orders": [order("100", "1", "10"), order("101", "2", "11", "processing")],
    "payments": [payment("500", "100"), payment("501", "101"), payment("502", "999")],
    "events": [event("900", "1", "10"), event("901", "3", "10"), event("902", "1", "12")],
}


def test_loading_a_batch_once_and_again(spark, tmp_path):
    vault = StoredVault(spark, str(tmp_path))
    load(spark, vault, DAY_1, **BATCH)
    before, logged = counts(vault), vault.rejects().count()
    assert before["hub_customer"] == 2 and before["link_order_customer_product"] == 2
    assert before["link_event_customer_product"] == 1 and before["link_payment_order"] == 2

    # a planned vault holds the same rows
    raw = batch(spark, **BATCH)
    rows = {
        name: accepted(spark, e, [tuple(r) for r in raw[name].collect()])
        for name, e in ENTITIES.items()
    }
    planned = planned_vault(rows, DAY_1)
    assert planned.keys() == VAULT_SCHEMAS.keys() == set(vault)
    for name, schema in VAULT_SCHEMAS.items():
        assert tuples(planned[name], *schema.names) == tuples(vault[name], *schema.names), name
        assert planned[name].schema.names == vault[name].schema.names == schema.names
        assert [f.dataType for f in planned[name].schema] == [f.dataType for f in schema]

    # the same load again replaces its own rows
    load(spark, vault, DAY_1, **BATCH)
    assert counts(vault) == before
    assert vault.rejects().count() == logged

    # the same batch as a new load adds nothing but log records
    load(spark, vault, DAY_2, **BATCH)
    assert counts(vault) == before
    assert vault.rejects().count() == 2 * logged


    vault.clear()
    assert set(counts(vault).values()) == {0}
    assert vault.rejects().count() == 0


def versions(spark, tmp_path, entity, *batches):
    """The satellite after one load per batch."""
    vault = StoredVault(spark, str(tmp_path))
    for day, batch_rows in zip((DAY_1, DAY_2, DAY_3), batches):
        rows = accepted(spark, entity, batch_rows)
        history = vault.before(entity.sat, day.isoformat())
        vault.append(entity.sat, new_sat_rows(rows, entity, day, history), day.isoformat())
        vault.set_complete(day.isoformat())
    return vault[entity.sat]


def test_values_that_change_back_make_three_versions(spark, tmp_path):
    batches = [[customer("1", city=c), customer("2")] for c in ("Oslo", "Bergen", "Oslo")]
    sat = versions(spark, tmp_path, CUSTOMERS, *batches)
    assert tuples(sat, "load_datetime", "city") == [
        (DAY_1, "Oslo"),
        (DAY_1, "Oslo"),
        (DAY_2, "Bergen"),
        (DAY_3, "Oslo"),
    ]
    newest = latest_version(sat, "customer_hk")
    assert tuples(newest, "load_datetime") == [(DAY_1,), (DAY_3,)]


def test_padding_and_money_scale_make_no_new_version(spark, tmp_path):
    first = ("1", "lamp", "Home", "59.9", "RUB", "yes")
    second = ("1", " lamp ", "Home", "59.90", "RUB", "TRUE")
    assert versions(spark, tmp_path, PRODUCTS, [first], [second]).count() == 1


def test_links_of_changed_orders_stay(spark):
    link = LINKS["link_order_customer_product"]

    def checked(row):
        return checked_ids(linked_ids(accepted(spark, ORDERS, [row]), link), link, {})

    first = new_link_rows(checked(order("100", "1", "10")), link, DAY_1)
    assert new_link_rows(checked(order("100", "1", "10")), link, DAY_2, first).count() == 0
    assert new_link_rows(checked(order("100", "2", "10")), link, DAY_2, first).count() == 1


def test_two_versions_in_one_batch(spark):
    rows = [customer("1", city="Oslo"), customer("1", city=" Oslo "), customer("1", city="Bergen")]
    rows += [customer("2"), customer("2")]
    cleaned = cleaned_rows(parsed(spark, CUSTOMERS, rows), CUSTOMERS)
    smallest = cleaned.filter("customer_id = 1").orderBy("row_hash").first()
    chosen = new_sat_rows(cleaned, CUSTOMERS, DAY_1)
    assert tuples(chosen, "city") == sorted([(smallest["city"],), ("Oslo",)])
    (conflict,) = details(conflicting_versions(cleaned, CUSTOMERS, DAY_1))
    assert conflict["reason"] == "conflicting_versions"
    assert conflict["details"]["hash_diff"] not in [r["hash_diff"] for r in chosen.collect()]


def test_satellite_rows_are_limited_to_hub_keys_when_a_hub_is_given(spark):
    rows = accepted(spark, PRODUCTS, [product("1"), product("2")])
    hub = new_hub_rows(accepted(spark, PRODUCTS, [product("2")]), PRODUCTS, DAY_1)
    assert new_sat_rows(rows, PRODUCTS, DAY_1, hub=hub).count() == 1


def test_missing_references_name_the_first_missing_id(spark):
    link = LINKS["link_order_customer_product"]
    rows = cleaned_rows(
        parsed(
            spark,
            ORDERS,
            [
                order("100", "1", "10"),
                order("101", "8", "19"),
                order("102", "1", "19"),
                order("103", None, "19"),
                order("104", "1", None),
            ],
        ),
        ORDERS,
    )
    hubs = {
        "customer": new_hub_rows(accepted(spark, CUSTOMERS, [customer("1")]), CUSTOMERS, DAY_1),
        "product": new_hub_rows(accepted(spark, PRODUCTS, [product("10")]), PRODUCTS, DAY_1),
        "order": new_hub_rows(rows.filter("order_id <> 102"), ORDERS, DAY_1),
    }
    checked = checked_ids(linked_ids(rows, link), link, hubs)
    assert tuples(checked, "order_id", "missing_type") == [
        (100, None),
        (101, "customer_id"),
        (102, "order_id"),
    ]
    assert new_link_rows(checked, link, DAY_1).count() == 1
    found = details(missing_references(rows, checked, link, DAY_1))
    assert sorted((d["details"]["missing_type"], d["details"]["missing_value"]) for d in found) == [
        ("customer_id", 8),
        ("order_id", 102),
    ]
    assert {d["reason"] for d in found} == {"missing_reference"}
    assert {d["details"]["source_table"] for d in found} == {"cleaned.orders"}


def test_padded_rows_with_a_missing_reference_are_each_logged(spark):
    link = LINKS["link_payment_order"]
    rows = cleaned_rows(
        parsed(spark, PAYMENTS, [payment("1", "9"), payment("1", " 9")]), PAYMENTS
    )
    hubs = {"order": new_hub_rows(accepted(spark, ORDERS, [order("5", "1", "1")]), ORDERS, DAY_1)}
    checked = checked_ids(linked_ids(rows, link), link, hubs)
    assert missing_references(rows, checked, link, DAY_1).count() == 2


def test_hot_keys_are_split_and_the_join_stays_the_same(spark):
    # key 1 owns a third of the rows, key 2 is just above the limit, the rest are single
    rows = spark.range(3000).selectExpr(
        "id AS n", "CASE WHEN id < 1000 THEN 1 WHEN id < 1111 THEN 2 ELSE id END AS k"
    )
    lookup = spark.range(0, 3000, 2).selectExpr("id AS k", "true AS known").union(
        spark.sql("SELECT 1L, true")
    )
    for how in ("left", "inner"):
        plain = tuples(rows.join(lookup, "k", how), "k", "n", "known")
        assert tuples(lookup_join(rows, lookup, ["k"], ["n"], how), "k", "n", "known") == plain
    empty = rows.limit(0)
    assert lookup_join(empty, lookup, ["k"], ["n"]).count() == 0


def test_hot_keys_own_more_than_an_even_share(spark):
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.range(3000).selectExpr("id AS n", "CASE WHEN id < 1500 THEN 1 WHEN id < 1600 THEN 2 ELSE id END AS k")
    (one,) = spark.sql("SELECT xxhash64(1L)").first()
    (found, by_both) = hot_keys(rows.selectExpr("n", "cast(k AS bigint) AS k"), ["k"], ["k", "n"])
    assert found.keys() == {one} and by_both == {}
    assert partitions // 2 <= found[one] <= partitions // 2 + 1  # counts are estimates
    groups = rows.filter("k = 1").groupBy(F.expr(f"pmod(xxhash64(n), {found[one]})")).count()
    assert groups.agg(F.max("count")).first()[0] < 2 * 3000 / partitions
    plan = lookup_join(rows, rows.select("k").distinct(), ["k"], ["n"])
    assert "_group" in plan._jdf.queryExecution().executedPlan().toString()
    everything = spark.range(40).selectExpr("1 AS k", "id AS n")  # every key's share is even or more
    assert len(hot_keys(everything, ["k"])[0]) == 1
    assert hot_keys(rows.limit(0), ["k"]) == [{}]


def test_without_hot_keys_the_join_is_the_plain_one(spark):
    rows = spark.range(500).selectExpr("id AS n", "id % 250 AS k")
    lookup = spark.range(250).selectExpr("id AS k", "true AS known")
    plan = lookup_join(rows, lookup, ["k"], ["n"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan == rows.join(lookup, ["k"])._jdf.queryExecution().optimizedPlan().toString() or "_group" not in plan


def test_finding_hot_keys_shuffles_sketches_only(spark):
    rows = spark.range(1000).selectExpr("id % 7 AS k")
    plan = rows.selectExpr("approx_top_k(xxhash64(k), 8, 64) AS x")._jdf.queryExecution().executedPlan().toString()
    assert "partial_approx_top_k" in plan and "hashpartitioning" not in plan


def test_a_stored_vault_knows_the_hot_keys_of_its_links(spark, tmp_path, monkeypatch):
    """From the sketches of its loads, merged; the links themselves aren't read."""
    vault = StoredVault(spark, str(tmp_path))
    people = [customer(str(i)) for i in range(1, 40)]
    first = [order(str(i), "7" if i % 3 else str(i % 39 + 1), "1") for i in range(1, 60)]
    second = [order(str(i), "7", "1") for i in range(60, 100)]
    load(spark, vault, DAY_1, customers=people, products=[product("1")], orders=first)
    load(spark, vault, DAY_2, orders=second)
    (seven,) = spark.sql("SELECT md5('7') AS k").selectExpr("xxhash64(k)").first()
    link = "link_order_customer_product"
    found = vault.hot_keys(link, "customer_hk")
    counted = hot_keys(vault[link], ["customer_hk"])[0]
    assert found == counted and found.keys() == {seven}
    assert vault.hot_keys(link, "order_hk") == {}
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")  # sketches of one size are merged into another
    try:
        assert vault.hot_keys(link, "customer_hk").keys() == {seven}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    monkeypatch.setattr("tallyvault.plans.analytics.hot_keys", None)  # never asked
    assert top_customers(vault, "orders", 1).first()["customer_id"] == 7


def died(spark, vault, day, step, **rows):
    """A load that ends after the given step."""
    load_ = Load(spark, vault, day, Staging(spark), again=True)
    monkey = pytest.MonkeyPatch()
    with monkey.context() as patch, pytest.raises(RuntimeError, match="killed"):

        def killed():
            getattr(Load, step)(load_)
            raise RuntimeError("killed")

        patch.setattr(load_, step, killed)
        load_.run(batch(spark, **rows))


@pytest.mark.parametrize("buckets", [None, 3])
@pytest.mark.parametrize("step", ["load_hubs", "load_satellites", "load_links"])
def test_a_load_that_dies_changes_nothing(spark, tmp_path, step, buckets):
    vault = StoredVault(spark, f"{tmp_path}/v", buckets=buckets)
    load(spark, vault, DAY_1, **BATCH)
    tables = {name: tuples(vault[name], *schema.names) for name, schema in VAULT_SCHEMAS.items()}
    logged = vault.rejects().count()
    later = {**BATCH, "customers": [customer("1", city="Rome"), customer("7")], "orders": [order("100", "7", "11")]}
    died(spark, vault, DAY_2, step, **later)
    for name, schema in VAULT_SCHEMAS.items():
        assert tuples(vault[name], *schema.names) == tables[name], (step, name)
    assert vault.rejects().count() == logged and vault.published() == ["20260101T000000000000"]

    # another load compares with the first one only, and the dead one can be run again
    load(spark, vault, DAY_3, **later)
    assert ("Rome",) in tuples(vault["sat_customer"], "city")
    load(spark, vault, DAY_2, **later)
    assert len(vault.published()) == 3


def test_a_published_load_that_is_run_again_is_invisible_meanwhile(spark, tmp_path):
    vault = StoredVault(spark, f"{tmp_path}/v")
    load(spark, vault, DAY_1, **BATCH)
    died(spark, vault, DAY_1, "load_hubs", **BATCH)
    assert set(counts(vault).values()) == {0}
    load(spark, vault, DAY_1, **BATCH)
    assert counts(vault)["hub_customer"] == 2


def test_links_read_their_ids_once(spark):
    link = LINKS["link_order_customer_product"]
    rows = accepted(spark, ORDERS, [order(str(i), str(i % 3), "1") for i in range(1, 30)])
    ids = Staging(spark).put("ids", linked_ids(rows, link))
    hubs = {n: Staging(spark).put(n, spark.range(9).selectExpr(f"id AS {n}_id")) for n in ("customer", "product")}
    plan = checked_ids(ids, link, hubs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 3  # the ids and two hubs


def shuffles(result):
    plan = result._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def test_a_bucketed_vault_holds_the_same_rows_and_reads_without_shuffles(spark, tmp_path):
    plain = StoredVault(spark, f"{tmp_path}/plain")
    bucketed = StoredVault(spark, f"{tmp_path}/bucketed", buckets=4)
    changed = {**BATCH, "orders": [order("100", "2", "10"), order("105", "1", "11")]}
    for vault in (plain, bucketed):
        load(spark, vault, DAY_1, **BATCH)
        load(spark, vault, DAY_2, **changed)
    load(spark, bucketed, DAY_2, **changed)
    again = StoredVault(spark, f"{tmp_path}/bucketed", buckets=4)
    for name, schema in VAULT_SCHEMAS.items():
        assert tuples(again[name], *schema.names) == tuples(plain[name], *schema.names), name

    latest = latest_version(bucketed["sat_order"], "order_hk")
    assert shuffles(latest) == 0
    assert shuffles(latest_version(plain["sat_order"], "order_hk")) == 1
    keys = spark.range(9).selectExpr("id AS order_id").distinct()
    unknown = keys.join(bucketed["hub_order"].hint("merge"), "order_id", "left_anti")
    assert shuffles(unknown) == 1  # the keys; the hub is read as it lies

    bucketed.clear()
    assert bucketed["hub_customer"].count() == 0 and bucketed["sat_order"].count() == 0


def test_a_load_writes_one_file_per_bucket(spark, tmp_path):
    vault = StoredVault(spark, f"{tmp_path}/v", buckets=3)
    many = [order(str(i), "1", "1") for i in range(1, 200)]
    load(spark, vault, DAY_1, orders=many, customers=[customer("1")], products=[product("1")])
    for table in ("hub_order", "sat_order", "link_order_customer_product"):
        assert len(list(tmp_path.glob(f"v/{table}/load_id=*/part-*.parquet"))) == 3


def test_loads_of_one_second_are_both_kept(spark, tmp_path):
    vault = StoredVault(spark, f"{tmp_path}/v")
    later = DAY_1.replace(microsecond=900_000)
    load(spark, vault, DAY_1, customers=[customer("1")])
    load(spark, vault, later, customers=[customer("2")])
    assert tuples(vault["hub_customer"], "customer_id") == [(1,), (2,)]
    with pytest.raises(ValueError, match="already"):
        Load(spark, vault, later, Staging(spark)).run(batch(spark, customers=[customer("3")]))


def test_a_vault_keeps_its_bucket_count(spark, tmp_path):
    StoredVault(spark, f"{tmp_path}/a", buckets=4)
    assert StoredVault(spark, f"{tmp_path}/a").buckets == 4
    with pytest.raises(ValueError, match="4 buckets"):
        StoredVault(spark, f"{tmp_path}/a", buckets=8)
    hub = new_hub_rows(accepted(spark, PRODUCTS, [product("1")]), PRODUCTS, DAY_1)
    StoredVault(spark, f"{tmp_path}/b").append("hub_product", hub, "1")
    with pytest.raises(ValueError, match="without buckets"):
        StoredVault(spark, f"{tmp_path}/b", buckets=4)


def newest(vault, sat):
    hk = {e.sat: e.hk for e in ENTITIES.values()}[sat]
    return tuples(latest_version(vault[sat], hk), *VAULT_SCHEMAS[sat].names)


@pytest.mark.parametrize("buckets", [None, 3])
def test_snapshots_hold_the_newest_versions(spark, tmp_path, buckets):
    vault = StoredVault(spark, f"{tmp_path}/v", buckets=buckets)
    sats = [e.sat for e in ENTITIES.values()]
    assert vault.current("sat_order") is None
    second = {"orders": [order("100", "2", "10", "cancelled"), order("105", "1", "11")], "customers": [customer("1", city="Rome")]}
    third = {"orders": [order("100", "1", "10")], "products": [product("12")]}

    def agree():
        for sat in sats:
            assert tuples(vault.current(sat), *VAULT_SCHEMAS[sat].names) == newest(vault, sat), sat

    load(spark, vault, DAY_1, **BATCH)
    agree()
    died(spark, vault, DAY_2, "load_satellites", **third)
    agree()
    load(spark, vault, DAY_3, **third)
    agree()
    # a load in between: the snapshot of the third stands for other loads than there are now
    load(spark, vault, DAY_2, **second)
    assert vault.current("sat_order") is None
    load(spark, vault, DAY_3.replace(hour=5), **second)
    agree()
    assert ("Rome",) in tuples(vault.current("sat_customer"), "city")
    # the same load again, and a vault opened anew
    load(spark, vault, DAY_3.replace(hour=5), **second)
    agree()
    again = StoredVault(spark, f"{tmp_path}/v")
    assert tuples(again.current("sat_order"), "order_hk", "status") == tuples(vault.current("sat_order"), "order_hk", "status")
    assert len(list(tmp_path.glob("v/current/sat_order/of_*"))) <= 2


def test_a_load_reads_the_snapshot_and_no_history(spark, tmp_path):
    vault = StoredVault(spark, f"{tmp_path}/v", buckets=4)  # the shuffle partitions
    many = [order(str(i), "1", "1") for i in range(1, 60)]
    load(spark, vault, DAY_1, orders=many, customers=[customer("1")], products=[product("1")])
    load(spark, vault, DAY_2, orders=many[:7])
    staged = Staging(spark).put("rows", accepted(spark, ORDERS, [order("3", "1", "1", "cancelled")]))
    latest = vault.current("sat_order", "20260103T000000000000")
    plan = new_sat_rows(staged, ORDERS, DAY_3, latest=latest.hint("merge"))._jdf.queryExecution().executedPlan().toString()
    assert ".current_sat_order_of_" in plan and ".sat_order[" not in plan
    assert plan.count("Exchange hashpartitioning") == 1  # the batch; the snapshot is read as it lies
    report = top_customers(vault, "orders", 1)._jdf.queryExecution().executedPlan().toString()
    assert ".current_sat_event_of_" in report and ".sat_event[" not in report
    assert top_customers(vault, "orders", 1).first()["order_count"] == 59
