"""Rows of keys that occur once take no shuffle; the tables are those that the shuffles made."""

from __future__ import annotations

import os

import pytest

from tallyvault import queries
from tallyvault.model import CUSTOMERS, LINKS, ORDERS
from tallyvault.operators import repeats as repeats_module
from tallyvault.operators.cleaning import cleaned_rows
from tallyvault.operators.links import missing_references, new_link_rows, rows_near
from tallyvault.operators.repeats import parted, repeated_keys
from tallyvault.operators.satellites import conflicting_versions, new_sat_rows
from tallyvault.plans import staging as staging_module
from tallyvault.plans import vault as vault_module
from tallyvault.plans.pipeline import Load
from tallyvault.plans.staging import DROPS_SHUFFLES, Staging, shuffles_dropped
from tallyvault.plans.vault import StoredVault

from .support import DAY_1, DAY_2, accepted, batch, customer, event, order, parsed, payment, product, raw, tuples

CUSTOMER_ROWS = [
    customer("1"),
    customer("2"),
    customer("2"),
    customer("2", "Ann Poe"),
    customer("3", city=""),
    customer("3", city=None),
    customer("3", city=""),
    customer("x"),
    customer(None),
    customer(None),
    customer("UNKNOWN"),
] + [customer(str(k)) for k in range(10, 40)]


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_single_rows_are_told_without_a_shuffle(spark):
    rows = spark.createDataFrame([(1,), (2,), (2,), (None,), (None,), (3,)], "k long")
    repeated = Staging(spark).repeated("keys", rows, ["k"])
    single, several = parted(rows, ["k"], repeated)
    assert tuples(single, "k") == [(1,), (3,)]
    assert tuples(several, "k") == sorted([(2,), (2,), (None,), (None,)], key=repr)
    assert "hashpartitioning" not in plan(single) + plan(several)


def test_too_many_repeated_keys_are_not_broadcast(spark, monkeypatch):
    rows = spark.createDataFrame([(k // 2,) for k in range(10)], "k long")
    assert repeated_keys(rows, ["k"]).count() == 5
    monkeypatch.setattr(staging_module, "MOST_KEYS", 4)
    assert Staging(spark).repeated("keys", rows, ["k"]) is None


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_parsed_rows_are_those_of_the_whole_shuffle(spark, monkeypatch, most):
    monkeypatch.setattr(staging_module, "MOST_KEYS", most)
    expected = parsed(spark, CUSTOMERS, CUSTOMER_ROWS)
    found = Staging(spark).put_parsed(raw(spark, CUSTOMERS, CUSTOMER_ROWS), CUSTOMERS)
    assert dict(found.dtypes) == dict(expected.dtypes)
    assert tuples(found, *expected.columns) == tuples(expected, *expected.columns)
    if most:
        scans = plan(found).split("Union")[1]
        assert "hashpartitioning" not in scans


def test_versions_are_those_of_the_whole_shuffle(spark):
    first = accepted(spark, CUSTOMERS, CUSTOMER_ROWS)
    history = new_sat_rows(first, CUSTOMERS, DAY_1)
    second = Staging(spark).put_parsed(
        raw(spark, CUSTOMERS, [*CUSTOMER_ROWS[:7], customer("1", city="Rome"), customer("50"), customer("11", "Al Ba")]), CUSTOMERS
    )
    rows = cleaned_rows(second, CUSTOMERS)
    repeated = Staging(spark).repeated("keys", rows, ["customer_id"])
    for known in (None, history):
        expected = new_sat_rows(rows, CUSTOMERS, DAY_2, known)
        found = new_sat_rows(rows, CUSTOMERS, DAY_2, known, repeated=repeated)
        assert found.dtypes == expected.dtypes
        assert tuples(found, *expected.columns) == tuples(expected, *expected.columns)
        assert expected.count()
    expected = conflicting_versions(rows, CUSTOMERS, DAY_2)
    found = conflicting_versions(rows, CUSTOMERS, DAY_2, repeated)
    assert tuples(found, *expected.columns) == tuples(expected, *expected.columns)
    assert expected.count() == 2


def test_known_links_are_left_out_before_the_hub_keys_are_made(spark):
    link = LINKS["link_order_customer_product"]
    checked = spark.createDataFrame(
        [(1, 2, 3, None), (4, 5, 6, None), (7, 8, 9, "customer_id")], "order_id long, customer_id long, product_id long, missing_type string"
    )
    known = new_link_rows(checked.filter("order_id = 1"), link, DAY_1)
    added = new_link_rows(checked, link, DAY_2, known)
    assert added.columns == link.schema.names
    expected = new_link_rows(checked.filter("order_id = 4"), link, DAY_2)
    assert tuples(added, *added.columns) == tuples(expected, *added.columns)


def test_shuffles_are_dropped_while_tables_are_written(spark):
    before = spark.conf.get(DROPS_SHUFFLES, None)
    with shuffles_dropped(spark):
        assert spark.conf.get(DROPS_SHUFFLES) == "true"
    assert spark.conf.get(DROPS_SHUFFLES, None) == before


@pytest.mark.parametrize("dies_after", ["", "load_satellites"])
def test_two_loads_leave_the_vault_alone_on_the_disk(spark, monkeypatch, tmp_path, dies_after):
    rows = batch(
        spark,
        customers=CUSTOMER_ROWS,
        products=[product("10")],
        orders=[order("100", "1", "10"), order("101", "2", "10"), order("102", "99", "10")],
        payments=[payment("500", "100"), payment("501", "777")],
        events=[event("900", "1", "10")],
    )
    monkeypatch.setattr(queries, "_raw", lambda spark, sf_dir, entity: rows[entity.name])
    monkeypatch.setattr(staging_module, "shared_folder", lambda spark: str(tmp_path))
    vault = queries._load_twice(spark, "", dies_after)
    assert [f"{tmp_path}/{name}/vault" for name in os.listdir(tmp_path)] == [vault.root]
    # the second load adds order 10000101
    assert vault[ORDERS.hub].count() == vault[ORDERS.sat].count() == (3 if dies_after else 4)
    assert vault.rejects().count() > 0


def shuffled_columns(frame, of: str) -> list[str]:
    """What the plan's shuffles whose rows have a column of that name carry."""
    lines = frame._jdf.queryExecution().explainString(frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")).splitlines()
    inputs = [lines[i + 1] for i, line in enumerate(lines) if line.endswith("Exchange") or ") Exchange" in line]
    return [line for line in inputs if f"{of}#" in line]


def test_the_comparison_shuffles_business_keys_and_short_hashes(spark):
    rows = cleaned_rows(Staging(spark).put_parsed(raw(spark, CUSTOMERS, CUSTOMER_ROWS), CUSTOMERS), CUSTOMERS)
    staging = Staging(spark)
    repeated = staging.repeated("keys", rows, ["customer_id"])
    latest = staging.put("latest", new_sat_rows(rows, CUSTOMERS, DAY_1)).hint("merge")
    found = new_sat_rows(rows, CUSTOMERS, DAY_2, latest=latest, repeated=repeated)
    assert found.count() == 0
    compared = [line for line in shuffled_columns(found, "full_name") if "row_hash#" not in line]
    assert compared and all("customer_id#" in line and "customer_hk#" not in line for line in compared)
    assert not shuffled_columns(found, "hash_diff") or all("_n#" in x or "row_hash#" in x for x in shuffled_columns(found, "hash_diff"))


def test_known_links_meet_the_ids(spark):
    link = LINKS["link_payment_order"]
    checked = Staging(spark).put("checked", spark.createDataFrame([(1, 2, None), (4, 5, None)], "payment_id long, order_id long, missing_type string"))
    known = Staging(spark).put("known", new_link_rows(checked.filter("order_id = 2"), link, DAY_1)).hint("merge")
    added = new_link_rows(checked, link, DAY_2, known)
    assert added.count() == 1
    sent = shuffled_columns(added, "payment_id")
    assert sent and not any("link_hk#" in line for line in sent)


@pytest.mark.parametrize("buckets", [None, 3])
def test_the_first_load_is_its_own_snapshot(spark, tmp_path, buckets):
    vault = StoredVault(spark, f"{tmp_path}/v", buckets=buckets)
    Load(spark, vault, DAY_1, Staging(spark)).run(batch(spark, customers=CUSTOMER_ROWS))
    assert not (tmp_path / "v/current").exists()
    names = CUSTOMERS.sat_schema.names
    assert tuples(vault.current("sat_customer"), *names) == tuples(vault["sat_customer"], *names) != []
    Load(spark, vault, DAY_2, Staging(spark)).run(batch(spark, customers=[customer("1", city="Rome"), customer("99")]))
    assert len(list(tmp_path.glob("v/current/sat_customer/of_*"))) == 1
    found = vault.current("sat_customer")
    assert found.count() == vault["sat_customer"].count() - 1 and ("Rome",) in tuples(found, "city")


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_staged_rows_leave_out_the_row_hash(spark, monkeypatch, most):
    monkeypatch.setattr(staging_module, "MOST_KEYS", most)
    staging = Staging(spark)
    found = staging.put_parsed(raw(spark, CUSTOMERS, CUSTOMER_ROWS), CUSTOMERS)
    for table in ("rows_customers", "customers"):
        assert "row_hash" not in spark.read.parquet(f"{staging.root}/{table}").columns
    expected = parsed(spark, CUSTOMERS, CUSTOMER_ROWS)
    names = ["raw_customer_id", "raw_city", "row_hash", "copies"]
    assert tuples(found, *names) == tuples(expected, *names)


@pytest.mark.parametrize("buckets", [None, 3])
def test_a_snapshot_leaves_out_the_hash_diff(spark, tmp_path, buckets):
    vault = StoredVault(spark, f"{tmp_path}/v", buckets=buckets)
    wide = [order(key, "1", "1") for key in "123"]
    wide = [(*o[:4], price, *o[5:]) for o, price in zip(wide, ["10.50", "7" * 50, "-0.50"])]
    Load(spark, vault, DAY_1, Staging(spark)).run(batch(spark, orders=wide))
    Load(spark, vault, DAY_2, Staging(spark)).run(batch(spark, orders=[order("1", "1", "1", "cancelled"), order("4", "1", "1")]))
    written = spark.read.parquet(*map(str, tmp_path.glob("v/current/sat_order/of_*")))
    assert "hash_diff" not in written.columns and written.count() == 4
    stored = {(hk, diff) for hk, diff in tuples(vault["sat_order"], "order_hk", "hash_diff")}
    found = tuples(vault.current("sat_order"), "order_hk", "hash_diff")
    assert len(found) == 4 and set(found) <= stored
    # what didn't change is no new version
    Load(spark, vault, DAY_2.replace(hour=9), Staging(spark)).run(batch(spark, orders=[*wide[1:], order("4", "1", "1")]))
    assert vault["sat_order"].count() == 5


@pytest.mark.parametrize("bits", [2**27, 2**15])
def test_a_bitmap_tells_single_rows_however_many_keys_repeat(spark, monkeypatch, bits):
    monkeypatch.setattr(staging_module, "MOST_KEYS", 4)
    monkeypatch.setattr(repeats_module, "BITS", bits)
    given = [(k,) for k in range(-5000, 5000)] + [(k,) for k in range(0, 5000, 7)] + [(None,), (None,)]
    rows = spark.createDataFrame(given, "k long").repartition(3)
    repeated = Staging(spark).repeats("keys", rows, ["k"])
    assert repeated.columns == ["_part", "_marks"]
    single, several = parted(rows, ["k"], repeated)
    assert sorted(tuples(single, "k") + tuples(several, "k"), key=repr) == sorted(given, key=repr)
    twice = {(k,) for k in range(0, 5000, 7)} | {(None,)}
    assert not twice & set(tuples(single, "k"))
    # some rows that share a bit with a repeated key are among the others, most are not
    assert single.count() > (0.9 if bits == 2**15 else 0.999) * (len(given) - 2 * len(twice))
    assert "hashpartitioning(k" not in plan(single) + plan(several)


@pytest.mark.parametrize("buckets", [None, 3])
def test_loads_with_too_many_repeated_keys_are_those_with_few(spark, monkeypatch, tmp_path, buckets):
    orders = [order(str(k), "1", "1") for k in range(1, 60)] + [order(str(k), "1", "1", "cancelled") for k in range(1, 60, 3)]
    again = [order(str(k), "1", "1", "processing") for k in range(40, 80)] + [order(str(k), "2", "1") for k in range(50, 90)]
    found = []
    for most in (1_000_000, 2):
        monkeypatch.setattr(staging_module, "MOST_KEYS", most)
        vault = StoredVault(spark, f"{tmp_path}/v{most}", buckets=buckets)
        for day, rows in ((DAY_1, orders), (DAY_2, again)):
            load = Load(spark, vault, day, Staging(spark))
            load.run(batch(spark, orders=rows, customers=CUSTOMER_ROWS, products=[product("1")]))
            assert most > 2 or "_marks" in spark.read.parquet(f"{load.staging.root}/keys_orders_marks").columns
        tables = {name: vault[name] for name in vault} | {"log": vault.rejects(), "current": vault.current("sat_order")}
        found.append({name: tuples(table, *table.columns) for name, table in tables.items()})
    assert found[0] == found[1]
    assert len(found[0]["current"]) == 89 and len(found[0]["sat_order"]) > 89


def test_latest_versions_are_shuffled_as_fingerprints(spark):
    staging = Staging(spark)
    rows = staging.put("rows", accepted(spark, CUSTOMERS, [customer(str(k)) for k in range(9)]))
    changed = staging.put("changed", accepted(spark, CUSTOMERS, [customer(str(k), city="Rome" if k < 12 else "Oslo") for k in range(7, 15)]))
    latest = staging.put("latest", new_sat_rows(rows, CUSTOMERS, DAY_1)).hint("merge")
    repeated = staging.repeats("keys", changed, ["customer_id"])
    found = new_sat_rows(changed, CUSTOMERS, DAY_2, latest=latest, repeated=repeated)
    expected = new_sat_rows(changed, CUSTOMERS, DAY_2, latest)
    assert tuples(found, *expected.columns) == tuples(expected, *expected.columns) and expected.count() == 8
    sent = shuffled_columns(found, "_stored")
    assert sent and not any("customer_hk#" in line for line in sent)


def test_a_snapshot_shuffles_only_what_may_have_changed(spark, monkeypatch, tmp_path):
    vault = StoredVault(spark, f"{tmp_path}/v")
    Load(spark, vault, DAY_1, Staging(spark)).run(batch(spark, customers=CUSTOMER_ROWS))
    kept = []
    monkeypatch.setattr(vault_module, "parted", lambda *given: kept.append(parted(*given)) or kept[-1])
    Load(spark, vault, DAY_2, Staging(spark)).run(batch(spark, customers=[customer("1", city="Rome"), customer("99")]))
    single, several = next(k for k in kept if "customer_hk" in k[0].columns)
    assert several.count() == 1 and single.count() == vault["sat_customer"].count() - 3
    assert not shuffled_columns(single, "full_name")


def test_only_rows_near_failing_ids_are_joined_with_them(spark):
    link = LINKS["link_payment_order"]
    rows = [payment(str(k), "777" if k % 5 == 0 else str(k)) for k in range(1, 50)] + [payment("90", None), payment("91", "x")]
    staging = Staging(spark)
    rows = staging.put("rows", accepted(spark, link.entity, [*rows, rows[4]]))
    checked = staging.put("checked", rows.selectExpr("payment_id", "order_id", "if(order_id = 777, 'order_id', NULL) AS missing_type").distinct())
    near = rows_near(rows, checked.filter("missing_type IS NOT NULL"), link)
    assert near.count() == 10 and "hashpartitioning(payment_id" not in plan(near)
    expected, found = (missing_references(r, checked, link, DAY_1) for r in (rows, near))
    assert tuples(found, *found.columns) == tuples(expected, *found.columns) and found.count() == 10
