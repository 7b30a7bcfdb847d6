from __future__ import annotations

import json
from datetime import datetime
from pathlib import Path

import pytest

from tallyvault.__main__ import arguments, main, run
from tallyvault.plans.report import default_queries, structure_report, write_analytics
from tallyvault.plans.staging import Staging, shared_folder
from tallyvault.plans.vault import StoredVault

from .support import customer, event, order, payment, product

NOW = datetime(2026, 6, 19, 2, 36, 21)


def csv_text(header, rows, separator=","):
    lines = [header] + [separator.join("" if v is None else v for v in row) for row in rows]
    return "\n".join(lines) + "\n"


@pytest.fixture(scope="module")
def inputs(tmp_path_factory):
    folder = tmp_path_factory.mktemp("inputs")
    (folder / "customers.csv").write_text(
        csv_text(
            "customer_id,full_name,email,phone,city,created_at",
            [customer(str(i)) for i in range(1, 5)] + [customer("1"), customer("UNKNOWN")],
        )
    )
    (folder / "products.csv").write_text(
        csv_text(
            "product_id,product_name,category,price,currency,is_active",
            [product("1"), product("2", '"red, small"')],
        )
    )
    (folder / "payments.csv").write_text(
        csv_text(
            "payment_id^order_id^payment_method^amount^currency^payment_timestamp",
            [payment("1", "1"), payment("2", "2", "2.50", "USD"), payment("3", "77")],
            "^",
        )
    )
    keys = "order_id customer_id product_id quantity unit_price currency order_timestamp status"
    orders = [order("1", "1", "1"), order("2", "2", "2"), order("3", None, "2")]
    (folder / "orders.json").write_text(
        json.dumps([dict(zip(keys.split(), o)) for o in orders], indent=1)
    )
    tags = "event_id customer_id event_type event_timestamp product_id".split()
    elements = [
        "<event>" + "".join(f"<{t}>{v}</{t}>" for t, v in zip(tags, e)) + "</event>"
        for e in [event("1", "1", "1"), event("2", "2", "2"), event("BAD_ID", "2", "2")]
    ]
    (folder / "events.xml").write_text("<events>" + "\n".join(elements) + "</events>")
    return folder


def command(inputs, tmp_path, *extra):
    paths = [
        f"--{name.split('.')[0]}-path={inputs / name}"
        for name in ("customers.csv", "products.csv", "payments.csv", "orders.json", "events.xml")
    ]
    return [f"--vault={tmp_path}/vault", f"--output={tmp_path}/out", *paths, *extra]


def lines(folder):
    found = [p.read_text().splitlines() for p in sorted(folder.glob("part-*"))]
    return [line for part in found for line in part]


def test_runs_from_files_to_reports(spark, inputs, tmp_path):
    args = arguments().parse_args(command(inputs, tmp_path))
    assert run(spark, args, NOW) == {}
    out = tmp_path / "out"

    report = lines(out / "structure_example_20260619_023621.txt")
    counts = dict(line.split(": ") for line in report if ": " in line and "{" not in line)
    assert len(counts) == 19
    assert counts["cleaned.customers"] == "4" and counts["cleaned.events"] == "3"
    assert counts["dwh.hub_event"] == "2" and counts["dwh.sat_order"] == "3"
    assert counts["dwh.link_order_customer_product"] == "2"
    # fatal 1, copies 2, null customer 1, bad event id 1, missing order 1
    assert counts["logs.rejected_records"] == "6"

    assert lines(out / "top_most_lucrative_20260619_023621.csv") == [
        "customer_id,full_name,total_spent",
        "2,Anna Lee,187.5",
        "1,Anna Lee,10.5",
    ]
    assert lines(out / "monthly_revenue_20260619_023621.csv") == [
        "month,total_revenue",
        "2024-02-01,198",
    ]
    assert lines(out / "top_products_20260619_023621.csv") == [
        "product_id,product_name,popularity",
        "1,lamp,1",
        '2,"red, small",1',
    ]
    assert lines(out / "top_customers_last_date_20260619_023621.csv") == [
        "customer_id,full_name,order_count,last_action_date",
        "1,Anna Lee,1,2024-03-01",
        "2,Anna Lee,1,2024-03-01",
    ]
    assert lines(out / "customers_without_orders_20260619_023621.csv") == [
        "customer_id,full_name",
        "3,Anna Lee",
        "4,Anna Lee",
    ]
    assert not list(Path(shared_folder(spark)).glob("staging-*"))

    # a second run adds to the log only
    vault = StoredVault(spark, f"{tmp_path}/vault")
    run(spark, args, NOW.replace(hour=3))
    assert vault["hub_customer"].count() == 4
    assert vault.rejects().count() == 12

    # a reset starts over; here an explicit JSON null also counts as the text None
    extra = ("--reset-db", "--json-null-token=None")
    run(spark, arguments().parse_args(command(inputs, tmp_path, *extra)), NOW.replace(hour=4))
    assert vault.rejects().count() == 6
    assert vault["sat_customer"].select("load_datetime").distinct().count() == 1
    (record,) = vault.rejects().filter("source_table = 'orders'").collect()
    assert json.loads(record["raw_payload"])["customer_id"] == "None"
    assert json.loads(record["error_details"])["details"]["customer_id_format"] == "invalid"


@pytest.mark.parametrize(
    "extra",
    [
        ["--events-path=/nowhere/events.xml"],
        ["--top_products_by=likes"],
        ["--top_customers_last_date_by=views"],
        ["--usd=0"],
    ],
)
def test_bad_arguments_stop_before_anything_is_written(spark, inputs, tmp_path, extra, monkeypatch):
    args = arguments().parse_args(command(inputs, tmp_path, *extra))
    with pytest.raises(Exception, match="PATH_NOT_FOUND|must be"):
        run(spark, args, NOW)
    assert not list(tmp_path.iterdir())


def test_the_command_reports_a_missing_file(spark, inputs, tmp_path, capsys):
    code = main(command(inputs, tmp_path, "--orders-path=/nowhere/orders.json"))
    assert code == 1
    assert "/nowhere/orders.json" in capsys.readouterr().err


def test_a_failing_query_leaves_the_others_alone(spark, tmp_path):
    queries = {
        "bad": lambda: spark.sql("SELECT cast(raise_error('no luck') AS string) AS x"),
        "good": lambda: spark.sql("SELECT 1 AS x, cast(NULL AS string) AS y, 'a,b' AS z"),
    }
    errors = write_analytics(spark, queries, str(tmp_path), "now")
    assert list(errors) == ["bad"]
    assert "no luck" in "".join(lines(tmp_path / "bad_now.error"))
    assert lines(tmp_path / "good_now.csv") == ["x,y,z", '1,,"a,b"']


def test_an_unreadable_table_is_noted(spark):
    broken = spark.range(1).selectExpr("raise_error('broken') AS x").filter("x IS NULL")
    report = structure_report({"a": broken, "b": spark.range(2)})
    assert report[0] == "a throws error"
    assert "b: 2" in report


def test_default_queries_are_the_five_of_a_run():
    assert list(default_queries({})) == [
        "top_most_lucrative",
        "monthly_revenue",
        "top_products",
        "top_customers_last_date",
        "customers_without_orders",
    ]


def test_staging_lives_in_the_shared_folder(spark):
    staging = Staging(spark)
    assert staging.root.startswith(shared_folder(spark))
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    stored = staging.put("t", spark.range(5))
    assert stored.count() == 5
    staging.drop()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{staging.root}/t")
