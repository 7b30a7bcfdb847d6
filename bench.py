"""Time a full load, a second load and every analytics query; print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import re
import tempfile
import time
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tallyvault.model import ENTITIES
from tallyvault.plans import analytics
from tallyvault.plans.pipeline import Load
from tallyvault.plans.staging import Staging
from tallyvault.plans.vault import StoredVault
from tallyvault.queries import CHANGES, RATES, registry
from tallyvault.session import configured
from tallyvault.sources.bindings import next_batch, raw_entities

# Single operators, timed from the raw tables; every row of each result is produced.
OPERATORS = [
    "row_hash_orders",
    "clean_customers",
    "clean_orders",
    "clean_events",
    "rejects_warn_orders",
    "hub_order",
    "sat_order",
    "sat_incremental_order",
    "link_order_customer_product",
    "missing_references_payments",
]


def session(work: str) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.checkpoint.dir", f"{work}/checkpoint")
    )
    spark = configured(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def produce(result: DataFrame) -> None:
    result.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    # on a cluster, BENCH_WORK is a folder that all executors reach
    work = tempfile.mkdtemp(prefix="bench-", dir=os.environ.get("BENCH_WORK"))
    spark = session(work)
    seconds: dict[str, float] = {}

    def timed(name: str, job: Callable[[], object]) -> None:
        start = time.perf_counter()
        job()
        seconds[name] = round(time.perf_counter() - start, 3)

    # start the executor threads and load the classes that any job needs
    produce(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count())

    raw = raw_entities(spark, sf_dir)
    later = {n: next_batch(raw[n], e, *CHANGES[n]) for n, e in ENTITIES.items()}
    rows: dict[str, int] = {}

    def load_twice(vault: StoredVault, prefix: str) -> None:
        for number, batch in ((1, raw), (2, later)):
            staging = Staging(spark)
            load = Load(spark, vault, datetime(2026, 1, number), staging)
            timed(f"{prefix}load{number}_stage", lambda: load.stage(batch))
            rows[f"{prefix}load{number}"] = sum(t.agg({"copies": "sum"}).first()[0] for t in load.parsed.values())
            timed(f"{prefix}load{number}_rejects", load.log_rejects)
            timed(f"{prefix}load{number}_hubs", load.load_hubs)
            timed(f"{prefix}load{number}_satellites", load.load_satellites)
            timed(f"{prefix}load{number}_links", load.load_links)
            vault.set_complete(load.load_id)
            staging.drop()

    vault = StoredVault(spark, f"{work}/vault", buckets=int(os.environ.get("BENCH_CPUS", "8")))
    load_twice(vault, "")

    reports = {
        "top_customers_lucrative": lambda: analytics.get_top_customers(vault, "RUB", RATES),
        "monthly_revenue": lambda: analytics.get_monthly_revenue(vault, "RUB", RATES),
        **{
            f"top_products_{by}": lambda by=by: analytics.top_products(vault, by, 10)
            for by in analytics.TOP_PRODUCTS
        },
        **{
            f"top_customers_{by}": lambda by=by: analytics.top_customers(vault, by, 5)
            for by in analytics.TOP_CUSTOMERS
        },
        "customers_without_orders": lambda: analytics.get_customers_without_orders(vault),
    }
    for name, report in reports.items():
        timed(name, lambda: produce(report()))

    queries = registry()
    for name in OPERATORS:
        timed(name, lambda: produce(queries[name](spark, sf_dir)))

    # the same loads into a vault without buckets, beside the total
    total = sum(seconds.values())
    load_twice(StoredVault(spark, f"{work}/plain"), "plain_")
    speed = {
        name: round(rows[name.rsplit("_", 1)[0]] / took)
        for name, took in seconds.items()
        if name.rsplit("_", 1)[0] in rows
    }

    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "load_and_analytics_total",
                "value": round(total, 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": speed,
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
