"""Outputs of a run: the structure report and one CSV per analytics query."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyvault.functions.currency import Rates, normalised_rates
from tallyvault.model import ENTITIES, LINKS, REJECTS, VAULT_SCHEMAS
from tallyvault.plans import analytics
from tallyvault.plans.analytics import Vault
from tallyvault.plans.pipeline import Load
from tallyvault.plans.staging import run_together

SAMPLE_ROWS = 5


def structure_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """table_name, row_count for each table, as one job."""
    counts = [
        table.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def reported_tables(load: Load) -> dict[str, DataFrame]:
    """The nineteen tables of the report: cleaned, reject log, hubs, satellites, links."""
    tables = {f"cleaned.{e.name}": load.cleaned(e) for e in ENTITIES.values()}
    tables[f"logs.{REJECTS}"] = load.vault.rejects()
    names = [
        *(e.hub for e in ENTITIES.values()),
        *(e.sat for e in ENTITIES.values()),
        *LINKS,
    ]
    assert set(names) == set(VAULT_SCHEMAS)
    return tables | {f"dwh.{name}": load.vault[name] for name in names}


def structure_report(tables: Mapping[str, DataFrame]) -> list[str]:
    """Lines of the report: count, header and a few sample rows per table.

    A table that cannot be read is noted and the rest goes on.
    """

    def describe(name: str, table: DataFrame) -> list[str]:
        try:
            count, sample = table.count(), table.limit(SAMPLE_ROWS).collect()
        except Exception as error:
            return [f"{name} throws error", type(error).__name__, ""]
        values = [",".join("" if v is None else str(v) for v in row) for row in sample]
        return [f"{name}: {count}", ",".join(table.columns), *values, ""]

    described = run_together(partial(describe, name, table) for name, table in tables.items())
    return [line for lines in described for line in lines]


def write_lines(spark: SparkSession, lines: list[str], path: str) -> None:
    numbered = spark.createDataFrame(list(enumerate(lines)), "n int, value string")
    numbered.coalesce(1).sortWithinPartitions("n").select("value").write.mode("overwrite").text(path)


def check_choices(
    preferred_currency: str, rates: Rates | None, top_products_by: str, top_customers_by: str
) -> None:
    """Raise ValueError for arguments the queries would refuse, before anything is loaded."""
    if top_products_by not in analytics.TOP_PRODUCTS:
        raise ValueError(f"top products by must be one of {list(analytics.TOP_PRODUCTS)}")
    if top_customers_by not in analytics.TOP_CUSTOMERS:
        raise ValueError(f"top customers by must be one of {list(analytics.TOP_CUSTOMERS)}")
    normalised_rates(preferred_currency, rates)


def default_queries(
    vault: Vault,
    preferred_currency: str = "RUB",
    rates: Rates | None = None,
    top_products_by: str = "views",
    top_customers_by: str = "orders",
) -> dict[str, Callable[[], DataFrame]]:
    """The five queries of a run."""
    return {
        "top_most_lucrative": lambda: analytics.get_top_customers(
            vault, preferred_currency, rates, 10
        ),
        "monthly_revenue": lambda: analytics.get_monthly_revenue(vault, preferred_currency, rates),
        "top_products": lambda: analytics.top_products(vault, top_products_by, 10),
        "top_customers_last_date": lambda: analytics.top_customers(vault, top_customers_by, 5),
        "customers_without_orders": lambda: analytics.get_customers_without_orders(vault),
    }


def write_analytics(
    spark: SparkSession,
    queries: Mapping[str, Callable[[], DataFrame]],
    output: str,
    run_stamp: str,
) -> dict[str, str]:
    """Write each result to ``<output>/<name>_<stamp>.csv``; returns the errors by name.

    Results are written by the executors and never pass through the driver. A query that fails
    leaves a ``.error`` file and the others still run.
    """
    errors: dict[str, str] = {}
    for name, query in queries.items():
        target = f"{output}/{name}_{run_stamp}"
        try:
            query().write.mode("overwrite").option("header", True).csv(f"{target}.csv")
        except Exception as error:
            errors[name] = str(error)
            write_lines(spark, [f"Query: {name}", f"Error: {error}"], f"{target}.error")
    return errors
