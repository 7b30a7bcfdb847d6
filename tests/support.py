"""Small inputs and shortcuts shared by the tests."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tallyvault.model import ENTITIES, Entity
from tallyvault.operators.cleaning import accepted_rows, collapse_copies, parse, with_row_hash

DAY_1 = datetime(2026, 1, 1)
DAY_2 = datetime(2026, 1, 2)
DAY_3 = datetime(2026, 1, 3)


def raw(spark: SparkSession, entity: Entity, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, entity.raw_schema)


def parsed(spark: SparkSession, entity: Entity, rows: list[tuple]) -> DataFrame:
    hashed = with_row_hash(raw(spark, entity, rows), entity)
    return parse(collapse_copies(hashed, entity), entity)


def accepted(spark: SparkSession, entity: Entity, rows: list[tuple]) -> DataFrame:
    return accepted_rows(parse(with_row_hash(raw(spark, entity, rows), entity), entity), entity)


def tuples(rows: DataFrame, *columns: str) -> list[tuple]:
    return sorted((tuple(r) for r in rows.select(*columns).collect()), key=repr)


def customer(key, name="Anna Lee", city="Oslo") -> tuple:
    return (key, name, f"c{key}@example.com", "+7 (900) 123-45-67", city, "2024-01-31")


def product(key, name="lamp") -> tuple:
    return (key, name, "Home", "10.50", "RUB", "yes")


def order(key, customer_id, product_id, status="completed") -> tuple:
    return (key, customer_id, product_id, "1", "10.50", "RUB", "2024-02-01 10:00:00", status)


def payment(key, order_id, amount="10.50", currency="RUB", at="2024-02-01 10:00:00") -> tuple:
    return (key, order_id, "card", amount, currency, at)


def event(key, customer_id, product_id, kind="view", at="2024-03-01 10:00:00") -> tuple:
    return (key, customer_id, kind, at, product_id)


def batch(spark: SparkSession, **rows: list[tuple]) -> dict[str, DataFrame]:
    """Raw entities; those not given are empty."""
    return {name: raw(spark, e, rows.get(name, [])) for name, e in ENTITIES.items()}


def details(records: DataFrame) -> list[dict]:
    found = [json.loads(r["error_details"]) for r in records.collect()]
    return sorted(found, key=repr)
