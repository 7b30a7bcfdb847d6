"""The benchmark tables seen as raw business data, dirt included.

Pure projections of the whole tables into text columns: the key's remainders decide which rows
get placeholder names, bad dates, missing references and so on. Money goes through decimal(18,2)
so that no text of a double enters a hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyvault.model import Entity


# The columns used, with their types: reading with a given schema needs no job to find it.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_name string, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, props string",
}


# Keys that no row should have, by the key's remainder: missing, empty, blank and not a number.
_ODD_KEY = "CASE k % 71 WHEN 1 THEN NULL WHEN 2 THEN '' WHEN 3 THEN ' ' WHEN 4 THEN concat('x', k) ELSE {key} END"
# Sums that need many digits; the last four need more than a decimal has, two of them by their sum.
_ODD_SUM = """CASE k % 53 WHEN 1 THEN '0.00004' WHEN 2 THEN '1.00005' WHEN 3 THEN '123456789012345.5'
    WHEN 4 THEN '0.0000000000000000004' WHEN 5 THEN '6e19' WHEN 6 THEN '+060000000000000000000.50'
    WHEN 7 THEN '1234567890123456789012345678901234567890.1234567890123456789012' WHEN 8 THEN '-7e40'
    ELSE {sum} END"""


def _key(text: str = "cast(k as string)") -> str:
    return _ODD_KEY.format(key=text)


def _sum(text: str) -> str:
    return _ODD_SUM.format(sum=text)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers; every fiftieth row comes twice."""
    nation = _table(spark, sf_dir, "nation")
    customer = _table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS k",
        "c_name",
        "c_nationkey AS n_nationkey",
        "explode(if(c_custkey % 50 = 0, array(1, 2), array(1))) AS copy",
    )
    return (
        customer.join(nation, "n_nationkey", "left")
        .selectExpr(
            f"{_key("if(k % 97 = 0, 'UNKNOWN', cast(k as string))")} AS customer_id",
            """CASE k % 5 WHEN 0 THEN '  ivan IVANOV ' WHEN 1 THEN 'mr. John Smith'
               WHEN 2 THEN 'John  Smith' WHEN 3 THEN c_name ELSE 'Anna Maria Lee' END
               AS full_name""",
            """CASE k % 4 WHEN 0 THEN concat('user', cast(k as string), '@example.com')
               WHEN 1 THEN 'UNKNOWN' WHEN 2 THEN 'bad@' END AS email""",
            """CASE k % 4 WHEN 0 THEN concat('+7 (900) ', lpad(cast(k as string), 7, '0'))
               WHEN 1 THEN '123-45' WHEN 2 THEN 'x123' END AS phone""",
            "CASE WHEN k % 11 = 0 THEN 'UNKNOWN' WHEN k % 61 = 5 THEN '' ELSE n_name END AS city",
            """CASE k % 4 WHEN 0 THEN '2024-02-28' WHEN 1 THEN '28.02.2024'
               WHEN 2 THEN '31.02.2024' ELSE 'UNKNOWN' END AS created_at""",
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "k")
    return part.selectExpr(
        f"{_key()} AS product_id",
        "if(k % 13 = 0, concat('  ', p_name, ' '), p_name) AS product_name",
        """CASE k % 6 WHEN 0 THEN 'Home' WHEN 1 THEN 'Books' WHEN 2 THEN 'Electronics'
           WHEN 3 THEN 'Clothing' WHEN 4 THEN 'Sports' ELSE if(k % 12 = 5, '', 'Toys') END
           AS category""",
        f"{_sum("if(k % 31 = 0, 'N/A', cast(cast(p_retailprice as decimal(18,2)) as string))")} AS price",
        "CASE k % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'RUB' ELSE 'GBP' END AS currency",
        """CASE k % 5 WHEN 0 THEN 'True' WHEN 1 THEN 'False' WHEN 2 THEN 'yes' WHEN 3 THEN '0'
           ELSE 'maybe' END AS is_active""",
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the smallest part and the total quantity of their line items."""
    items = (
        _table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("k"))
        .agg(F.min("l_partkey").alias("part"), F.sum("l_quantity").alias("quantity"))
    )
    order = _table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "k")
    return order.join(items, "k", "left").selectExpr(
        f"{_key()} AS order_id",
        "if(k % 17 = 0 OR o_custkey % 10 = 3, NULL, cast(o_custkey as string)) AS customer_id",
        "cast(part as string) AS product_id",
        "if(k % 19 = 0, '0', cast(cast(quantity as int) as string)) AS quantity",
        f"{_sum('cast(cast(o_totalprice as decimal(18,2)) as string)')} AS unit_price",
        "CASE k % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'RUB' END AS currency",
        """if(k % 23 = 0, '2025-99-99', substr(cast(o_orderdate as string), 1, 19))
           AS order_timestamp""",
        """CASE WHEN k % 29 = 0 THEN 'unknown' WHEN o_orderstatus = 'F' THEN 'completed'
           WHEN o_orderstatus = 'O' THEN 'processing' WHEN o_orderstatus = 'P' THEN 'cancelled'
           END AS status""",
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment per order; every thirteenth points to an order that does not exist."""
    order = (
        _table(spark, sf_dir, "orders")
        .withColumnRenamed("o_orderkey", "k")
        .withColumn("day", F.expr("cast(o_orderdate as string)"))
    )
    return order.selectExpr(
        f"{_key('cast(k + 1 as string)')} AS payment_id",
        "cast(if(k % 13 = 0, k + 10000000, k) as string) AS order_id",
        """CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'card' WHEN '2' THEN 'paypal'
           WHEN '3' THEN 'bank_transfer' ELSE 'cash' END AS payment_method""",
        f"{_sum("if(k % 37 = 0, 'error_amount', cast(cast(o_totalprice as decimal(18,2)) as string))")} AS amount",
        "CASE k % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'RUB' END AS currency",
        """CASE WHEN k % 41 = 0 THEN '13/45/2025'
           WHEN k % 5 = 0 THEN concat(substr(day, 9, 2), '.', substr(day, 6, 2), '.', substr(day, 1, 4))
           ELSE substr(day, 1, 19) END AS payment_timestamp""",
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").withColumnRenamed("event_id", "k").selectExpr(
        f"{_key("if(k % 101 = 0, 'BAD_ID', cast(k as string))")} AS event_id",
        "cast(user_id as string) AS customer_id",
        "event_type",
        "if(k % 43 = 0, 'broken-date', substr(cast(ts as string), 1, 19)) AS event_timestamp",
        "get_json_object(props, '$.k') AS product_id",
    )


BINDINGS = {
    "customers": customers,
    "products": products,
    "payments": payments,
    "orders": orders,
    "events": events,
}


def raw_entity(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return BINDINGS[name](spark, sf_dir)


def raw_entities(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: bind(spark, sf_dir) for name, bind in BINDINGS.items()}


def next_batch(raw: DataFrame, entity: Entity, attribute: str, changed_to: str) -> DataFrame:
    """The rows of a following load: one attribute changed where the key divides by 7, and every
    tenth key (remainder 1) also as a new key 10 million higher."""
    key = f"try_cast({entity.key} AS bigint)"
    both_keys = f"array({entity.key}, cast({key} + 10000000 AS string))"
    values = {c: c for c in entity.attributes}
    values[attribute] = f"if({key} % 7 = 0, '{changed_to}', {attribute})"
    return raw.selectExpr(
        f"explode(if({key} % 10 = 1, {both_keys}, array({entity.key}))) AS {entity.key}",
        *[f"{value} AS {c}" for c, value in values.items()],
    )
