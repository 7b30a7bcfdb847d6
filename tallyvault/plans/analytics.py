"""Analytics over a vault. Every function returns a DataFrame.

A vault is anything that maps a table name to a DataFrame. While a plan is built, hot keys of the
links are looked up (in the sketches a stored vault keeps, else in one pass over the link), and a top
list of customers is found; all else is lazy. Ties in a top-N are broken by the smaller id, so results
are repeatable.

Facts are aggregated before they meet a table on a key that may be hot (an order with very many
payments, a customer with very many orders). A link may hold very many rows of one order or event,
so links meet their satellites in a join that splits such keys.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyvault.functions.currency import Rates, converted_totals, known_currencies
from tallyvault.functions.exact import added, amount_sums, by_size
from tallyvault.model import CUSTOMERS, EVENTS, ORDERS, PAYMENTS, PRODUCTS, Entity
from tallyvault.operators.satellites import latest_version
from tallyvault.operators.skew import HotKeys, hot_keys, lookup_join

Vault = Mapping[str, DataFrame]

EVENT_LINK = "link_event_customer_product"
ORDER_LINK = "link_order_customer_product"
PAYMENT_LINK = "link_payment_order"


def _latest(vault: Vault, entity: Entity, *columns: str) -> DataFrame:
    """(hk, *columns) of the newest versions: the snapshot a stored vault keeps, else out of all versions."""
    snapshot = vault.current(entity.sat) if hasattr(vault, "current") else None
    if snapshot is not None:
        return snapshot.select(entity.hk, *columns)
    sat = vault[entity.sat].select(entity.hk, "load_datetime", *columns)
    return latest_version(sat, entity.hk).drop("load_datetime")


def _latest_of(vault: Vault, entity: Entity, column: str, keys: DataFrame) -> DataFrame:
    """(hk, column) of the newest versions of some keys; without a snapshot, only their versions
    reach the window that finds the latest one."""
    keys = keys.select(entity.hk)
    if hasattr(vault, "current") and (snapshot := vault.current(entity.sat)) is not None:
        return snapshot.select(entity.hk, column).join(keys, entity.hk, "left_semi")
    versions = vault[entity.sat].select(entity.hk, "load_datetime", column).join(keys, entity.hk, "left_semi")
    return latest_version(versions, entity.hk).drop("load_datetime")


def _named(vault: Vault, entity: Entity, name: str) -> DataFrame:
    """(hk, id, latest name) of an entity."""
    hub = vault[entity.hub].select(entity.hk, entity.key)
    return _latest(vault, entity, name).join(hub, entity.hk)


def _linked(
    vault: Vault, link: str, entity: Entity, columns: list[str], lookup: DataFrame
) -> DataFrame:
    """Rows of a link (``columns``) joined with one row per key of its own entity."""
    rows = vault[link].select("link_hk", entity.hk, *columns)
    hot = _hot_keys(vault, link, entity)
    return lookup_join(rows, lookup, [entity.hk], ["link_hk"], hot=hot).drop("link_hk")


def _hot_keys(vault: Vault, link: str, entity: Entity) -> HotKeys:
    known = getattr(vault, "hot_keys", None)
    found = known(link, entity.hk) if known else None
    return hot_keys(vault[link], [entity.hk])[0] if found is None else found


def _completed_orders(vault: Vault) -> DataFrame:
    return _latest(vault, ORDERS, "status").filter(F.col("status") == "completed").select("order_hk")


def _events_of_type(vault: Vault, event_type: str) -> DataFrame:
    of_type = F.col("event_type") == event_type
    return _latest(vault, EVENTS, "event_type").filter(of_type).select("event_hk")


def _positive(n: int) -> int:
    if n < 1:
        raise ValueError(f"a top list needs one place or more, got {n}")
    return n


# --- money -----------------------------------------------------------------------------------


def _paid_per_order(
    vault: Vault, preferred_currency: str, exchange_rates: Rates | None, by: dict[str, Column]
) -> DataFrame:
    """Payment sums per order, currency (and ``by``) by place, completed orders only.

    Payments without a known rate are left out. Sums are taken per order first: an order may own
    any number of payments, and the order satellite and link then join few rows per key.
    """
    known = F.col("currency").isin(known_currencies(preferred_currency, exchange_rates))
    paid = (
        _latest(vault, PAYMENTS, "amount", "amount_wide", "currency", "payment_timestamp")
        .filter(known)
        .filter("amount IS NOT NULL OR amount_wide IS NOT NULL")
        .select("payment_hk", "currency", "amount", "amount_wide", *[c.alias(n) for n, c in by.items()])
    )
    linked = _linked(vault, PAYMENT_LINK, PAYMENTS, ["order_hk"], paid)
    sums = amount_sums(linked, ["order_hk", "currency", *by], "amount", "amount_wide")
    return sums.join(_completed_orders(vault), "order_hk")


def get_top_customers(
    vault: Vault, preferred_currency: str, exchange_rates: Rates | None = None, top_n: int = 10
) -> DataFrame:
    """Customers by money paid for completed orders: customer_id, full_name, total_spent.

    total_spent is exact at any size, as plain text; see ``converted_totals``.
    """
    paid = _paid_per_order(vault, preferred_currency, exchange_rates, by={})
    parts = added(_linked(vault, ORDER_LINK, ORDERS, ["customer_hk"], paid), ["customer_hk", "currency"])
    spent = converted_totals(parts, ["customer_hk"], preferred_currency, exchange_rates, "total_spent")
    return (
        spent.join(_named(vault, CUSTOMERS, "full_name"), "customer_hk")
        .select("customer_id", "full_name", "total_spent")
        .orderBy(*by_size("total_spent"), "customer_id")
        .limit(top_n)
    )


def get_monthly_revenue(
    vault: Vault, preferred_currency: str, exchange_rates: Rates | None = None
) -> DataFrame:
    """Money paid for completed orders by payment month: month, total_revenue.

    total_revenue is exact at any size, as plain text.
    """
    month = F.trunc(F.to_date("payment_timestamp"), "month")
    paid = _paid_per_order(vault, preferred_currency, exchange_rates, by={"month": month})
    parts = added(paid.filter(F.col("month").isNotNull()), ["month", "currency"])
    return converted_totals(parts, ["month"], preferred_currency, exchange_rates, "total_revenue").orderBy("month")


# --- products --------------------------------------------------------------------------------


def _most_popular(vault: Vault, facts: DataFrame, n: int) -> DataFrame:
    counts = facts.groupBy("product_hk").agg(F.count(F.lit(1)).alias("popularity"))
    return (
        counts.join(_named(vault, PRODUCTS, "product_name"), "product_hk")
        .orderBy(F.desc("popularity"), "product_id")
        .limit(n)
        .select(F.col("product_id").cast("string").alias("product_id"), "product_name", "popularity")
    )


def _top_products_by_event(vault: Vault, event_type: str, n: int) -> DataFrame:
    events = _events_of_type(vault, event_type)
    return _most_popular(vault, _linked(vault, EVENT_LINK, EVENTS, ["product_hk"], events), n)


def get_top_products_by_views(vault: Vault, n: int = 10) -> DataFrame:
    return _top_products_by_event(vault, "view", n)


def get_top_products_by_clicks(vault: Vault, n: int = 10) -> DataFrame:
    return _top_products_by_event(vault, "click", n)


def get_top_products_by_purchases(vault: Vault, n: int = 10) -> DataFrame:
    return _top_products_by_event(vault, "purchase", n)


def get_top_products_by_completed_orders(vault: Vault, n: int = 10) -> DataFrame:
    orders = _completed_orders(vault)
    return _most_popular(vault, _linked(vault, ORDER_LINK, ORDERS, ["product_hk"], orders), n)


# --- customers -------------------------------------------------------------------------------


def _most_active(vault: Vault, facts: DataFrame, count_name: str, n: int) -> DataFrame:
    """The n customers with most facts, their names and the date of their last event.

    The list is cut before names and dates are looked up, so both lookups read for n customers.
    """
    counts = facts.groupBy("customer_hk").agg(F.count(F.lit(1)).alias(count_name))
    hub = vault[CUSTOMERS.hub].select("customer_hk", "customer_id")
    ranked = counts.join(hub, "customer_hk").orderBy(F.desc(count_name), "customer_id").limit(n)
    # the n rows of the list itself; a local table, as three lookups read it
    top = ranked.sparkSession.createDataFrame(ranked.collect(), ranked.schema)
    names = _latest_of(vault, CUSTOMERS, "full_name", top)
    their_events = (
        vault[EVENT_LINK]
        .select("link_hk", "event_hk", "customer_hk")
        .join(top.select("customer_hk"), "customer_hk", "left_semi")
    )
    of_theirs = _latest_of(vault, EVENTS, "event_timestamp", their_events.select("event_hk").distinct())
    last_action = (
        lookup_join(
            their_events,
            of_theirs,
            ["event_hk"],
            ["link_hk"],
            hot=_hot_keys(vault, EVENT_LINK, EVENTS),
        )
        .groupBy("customer_hk")
        .agg(F.to_date(F.max("event_timestamp")).alias("last_action_date"))
    )
    return (
        names.join(top, "customer_hk")
        .join(last_action, "customer_hk", "left")
        .select("customer_id", "full_name", count_name, "last_action_date")
        .orderBy(F.desc(count_name), "customer_id")
    )


def get_top_customers_by_orders(vault: Vault, n: int = 5) -> DataFrame:
    completed = _linked(vault, ORDER_LINK, ORDERS, ["customer_hk"], _completed_orders(vault))
    return _most_active(vault, completed, "order_count", n)


def get_top_customers_by_purchases(vault: Vault, n: int = 5) -> DataFrame:
    events = _events_of_type(vault, "purchase")
    purchases = _linked(vault, EVENT_LINK, EVENTS, ["customer_hk"], events)
    return _most_active(vault, purchases, "purchase_count", n)


def get_customers_without_orders(vault: Vault, n: int | None = None) -> DataFrame:
    """Customers no order links to, by id; all of them unless ``n`` is given."""
    ordering = vault[ORDER_LINK].select("customer_hk").distinct()
    idle = (
        _named(vault, CUSTOMERS, "full_name")
        .join(ordering, "customer_hk", "left_anti")
        .select("customer_id", "full_name")
        .orderBy("customer_id")
    )
    return idle if n is None else idle.limit(n)


# --- metric selection ------------------------------------------------------------------------

TOP_PRODUCTS: dict[str, Callable[[Vault, int], DataFrame]] = {
    "views": get_top_products_by_views,
    "clicks": get_top_products_by_clicks,
    "purchases": get_top_products_by_purchases,
    "orders": get_top_products_by_completed_orders,
}
TOP_CUSTOMERS: dict[str, Callable[[Vault, int], DataFrame]] = {
    "orders": get_top_customers_by_orders,
    "purchases": get_top_customers_by_purchases,
}


def _choose(table: Mapping[str, Callable[[Vault, int], DataFrame]], by: str):
    if by not in table:
        raise ValueError(f"no metric {by!r}, choose from {list(table)}")
    return table[by]


def top_products(vault: Vault, by: str, n: int = 5) -> DataFrame:
    return _choose(TOP_PRODUCTS, by)(vault, _positive(n))


def top_customers(vault: Vault, by: str, n: int = 5) -> DataFrame:
    return _choose(TOP_CUSTOMERS, by)(vault, _positive(n))
