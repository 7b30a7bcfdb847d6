"""Analytics against plain Python over the same small history."""

from __future__ import annotations

from collections import Counter, defaultdict
from datetime import date, datetime
from decimal import Decimal, getcontext

import pytest
from pyspark.sql import functions as F

from tallyvault.functions.currency import converted_amount, normalised_rates
from tallyvault.plans import analytics as A
from tallyvault.plans.vault import StoredVault

from .support import DAY_1, DAY_2, customer, event, order, payment, product
from .test_vault import load

STATUSES = ["completed", "processing", "completed", "cancelled", "completed"]
KINDS = ["view", "click", "purchase", "view", "login", "logout"]
MONEY = ["RUB", "USD", "EUR", "GBP"]
RATES = {"RUB": 1, "USD": 75, "EUR": 85}

CUSTOMERS = [customer(str(i), name=f"Name {chr(64 + i)}") for i in range(1, 13)]
PRODUCTS = [product(str(i), name=f"thing {i}") for i in range(1, 8)]
# customers 10-12 order nothing
ORDERS = [
    order(str(i), str(i * i % 9 + 1), str(i % 7 + 1), STATUSES[i % 5]) for i in range(1, 60)
]
PAYMENTS = [
    payment(
        str(i),
        str(i % 59 + 1),
        amount=f"{i * 7 % 100}.{i % 10}",  # amount 0 is rejected
        currency=MONEY[i % 4],
        at=f"2024-{i % 12 + 1:02d}-15 10:00:00" if i % 11 else "bad",
    )
    for i in range(1, 150)
]
EVENTS = [
    event(
        str(i),
        str(i * 3 % 8 + 1),
        str(i * i % 7 + 1),
        KINDS[i % 6],
        f"2024-03-{i % 28 + 1:02d} 10:00:00" if i % 5 else "broken-date",
    )
    for i in range(1, 120)
]
# the second day moves an order to another customer and changes a status, an amount and an event
LATER = {
    "orders": [order("2", "9", "3", "completed"), order("7", "5", "1", "cancelled")],
    "payments": [payment("5", "6", "999.99", "USD", "2024-05-01 00:00:00")],
    "events": [event("3", "4", "3", "view", "2024-06-01 09:00:00")],
    "customers": [customer("1", name="New Name")],
}


@pytest.fixture(scope="module")
def vault(spark, tmp_path_factory):
    stored = StoredVault(spark, str(tmp_path_factory.mktemp("vault")))
    load(
        spark, stored, DAY_1,
        customers=CUSTOMERS, products=PRODUCTS, orders=ORDERS, payments=PAYMENTS, events=EVENTS,
    )
    load(spark, stored, DAY_2, products=PRODUCTS, **LATER)
    return stored


def plain(number):
    return f"{number.normalize():f}"


class Expected:
    """The same history in Python: latest attributes, all links ever seen."""

    names = {int(c[0]): c[1] for c in CUSTOMERS + LATER["customers"]}
    products = {int(p[0]): p[1] for p in PRODUCTS}
    status = {o[0]: o[7] for o in ORDERS + LATER["orders"]}
    order_links = {(o[0], int(o[1]), int(o[2])) for o in ORDERS + LATER["orders"]}
    paid = {p[0]: p for p in PAYMENTS + LATER["payments"]}
    payment_links = {(p[0], p[1]) for p in PAYMENTS + LATER["payments"]}
    events = {e[0]: e for e in EVENTS + LATER["events"]}
    event_links = {(e[0], int(e[1]), int(e[4])) for e in EVENTS + LATER["events"]}

    @classmethod
    def payments(cls, rates):
        for payment_id, order_id in cls.payment_links:
            _, _, _, amount, currency, at = cls.paid[payment_id]
            if cls.status[order_id] == "completed" and Decimal(amount) > 0 and currency in rates:
                yield order_id, at, Decimal(amount) * rates[currency]

    @classmethod
    def spent(cls, rates):
        total = defaultdict(Decimal)
        for order_id, _, amount in cls.payments(rates):
            for linked, customer_id, _ in cls.order_links:
                if linked == order_id:
                    total[customer_id] += amount
        ranked = sorted(total.items(), key=lambda r: (-r[1], r[0]))
        return [(c, cls.names[c], plain(t)) for c, t in ranked]

    @classmethod
    def revenue(cls, rates):
        total = defaultdict(Decimal)
        for _, at, amount in cls.payments(rates):
            if at != "bad":
                total[date(int(at[:4]), int(at[5:7]), 1)] += amount
        return [(month, plain(t)) for month, t in sorted(total.items())]

    @classmethod
    def facts(cls, by):
        if by == "orders":
            return [link for link in cls.order_links if cls.status[link[0]] == "completed"]
        kind = {"views": "view", "clicks": "click", "purchases": "purchase"}[by]
        return [link for link in cls.event_links if cls.events[link[0]][2] == kind]

    @classmethod
    def top_products(cls, by, n):
        found = Counter(p for _, _, p in cls.facts(by)).items()
        rows = sorted(found, key=lambda r: (-r[1], r[0]))[:n]
        return [(str(p), cls.products[p], count) for p, count in rows]

    @classmethod
    def top_customers(cls, by, n):
        last = {}
        for event_id, customer_id, _ in cls.event_links:
            at = cls.events[event_id][3]
            if at != "broken-date":
                last[customer_id] = max(last.get(customer_id, at), at)
        found = Counter(c for _, c, _ in cls.facts(by)).items()
        rows = sorted(found, key=lambda r: (-r[1], r[0]))[:n]
        day = {c: datetime.fromisoformat(at).date() for c, at in last.items()}
        return [(c, cls.names[c], count, day.get(c)) for c, count in rows]


def rows(result):
    return [tuple(r) for r in result.collect()]


@pytest.mark.parametrize("top_n", [3, 100])
def test_top_customers_by_money(vault, top_n):
    found = A.get_top_customers(vault, "RUB", RATES, top_n)
    assert found.columns == ["customer_id", "full_name", "total_spent"]
    assert rows(found) == Expected.spent(RATES)[:top_n]


def test_an_order_that_moved_counts_for_both_customers():
    assert {c for o, c, _ in Expected.order_links if o == "2"} == {5, 9}


def test_without_rates_only_the_preferred_currency_counts(vault):
    assert rows(A.get_top_customers(vault, "EUR")) == Expected.spent({"EUR": 1})[:10]
    assert rows(A.get_monthly_revenue(vault, "EUR")) == Expected.revenue({"EUR": 1})


def test_monthly_revenue(vault):
    found = A.get_monthly_revenue(vault, "RUB", RATES)
    assert found.columns == ["month", "total_revenue"]
    assert rows(found) == Expected.revenue(RATES)


@pytest.mark.parametrize("by", ["views", "clicks", "purchases", "orders"])
def test_top_products(vault, by):
    found = A.top_products(vault, by, 4)
    assert found.columns == ["product_id", "product_name", "popularity"]
    assert rows(found) == Expected.top_products(by, 4)


@pytest.mark.parametrize("by, count", [("orders", "order_count"), ("purchases", "purchase_count")])
def test_top_customers(vault, by, count):
    found = A.top_customers(vault, by, 6)
    assert found.columns == ["customer_id", "full_name", count, "last_action_date"]
    assert rows(found) == Expected.top_customers(by, 6)


def test_customers_without_events_have_no_last_date(vault):
    assert any(r[3] is None for r in rows(A.top_customers(vault, "orders", 20)))


def test_customers_without_orders(vault):
    busy = {link[1] for link in Expected.order_links}
    expected = [(c, n) for c, n in sorted(Expected.names.items()) if c not in busy]
    assert rows(A.get_customers_without_orders(vault)) == expected
    assert rows(A.get_customers_without_orders(vault, 2)) == expected[:2]


@pytest.mark.parametrize("choose", [A.top_products, A.top_customers])
def test_bad_selections_are_refused(vault, choose):
    with pytest.raises(ValueError, match="no metric"):
        choose(vault, "likes")
    with pytest.raises(ValueError, match="one place or more"):
        choose(vault, "purchases", 0)


def test_rates_are_relative_to_the_preferred_currency():
    found = normalised_rates("USD", {"RUB": "1", "USD": "75", "EUR": "85"})
    expected = {"RUB": Decimal(1) / 75, "USD": Decimal(1), "EUR": Decimal(85) / 75}
    assert found.keys() == expected.keys()
    assert all(abs(found[c] - expected[c]) < Decimal("1e-26") for c in expected)
    assert normalised_rates("GBP", {"USD": 2}) == {"USD": Decimal(2)}
    assert normalised_rates("USD", None) == {}


@pytest.mark.parametrize("rate", [0, -1, "NaN"])
def test_rates_must_be_positive(rate):
    with pytest.raises(ValueError, match="exchange rate of USD"):
        normalised_rates("USD", {"USD": rate})


def converted(spark, amount, currency, preferred, rates):
    rows = spark.createDataFrame([(amount, currency)], "amount string, currency string")
    found = rows.selectExpr(f"{converted_amount('amount', 'currency', preferred, rates)} AS a").first()["a"]
    return found if found is None else Decimal(found)


def test_converted_amounts_keep_their_digits(spark):
    found = converted(spark, "5286.18", "USD", "EUR", {"EUR": 75, "USD": 85})
    assert abs(found - Decimal("5991.004")) < Decimal("1e-30")
    assert converted(spark, "1000000", "X", "EUR", {"EUR": 1, "X": "1e-15"}) == Decimal("1e-9")
    assert converted(spark, "0.000000000000000001", "EUR", "EUR", None) == Decimal("1e-18")
    assert converted(spark, "2", "IDR", "EUR", {"EUR": 1, "IDR": "1234567890"}) == Decimal(2469135780)
    assert converted(spark, "1", "GBP", "EUR", {"IDR": 10**20}) is None
    assert converted(spark, None, "EUR", "EUR", None) is None
    assert converted(spark, "7", "a'b\\", "EUR", {"a'b\\": 2}) == 14


def test_rates_may_be_any_number_of_digits_apart(spark):
    assert converted(spark, "3", "IDR", "EUR", {"IDR": 10**60}) == 3 * 10**60
    assert converted(spark, "3", "X", "EUR", {"EUR": "1e-11", "X": 1}) == 3 * 10**11
    assert converted(spark, "9" * 60 + ".5", "X", "EUR", {"X": "1e-70"}) == Decimal("9" * 60 + ".5e-70")


def test_sums_beyond_a_decimal(spark, tmp_path):
    """Two amounts of 6e19 add up, and so do amounts of any size, beside small ones, across currencies."""
    stored = StoredVault(spark, str(tmp_path))
    amounts = ["6e19", "60000000000000000000", "1e45", "0.0000000000000000000001", "2.50", "-1e50", "9" * 38]
    load(
        spark, stored, DAY_1, customers=[customer("1"), customer("2")], products=[product("1")],
        orders=[order("1", "1", "1"), order("2", "2", "1")],
        payments=[payment(str(i), "1", a, ["RUB", "USD"][i % 2]) for i, a in enumerate(amounts)]
        + [payment("90", "2", "999999999999999999999999999999999999999999999")],
    )
    getcontext().prec = 120
    total = sum(Decimal(a) * RATES[["RUB", "USD"][i % 2]] for i, a in enumerate(amounts) if Decimal(a) > 0)
    second = Decimal("999999999999999999999999999999999999999999999")
    assert rows(A.get_top_customers(stored, "RUB", RATES)) == [(1, "Anna Lee", plain(total)), (2, "Anna Lee", plain(second))]
    assert rows(A.get_monthly_revenue(stored, "RUB", RATES)) == [(date(2024, 2, 1), plain(total + second))]
    held = {r["amount_wide"] for r in stored["sat_payment"].collect()}
    assert held >= {"1" + "0" * 45, "0." + "0" * 21 + "1", "9" * 38}


@pytest.mark.parametrize("by", ["orders", "purchases"])
def test_splitting_link_keys_changes_nothing(vault, by, monkeypatch):
    def every_key(rows, *key_sets):
        return [{r[0]: 3 for r in rows.select(F.xxhash64(*keys)).collect()} for keys in key_sets]

    monkeypatch.setattr("tallyvault.plans.analytics.hot_keys", every_key)
    tables = {name: vault[name] for name in vault}
    assert rows(A.top_customers(tables, by, 6)) == Expected.top_customers(by, 6)
    assert rows(A.top_products(tables, by, 4)) == Expected.top_products(by, 4)
    assert rows(A.get_top_customers(tables, "RUB", RATES)) == Expected.spent(RATES)[:10]
    assert rows(A.get_monthly_revenue(tables, "RUB", RATES)) == Expected.revenue(RATES)
