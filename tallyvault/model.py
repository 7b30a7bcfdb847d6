"""The data model: five source entities, the vault tables built from them, their schemas.

One declaration per entity drives reading, cleaning, hubs, satellites and links, so each of those
steps is written once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from tallyvault.functions import parsers as P
from tallyvault.functions.parsers import Parser


@dataclass(frozen=True, eq=False)
class Entity:
    """One kind of source row.

    ``key`` is the business key. With ``key_parser`` the key is parsed like any other column: a
    bad key is a warning and the row stays with a NULL key. Without it the key is only cast, and
    a row whose key does not cast is a fatal reject.
    """

    name: str
    noun: str
    key: str
    attributes: dict[str, Parser]
    key_parser: Parser | None = None
    missing_keys: tuple[str, ...] = ("",)

    @property
    def columns(self) -> list[str]:
        """Source columns in file order; they are also the row-hash order."""
        return [self.key, *self.attributes]

    @property
    def parsers(self) -> dict[str, Parser]:
        """Parsers whose tags decide whether a row is logged as a warning."""
        keyed = {self.key: self.key_parser} if self.key_parser else {}
        return {**keyed, **self.attributes}

    @property
    def hub(self) -> str:
        return f"hub_{self.noun}"

    @property
    def sat(self) -> str:
        return f"sat_{self.noun}"

    @property
    def hk(self) -> str:
        return f"{self.noun}_hk"

    @property
    def value_fields(self) -> list[T.StructField]:
        """The attributes as stored; a number of any size has a second column for its text."""
        found = []
        for name, parser in self.attributes.items():
            found.append(T.StructField(name, parser.data_type))
            if parser.wide:
                found.append(T.StructField(f"{name}_wide", T.StringType()))
        return found

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    @property
    def cleaned_schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(self.key, T.LongType())]
            + self.value_fields
            + [T.StructField("row_hash", T.StringType())]
        )

    @property
    def hub_schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(self.hk, T.StringType()),
                T.StructField(self.key, T.LongType()),
                T.StructField("load_datetime", T.TimestampNTZType()),
            ]
        )

    @property
    def sat_schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(self.hk, T.StringType()),
                T.StructField("load_datetime", T.TimestampNTZType()),
            ]
            + self.value_fields
            + [T.StructField("hash_diff", T.StringType())]
        )


CUSTOMERS = Entity(
    "customers",
    "customer",
    "customer_id",
    {
        "full_name": P.FULL_NAME,
        "email": P.EMAIL_ADDRESS,
        "phone": P.PHONE,
        "city": P.CITY,
        "created_at": P.CREATED_AT,
    },
    missing_keys=("", "UNKNOWN"),
)
PRODUCTS = Entity(
    "products",
    "product",
    "product_id",
    {
        "product_name": P.PRODUCT_NAME,
        "category": P.CATEGORY,
        "price": P.PRICE,
        "currency": P.CURRENCY,
        "is_active": P.IS_ACTIVE,
    },
)
PAYMENTS = Entity(
    "payments",
    "payment",
    "payment_id",
    {
        "order_id": P.POSITIVE_ID,
        "payment_method": P.PAYMENT_METHOD,
        "amount": P.AMOUNT,
        "currency": P.CURRENCY,
        "payment_timestamp": P.PAYMENT_TIMESTAMP,
    },
)
ORDERS = Entity(
    "orders",
    "order",
    "order_id",
    {
        "customer_id": P.POSITIVE_ID,
        "product_id": P.POSITIVE_ID,
        "quantity": P.QUANTITY,
        "unit_price": P.UNIT_PRICE,
        "currency": P.CURRENCY,
        "order_timestamp": P.ORDER_TIMESTAMP,
        "status": P.STATUS,
    },
    key_parser=P.POSITIVE_ID,
)
EVENTS = Entity(
    "events",
    "event",
    "event_id",
    {
        "customer_id": P.POSITIVE_ID,
        "event_type": P.EVENT_TYPE,
        "event_timestamp": P.EVENT_TIMESTAMP,
        "product_id": P.POSITIVE_ID,
    },
    key_parser=P.EVENT_ID,
)

ENTITIES: dict[str, Entity] = {
    e.name: e for e in (CUSTOMERS, PRODUCTS, PAYMENTS, ORDERS, EVENTS)
}
BY_NOUN: dict[str, Entity] = {e.noun: e for e in ENTITIES.values()}


@dataclass(frozen=True, eq=False)
class Link:
    """A relationship carried by the rows of one entity; its own hub comes first in ``nouns``."""

    name: str
    entity: Entity
    nouns: tuple[str, ...]

    @property
    def ids(self) -> list[str]:
        return [BY_NOUN[n].key for n in self.nouns]

    @property
    def hks(self) -> list[str]:
        return [BY_NOUN[n].hk for n in self.nouns]

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c, T.StringType()) for c in ("link_hk", *self.hks)]
            + [T.StructField("load_datetime", T.TimestampNTZType())]
        )


LINKS: dict[str, Link] = {
    link.name: link
    for link in (
        Link("link_payment_order", PAYMENTS, ("payment", "order")),
        Link("link_event_customer_product", EVENTS, ("event", "customer", "product")),
        Link("link_order_customer_product", ORDERS, ("order", "customer", "product")),
    )
}

REJECTS = "rejected_records"
REJECT_SCHEMA = T.StructType(
    [
        T.StructField("source_table", T.StringType()),
        T.StructField("load_datetime", T.TimestampNTZType()),
        T.StructField("raw_payload", T.StringType()),
        T.StructField("error_details", T.StringType()),
    ]
)

VAULT_SCHEMAS: dict[str, T.StructType] = (
    {e.hub: e.hub_schema for e in ENTITIES.values()}
    | {e.sat: e.sat_schema for e in ENTITIES.values()}
    | {link.name: link.schema for link in LINKS.values()}
)
