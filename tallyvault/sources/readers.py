"""Readers: every source becomes a DataFrame of text columns, never inferred.

A path may be a file, a directory or a glob; Spark raises PATH_NOT_FOUND when it is missing, as
soon as the reader is called.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyvault.model import CUSTOMERS, ENTITIES, EVENTS, ORDERS, PAYMENTS, PRODUCTS, Entity
from tallyvault.sources.quoted import JSON, XML, records

# No text equals this, so Spark turns only absent CSV fields into NULL and keeps "" as ''.
_NO_NULL_TEXT = "\u0002"


def _read_csv(
    spark: SparkSession, path: str, entity: Entity, separator: str, multi_line: bool | str
) -> DataFrame:
    """Columns by position under a header line; absent field -> NULL, quoted "" -> ''.

    A row with too few or too many fields fails the load. ``multi_line`` allows line feeds inside
    quoted fields. With True any number of tasks read a file, in two passes; quotes must then be paired,
    so a stray one in a bare field fails the load as rows of a wrong width. ``document`` reads each
    file in one task and bears with stray quotes.
    """
    if multi_line not in (False, True, "document"):
        raise ValueError(f"unknown way to read line feeds: {multi_line}")
    options = {"sep": separator, "escape": '"', "nullValue": _NO_NULL_TEXT, "mode": "FAILFAST", "multiLine": bool(multi_line)}
    if multi_line is not True:
        return spark.read.schema(entity.raw_schema).options(header=True, **options).csv(path)
    texts = {name: str(value).lower() if isinstance(value, bool) else value for name, value in options.items()}
    row = F.from_csv("record", entity.raw_schema.simpleString()[len("struct<") : -1].replace(":", " "), texts)
    return records(spark, path).select(row.alias("r")).select("r.*")


def read_customers(spark: SparkSession, path: str, multi_line: bool | str = False) -> DataFrame:
    return _read_csv(spark, path, CUSTOMERS, ",", multi_line)


def read_products(spark: SparkSession, path: str, multi_line: bool | str = False) -> DataFrame:
    return _read_csv(spark, path, PRODUCTS, ",", multi_line)


def read_payments(spark: SparkSession, path: str, multi_line: bool | str = False) -> DataFrame:
    return _read_csv(spark, path, PAYMENTS, "^", multi_line)


def _absent_if_empty(raw: DataFrame, entity: Entity) -> DataFrame:
    return raw.selectExpr(*[f"nullif({c}, '') AS {c}" for c in entity.columns])


def read_orders(
    spark: SparkSession, path: str, layout: str = "split", json_null_token: str | None = None
) -> DataFrame:
    """Orders as JSON objects; fields keep the text they have in the file (109.90 stays 109.90).

    ``layout`` tells how the objects lie in the files:

    - ``split``: flat objects, in an array or one after another, cut at each ``}`` that is not within a
      text and read by any number of tasks, in two passes. An object inside an object makes the load
      fail, naming the layout to use instead;
    - ``lines``: one object per line, read by any number of tasks;
    - ``array``: a JSON array per file, parsed by one task per file.

    ``json_null_token`` is the text an explicit JSON null becomes; by default it is NULL like a
    missing field. It needs flat objects that any task can read: ``split`` or ``lines``.
    """
    if layout not in ("array", "lines", "split"):
        raise ValueError(f"unknown layout of orders: {layout}")
    if layout == "array" and json_null_token is not None:
        raise ValueError("a text for JSON null needs the orders layout split or lines")
    if layout == "split" or json_null_token is not None:
        raw = _flat_json(spark, path, layout == "lines", json_null_token)
    else:
        raw = (
            spark.read.schema(ORDERS.raw_schema)
            .option("mode", "FAILFAST")
            .option("multiLine", layout == "array")
            .json(path)
        )
    return _absent_if_empty(raw, ORDERS)


def _flat_json(
    spark: SparkSession, path: str, lines: bool, json_null_token: str | None
) -> DataFrame:
    """Order columns of flat JSON objects, one per line or cut at each closing brace."""
    advice = "write one object per line" if lines else "use the orders layout lines or array"
    if lines:
        objects = spark.read.text(path).filter("trim(value) <> ''").selectExpr("value AS json")
    else:
        # Each piece must be a whole object once its brace is put back.
        pieces = records(spark, path, JSON).selectExpr(
            r"regexp_replace(record, r'^[\s,\[]+', '') AS piece"
        )
        objects = pieces.filter(r"NOT piece RLIKE r'^[\s\]]*\z'").selectExpr(
            "concat(piece, '}') AS json"
        )
    # a map tells a null from a missing field
    parsed = objects.selectExpr(
        "json",
        f"coalesce(from_json(json, 'map<string,string>', map('mode', 'PERMISSIVE')),"
        f" raise_error('not a flat JSON object: {advice}')) AS fields",
    )
    # a value that looks like an object may be a text; what is left without the texts tells
    bare = r"""regexp_replace(json, r'(?s)"(?:[^"\\]++|\\.)*+"', '')"""
    nested = (
        "exists(map_values(fields), v -> v LIKE '{%' OR v LIKE '[%')"
        f" AND (regexp_count({bare}, '[{{]') > 1 OR contains({bare}, '['))"
    )
    flat = parsed.selectExpr(
        "json", f"if({nested}, raise_error('orders must be flat objects'), fields) AS fields"
    )
    return flat.selectExpr(*[f"{_field_text(c, json_null_token)} AS {c}" for c in ORDERS.columns])


def _field_text(column: str, json_null_token: str | None) -> str:
    """A field's text. The parser would drop the trailing zeros of a number, so numbers are taken
    from the JSON itself; a quoted name followed by a colon cannot occur inside a JSON text."""
    number = rf"""r'"{column}"\s*:\s*(-?\d[\d.eE+\-]*)'"""
    text = f"coalesce(nullif(regexp_extract(json, {number}, 1), ''), fields['{column}'])"
    if json_null_token is None:
        return text
    token = json_null_token.replace("'", "''")
    return f"if(map_contains_key(fields, '{column}'), coalesce({text}, '{token}'), NULL)"


def read_events(spark: SparkSession, path: str, layout: str = "split") -> DataFrame:
    """Events: every ``<event>`` element at any depth, its five child elements as text.

    ``layout`` ``split`` cuts the files at each ``</event>`` outside of comments and CDATA sections and
    reads them with any number of tasks, in two passes; event elements that are nested, empty or end in a
    tag with blanks make the load fail, naming the other layout. ``document`` streams each file through
    one task.
    """
    if layout not in ("document", "split"):
        raise ValueError(f"unknown layout of events: {layout}")
    options = {"rowTag": "event", "ignoreSurroundingSpaces": "false"}
    if layout == "document":
        raw = spark.read.format("xml").schema(EVENTS.raw_schema).options(**options).load(path)
        return _absent_if_empty(raw, EVENTS)

    # comments go, CDATA sections stay; tags within them are none
    marked = r"regexp_replace(record, r'(?s)(<!\[CDATA\[.*?\]\]>)|<!--.*?-->', '$1')"
    pieces = (
        records(spark, path, XML)
        .selectExpr(f"if(contains(record, '<!'), {marked}, record) AS value")
        .selectExpr("value", r"if(contains(value, '<!['), regexp_replace(value, r'(?s)<!\[CDATA\[.*?\]\]>', ''), value) AS bare")
        .selectExpr(
            "value",
            r"regexp_count(bare, r'<event[\s/>]') AS starts",
            r"bare RLIKE r'<event(\s[^>]*)?/>|</event\s' AS unreliable",
        )
    )
    checked = pieces.filter("starts > 0 OR unreliable").selectExpr(
        "if(starts = 1 AND NOT unreliable,"
        r" concat(regexp_extract(value, r'(?s)<event[\s>].*', 0), '</event>'),"
        " raise_error('events cannot be read with layout split; use document')) AS event"
    )
    event = F.from_xml("event", EVENTS.raw_schema, {**options, "mode": "FAILFAST"})
    return _absent_if_empty(checked.select(event.alias("e")).select("e.*"), EVENTS)


READERS = {
    "customers": read_customers,
    "products": read_products,
    "payments": read_payments,
    "orders": read_orders,
    "events": read_events,
}


@dataclass(frozen=True)
class SourcePaths:
    """Where the five inputs are, with reader options per source where needed."""

    customers: str
    products: str
    payments: str
    orders: str
    events: str
    options: Mapping[str, Mapping[str, object]] | None = None

    def read(self, spark: SparkSession) -> dict[str, DataFrame]:
        """All five inputs; raises before any work when one is missing."""
        options = self.options or {}
        return {
            name: READERS[name](spark, getattr(self, name), **options.get(name, {}))
            for name in ENTITIES
        }
