"""The registered queries in DuckDB SQL, over the same tables.

Written the way one would write them in SQL (plain window counts, outer joins, subqueries), so
that they check the Spark plans rather than repeat them. Statements are put together from named
common table expressions.
"""

from __future__ import annotations

import re

# --- raw entities ----------------------------------------------------------------------------

def _odd_key(k: str, otherwise: str) -> str:
    return f"""CASE {k} % 71 WHEN 1 THEN NULL WHEN 2 THEN '' WHEN 3 THEN ' ' WHEN 4 THEN 'x' || {k}
               ELSE {otherwise} END"""


def _odd_sum(k: str, otherwise: str) -> str:
    return f"""CASE {k} % 53 WHEN 1 THEN '0.00004' WHEN 2 THEN '1.00005'
               WHEN 3 THEN '123456789012345.5' WHEN 4 THEN '0.0000000000000000004'
               WHEN 5 THEN '6e19' WHEN 6 THEN '+060000000000000000000.50'
               WHEN 7 THEN '1234567890123456789012345678901234567890.1234567890123456789012'
               WHEN 8 THEN '-7e40'
               ELSE {otherwise} END"""


CTES: dict[str, str] = {
    "raw_customers": f"""
        SELECT {_odd_key("k", "CASE WHEN k % 97 = 0 THEN 'UNKNOWN' ELSE CAST(k AS VARCHAR) END")}
                   AS customer_id,
               CASE k % 5 WHEN 0 THEN '  ivan IVANOV ' WHEN 1 THEN 'mr. John Smith'
                          WHEN 2 THEN 'John  Smith' WHEN 3 THEN c_name
                          ELSE 'Anna Maria Lee' END AS full_name,
               CASE k % 4 WHEN 0 THEN 'user' || k || '@example.com' WHEN 1 THEN 'UNKNOWN'
                          WHEN 2 THEN 'bad@' END AS email,
               CASE k % 4 WHEN 0 THEN '+7 (900) ' || lpad(CAST(k AS VARCHAR), 7, '0')
                          WHEN 1 THEN '123-45' WHEN 2 THEN 'x123' END AS phone,
               CASE WHEN k % 11 = 0 THEN 'UNKNOWN' WHEN k % 61 = 5 THEN '' ELSE n_name END AS city,
               CASE k % 4 WHEN 0 THEN '2024-02-28' WHEN 1 THEN '28.02.2024'
                          WHEN 2 THEN '31.02.2024' ELSE 'UNKNOWN' END AS created_at
        FROM (SELECT c_custkey AS k, c_name, c_nationkey FROM customer
              UNION ALL
              SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_custkey % 50 = 0) c
        LEFT JOIN nation ON n_nationkey = c_nationkey""",
    "raw_products": f"""
        SELECT {_odd_key("p_partkey", "CAST(p_partkey AS VARCHAR)")} AS product_id,
               CASE WHEN p_partkey % 13 = 0 THEN '  ' || p_name || ' ' ELSE p_name END
                   AS product_name,
               CASE p_partkey % 6 WHEN 0 THEN 'Home' WHEN 1 THEN 'Books' WHEN 2 THEN 'Electronics'
                   WHEN 3 THEN 'Clothing' WHEN 4 THEN 'Sports'
                   ELSE CASE WHEN p_partkey % 12 = 5 THEN '' ELSE 'Toys' END END AS category,
               {_odd_sum("p_partkey", """CASE WHEN p_partkey % 31 = 0 THEN 'N/A'
                   ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) END""")} AS price,
               CASE p_partkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'RUB'
                   ELSE 'GBP' END AS currency,
               CASE p_partkey % 5 WHEN 0 THEN 'True' WHEN 1 THEN 'False' WHEN 2 THEN 'yes'
                   WHEN 3 THEN '0' ELSE 'maybe' END AS is_active
        FROM part""",
    "raw_orders": f"""
        SELECT {_odd_key("o_orderkey", "CAST(o_orderkey AS VARCHAR)")} AS order_id,
               CASE WHEN o_orderkey % 17 <> 0 AND o_custkey % 10 <> 3
                    THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
               CAST(part AS VARCHAR) AS product_id,
               CASE WHEN o_orderkey % 19 = 0 THEN '0'
                    ELSE CAST(CAST(qty AS INTEGER) AS VARCHAR) END AS quantity,
               {_odd_sum("o_orderkey", "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)")}
                   AS unit_price,
               CASE o_orderkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'RUB' END AS currency,
               CASE WHEN o_orderkey % 23 = 0 THEN '2025-99-99'
                    ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS order_timestamp,
               CASE WHEN o_orderkey % 29 = 0 THEN 'unknown' WHEN o_orderstatus = 'F' THEN 'completed'
                    WHEN o_orderstatus = 'O' THEN 'processing'
                    WHEN o_orderstatus = 'P' THEN 'cancelled' END AS status
        FROM orders
        LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS part, sum(l_quantity) AS qty
                   FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey""",
    "raw_payments": f"""
        SELECT {_odd_key("o_orderkey", "CAST(o_orderkey + 1 AS VARCHAR)")} AS payment_id,
               CASE WHEN o_orderkey % 13 = 0 THEN CAST(o_orderkey + 10000000 AS VARCHAR)
                    ELSE CAST(o_orderkey AS VARCHAR) END AS order_id,
               CASE left(o_orderpriority, 1) WHEN '1' THEN 'card' WHEN '2' THEN 'paypal'
                    WHEN '3' THEN 'bank_transfer' ELSE 'cash' END AS payment_method,
               {_odd_sum("o_orderkey", """CASE WHEN o_orderkey % 37 = 0 THEN 'error_amount'
                    ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END""")} AS amount,
               CASE o_orderkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'RUB' END AS currency,
               CASE WHEN o_orderkey % 41 = 0 THEN '13/45/2025'
                    WHEN o_orderkey % 5 = 0 THEN strftime(o_orderdate, '%d.%m.%Y')
                    ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS payment_timestamp
        FROM orders""",
    "raw_events": f"""
        SELECT {_odd_key("event_id", """CASE WHEN event_id % 101 = 0 THEN 'BAD_ID'
                   ELSE CAST(event_id AS VARCHAR) END""")} AS event_id,
               CAST(user_id AS VARCHAR) AS customer_id,
               event_type,
               CASE WHEN event_id % 43 = 0 THEN 'broken-date'
                    ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS event_timestamp,
               json_extract_string(props, '$.k') AS product_id
        FROM events""",
}

COLUMNS = {
    "customers": ["customer_id", "full_name", "email", "phone", "city", "created_at"],
    "products": ["product_id", "product_name", "category", "price", "currency", "is_active"],
    "payments": [
        "payment_id", "order_id", "payment_method", "amount", "currency", "payment_timestamp",
    ],
    "orders": [
        "order_id", "customer_id", "product_id", "quantity", "unit_price", "currency",
        "order_timestamp", "status",
    ],
    "events": ["event_id", "customer_id", "event_type", "event_timestamp", "product_id"],
}
NOUNS = {
    "customers": "customer",
    "products": "product",
    "payments": "payment",
    "orders": "order",
    "events": "event",
}
CHANGES = {
    "customers": ("city", "Moved"),
    "products": ("currency", "EUR"),
    "payments": ("payment_method", "paypal"),
    "orders": ("status", "cancelled"),
    "events": ("event_type", "login"),
}
BROKEN = {"customers": "full_name", "products": "product_name", "payments": "payment_method"}
WHOLE_NUMBER = r"'^[+-]?\d+$'"


def _int_key(column: str) -> str:
    return f"CASE WHEN regexp_matches({column}, {WHOLE_NUMBER}) THEN CAST({column} AS BIGINT) END"


for _name, _columns in COLUMNS.items():
    _key, (_attribute, _text) = _columns[0], CHANGES[_name]
    _changed = [
        f"CASE WHEN ({_int_key(_key)}) % 7 = 0 THEN '{_text}' ELSE {c} END AS {c}"
        if c == _attribute
        else c
        for c in _columns[1:]
    ]
    CTES[f"raw2_{_name}"] = f"""
        SELECT {_key}, {", ".join(_changed)} FROM raw_{_name}
        UNION ALL
        SELECT CAST(TRY_CAST({_key} AS BIGINT) + 10000000 AS VARCHAR), {", ".join(_changed)}
        FROM raw_{_name} WHERE ({_int_key(_key)}) % 10 = 1"""
    CTES[f"rawboth_{_name}"] = f"""
        SELECT {", ".join(_columns)} FROM raw_{_name}
        UNION ALL SELECT {", ".join(_columns)} FROM raw2_{_name}"""

# --- parsers: column -> (value, tag) ---------------------------------------------------------

NAME = r"'^([\p{Ll}\s.\-]*?)\s*((\p{Lu}\p{Ll}*)([\s.\-]+\p{Lu}\p{Ll}*){1,2})\s*$'"
PLACEHOLDER = r"lower(regexp_replace({t}, '\s+', ' ', 'g')) = 'ivan ivanov'"
EMAIL = r"'^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$'"
ISO_DATE = r"'^\d{4}-\d{2}-\d{2}$'"
DOTTED_DATE = r"'^\d{2}\.\d{2}\.\d{4}$'"
TIMESTAMP = r"'^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$'"
DIGITS = r"regexp_replace({t}, '[^0-9]', '', 'g')"


def _case(*branches: str) -> str:
    return "CASE " + " ".join(branches) + " END"


def _missing(t: str, null: str = "null", empty: str = "empty", unknown: bool = False) -> list[str]:
    found = [f"WHEN {t} IS NULL THEN '{null}'", f"WHEN {t} = '' THEN '{empty}'"]
    return found + ([f"WHEN {t} = 'UNKNOWN' THEN 'invalid unknown'"] if unknown else [])


def _customer_missing(t: str, unknown: bool = True) -> list[str]:
    return _missing(t, "invalid null", "invalid empty", unknown)


def _words(words: str):
    def sql(t: str) -> tuple[str, str]:
        accepted = f"{t} IN ({words})"
        tag = _case(*_missing(t), f"WHEN {accepted} THEN 'valid'", "ELSE 'invalid'")
        return _case(f"WHEN {accepted} THEN {t}"), tag

    return sql


def _positive(cast: str, guard: str = "TRUE", token: str = "", token_tag: str = ""):
    def sql(t: str) -> tuple[str, str]:
        usable = f"({guard.format(t=t)}) AND TRY_CAST({t} AS {cast}) > 0"
        special = [f"WHEN {t} = '{token}' THEN '{token_tag}'"] if token else []
        tag = _case(*_missing(t), *special, f"WHEN {usable} THEN 'valid'", "ELSE 'invalid'")
        return _case(f"WHEN {usable} THEN TRY_CAST({t} AS {cast})"), tag

    return sql


_whole = f"regexp_matches({{t}}, {WHOLE_NUMBER})"
_id = _positive("BIGINT", _whole)
_currency = _words("'USD', 'EUR', 'RUB'")


def _full_name(t: str) -> tuple[str, str]:
    placeholder = PLACEHOLDER.format(t=t)
    value = _case(
        f"WHEN {placeholder} THEN NULL",
        f"WHEN regexp_matches({t}, {NAME}) THEN regexp_extract({t}, {NAME}, 2)",
    )
    tag = _case(
        *_customer_missing(t, unknown=False),
        f"WHEN {placeholder} THEN 'invalid placeholder'",
        f"WHEN NOT regexp_matches({t}, {NAME}) THEN 'invalid'",
        f"WHEN regexp_extract({t}, {NAME}, 1) <> '' THEN 'valid with prefix'",
        "ELSE 'valid'",
    )
    return value, tag


def _email(t: str) -> tuple[str, str]:
    ok = f"regexp_matches({t}, {EMAIL})"
    tag = _case(*_customer_missing(t), f"WHEN {ok} THEN 'valid'", "ELSE 'invalid'")
    return _case(f"WHEN {ok} THEN {t}"), tag


def _phone(t: str) -> tuple[str, str]:
    digits = DIGITS.format(t=t)
    strange = rf"length(regexp_replace({t}, '[0-9\-+() ]', '', 'g')) > 0"
    short = f"length({digits}) < 10"
    value = _case(
        f"WHEN {t} = 'UNKNOWN' OR {strange} OR {short} THEN NULL", f"ELSE right({digits}, 10)"
    )
    tag = _case(
        *_customer_missing(t),
        f"WHEN {strange} THEN 'invalid symb'",
        f"WHEN {short} THEN 'invalid short'",
        "ELSE 'valid'",
    )
    return value, tag


def _phone_code(t: str) -> str:
    digits = DIGITS.format(t=t)
    strange = rf"length(regexp_replace({t}, '[0-9\-+() ]', '', 'g')) > 0"
    return _case(
        f"WHEN NOT ({strange}) AND length({digits}) > 10 THEN left({digits}, length({digits}) - 10)"
    )


def _city(t: str) -> tuple[str, str]:
    tag = _case(*_customer_missing(t), "ELSE 'valid'")
    return f"nullif(nullif({t}, ''), 'UNKNOWN')", tag


def _dates(forms: list[tuple[str, str, str]], missing: list[str], token: str = "", tag: str = ""):
    """forms: (pattern, value expression, tag)."""
    special = [f"WHEN {{t}} = '{token}' THEN '{tag}'"] if token else []
    value = [f"WHEN regexp_matches({{t}}, {p}) THEN {v}" for p, v, _ in forms]
    tags = [
        f"WHEN regexp_matches({{t}}, {p}) AND {v} IS NOT NULL THEN '{name}'" for p, v, name in forms
    ]

    def sql(t: str) -> tuple[str, str]:
        fill = lambda text: text.replace("{t}", t)
        return (
            fill(_case(*value)),
            fill(_case(*missing, *special, *tags, "ELSE 'invalid'")),
        )

    return sql


_TS = (TIMESTAMP, "TRY_CAST({t} AS TIMESTAMP)", "yyyy-mm-dd hh24:mi:ss")
_DMY_DATE = (DOTTED_DATE, "CAST(try_strptime({t}, '%d.%m.%Y') AS DATE)", "dd.mm.yyyy")
_DMY_TS = (DOTTED_DATE, "try_strptime({t}, '%d.%m.%Y')", "dd.mm.yyyy")
_YMD_DATE = (ISO_DATE, "TRY_CAST({t} AS DATE)", "yyyy-mm-dd")
_YMD_TS = (ISO_DATE, "TRY_CAST({t} AS TIMESTAMP)", "yyyy-mm-dd")


def _product_name(t: str) -> tuple[str, str]:
    return f"nullif({t}, '')", _case(*_missing(t), "ELSE 'valid'")


_NUMBER = r"'^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$'"


def _shift(t: str) -> tuple[str, str, str]:
    """Whole digits, decimals and sign of a number's text."""
    digits = rf"regexp_replace(regexp_extract({t}, '^[+-]?([\d.]*)', 1), '\.', '')"
    point = (
        rf"(length(regexp_extract({t}, '^[+-]?(\d*)', 1))"
        rf" + coalesce(TRY_CAST(nullif(regexp_extract({t}, '[eE](.*)$', 1), '') AS INTEGER), 0))"
    )
    whole = (
        f"CASE WHEN {point} <= 0 THEN '' WHEN {point} >= length({digits}) THEN rpad({digits}, CAST({point} AS INTEGER), '0')"
        f" ELSE left({digits}, {point}) END"
    )
    decimals = (
        f"CASE WHEN {point} <= 0 THEN repeat('0', -CAST({point} AS INTEGER)) || {digits}"
        f" WHEN {point} >= length({digits}) THEN '' ELSE substr({digits}, {point} + 1) END"
    )
    return f"ltrim({whole}, '0')", f"rtrim({decimals}, '0')", f"({t} LIKE '-%')"


def _money(token: str = "", token_tag: str = "", positive: bool = True):
    """A number of any size as text, without exponent and idle zeros."""

    def sql(t: str) -> tuple[str, str]:
        whole, decimals, negative = _shift(t)
        zero = f"{whole} = '' AND {decimals} = ''"
        text = (
            f"CASE WHEN {negative} AND NOT ({zero}) THEN '-' ELSE '' END || coalesce(nullif({whole}, ''), '0')"
            f" || CASE WHEN {decimals} = '' THEN '' ELSE '.' || {decimals} END"
        )
        usable = f"regexp_matches({t}, {_NUMBER})"
        if positive:
            usable += f" AND NOT {negative} AND NOT ({zero})"
        special = [f"WHEN {t} = '{token}' THEN '{token_tag}'"] if token else []
        tag = _case(*_missing(t), *special, f"WHEN {usable} THEN 'valid'", "ELSE 'invalid'")
        return _case(f"WHEN {usable} THEN {text}"), tag

    return sql


# Sums of positive numbers in pieces of 18 digits: three before the point, two behind it.
_PIECES = ("h2", "h1", "h0", "f1", "f2")


def _pieces(text: str, rate: str) -> str:
    whole, decimals = f"lpad(split_part({text}, '.', 1), 54, '0')", f"rpad(split_part({text}, '.', 2), 36, '0')"
    cuts = [f"substr({whole}, {1 + 18 * k}, 18)" for k in range(3)] + [f"substr({decimals}, {1 + 18 * k}, 18)" for k in range(2)]
    return ", ".join(f"CAST({cut} AS HUGEINT) * {rate} AS {name}" for cut, name in zip(cuts, _PIECES))


def _carried(columns: str, rows: str, group: str = "") -> str:
    """columns and the pieces of sums over rows, each but the first below 10^18."""
    unit = "1000000000000000000"
    query = f"SELECT {columns}, {', '.join(f'sum({p})::HUGEINT AS {p}' for p in _PIECES)} FROM {rows} {group}"
    for low, high in zip(_PIECES[:0:-1], _PIECES[-2::-1]):
        query = f"SELECT * REPLACE ({low} % {unit} AS {low}, {high} + {low} // {unit} AS {high}) FROM ({query})"
    return query


_TOTAL = (
    "coalesce(nullif(ltrim(h2::VARCHAR || lpad(h1::VARCHAR, 18, '0') || lpad(h0::VARCHAR, 18, '0'), '0'), ''), '0')"
    " || rtrim('.' || rtrim(lpad(f1::VARCHAR, 18, '0') || lpad(f2::VARCHAR, 18, '0'), '0'), '.')"
)


def _is_active(t: str) -> tuple[str, str]:
    yes, no = f"lower({t}) IN ('true', '1', 'yes')", f"lower({t}) IN ('false', '0', 'no')"
    tag = _case(*_missing(t), f"WHEN {yes} OR {no} THEN 'valid'", "ELSE 'invalid'")
    return _case(f"WHEN {yes} THEN TRUE", f"WHEN {no} THEN FALSE"), tag


PARSERS = {
    "customers": {
        "full_name": _full_name,
        "email": _email,
        "phone": _phone,
        "city": _city,
        "created_at": _dates([_YMD_DATE, _DMY_DATE], _customer_missing("{t}")),
    },
    "products": {
        "product_name": _product_name,
        "category": _words("'Home', 'Books', 'Electronics', 'Clothing', 'Sports'"),
        "price": _money("N/A", "na", positive=False),
        "currency": _currency,
        "is_active": _is_active,
    },
    "payments": {
        "order_id": _id,
        "payment_method": _words("'bank_transfer', 'card', 'paypal'"),
        "amount": _money("error_amount", "error_amount"),
        "currency": _currency,
        "payment_timestamp": _dates([_TS, _DMY_TS], _missing("{t}")),
    },
    "orders": {
        "order_id": _id,
        "customer_id": _id,
        "product_id": _id,
        "quantity": _positive("INTEGER", _whole),
        "unit_price": _money(),
        "currency": _currency,
        "order_timestamp": _dates(
            [_TS, _YMD_TS], _missing("{t}"), "2025-99-99", "placeholder_date"
        ),
        "status": _words("'processing', 'completed', 'cancelled'"),
    },
    "events": {
        "event_id": _positive("BIGINT", _whole, "BAD_ID", "bad_id"),
        "customer_id": _id,
        "event_type": _words("'view', 'login', 'purchase', 'click', 'logout'"),
        "event_timestamp": _dates([_TS], _missing("{t}"), "broken-date", "broken-date"),
        "product_id": _id,
    },
}

ACCEPTED = {
    "full_name": "'valid', 'valid with prefix'",
    "created_at": "'yyyy-mm-dd', 'dd.mm.yyyy'",
    "payment_timestamp": "'yyyy-mm-dd hh24:mi:ss', 'dd.mm.yyyy'",
    "order_timestamp": "'yyyy-mm-dd hh24:mi:ss', 'yyyy-mm-dd'",
    "event_timestamp": "'yyyy-mm-dd hh24:mi:ss'",
}
MONEY = {"price", "amount", "unit_price"}
DATED = {"created_at", "payment_timestamp", "order_timestamp", "event_timestamp"}


def _hash(parts: list[str]) -> str:
    return "md5(" + " || '||' || ".join(f"coalesce({p}, '')" for p in parts) + ")"


def _attribute_text(column: str) -> str:
    return f"CAST({column} AS VARCHAR)"


def _plain(columns: list[str]) -> str:
    def one(c: str) -> str:
        if c in MONEY:
            return f"CAST({c} AS DOUBLE) AS {c}"
        return f"CAST({c} AS VARCHAR) AS {c}" if c in DATED else c

    return ", ".join(one(c) for c in columns)


# --- parsed, cleaned, hub, satellite per entity; batch "" is the first load, "2" the second -----

for _name, _columns in COLUMNS.items():
    _key, _noun = _columns[0], NOUNS[_name]
    _hk, _attributes = f"{_noun}_hk", _columns[1:]
    for _batch in ("", "2", "both"):
        _values, _tags = [], []
        for _column, _sql in PARSERS[_name].items():
            _value, _tag = _sql(f"trim(r.{_column})")
            _values.append(f"{_value} AS v_{_column}")
            _tags.append(f"{_tag} AS {_column}_format")
        if _key not in PARSERS[_name]:
            _values.append(f"{_int_key(f'trim(r.{_key})')} AS v_{_key}")
        _missing_key = f"r.{_key} IS NULL OR r.{_key} = ''" + (
            f" OR r.{_key} = 'UNKNOWN'" if _name == "customers" else ""
        )
        _reasons = [f"WHEN {_missing_key} THEN 'missing_or_null_{_key}'"]
        if _key not in PARSERS[_name]:
            _reasons.append(f"WHEN ({_int_key(f'trim(r.{_key})')}) IS NULL THEN 'invalid_{_key}'")
        CTES[f"parsed{_batch}_{_name}"] = f"""
        SELECT r.*, {_hash([f"r.{c}" for c in _columns])} AS row_hash,
               {", ".join(_values)},
               {", ".join(_tags)},
               count(*) OVER (PARTITION BY {_hash([f"r.{c}" for c in _columns])})
                   AS duplicate_count,
               {_case(*_reasons)} AS fatal_reason, fatal_reason IS NOT NULL AS is_fatal
        FROM raw{_batch}_{_name} r"""
        CTES[f"cleaned{_batch}_{_name}"] = f"""
        SELECT {", ".join(f"v_{c} AS {c}" for c in _columns)}, row_hash
        FROM parsed{_batch}_{_name} WHERE NOT is_fatal
        QUALIFY row_number() OVER (PARTITION BY row_hash) = 1"""
        CTES[f"hub{_batch}_{_noun}"] = f"""
        SELECT DISTINCT md5(CAST({_key} AS VARCHAR)) AS {_hk}, {_key}
        FROM cleaned{_batch}_{_name} WHERE {_key} IS NOT NULL"""
        CTES[f"versions{_batch}_{_noun}"] = f"""
        SELECT md5(CAST({_key} AS VARCHAR)) AS {_hk}, {_key}, {", ".join(_attributes)},
               {_hash([_attribute_text(c) for c in _attributes])} AS hash_diff, row_hash
        FROM cleaned{_batch}_{_name} WHERE {_key} IS NOT NULL"""
        CTES[f"sat{_batch}_{_noun}"] = f"""
        SELECT {_hk}, {", ".join(_attributes)}, hash_diff FROM versions{_batch}_{_noun}
        QUALIFY row_number() OVER (PARTITION BY {_hk} ORDER BY row_hash) = 1"""

LINKS = {
    "link_payment_order": ("payments", ["payment", "order"]),
    "link_event_customer_product": ("events", ["event", "customer", "product"]),
    "link_order_customer_product": ("orders", ["order", "customer", "product"]),
}

for _link, (_name, _nouns) in LINKS.items():
    _ids = [f"{n}_id" for n in _nouns]
    for _batch in ("", "2"):
        _joins = " ".join(
            f"LEFT JOIN hub{_batch if n == _nouns[0] else ''}_{n} h_{n} ON h_{n}.{n}_id = c.{n}_id"
            for n in _nouns
        )
        CTES[f"checked{_batch}_{_link}"] = f"""
        SELECT c.*, {", ".join(f"h_{n}.{n}_hk" for n in _nouns)}
        FROM cleaned{_batch}_{_name} c {_joins}
        WHERE {" AND ".join(f"c.{i} IS NOT NULL" for i in _ids)}"""
        CTES[f"rows{_batch}_{_link}"] = f"""
        SELECT DISTINCT {_hash([f"CAST({i} AS VARCHAR)" for i in _ids])} AS link_hk,
               {", ".join(f"{n}_hk" for n in _nouns)}
        FROM checked{_batch}_{_link}
        WHERE {" AND ".join(f"{n}_hk IS NOT NULL" for n in _nouns)}"""

# --- a second load in full: it finds the keys of both loads --------------------------------------

for _noun in NOUNS.values():
    CTES[f"hubs_{_noun}"] = f"SELECT * FROM hub_{_noun} UNION SELECT * FROM hub2_{_noun}"
    CTES[f"sats_{_noun}"] = f"""
        SELECT {_noun}_hk, hash_diff FROM sat_{_noun}
        UNION ALL
        SELECT {_noun}_hk, hash_diff FROM sat2_{_noun} n WHERE NOT EXISTS (
            SELECT 1 FROM sat_{_noun} o WHERE o.{_noun}_hk = n.{_noun}_hk AND o.hash_diff = n.hash_diff)"""
for _link, (_name, _nouns) in LINKS.items():
    _ids = [f"{n}_id" for n in _nouns]
    CTES[f"checkedall_{_link}"] = f"""
        SELECT c.*, {", ".join(f"h_{n}.{n}_hk" for n in _nouns)} FROM cleaned2_{_name} c
        {" ".join(f"LEFT JOIN hubs_{n} h_{n} ON h_{n}.{n}_id = c.{n}_id" for n in _nouns)}
        WHERE {" AND ".join(f"c.{i} IS NOT NULL" for i in _ids)}"""
    CTES[f"rowsall_{_link}"] = f"""
        SELECT DISTINCT {_hash([f"CAST({i} AS VARCHAR)" for i in _ids])} AS link_hk FROM checkedall_{_link}
        WHERE {" AND ".join(f"{n}_hk IS NOT NULL" for n in _nouns)}
        UNION SELECT link_hk FROM rows_{_link}"""


def _logged(batch: str) -> str:
    """A row of (source_table, level, reason) for every record that a load logs."""
    checked = "checkedall" if batch else "checked"
    found = []
    for name, noun in NOUNS.items():
        bad = " OR ".join(f"{c}_format NOT IN ({ACCEPTED.get(c, repr('valid'))})" for c in PARSERS[name])
        found += [
            f"SELECT '{name}' AS source_table, 'fatal' AS level, fatal_reason AS reason FROM parsed{batch}_{name} WHERE is_fatal",
            f"""SELECT '{name}', 'warn', 'invalid_descriptive_attributes' FROM parsed{batch}_{name}
                WHERE NOT is_fatal AND (duplicate_count > 1 OR {bad})""",
            f"""SELECT '{name}', 'warn', 'conflicting_versions'
                FROM (SELECT DISTINCT {noun}_hk, hash_diff FROM versions{batch}_{noun}) v
                WHERE NOT EXISTS (SELECT 1 FROM sat{batch}_{noun} s
                    WHERE s.{noun}_hk = v.{noun}_hk AND s.hash_diff = v.hash_diff)""",
        ]
    for link, (name, nouns) in LINKS.items():
        missing = " OR ".join(f"{n}_hk IS NULL" for n in nouns)
        found.append(f"SELECT '{name}', 'warn', 'missing_reference' FROM {checked}_{link} WHERE {missing}")
    return " UNION ALL ".join(found)


# --- analytics -------------------------------------------------------------------------------

CTES["done_orders"] = "SELECT order_hk FROM sat_order WHERE status = 'completed'"
for _case_name, _preferred, _rates in (
    ("", "RUB", {"RUB": 1, "USD": 75, "EUR": 85}),
    ("_no_rates", "EUR", {"EUR": 1}),
):
    _rate = _case(*[f"WHEN currency = '{c}' THEN {r}" for c, r in _rates.items()])
    CTES[f"paid{_case_name}"] = f"""
        SELECT l.order_hk, s.payment_timestamp, {_pieces("s.amount", f"({_rate})")}
        FROM sat_payment s
        JOIN rows_link_payment_order l ON l.payment_hk = s.payment_hk
        JOIN done_orders c ON c.order_hk = l.order_hk
        WHERE {_rate} IS NOT NULL AND s.amount IS NOT NULL"""
CTES["last_action"] = """
        SELECT l.customer_hk, CAST(CAST(max(s.event_timestamp) AS DATE) AS VARCHAR)
                   AS last_action_date
        FROM sat_event s JOIN rows_link_event_customer_product l ON l.event_hk = s.event_hk
        GROUP BY l.customer_hk"""


def _with(query: str) -> str:
    """``query`` with the common table expressions it needs, in order of definition."""
    needed: set[str] = set()
    waiting = [query]
    while waiting:
        words = set(re.findall(r"\w+", waiting.pop()))
        for name in (words & CTES.keys()) - needed:
            needed.add(name)
            waiting.append(CTES[name])
    ordered: list[str] = []

    def place(name: str) -> None:
        for other in sorted(set(re.findall(r"\w+", CTES[name])) & CTES.keys() - {name}):
            if other not in ordered:
                place(other)
        ordered.append(name)

    for name in sorted(needed):
        if name not in ordered:
            place(name)
    if not ordered:
        return query
    ctes = ",\n".join(f"{name} AS ({CTES[name]}\n)" for name in ordered)
    return f"WITH {ctes}\n{query}"


def _lucrative(paid: str) -> str:
    rows = f"""{paid} p
        JOIN rows_link_order_customer_product l ON l.order_hk = p.order_hk
        JOIN hub_customer h ON h.customer_hk = l.customer_hk
        JOIN sat_customer s ON s.customer_hk = l.customer_hk"""
    return f"""
        SELECT customer_id, full_name, {_TOTAL} AS total_spent
        FROM ({_carried("h.customer_id, s.full_name", rows, "GROUP BY ALL")})
        ORDER BY h2 DESC, h1 DESC, h0 DESC, f1 DESC, f2 DESC, customer_id LIMIT 10"""


def _revenue(paid: str) -> str:
    month = "CAST(CAST(date_trunc('month', payment_timestamp) AS DATE) AS VARCHAR) AS month"
    return f"""
        SELECT month, {_TOTAL} AS total_revenue
        FROM ({_carried(month, f"{paid} WHERE payment_timestamp IS NOT NULL", "GROUP BY 1")}) ORDER BY 1"""


def _products(facts: str) -> str:
    return f"""
        SELECT CAST(h.product_id AS VARCHAR) AS product_id, s.product_name, count(*) AS popularity
        FROM ({facts}) f JOIN hub_product h USING (product_hk) JOIN sat_product s USING (product_hk)
        GROUP BY h.product_id, s.product_name ORDER BY count(*) DESC, h.product_id LIMIT 10"""


def _customers(facts: str, count_name: str) -> str:
    return f"""
        SELECT t.customer_id, s.full_name, t.{count_name}, a.last_action_date
        FROM (SELECT h.customer_hk, h.customer_id, count(*) AS {count_name}
              FROM ({facts}) f JOIN hub_customer h ON h.customer_hk = f.customer_hk
              GROUP BY ALL ORDER BY 3 DESC, 2 LIMIT 5) t
        JOIN sat_customer s ON s.customer_hk = t.customer_hk
        LEFT JOIN last_action a ON a.customer_hk = t.customer_hk
        ORDER BY 3 DESC, 1"""


def _events(event_type: str) -> str:
    return f"""SELECT l.* FROM sat_event s JOIN rows_link_event_customer_product l
               ON l.event_hk = s.event_hk WHERE s.event_type = '{event_type}'"""


_ORDERS = """SELECT l.* FROM done_orders c JOIN rows_link_order_customer_product l
             ON l.order_hk = c.order_hk"""


def statements() -> dict[str, str]:
    found: dict[str, str] = {}
    for name, columns in COLUMNS.items():
        key, noun = columns[0], NOUNS[name]
        attributes, hk = columns[1:], f"{noun}_hk"
        absent = "nullif({c}, '') AS {c}" if name in ("orders", "events") else "{c}"
        found[f"read_{name}"] = f"SELECT {', '.join(absent.format(c=c) for c in columns)} FROM raw_{name}"
        if name in BROKEN:
            broken = f"""{BROKEN[name]} || '",' || chr(10) || '^"' || chr(10) || {BROKEN[name]}"""
            texts = [f"{broken} AS {c}" if c == BROKEN[name] else c for c in columns]
            found[f"read_line_feeds_{name}"] = f"SELECT {', '.join(texts)} FROM raw_{name}"
        found[f"row_hash_{name}"] = f"SELECT {key}, {_hash(columns)} AS row_hash FROM raw_{name}"
        for column in PARSERS[name]:
            code = f", {_phone_code('trim(phone)')} AS phone_code" if column == "phone" else ""
            found[f"parse_{name}_{column}"] = f"""
                SELECT {key} AS source_key, {column} AS raw_value,
                       CAST(v_{column} AS VARCHAR) AS value, {column}_format AS format{code}
                FROM parsed_{name}"""
        found[f"duplicate_counts_{name}"] = f"""
            SELECT row_hash, count(*) AS duplicate_count FROM parsed_{name} GROUP BY row_hash"""
        found[f"clean_{name}"] = f"SELECT {_plain([*columns, 'row_hash'])} FROM cleaned_{name}"
        tags = ", ".join(f"{c}_format" for c in attributes)
        bad = " OR ".join(
            f"{c}_format NOT IN ({ACCEPTED.get(c, repr('valid'))})" for c in PARSERS[name]
        )
        found[f"rejects_warn_{name}"] = f"""
            SELECT '{name}' AS source_table, {", ".join(columns)}, row_hash, 'warn' AS level,
                   'invalid_descriptive_attributes' AS reason, {tags},
                   duplicate_count AS num_duplicates
            FROM parsed_{name} WHERE NOT is_fatal AND (duplicate_count > 1 OR {bad})"""
        found[f"hub_{noun}"] = f"SELECT * FROM hub_{noun}"
        found[f"hub_incremental_{noun}"] = f"""
            SELECT * FROM hub2_{noun} WHERE {key} NOT IN (SELECT {key} FROM hub_{noun})"""
        sat_columns = _plain([hk, *attributes, "hash_diff"])
        found[f"sat_{noun}"] = f"SELECT {sat_columns} FROM sat_{noun}"
        found[f"sat_incremental_{noun}"] = f"""
            SELECT {sat_columns} FROM sat2_{noun} n WHERE NOT EXISTS (
                SELECT 1 FROM sat_{noun} o WHERE o.{hk} = n.{hk} AND o.hash_diff = n.hash_diff)"""
        found[f"sat_latest_{noun}"] = f"""
            SELECT {hk}, CASE WHEN batch = 1 THEN '2026-01-01 00:00:00'
                              ELSE '2026-01-02 00:00:00' END AS load_datetime,
                   {_plain([*attributes, "hash_diff"])}
            FROM (SELECT 1 AS batch, * FROM sat_{noun}
                  UNION ALL
                  SELECT 2, * FROM sat2_{noun} n WHERE NOT EXISTS (
                      SELECT 1 FROM sat_{noun} o
                      WHERE o.{hk} = n.{hk} AND o.hash_diff = n.hash_diff))
            QUALIFY row_number() OVER (PARTITION BY {hk} ORDER BY batch DESC) = 1"""
        found[f"sat_current_{noun}"] = f"""
            SELECT {sat_columns} FROM (
                SELECT * FROM sat2_{noun}
                UNION ALL
                SELECT * FROM sat_{noun} WHERE {hk} NOT IN (SELECT {hk} FROM sat2_{noun}))"""
        found[f"sat_of_known_keys_{noun}"] = f"""
            SELECT {sat_columns} FROM sat2_{noun} WHERE {hk} IN (SELECT {hk} FROM hub_{noun})"""
        found[f"conflicting_versions_{name}"] = f"""
            SELECT '{name}' AS source_table, CAST({key} AS VARCHAR) AS {key},
                   min(row_hash) AS row_hash, 'conflicting_versions' AS reason, hash_diff
            FROM versionsboth_{noun} v
            WHERE NOT EXISTS (SELECT 1 FROM satboth_{noun} s
                              WHERE s.{hk} = v.{hk} AND s.hash_diff = v.hash_diff)
            GROUP BY {key}, hash_diff"""
    found["rejects_fatal"] = " UNION ALL ".join(
        f"""SELECT '{name}' AS source_table, row_hash, 'fatal' AS level,
                   fatal_reason AS reason FROM parsed_{name} WHERE is_fatal"""
        for name, columns in COLUMNS.items()
    )
    for link, (name, nouns) in LINKS.items():
        found[link] = f"SELECT * FROM rows_{link}"
        found[f"{link}_incremental"] = f"""
            SELECT * FROM rows2_{link} WHERE link_hk NOT IN (SELECT link_hk FROM rows_{link})"""
        kind = _case(*[f"WHEN {n}_hk IS NULL THEN '{n}_id'" for n in nouns])
        value = _case(*[f"WHEN {n}_hk IS NULL THEN CAST({n}_id AS VARCHAR)" for n in nouns])
        found[f"missing_references_{name}"] = f"""
            SELECT '{name}' AS source_table, row_hash, 'warn' AS level,
                   'missing_reference' AS reason, {kind} AS missing_type,
                   {value} AS missing_value, 'cleaned.{name}' AS checked_table
            FROM checked_{link} WHERE {" OR ".join(f"{n}_hk IS NULL" for n in nouns)}"""

    accepted = """(SELECT v_payment_id AS payment_id, v_amount AS amount, v_currency AS currency, row_number() OVER () AS n
                  FROM parsed_payments WHERE NOT is_fatal)"""
    for suffix, rates in (("", {"RUB": "1", "USD": "75", "EUR": "85"}), ("_no_rates", {"RUB": "1"})):
        rate = _case(*[f"WHEN currency = '{c}' THEN {r}" for c, r in rates.items()])
        pieces = f"(SELECT payment_id, n, amount IS NULL OR {rate} IS NULL AS none, {_pieces('amount', f'({rate})')} FROM {accepted})"
        found[f"converted_payments{suffix}"] = f"""
            SELECT payment_id, CASE WHEN NOT none THEN {_TOTAL} END AS amount_rub
            FROM ({_carried("payment_id, n, none", pieces, "GROUP BY ALL")})"""
    rates = {"EUR": "1", "USD": "75 / 85", "RUB": "1 / 85"}
    amount = "CAST(amount AS DOUBLE) * " + _case(*[f"WHEN currency = '{c}' THEN {r}" for c, r in rates.items()])
    found["converted_payments_into_eur"] = f"""
        SELECT payment_id, CASE WHEN x < 1000000000000 THEN CAST(round(CAST(x AS DECIMAL(30,6)), 2) AS DOUBLE)
               ELSE round(x / pow(10, floor(log10(x)) - 8)) END AS amount_eur
        FROM (SELECT payment_id, {amount} AS x FROM {accepted})"""
    for suffix in ("", "_no_rates"):
        found[f"top_customers_lucrative{suffix}"] = _lucrative(f"paid{suffix}")
        found[f"monthly_revenue{suffix}"] = _revenue(f"paid{suffix}")
    for by, event_type in (("views", "view"), ("clicks", "click"), ("purchases", "purchase")):
        found[f"top_products_{by}"] = _products(_events(event_type))
    found["top_products_orders"] = _products(_ORDERS)
    found["top_customers_orders"] = _customers(_ORDERS, "order_count")
    found["top_customers_purchases"] = _customers(_events("purchase"), "purchase_count")
    found["customers_without_orders"] = """
        SELECT h.customer_id, s.full_name FROM hub_customer h
        JOIN sat_customer s ON s.customer_hk = h.customer_hk
        WHERE h.customer_hk NOT IN (SELECT customer_hk FROM rows_link_order_customer_product)
        ORDER BY h.customer_id"""
    stored = {f"cleaned_{n}": f"cleaned_{n}" for n in COLUMNS}
    stored |= {f"hub_{n}": f"hub_{n}" for n in NOUNS.values()}
    stored |= {f"sat_{n}": f"sat_{n}" for n in NOUNS.values()}
    stored |= {link: f"rows_{link}" for link in LINKS}
    found["structure_counts"] = " UNION ALL ".join(
        f"SELECT '{shown}' AS table_name, count(*) AS row_count FROM {cte}"
        for shown, cte in stored.items()
    )
    logged = [f"SELECT 1 FROM ({found[f'rejects_warn_{name}']})" for name in COLUMNS]
    logged += [f"SELECT 1 FROM ({found['rejects_fatal']})"]
    logged += [f"SELECT 1 FROM ({found[f'missing_references_{name}']})" for name, _ in LINKS.values()]
    logged += [
        f"""SELECT DISTINCT 1 + 0 * length(v.{noun}_hk || v.hash_diff) FROM versions_{noun} v
            WHERE NOT EXISTS (SELECT 1 FROM sat_{noun} s
                              WHERE s.{noun}_hk = v.{noun}_hk AND s.hash_diff = v.hash_diff)"""
        for noun in NOUNS.values()
    ]
    found["structure_counts"] += f""" UNION ALL
        SELECT 'rejected_records', count(*) FROM ({" UNION ALL ".join(logged)})"""
    first = {f"hub_{n}": f"hub_{n}" for n in NOUNS.values()} | {f"sat_{n}": f"sat_{n}" for n in NOUNS.values()}
    first |= {link: f"rows_{link}" for link in LINKS}
    both = {f"hub_{n}": f"hubs_{n}" for n in NOUNS.values()} | {f"sat_{n}": f"sats_{n}" for n in NOUNS.values()}
    both |= {link: f"rowsall_{link}" for link in LINKS}
    for name, tables in (("a_killed_load", first), ("two_loads", both)):
        found[f"structure_after_{name}"] = " UNION ALL ".join(
            f"SELECT '{shown}' AS table_name, count(*) AS row_count FROM {cte}" for shown, cte in tables.items()
        )
    found["structure_after_a_killed_load"] += f" UNION ALL SELECT 'rejected_records', count(*) FROM ({_logged('')})"
    found["log_after_two_loads"] = " UNION ALL ".join(
        f"""SELECT '2026-01-0{day} 00:00:00' AS load_datetime, source_table, level, reason, count(*) AS records
            FROM ({_logged(batch)}) GROUP BY ALL"""
        for day, batch in ((1, ""), (2, "2"))
    )
    return {name: _with(query) for name, query in found.items()}
