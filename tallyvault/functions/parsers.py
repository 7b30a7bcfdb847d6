"""Column parsers: raw text -> typed value plus a quality tag.

A parser builds two SQL expressions. ``value`` maps the trimmed text to the typed value (NULL when
unusable); ``tag`` names what was found, given the text and the column that holds the value, so
that the tag does not evaluate the value's pattern again. They use built-in functions only, so
parsing stays in one whole-stage-codegen span.

Tag names, accepted words and patterns are fixed values of the log format.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import types as T

from tallyvault.functions.exact import plain_text

# Money keeps 20 whole digits and 18 decimals. A number beyond that is not rounded: its column is
# NULL, and the column <name>_wide holds it as plain text.
MONEY = T.DecimalType(38, 18)
SURE_LENGTH = 19  # no number this short without an exponent has more digits than money

# Accepted words.
CATEGORIES = ("Home", "Books", "Electronics", "Clothing", "Sports")
CURRENCIES = ("USD", "EUR", "RUB")
PAYMENT_METHODS = ("bank_transfer", "card", "paypal")
ORDER_STATUSES = ("processing", "completed", "cancelled")
EVENT_TYPES = ("view", "login", "purchase", "click", "logout")
TRUE_WORDS = ("true", "1", "yes")
FALSE_WORDS = ("false", "0", "no")
PLACEHOLDER_NAME = "ivan ivanov"

# Accepted patterns. \z, because $ would let a trailing line feed through.
NAME = r"^([\p{Ll}\s.\-]*?)\s*((\p{Lu}\p{Ll}*)([\s.\-]+\p{Lu}\p{Ll}*){1,2})\s*\z"
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\z"
PHONE_CHARS = r"^[0-9\-+() ]*\z"
ISO_DATE = r"^(?!0000)\d{4}-\d{2}-\d{2}\z"
DOTTED_DATE = r"^\d{2}\.\d{2}\.(?!0000)\d{4}\z"
NUMBER = r"^[+-]?(?=\.?\d)\d*\.?(\d*?)0*(?:[eE]([+-]?\d+))?\z"
FULL_TIMESTAMP = r"^(?!0000)\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z"

# Tags of the accepted date forms.
TAG_ISO_DATE = "yyyy-mm-dd"
TAG_DOTTED_DATE = "dd.mm.yyyy"
TAG_FULL_TIMESTAMP = "yyyy-mm-dd hh24:mi:ss"


class Parser(NamedTuple):
    data_type: T.DataType
    value: Callable[[str], str]
    tag: Callable[[str, str], str]
    accepted: tuple[str, ...] = ("valid",)
    #: of a number of any size: the value, given the column that holds ``money`` of the text, so that
    #: it is parsed once; and the plain text of a number that ``money`` can't hold, given both
    of_number: Callable[[str], str] | None = None
    wide: Callable[[str, str], str] | None = None


def quoted(words: Sequence[str]) -> str:
    """Words as a list of SQL string literals."""
    return ", ".join(f"'{word}'" for word in words)


def _parser(
    data_type: T.DataType,
    value: Callable[[str], str],
    *,
    null: str = "null",
    empty: str = "empty",
    tokens: Mapping[str, str] | None = None,
    usable: Callable[[str], str] = lambda t: "'valid'",
    unusable: Callable[[str], str] = lambda t: "'invalid'",
    accepted: tuple[str, ...] = ("valid",),
) -> Parser:
    """Tag order: NULL, '', special tokens, then whether a value came out."""
    missing = {"": empty, **(tokens or {})}

    def tag(text: str, parsed: str) -> str:
        special = " ".join(f"WHEN {text} = '{token}' THEN '{t}'" for token, t in missing.items())
        return (
            f"CASE WHEN {text} IS NULL THEN '{null}' {special}"
            f" WHEN {parsed} IS NOT NULL THEN {usable(text)} ELSE {unusable(text)} END"
        )

    return Parser(data_type, value, tag, accepted)


def _one_of(words: Sequence[str]) -> Parser:
    return _parser(T.StringType(), lambda t: f"CASE WHEN {t} IN ({quoted(words)}) THEN {t} END")


def _positive(data_type: T.DataType, tokens: Mapping[str, str] | None = None) -> Parser:
    def value(text: str) -> str:
        number = f"try_cast({text} AS {data_type.simpleString()})"
        return f"CASE WHEN {number} > 0 THEN {number} END"

    return _parser(data_type, value, tokens=tokens)


def money(t: str) -> str:
    """The exact number, NULL for other text and for numbers that need more digits.

    Short text of digits alone is cast and no more; only other text meets the pattern.
    """
    number = f"try_cast({t} AS {MONEY.simpleString()})"
    short = rf"length({t}) <= {SURE_LENGTH} AND {t} RLIKE r'^[-+.0-9]+\z'"
    return f"CASE WHEN {short} THEN {number} WHEN {_decimals(t)} <= {MONEY.scale} THEN {number} END"


def _decimals(t: str) -> str:
    """Digits a number has behind its point, zeros at the end left out; NULL for other text."""
    digits = f"length(regexp_extract({t}, r'{NUMBER}', 1))"
    exponent = f"coalesce(try_cast(nullif(regexp_extract({t}, r'{NUMBER}', 2), '') AS int), 0)"
    return f"CASE WHEN {t} RLIKE r'{NUMBER}' THEN {digits} - {exponent} END"


def _money_parser(positive: bool, tokens: Mapping[str, str] | None = None) -> Parser:
    def of_number(n: str) -> str:
        return f"CASE WHEN {n} > 0 THEN {n} END" if positive else n

    def wide(t: str, n: str) -> str:
        text = f"if(startswith({t}, '-'), NULL, nullif({plain_text(t)}, '0'))" if positive else plain_text(t)
        return f"CASE WHEN {n} IS NULL THEN {text} END"

    parser = _parser(MONEY, lambda t: of_number(money(t)), tokens=tokens)
    return parser._replace(of_number=of_number, wide=wide)


def _iso_date(t: str) -> str:
    return f"CASE WHEN {t} RLIKE r'{ISO_DATE}' THEN try_to_date({t}, 'yyyy-MM-dd') END"


def _dotted_date(t: str) -> str:
    return f"CASE WHEN {t} RLIKE r'{DOTTED_DATE}' THEN try_to_date({t}, 'dd.MM.yyyy') END"


def _full_timestamp(t: str) -> str:
    return f"CASE WHEN {t} RLIKE r'{FULL_TIMESTAMP}' THEN try_cast({t} AS timestamp_ntz) END"


def _midnight(date: str) -> str:
    return f"cast({date} AS timestamp_ntz)"


# --- customers -------------------------------------------------------------------------------

# Customer columns spell the missing-value tags differently from the other sources.
_CUSTOMER = {"null": "invalid null", "empty": "invalid empty"}
_CUSTOMER_OR_UNKNOWN = {**_CUSTOMER, "tokens": {"UNKNOWN": "invalid unknown"}}


def _is_placeholder(t: str) -> str:
    return rf"lower(regexp_replace({t}, r'\s+', ' ')) = '{PLACEHOLDER_NAME}'"


def _phone_digits(t: str) -> str:
    return f"CASE WHEN {t} RLIKE r'{PHONE_CHARS}' THEN regexp_replace({t}, '[^0-9]', '') END"


def _phone(t: str) -> str:
    digits = _phone_digits(t)
    return f"CASE WHEN length({digits}) >= 10 THEN right({digits}, 10) END"


def phone_code(t: str) -> str:
    """Digits in front of the ten of a valid phone number, NULL when there are none."""
    digits = _phone_digits(t)
    return f"CASE WHEN length({digits}) > 10 THEN left({digits}, length({digits}) - 10) END"


FULL_NAME = _parser(
    T.StringType(),
    lambda t: (
        f"CASE WHEN NOT ({_is_placeholder(t)})"
        f" THEN nullif(regexp_extract({t}, r'{NAME}', 2), '') END"
    ),
    **_CUSTOMER,
    # a name that does not open with a capital has a prefix in front of it
    usable=lambda t: (
        rf"CASE WHEN {t} RLIKE r'^\s*\p{{Lu}}' THEN 'valid' ELSE 'valid with prefix' END"
    ),
    unusable=lambda t: (
        f"CASE WHEN {_is_placeholder(t)} THEN 'invalid placeholder' ELSE 'invalid' END"
    ),
    accepted=("valid", "valid with prefix"),
)
EMAIL_ADDRESS = _parser(
    T.StringType(),
    lambda t: f"CASE WHEN {t} RLIKE r'{EMAIL}' THEN {t} END",
    **_CUSTOMER_OR_UNKNOWN,
)
PHONE = _parser(
    T.StringType(),
    _phone,
    **_CUSTOMER_OR_UNKNOWN,
    unusable=lambda t: (
        f"CASE WHEN {t} RLIKE r'{PHONE_CHARS}' THEN 'invalid short' ELSE 'invalid symb' END"
    ),
)
CITY = _parser(
    T.StringType(),
    lambda t: f"CASE WHEN {t} NOT IN ('', 'UNKNOWN') THEN {t} END",
    **_CUSTOMER_OR_UNKNOWN,
)
CREATED_AT = _parser(
    T.DateType(),
    lambda t: f"coalesce({_iso_date(t)}, {_dotted_date(t)})",
    **_CUSTOMER_OR_UNKNOWN,
    usable=lambda t: f"if(contains({t}, '-'), '{TAG_ISO_DATE}', '{TAG_DOTTED_DATE}')",
    accepted=(TAG_ISO_DATE, TAG_DOTTED_DATE),
)

# --- products --------------------------------------------------------------------------------

PRODUCT_NAME = _parser(T.StringType(), lambda t: f"nullif({t}, '')")
CATEGORY = _one_of(CATEGORIES)
PRICE = _money_parser(positive=False, tokens={"N/A": "na"})
CURRENCY = _one_of(CURRENCIES)
IS_ACTIVE = _parser(
    T.BooleanType(),
    lambda t: (
        f"CASE WHEN lower({t}) IN ({quoted(TRUE_WORDS)}) THEN true"
        f" WHEN lower({t}) IN ({quoted(FALSE_WORDS)}) THEN false END"
    ),
)

# --- payments, orders, events ----------------------------------------------------------------

POSITIVE_ID = _positive(T.LongType())
EVENT_ID = _positive(T.LongType(), tokens={"BAD_ID": "bad_id"})
QUANTITY = _positive(T.IntegerType())
PAYMENT_METHOD = _one_of(PAYMENT_METHODS)
AMOUNT = _money_parser(positive=True, tokens={"error_amount": "error_amount"})
UNIT_PRICE = _money_parser(positive=True)
STATUS = _one_of(ORDER_STATUSES)
EVENT_TYPE = _one_of(EVENT_TYPES)
PAYMENT_TIMESTAMP = _parser(
    T.TimestampNTZType(),
    lambda t: f"coalesce({_full_timestamp(t)}, {_midnight(_dotted_date(t))})",
    usable=lambda t: f"if(contains({t}, '-'), '{TAG_FULL_TIMESTAMP}', '{TAG_DOTTED_DATE}')",
    accepted=(TAG_FULL_TIMESTAMP, TAG_DOTTED_DATE),
)
ORDER_TIMESTAMP = _parser(
    T.TimestampNTZType(),
    lambda t: f"coalesce({_full_timestamp(t)}, {_midnight(_iso_date(t))})",
    tokens={"2025-99-99": "placeholder_date"},
    usable=lambda t: f"if(contains({t}, ':'), '{TAG_FULL_TIMESTAMP}', '{TAG_ISO_DATE}')",
    accepted=(TAG_FULL_TIMESTAMP, TAG_ISO_DATE),
)
EVENT_TIMESTAMP = _parser(
    T.TimestampNTZType(),
    _full_timestamp,
    tokens={"broken-date": "broken-date"},
    usable=lambda t: f"'{TAG_FULL_TIMESTAMP}'",
    accepted=(TAG_FULL_TIMESTAMP,),
)
