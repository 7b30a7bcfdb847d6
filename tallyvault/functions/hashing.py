"""md5 fingerprints over text, shared by row hashes, hub keys, hash diffs and link keys.

Like the parsers, these build SQL expression text: one expression per column crosses from Python
to the JVM, instead of one call per operator in it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

SEPARATOR = "||"


def md5_of(parts: Iterable[str]) -> str:
    """md5 of the parts joined by ``||``; NULL counts as ''.

    ``concat_ws`` alone would drop a NULL together with its separator, so that two different
    rows could share a hash; every part is therefore coalesced first.
    """
    texts = ", ".join(f"coalesce({part}, '')" for part in parts)
    return f"md5(concat_ws('{SEPARATOR}', {texts}))"


def hub_key(business_key: str) -> str:
    """Surrogate key of a hub row: md5 of the business key as text."""
    return f"md5(cast({business_key} as string))"


def canonical_text(column: str, data_type: T.DataType) -> str:
    """A typed value as the text that goes into a hash diff.

    Money loses its trailing zeros, so 59.9 and 59.90 are the same value and do not make a new
    satellite version.
    """
    text = f"cast({column} as string)"
    if isinstance(data_type, T.DecimalType):
        return rf"regexp_replace(regexp_replace({text}, '0+$', ''), r'\.$', '')"
    return text
