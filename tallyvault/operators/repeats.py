"""Rows whose key no other row has, apart from the rest: only the rest needs a shuffle to be compared."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys that are broadcast at most, eight bytes each; more are broadcast as a bitmap.
MOST_KEYS = 1_000_000
#: Bits of a bitmap (16 MB), however many keys it stands for, and of each of its rows.
BITS, PART = 2**27, 2**15


def _hashed(keys: Sequence[str]) -> str:
    return f"xxhash64({', '.join(keys)})"


def hashes_of(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.selectExpr(f"{_hashed(keys)} AS _key")


def marked(hashes: DataFrame) -> DataFrame:
    """Hashes (_key) as a bitmap in rows of ``PART`` bits: a bit is set if a hash falls on it.

    Keys whose bit is not set are not among them; a key whose bit is set need not be, the more seldom the
    fewer there are (4 million keys mark 3 % of the bits, 40 million 26 %).
    """
    slots = hashes.selectExpr(f"pmod(_key, {BITS}L) AS _slot")
    return slots.groupBy(F.expr(f"_slot div {PART} AS _part")).agg(F.expr(f"bitmap_construct_agg(_slot % {PART}) AS _marks"))


def repeated_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hashes (_key) that more than one row has; of each row only the hash is shuffled.

    Every repeated key is among them. Two keys of one hash look like a repeated one, so what is done with
    these rows must be right for a key of one row, too.
    """
    return hashes_of(rows, keys).groupBy("_key").agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1").select("_key")


def parted(rows: DataFrame, keys: Sequence[str], repeated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose key is their own, and the others; ``repeated`` is broadcast, so nothing is shuffled.

    It has the repeated hashes, or is their bitmap (``marked``): then some rows whose key is their own are among
    the others.
    """
    found, on = F.broadcast(repeated), F.expr(f"{_hashed(keys)} = _key")
    if "_marks" in repeated.columns:
        slot = f"pmod({_hashed(keys)}, {BITS}L)"
        byte = f"conv(hex(substr(_marks, cast({slot} % {PART} div 8 AS int) + 1, 1)), 16, 10)"
        on = F.expr(f"{slot} div {PART} = _part AND getbit(cast({byte} AS int), cast({slot} % 8 AS int)) = 1")
    return rows.join(found, on, "left_anti"), rows.join(found, on, "left_semi")
