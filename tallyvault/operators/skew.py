"""Equi-join of many rows with a lookup table when some keys own very many rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Counters of a sketch for each share that makes a key hot. A sketch of m counters is off by less than
#: 4 rows in m, so every key with more than 1.25 shares is found.
COUNTERS = 16
MOST_COUNTERS = 1_000_000

HotKeys = Mapping[int, int]  # xxhash64 of the key -> groups


def counters(spark: SparkSession) -> int:
    return min(COUNTERS * int(spark.conf.get("spark.sql.shuffle.partitions")), MOST_COUNTERS)


def _hashed(keys: Sequence[str]) -> str:
    return f"xxhash64({', '.join(keys)})"


def _groups(spark: SparkSession, rows: int, counted: Sequence) -> HotKeys:
    share = rows / int(spark.conf.get("spark.sql.shuffle.partitions"))
    return {c["item"]: -int(-c["count"] // share) for c in counted if c["count"] > share}


def hot_keys(rows: DataFrame, *keys: Sequence[str]) -> list[HotKeys]:
    """For each list of key columns the keys that own more rows than an even share of the partitions.

    One pass over the rows: every map task counts heavy hitters in a sketch of fixed size, and only
    sketches are shuffled. It runs here and now, so give rows that are stored. Counts are estimates;
    which keys are named changes how a join is spread, never what it returns.
    """
    spark, size = rows.sparkSession, counters(rows.sparkSession)
    most = min(size, int(spark.conf.get("spark.sql.shuffle.partitions")) * 2)
    found = rows.selectExpr(
        "count(*) AS n", *[f"approx_top_k({_hashed(k)}, {most}, {size}) AS k{i}" for i, k in enumerate(keys)]
    ).first()
    return [_groups(spark, found["n"], found[f"k{i}"]) for i in range(len(keys))]


def sketches(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the number of rows, and per column a sketch of its heavy hitters that can be merged."""
    size = counters(rows.sparkSession)
    return rows.selectExpr("count(*) AS n", *[f"approx_top_k_accumulate({_hashed([c])}, {size}) AS {c}" for c in columns])


def hot_keys_of(stored: DataFrame, column: str) -> HotKeys:
    """hot_keys from rows of ``sketches``; the data they were made from isn't read."""
    spark, size = stored.sparkSession, counters(stored.sparkSession)
    most = min(size, int(spark.conf.get("spark.sql.shuffle.partitions")) * 2)
    merged = stored.selectExpr("sum(n) AS n", f"approx_top_k_combine({column}, {size}) AS k")
    found = merged.selectExpr("n", f"approx_top_k_estimate(k, {most}) AS k").first()
    return _groups(spark, found["n"] or 0, found["k"] or [])


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    hot: HotKeys | None = None,
) -> DataFrame:
    """``rows`` joined with ``lookup`` on ``keys`` (inner or left), with hot keys cut into groups.

    A hot key's rows get a group number from ``spread_by`` (columns that tell them apart) and its
    lookup rows are repeated once per group, so the join key is (key, group) and no group is much
    larger than an even share. Every row has one group, so the result is the plain join's. The
    repeats add at most twice as many lookup keys as there are partitions.

    ``hot`` is an entry of ``hot_keys`` of these rows, or of a stored table they come from. There are
    fewer hot keys than partitions, so their list may be broadcast; without any, the join is the plain
    one.
    """
    hot = hot_keys(rows, keys)[0] if hot is None else hot
    if not hot:
        return rows.join(lookup, list(keys), how)
    spark = rows.sparkSession
    table = F.broadcast(spark.createDataFrame(list(hot.items()), "_key long, _groups long"))

    def with_groups(side: DataFrame, group: str) -> DataFrame:
        found = side.withColumn("_key", F.expr(_hashed(keys))).join(table, "_key", "left")
        return found.selectExpr(*side.columns, f"{group} AS _group")

    grouped = with_groups(rows, f"if(_groups IS NULL, 0L, pmod(xxhash64({', '.join(spread_by)}), _groups))")
    repeated = with_groups(lookup, "explode(sequence(0L, coalesce(_groups, 1L) - 1))")
    return grouped.join(repeated, [*keys, "_group"], how).drop("_group")
