"""Links: which keys occur together, with a check that each key has a hub row."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyvault.functions.hashing import hub_key, md5_of
from tallyvault.model import BY_NOUN, Link
from tallyvault.operators.rejects import (
    cleaned_payload,
    error_details,
    reject_records,
    timestamp_literal,
)
from tallyvault.operators.repeats import hashes_of, marked, parted
from tallyvault.operators.skew import hot_keys, lookup_join


def linked_ids(rows: DataFrame, link: Link) -> DataFrame:
    """Distinct id tuples of ``rows``; tuples with a NULL id are skipped."""
    all_given = " AND ".join(f"{c} IS NOT NULL" for c in link.ids)
    return rows.select(*link.ids).filter(all_given).distinct()


def checked_ids(ids: DataFrame, link: Link, hubs: Mapping[str, DataFrame]) -> DataFrame:
    """The id tuples plus the first id that has no hub row.

    ``ids`` comes from ``linked_ids``; store it first, as one pass over it finds its hot keys here. ``hubs``
    maps nouns to hub rows; a noun left out is not checked, which is right for the link's own hub
    when it was loaded from these rows. Only the ids travel through the joins, and keys that own
    very many tuples are split (see ``lookup_join``).
    """
    checked = ids
    nouns = [n for n in link.nouns if n in hubs]
    hot = hot_keys(ids, *([BY_NOUN[n].key] for n in nouns)) if nouns else []
    for noun, heavy in zip(nouns, hot):
        key = BY_NOUN[noun].key
        present = hubs[noun].selectExpr(key, f"true AS has_{noun}")
        checked = lookup_join(checked, present, [key], link.ids, "left", heavy)
    tests = [f"if(has_{n} IS NULL, '{BY_NOUN[n].key}', NULL)" for n in link.nouns if n in hubs]
    first_missing = ", ".join([*tests, "cast(NULL AS string)"])
    return checked.selectExpr(*link.ids, f"coalesce({first_missing}) AS missing_type")


def new_link_rows(
    checked: DataFrame, link: Link, load_time: datetime, known: DataFrame | None = None, bucketed: bool = False
) -> DataFrame:
    """Link rows for the tuples whose ids all have hub rows, unless already linked.

    Where ``known`` is not ``bucketed`` by its link key, the keys are shuffled as bytes, half as long.
    """
    linked = checked.filter("missing_type IS NULL").select(*link.ids)
    link_hk = md5_of(f"cast({c} AS string)" for c in link.ids)
    # all keys follow from the ids, which are shorter to shuffle
    if known is not None:
        key = "{}" if bucketed else "unhex({})"
        stored = known.selectExpr(f"{key.format('link_hk')} AS _stored")
        linked = linked.join(stored, F.expr(f"{key.format(link_hk)} = _stored"), "left_anti")
    return linked.selectExpr(
        f"{link_hk} AS link_hk",
        *[f"{hub_key(BY_NOUN[n].key)} AS {BY_NOUN[n].hk}" for n in link.nouns],
        f"{timestamp_literal(load_time)} AS load_datetime",
    )


def rows_near(rows: DataFrame, tuples: DataFrame, link: Link) -> DataFrame:
    """The rows whose ids are among stored ``tuples``, and a few more, told by a bitmap without a shuffle."""
    return parted(rows, link.ids, marked(hashes_of(tuples, link.ids)))[1]


def missing_references(
    rows: DataFrame,
    checked: DataFrame,
    link: Link,
    load_time: datetime,
) -> DataFrame:
    """Reject records for the cleaned rows one of whose ids has no hub row.

    The wide rows are joined back to the few failing tuples; a tuple that very many rows share is
    split. Give stored ``rows``, or those of them that are ``rows_near`` the failing tuples: their hot tuples are
    counted here.
    """
    entity = link.entity
    missing = checked.filter("missing_type IS NOT NULL")
    found = lookup_join(rows, missing, link.ids, ["row_hash"])
    details = error_details(
        "warn",
        "'missing_reference'",
        missing_type="missing_type",
        missing_value=f"CASE missing_type {' '.join(f"WHEN '{c}' THEN {c}" for c in link.ids)} END",
        source_table=f"'cleaned.{entity.name}'",
    )
    return reject_records(found, entity.name, load_time, cleaned_payload(entity), details)
