"""Hubs: the business keys ever seen, one row each."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from tallyvault.functions.hashing import hub_key
from tallyvault.model import Entity
from tallyvault.operators.rejects import timestamp_literal


def new_hub_rows(
    rows: DataFrame, entity: Entity, load_time: datetime, known: DataFrame | None = None
) -> DataFrame:
    """Keys of ``rows`` that ``known`` does not hold yet, stamped with the load time.

    ``distinct`` folds repeated keys in the map tasks, so the shuffle and the anti join see
    unique keys only.
    """
    keys = rows.select(entity.key).filter(f"{entity.key} IS NOT NULL").distinct()
    if known is not None:
        keys = keys.join(known.select(entity.key), entity.key, "left_anti")
    return keys.selectExpr(
        f"{hub_key(entity.key)} AS {entity.hk}",
        entity.key,
        f"{timestamp_literal(load_time)} AS load_datetime",
    )
