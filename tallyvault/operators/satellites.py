"""Satellites: the attribute versions of each key over time."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyvault.functions.hashing import canonical_text, hub_key, md5_of
from tallyvault.model import Entity
from tallyvault.operators.rejects import (
    cleaned_payload,
    error_details,
    reject_records,
    timestamp_literal,
)
from tallyvault.operators.repeats import parted


def latest_version(sat: DataFrame, hk: str) -> DataFrame:
    """The newest row of each key.

    Row number 1 per key: Spark keeps one row per key in each map task before the shuffle, so a
    key with very many versions does not land on one task.
    """
    newest = Window.partitionBy(hk).orderBy(F.desc("load_datetime"))
    return sat.withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n")


def hash_diff_of(entity: Entity) -> str:
    """What tells a version from others: md5 of its values."""
    return md5_of(
        f"coalesce({text}, {c}_wide)" if p.wide else text
        for c, p in entity.attributes.items()
        for text in [canonical_text(c, p.data_type)]
    )


def _versioned(rows: DataFrame, entity: Entity) -> DataFrame:
    return rows.filter(f"{entity.key} IS NOT NULL").selectExpr(
        f"{hub_key(entity.key)} AS {entity.hk}", "*", f"{hash_diff_of(entity)} AS hash_diff"
    )


def _short(rows: DataFrame, entity: Entity) -> DataFrame:
    """Versions as they are shuffled: hashes as bytes, which sort like their text, and no hash key, which
    follows from the business key."""
    return rows.filter(f"{entity.key} IS NOT NULL").selectExpr(
        entity.key,
        *[f.name for f in entity.value_fields],
        "unhex(row_hash) AS row_hash",
        f"unhex({hash_diff_of(entity)}) AS hash_diff",
    )


def _chosen(versioned: DataFrame, key: str) -> DataFrame:
    """One version per key and batch: the one with the smallest row hash."""
    first = Window.partitionBy(key).orderBy("row_hash", "hash_diff")
    return versioned.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")


def _fingerprint(hk: str, hash_diff: str) -> str:
    """Sixteen bytes that stand for a version of a key."""
    return f"unhex(md5(concat({hk}, {hash_diff})))"


def new_sat_rows(
    rows: DataFrame,
    entity: Entity,
    load_time: datetime,
    history: DataFrame | None = None,
    hub: DataFrame | None = None,
    latest: DataFrame | None = None,
    repeated: DataFrame | None = None,
    bucketed: bool = False,
) -> DataFrame:
    """Versions to append: keys without any version, or whose latest version differs.

    What is stored is given as all versions (``history``) or, read once per key, as the ``latest`` ones.
    ``hub`` limits the rows to its keys; leave it out when the hub was loaded from these rows,
    as it then holds every key. Both joins come after the choice of one row per key, so no key is
    hot in them. They use the hash key alone, the partitioning that the rows and the history already
    have from their row-number windows, so the comparison adds no shuffle.

    With ``repeated`` (``repeated_keys`` of these rows by business key, or their bitmap, to be broadcast) only
    the rows of such keys go through the choice; all others are their key's one version and are shuffled for the
    comparison at most, without the hashes that follow from their key and values. The ``latest`` versions then
    meet them as one fingerprint of key and version each, unless they are ``bucketed`` by hash key.
    """
    values = [f.name for f in entity.value_fields]
    if repeated is None:
        own, hk = [entity.hk, *values], entity.hk
        chosen = _chosen(_versioned(rows, entity), entity.hk)
    else:
        # a business key is shorter to shuffle than the hash key that follows from it
        own, hk = [entity.key, *values], hub_key(entity.key)
        given = rows.filter(f"{entity.key} IS NOT NULL")
        single, several = parted(given, [entity.key], repeated)
        chosen = single.select(*own).unionByName(_chosen(_short(several, entity), entity.key).select(*own))
    if hub is not None:
        known = hub.select(F.col(entity.hk).alias("_known"))
        chosen = chosen.join(known, F.expr(hk) == F.col("_known"), "left_semi")
    if latest is None and history is not None:
        latest = latest_version(history.select(entity.hk, "load_datetime", "hash_diff"), entity.hk)
    chosen = chosen.select(*own)
    if latest is not None and repeated is not None and not bucketed:
        # a key has one latest version, so a version that is not among them is new
        stored = latest.selectExpr(f"{_fingerprint(entity.hk, 'hash_diff')} AS _stored")
        own_version = F.expr(_fingerprint(hk, hash_diff_of(entity)))
        chosen, latest = chosen.join(stored, own_version == F.col("_stored"), "left_anti"), None
    if latest is not None:
        # hashes are hexadecimal text, twice as long as the bytes they stand for
        stored = latest.selectExpr(f"{entity.hk} AS _hk", "unhex(hash_diff) AS _stored")
        chosen = chosen.join(stored, F.expr(hk) == F.col("_hk"), "left").drop("_hk")
    chosen = chosen.selectExpr("*", f"{hash_diff_of(entity)} AS hash_diff")
    if latest is not None:
        chosen = chosen.filter("_stored IS NULL OR _stored <> unhex(hash_diff)")
    return chosen.selectExpr(
        f"{hk} AS {entity.hk}",
        f"{timestamp_literal(load_time)} AS load_datetime",
        *[f.name for f in entity.value_fields],
        "hash_diff",
    )


def conflicting_versions(
    rows: DataFrame, entity: Entity, load_time: datetime, repeated: DataFrame | None = None
) -> DataFrame:
    """Reject records for the versions a batch offered beside the chosen one.

    A key can have one version per load time. Equal versions are folded first; the others are
    found by an anti join on (key, version), which stays even when one key has most versions. The chosen
    ones are folded in the map tasks.
    With ``repeated`` (see ``new_sat_rows``) rows that are their key's only one are left out at once.
    """
    if repeated is not None:
        rows = parted(rows.filter(f"{entity.key} IS NOT NULL"), [entity.key], repeated)[1]
    version = [entity.key, "hash_diff"]
    first = Window.partitionBy(*version).orderBy("row_hash")
    offered = _short(rows, entity)
    versions = offered.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")
    smallest = offered.groupBy(entity.key).agg(F.expr("min(struct(row_hash, hash_diff)).hash_diff AS hash_diff"))
    losers = versions.join(smallest, version, "left_anti").withColumns(
        {name: F.expr(f"lower(hex({name}))") for name in ("row_hash", "hash_diff")}
    )
    details = error_details("warn", "'conflicting_versions'", hash_diff="hash_diff")
    return reject_records(losers, entity.name, load_time, cleaned_payload(entity), details)
