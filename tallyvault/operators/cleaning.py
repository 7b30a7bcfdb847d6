"""Raw rows -> parsed rows -> cleaned rows, for any entity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyvault.functions.hashing import md5_of
from tallyvault.functions.parsers import money, quoted
from tallyvault.model import Entity


def with_row_hash(raw: DataFrame, entity: Entity) -> DataFrame:
    """The source columns and their fingerprint, taken over the untrimmed text in file order."""
    return raw.selectExpr(*entity.columns, f"{md5_of(entity.columns)} AS row_hash")


def collapse_copies(hashed: DataFrame, entity: Entity) -> DataFrame:
    """One row per distinct raw row, with how often it occurs.

    ``copies`` counts rows equal in every field; ``duplicate_count`` counts rows sharing the
    row hash, which differs only where '' and NULL (or a separator inside a field) make two
    unequal rows hash alike. ``variant`` numbers such rows, 1 being the one that is kept.

    The plain form, a window count over the raw rows, would send every copy of a row to one
    task. Grouping first lets each map task fold its copies into one row, so a row that makes
    up a third of the input reaches the window as one row per task at most.
    """
    same_hash = Window.partitionBy("row_hash")
    return (
        hashed.groupBy("row_hash", *entity.columns)
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumns(
            {
                "duplicate_count": F.sum("copies").over(same_hash),
                "variant": F.row_number().over(same_hash.orderBy(*entity.columns)),
            }
        )
    )


def parse(rows: DataFrame, entity: Entity) -> DataFrame:
    """Raw text (renamed ``raw_<column>``), typed values, ``<column>_format`` tags and verdicts.

    Narrow: no shuffle. Columns that are not source columns (row_hash, copies, ...) pass through.
    """
    passed = [c for c in rows.columns if c not in entity.columns]
    raw = rows.selectExpr(*[f"{c} AS raw_{c}" for c in entity.columns], *passed)

    wide = {c: p.wide for c, p in entity.parsers.items() if p.wide}
    numbered = raw.selectExpr("*", *[f"{money(f'trim(raw_{c})')} AS _{c}" for c in wide])
    values = {
        c: p.of_number(f"_{c}") if c in wide else p.value(f"trim(raw_{c})") for c, p in entity.parsers.items()
    }
    values |= {f"{c}_wide": text(f"trim(raw_{c})", f"_{c}") for c, text in wide.items()}
    values.setdefault(entity.key, f"try_cast(raw_{entity.key} AS bigint)")
    valued = numbered.selectExpr("*", *[f"{value} AS {c}" for c, value in values.items()])
    valued = valued.drop(*[f"_{c}" for c in wide])
    # the tags see the values as columns, so each value is computed once
    held = {c: f"coalesce({c}, if({c}_wide IS NULL, NULL, 1))" if c in wide else c for c in entity.parsers}
    tags = {c: p.tag(f"trim(raw_{c})", held[c]) for c, p in entity.parsers.items()}
    tagged = valued.selectExpr("*", *[f"{tag} AS {c}_format" for c, tag in tags.items()])

    bad_tags = [
        f"{c}_format NOT IN ({quoted(p.accepted)})" for c, p in entity.parsers.items()
    ]
    return tagged.selectExpr(
        "*",
        f"{_fatal_reason(entity)} AS fatal_reason",
        f"{' OR '.join(bad_tags)} AS has_non_fatal_error",
    )


def _fatal_reason(entity: Entity) -> str:
    """NULL for usable rows. The key is tested as it came, untrimmed."""
    raw_key = f"raw_{entity.key}"
    invalid = (
        f"WHEN {entity.key} IS NULL THEN 'invalid_{entity.key}'"
        if entity.key_parser is None
        else ""
    )
    return (
        f"CASE WHEN {raw_key} IS NULL OR {raw_key} IN ({quoted(entity.missing_keys)})"
        f" THEN 'missing_or_null_{entity.key}' {invalid} END"
    )


def accepted_rows(parsed: DataFrame, entity: Entity) -> DataFrame:
    """Typed rows that are not fatal; a bad attribute is NULL and the row stays.

    Copies are still in. Hubs, satellites and links fold them on their own keys, so the vault
    can be loaded from here without the row-hash shuffle.
    """
    return parsed.filter("fatal_reason IS NULL").select(*entity.cleaned_schema.names)


def cleaned_rows(parsed: DataFrame, entity: Entity) -> DataFrame:
    """Typed rows, one per row hash; ``parsed`` comes from ``collapse_copies``."""
    return accepted_rows(parsed.filter("variant = 1"), entity)
