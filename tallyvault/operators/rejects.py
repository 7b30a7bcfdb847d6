"""Reject records: what was wrong with a row, next to the row as it came."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyvault.model import Entity

# Copies written out by one task at a time; more are spread over tasks first.
COPIES_PER_TASK = 100_000


def timestamp_literal(moment: datetime) -> str:
    """The load time as a literal: a retried task or load stamps the same time."""
    return f"TIMESTAMP_NTZ '{moment.isoformat(sep=' ')}'"


def reject_records(
    rows: DataFrame, source_table: str, load_time: datetime, payload: str, details: str
) -> DataFrame:
    """Records in the log's schema; ``payload`` and ``details`` are struct expressions.

    The payload keeps its NULL fields, as it shows the whole row.
    """
    return rows.selectExpr(
        f"'{source_table}' AS source_table",
        f"{timestamp_literal(load_time)} AS load_datetime",
        f"to_json({payload}, map('ignoreNullFields', 'false')) AS raw_payload",
        f"to_json({details}) AS error_details",
    )


def raw_payload(entity: Entity) -> str:
    fields = ", ".join(f"'{c}', raw_{c}" for c in entity.columns)
    return f"named_struct({fields}, 'row_hash', row_hash)"


def cleaned_payload(entity: Entity) -> str:
    return f"struct({', '.join(entity.cleaned_schema.names)})"


def error_details(level: str, reason: str, **details: str) -> str:
    """Struct of level, reason (an expression) and, if any, a nested struct of details."""
    nested = ", ".join(f"'{name}', {value}" for name, value in details.items())
    tail = f", 'details', named_struct({nested})" if nested else ""
    return f"named_struct('level', '{level}', 'reason', {reason}{tail})"


def clean_rejects(parsed: DataFrame, entity: Entity, load_time: datetime) -> DataFrame:
    """Records of all raw rows that are not clean, one per copy, in one pass over the parsed rows.

    A row without a usable business key is fatal. A usable one is a warning if an attribute is bad
    or if it has duplicates; its details list every attribute's tag, good ones too, and the number
    of duplicates.
    """
    rejected = parsed.filter("fatal_reason IS NOT NULL OR has_non_fatal_error OR duplicate_count > 1")
    tags = ", ".join(f"'{c}_format', {c}_format" for c in entity.attributes)
    details = f"named_struct({tags}, 'num_duplicates', duplicate_count)"
    return reject_records(
        one_row_per_copy(rejected),
        entity.name,
        load_time,
        raw_payload(entity),
        "named_struct('level', if(fatal_reason IS NULL, 'warn', 'fatal'),"
        " 'reason', coalesce(fatal_reason, 'invalid_descriptive_attributes'),"
        f" 'details', if(fatal_reason IS NULL, {details}, NULL))",
    )


def fatal_rejects(parsed: DataFrame, entity: Entity, load_time: datetime) -> DataFrame:
    """Records of the rows without a usable business key only."""
    return clean_rejects(parsed.filter("fatal_reason IS NOT NULL"), entity, load_time)


def warn_rejects(parsed: DataFrame, entity: Entity, load_time: datetime) -> DataFrame:
    """Records of the usable rows with a bad attribute or with duplicates only."""
    return clean_rejects(parsed.filter("fatal_reason IS NULL"), entity, load_time)


def one_row_per_copy(collapsed: DataFrame, per_task: int = COPIES_PER_TASK) -> DataFrame:
    """Undo ``collapse_copies``: each row as often as its ``copies``.

    Rows with very many copies are cut into chunks and the chunks spread over tasks before they
    are written out, so no task produces more than a few chunks of one row.
    """
    few = collapsed.filter(F.col("copies") <= per_task).withColumn(
        "_copy", F.expr("explode(sequence(1, cast(copies AS int)))")
    )
    chunked = collapsed.filter(F.col("copies") > per_task).withColumn(
        "_chunk", F.expr(f"explode(sequence(0L, (copies - 1) div {per_task}))")
    )
    in_chunk = f"cast(least({per_task}, copies - _chunk * {per_task}) AS int)"
    many = (
        chunked.repartition("row_hash", "_chunk")
        .withColumn("_copy", F.expr(f"explode(sequence(1, {in_chunk}))"))
        .drop("_chunk")
    )
    return few.unionByName(many).drop("_copy")
