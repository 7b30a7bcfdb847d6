"""Every operator as a named query over the benchmark tables.

Each query is ``(spark, sf_dir) -> DataFrame`` over whole tables. Results use plain types (money as
double, dates and times as text) so that they compare with any other engine's.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyvault.functions.currency import converted_amount, exact_amount
from tallyvault.functions.hashing import canonical_text
from tallyvault.functions.parsers import MONEY, phone_code
from tallyvault.model import (
    BY_NOUN,
    ENTITIES,
    EVENTS,
    LINKS,
    ORDERS,
    PAYMENTS,
    VAULT_SCHEMAS,
    Entity,
    Link,
)
from tallyvault.operators.cleaning import (
    accepted_rows,
    cleaned_rows,
    collapse_copies,
    parse,
    with_row_hash,
)
from tallyvault.operators.hubs import new_hub_rows
from tallyvault.operators.links import checked_ids, linked_ids, missing_references, new_link_rows, rows_near
from tallyvault.operators.rejects import clean_rejects, fatal_rejects, warn_rejects
from tallyvault.operators.satellites import conflicting_versions, latest_version, new_sat_rows
from tallyvault.plans import analytics
from tallyvault.plans.pipeline import Load
from tallyvault.plans.report import structure_counts
from tallyvault.plans.staging import Staging, run_together, shuffles_dropped
from tallyvault.plans.vault import StoredVault, other_hubs
from tallyvault.sources.bindings import next_batch, raw_entity
from tallyvault.sources.readers import READERS

Query = Callable[[SparkSession, str], DataFrame]

FIRST_LOAD = datetime(2026, 1, 1)
SECOND_LOAD = datetime(2026, 1, 2)
RATES = {"RUB": 1, "USD": 75, "EUR": 85}

# What a second load changes, by entity: attribute and its new text.
CHANGES = {
    "customers": ("city", "Moved"),
    "products": ("currency", "EUR"),
    "payments": ("payment_method", "paypal"),
    "orders": ("status", "cancelled"),
    "events": ("event_type", "login"),
}


WIDE = {f"{c}_wide" for e in ENTITIES.values() for c, p in e.attributes.items() if p.wide}


def plain(rows: DataFrame) -> DataFrame:
    def column(field: T.StructField) -> str:
        if f"{field.name}_wide" in WIDE:
            return f"cast({exact_amount(field.name)} AS double) AS {field.name}"
        if isinstance(field.dataType, (T.DateType, T.TimestampNTZType)):
            return f"cast({field.name} AS string) AS {field.name}"
        return field.name

    return rows.selectExpr(*[column(f) for f in rows.schema.fields if f.name not in WIDE])


# --- inputs ----------------------------------------------------------------------------------


def _raw(spark: SparkSession, sf_dir: str, entity: Entity) -> DataFrame:
    return raw_entity(spark, sf_dir, entity.name)


def _second_raw(spark: SparkSession, sf_dir: str, entity: Entity) -> DataFrame:
    return next_batch(_raw(spark, sf_dir, entity), entity, *CHANGES[entity.name])


def _accepted(raw: DataFrame, entity: Entity) -> DataFrame:
    """Rows ready for the vault; one scan, no shuffle."""
    return accepted_rows(parse(with_row_hash(raw, entity), entity), entity)


def _parsed(raw: DataFrame, entity: Entity) -> DataFrame:
    """Distinct raw rows with their copy counts, parsed."""
    return parse(collapse_copies(with_row_hash(raw, entity), entity), entity)


# --- sources ---------------------------------------------------------------------------------


def read_back(spark: SparkSession, sf_dir: str, entity: Entity) -> DataFrame:
    """An entity's raw rows written as a source file of its format, and read by its reader."""
    path = f"{Staging(spark).root}/{entity.name}"
    raw = _raw(spark, sf_dir, entity)
    if entity is ORDERS:
        raw.write.json(path)
    elif entity is EVENTS:
        raw.write.format("xml").option("rootTag", "events").option("rowTag", "event").save(path)
    else:
        writer = raw.write.option("header", True).option("escape", '"').option("emptyValue", '""')
        writer.option("sep", "^" if entity is PAYMENTS else ",").option("nullValue", "").option(
            "ignoreLeadingWhiteSpace", False
        ).option("ignoreTrailingWhiteSpace", False).csv(path)
    return READERS[entity.name](spark, path)


# The text column that gets line feeds, separators and quotes, by entity.
BROKEN = {"customers": "full_name", "products": "product_name", "payments": "payment_method"}


def read_line_feeds(spark: SparkSession, sf_dir: str, entity: Entity) -> DataFrame:
    """Raw rows with line feeds in one column, written as CSV files and read by any number of tasks."""
    path, name = f"{Staging(spark).root}/{entity.name}", BROKEN[entity.name]
    raw = _raw(spark, sf_dir, entity).withColumn(name, F.expr(f"""concat({name}, '",\\n^"\\n', {name})"""))
    writer = raw.write.option("header", True).option("escape", '"').option("emptyValue", '""')
    writer = writer.option("sep", "^" if entity is PAYMENTS else ",").option("nullValue", "")
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return READERS[entity.name](spark, path, multi_line=True)


# --- cleaning --------------------------------------------------------------------------------


def row_hash(spark: SparkSession, sf_dir: str, entity: Entity) -> DataFrame:
    return with_row_hash(_raw(spark, sf_dir, entity), entity).select(entity.key, "row_hash")


def parse_column(spark: SparkSession, sf_dir: str, entity: Entity, column: str) -> DataFrame:
    """Raw text, parsed value as text and tag of one column, for every source row."""
    rows = parse(with_row_hash(_raw(spark, sf_dir, entity), entity), entity)
    extra = [f"{phone_code('trim(raw_phone)')} AS phone_code"] if column == "phone" else []
    value = f"cast({column} AS string)"
    if f"{column}_wide" in WIDE:
        value = f"coalesce({canonical_text(column, MONEY)}, {column}_wide)"
    return rows.selectExpr(
        f"raw_{entity.key} AS source_key",
        f"raw_{column} AS raw_value",
        f"{value} AS value",
        f"{column}_format AS format",
        *extra,
    )


def duplicate_counts(spark: SparkSession, sf_dir: str, entity: Entity) -> DataFrame:
    rows = collapse_copies(with_row_hash(_raw(spark, sf_dir, entity), entity), entity)
    return rows.filter("variant = 1").select("row_hash", "duplicate_count")


def clean(spark: SparkSession, sf_dir: str, entity: Entity) -> DataFrame:
    return plain(cleaned_rows(_parsed(_raw(spark, sf_dir, entity), entity), entity))


def rejects_fatal(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = [
        fatal_rejects(_parsed(_raw(spark, sf_dir, e), e), e, FIRST_LOAD) for e in ENTITIES.values()
    ]
    return reduce(DataFrame.unionAll, records).selectExpr(
        "source_table",
        _json("raw_payload", "row_hash"),
        _json("error_details", "level"),
        _json("error_details", "reason"),
    )


def rejects_warn(spark: SparkSession, sf_dir: str, entity: Entity) -> DataFrame:
    records = warn_rejects(_parsed(_raw(spark, sf_dir, entity), entity), entity, FIRST_LOAD)
    return records.selectExpr(
        "source_table",
        *[_json("raw_payload", c) for c in (*entity.columns, "row_hash")],
        _json("error_details", "level"),
        _json("error_details", "reason"),
        *[_json("error_details", f"{c}_format", "details.") for c in entity.attributes],
        "cast(get_json_object(error_details, '$.details.num_duplicates') AS bigint)"
        " AS num_duplicates",
    )


def _json(column: str, name: str, path: str = "", called: str = "") -> str:
    return f"get_json_object({column}, '$.{path}{name}') AS {called or name}"


# --- vault -----------------------------------------------------------------------------------


def hub(spark: SparkSession, sf_dir: str, entity: Entity) -> DataFrame:
    rows = _accepted(_raw(spark, sf_dir, entity), entity)
    return new_hub_rows(rows, entity, FIRST_LOAD).drop("load_datetime")


def hub_incremental(spark: SparkSession, sf_dir: str, entity: Entity) -> DataFrame:
    """Hub rows the second load adds."""
    known = new_hub_rows(_accepted(_raw(spark, sf_dir, entity), entity), entity, FIRST_LOAD)
    rows = _accepted(_second_raw(spark, sf_dir, entity), entity)
    return new_hub_rows(rows, entity, SECOND_LOAD, known).drop("load_datetime")


def sat(spark: SparkSession, sf_dir: str, entity: Entity) -> DataFrame:
    rows = _accepted(_raw(spark, sf_dir, entity), entity)
    return plain(new_sat_rows(rows, entity, FIRST_LOAD).drop("load_datetime"))


def _two_loads(spark: SparkSession, sf_dir: str, entity: Entity) -> tuple[DataFrame, DataFrame]:
    first = new_sat_rows(_accepted(_raw(spark, sf_dir, entity), entity), entity, FIRST_LOAD)
    rows = _accepted(_second_raw(spark, sf_dir, entity), entity)
    return first, new_sat_rows(rows, entity, SECOND_LOAD, history=first)


def sat_incremental(spark: SparkSession, sf_dir: str, entity: Entity) -> DataFrame:
    """Versions the second load adds."""
    return plain(_two_loads(spark, sf_dir, entity)[1].drop("load_datetime"))


def sat_latest(spark: SparkSession, sf_dir: str, entity: Entity) -> DataFrame:
    """The newest version of every key after two loads."""
    first, second = _two_loads(spark, sf_dir, entity)
    return plain(latest_version(first.unionByName(second), entity.hk))


def sat_of_known_keys(spark: SparkSession, sf_dir: str, entity: Entity) -> DataFrame:
    """Versions of a second load limited to the keys that the first load's hub holds."""
    known = new_hub_rows(_accepted(_raw(spark, sf_dir, entity), entity), entity, FIRST_LOAD)
    rows = _accepted(_second_raw(spark, sf_dir, entity), entity)
    return plain(new_sat_rows(rows, entity, SECOND_LOAD, hub=known).drop("load_datetime"))


def conflicts(spark: SparkSession, sf_dir: str, entity: Entity) -> DataFrame:
    """Versions set aside when both loads' rows arrive as one batch."""
    both = _raw(spark, sf_dir, entity).unionByName(_second_raw(spark, sf_dir, entity))
    rows = cleaned_rows(_parsed(both, entity), entity)
    return conflicting_versions(rows, entity, FIRST_LOAD).selectExpr(
        "source_table",
        _json("raw_payload", entity.key),
        _json("raw_payload", "row_hash"),
        _json("error_details", "reason"),
        _json("error_details", "hash_diff", "details."),
    )


def _other_hubs(spark: SparkSession, sf_dir: str, link: Link) -> dict[str, DataFrame]:
    """First-load hub rows of the ids a link's rows refer to, by noun."""
    referred = [BY_NOUN[noun] for noun in link.nouns[1:]]
    return {
        e.noun: new_hub_rows(_accepted(_raw(spark, sf_dir, e), e), e, FIRST_LOAD) for e in referred
    }


def link(spark: SparkSession, sf_dir: str, link: Link) -> DataFrame:
    rows = _accepted(_raw(spark, sf_dir, link.entity), link.entity)
    ids = Staging(spark).put("ids", linked_ids(rows, link))
    checked = checked_ids(ids, link, _other_hubs(spark, sf_dir, link))
    return new_link_rows(checked, link, FIRST_LOAD).drop("load_datetime")


def link_incremental(spark: SparkSession, sf_dir: str, link: Link) -> DataFrame:
    """Link rows the second load adds, checked against the first load's hubs, own hub included."""
    hubs = _other_hubs(spark, sf_dir, link)
    first = _accepted(_raw(spark, sf_dir, link.entity), link.entity)
    staging = Staging(spark)
    first_ids = staging.put("first", linked_ids(first, link))
    known = new_link_rows(checked_ids(first_ids, link, hubs), link, FIRST_LOAD)
    rows = _accepted(_second_raw(spark, sf_dir, link.entity), link.entity)
    second_hub = new_hub_rows(rows, link.entity, SECOND_LOAD)
    ids = staging.put("second", linked_ids(rows, link))
    checked = checked_ids(ids, link, hubs | {link.nouns[0]: second_hub})
    return new_link_rows(checked, link, SECOND_LOAD, known).drop("load_datetime")


def missing(spark: SparkSession, sf_dir: str, link: Link) -> DataFrame:
    entity = link.entity
    staging = Staging(spark)
    rows = staging.put("rows", cleaned_rows(_parsed(_raw(spark, sf_dir, entity), entity), entity))
    ids = staging.put("ids", linked_ids(rows, link))
    checked = checked_ids(ids, link, _other_hubs(spark, sf_dir, link))
    return missing_references(rows, checked, link, FIRST_LOAD).selectExpr(
        "source_table",
        _json("raw_payload", "row_hash"),
        *[_json("error_details", c) for c in ("level", "reason")],
        _json("error_details", "missing_type", "details."),
        _json("error_details", "missing_value", "details."),
        _json("error_details", "source_table", "details.", called="checked_table"),
    )


# --- analytics -------------------------------------------------------------------------------

_vaults: dict[tuple[str, str], dict[str, DataFrame]] = {}


def stored_vault(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The vault of the benchmark tables, loaded into the shared folder once per session.

    Analytics read a loaded vault; they do not load one per question.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _vaults:
        with shuffles_dropped(spark):
            _vaults[key] = _store_vault(spark, sf_dir)
    return _vaults[key]


def _store_vault(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The tables of ``planned_vault``, each written as soon as what it is made from is."""
    staging, passing = Staging(spark), Staging(spark)
    accepted = dict(
        zip(
            ENTITIES,
            run_together(
                partial(passing.put, e.name, _accepted(_raw(spark, sf_dir, e), e)) for e in ENTITIES.values()
            ),
        )
    )

    def put_hub(entity: Entity) -> DataFrame:
        return staging.put(entity.hub, new_hub_rows(accepted[entity.name], entity, FIRST_LOAD))

    def put_sat(entity: Entity) -> DataFrame:
        rows = accepted[entity.name]
        repeated = passing.repeats(f"keys_{entity.name}", rows, [entity.key])
        return staging.put(entity.sat, new_sat_rows(rows, entity, FIRST_LOAD, repeated=repeated))

    named = [getattr(e, kind) for e in ENTITIES.values() for kind in ("hub", "sat")]
    stored = dict(
        zip(named, run_together(partial(put, e) for e in ENTITIES.values() for put in (put_hub, put_sat)))
    )

    def put_link(link: Link) -> DataFrame:
        ids = passing.put(f"ids_{link.name}", linked_ids(accepted[link.entity.name], link))
        checked = checked_ids(ids, link, other_hubs(link, stored))
        return staging.put(link.name, new_link_rows(checked, link, FIRST_LOAD))

    links = run_together(partial(put_link, link) for link in LINKS.values())
    passing.drop()
    return {name: (stored | dict(zip(LINKS, links)))[name] for name in VAULT_SCHEMAS}


def _analytics(build: Callable[..., DataFrame], *args) -> Query:
    return lambda spark, sf_dir: plain(build(stored_vault(spark, sf_dir), *args))


def converted_payments(spark: SparkSession, sf_dir: str, rates: dict | None, into: str = "RUB") -> DataFrame:
    """Every accepted payment in one currency, as exact text."""
    rows = _accepted(_raw(spark, sf_dir, PAYMENTS), PAYMENTS)
    amount = converted_amount(exact_amount("amount"), "currency", into, rates)
    return rows.selectExpr("payment_id", f"{amount} AS amount_{into.lower()}")


def rounded_payments(spark: SparkSession, sf_dir: str, rates: dict, into: str) -> DataFrame:
    """The same where rates have no end: cents, or the first nine digits of large amounts."""
    name = f"amount_{into.lower()}"
    rows = converted_payments(spark, sf_dir, rates, into).withColumn("x", F.col(name).cast("double"))
    small = "round(cast(x AS decimal(30,6)), 2)"
    large = "round(x / pow(10, floor(log10(x)) - 8))"
    return rows.select("payment_id", F.expr(f"if(x < 1e12, cast({small} AS double), {large})").alias(name))


def structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of the cleaned tables, the reject log and the vault after a first load."""
    vault, staging = stored_vault(spark, sf_dir), Staging(spark)
    with shuffles_dropped(spark):
        parsed = {
            e.name: staging.put_parsed(_raw(spark, sf_dir, e), e) for e in ENTITIES.values()
        }
        cleaned = {e.name: cleaned_rows(parsed[e.name], e) for e in ENTITIES.values()}
        log = [clean_rejects(parsed[e.name], e, FIRST_LOAD) for e in ENTITIES.values()]
        for e in ENTITIES.values():
            repeated = staging.repeats(f"keys_{e.name}", cleaned[e.name], [e.key])
            log.append(conflicting_versions(cleaned[e.name], e, FIRST_LOAD, repeated))
        for each in LINKS.values():
            rows = cleaned[each.entity.name]
            ids = staging.put(f"ids_{each.name}", linked_ids(rows, each))
            checked = staging.put(f"checked_{each.name}", checked_ids(ids, each, other_hubs(each, vault)))
            failing = staging.put(f"failing_{each.name}", checked.filter("missing_type IS NOT NULL"))
            log.append(missing_references(rows_near(rows, failing, each), failing, each, FIRST_LOAD))
    tables = {f"cleaned_{name}": rows for name, rows in cleaned.items()}
    return structure_counts(tables | {"rejected_records": reduce(DataFrame.unionAll, log)} | vault)


# --- loads -----------------------------------------------------------------------------------


def _loaded(spark: SparkSession, sf_dir: str, dies_after: str = "") -> StoredVault:
    """A stored vault after both loads, once per session; with dies_after the second one ends after that step.

    The vault stays; what the loads staged is deleted as soon as each has ended.
    """
    key = (spark.sparkContext.applicationId, sf_dir, dies_after)
    if key not in _stored:
        with shuffles_dropped(spark):
            _stored[key] = _load_twice(spark, sf_dir, dies_after)
    return _stored[key]


_stored: dict[tuple[str, str, str], StoredVault] = {}


def _load_twice(spark: SparkSession, sf_dir: str, dies_after: str) -> StoredVault:
    vault = StoredVault(spark, f"{Staging(spark).root}/vault")
    batches = [
        {name: _raw(spark, sf_dir, e) for name, e in ENTITIES.items()},
        {name: _second_raw(spark, sf_dir, e) for name, e in ENTITIES.items()},
    ]
    first = Load(spark, vault, FIRST_LOAD, Staging(spark))
    first.run(batches[0])
    first.staging.drop()
    second = Load(spark, vault, SECOND_LOAD, Staging(spark))
    if dies_after:
        second.stage(batches[1])
        for step in ("log_rejects", "load_hubs", "load_satellites", "load_links"):
            getattr(second, step)()
            if step == dies_after:
                break
    else:
        second.run(batches[1])
    second.staging.drop()
    return vault


def structure_after_a_killed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of vault and log when a second load died after its hubs and satellites."""
    vault = _loaded(spark, sf_dir, dies_after="load_satellites")
    return structure_counts({"rejected_records": vault.rejects()} | {name: vault[name] for name in vault})


def structure_after_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    vault = _loaded(spark, sf_dir)
    return structure_counts({name: vault[name] for name in vault})


def log_after_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many records of each kind the log holds; the second load adds to those of the first."""
    log = _loaded(spark, sf_dir).rejects()
    kind = ["cast(load_datetime AS string) AS load_datetime", "source_table"]
    kinds = log.selectExpr(*kind, _json("error_details", "level"), _json("error_details", "reason"))
    return kinds.groupBy(*kinds.columns).agg(F.count(F.lit(1)).alias("records"))


def sat_current(spark: SparkSession, sf_dir: str, entity: Entity) -> DataFrame:
    """The newest version of every key as the stored vault keeps it after two loads."""
    return plain(_loaded(spark, sf_dir).current(entity.sat).drop("load_datetime"))


# --- registry --------------------------------------------------------------------------------


def registry() -> dict[str, Query]:
    found: dict[str, Query] = {}

    def per_entity(prefix: str, query, entities=tuple(ENTITIES.values()), by: str = "name"):
        for entity in entities:
            found[f"{prefix}_{getattr(entity, by)}"] = partial(query, entity=entity)

    per_entity("read", read_back)
    per_entity("read_line_feeds", read_line_feeds, [ENTITIES[name] for name in BROKEN])
    per_entity("row_hash", row_hash)
    for entity in ENTITIES.values():
        for column in entity.parsers:
            found[f"parse_{entity.name}_{column}"] = partial(
                parse_column, entity=entity, column=column
            )
    per_entity("duplicate_counts", duplicate_counts)
    per_entity("clean", clean)
    found["rejects_fatal"] = rejects_fatal
    per_entity("rejects_warn", rejects_warn)

    per_entity("hub", hub, by="noun")
    per_entity("hub_incremental", hub_incremental, by="noun")
    per_entity("sat", sat, by="noun")
    per_entity("sat_incremental", sat_incremental, by="noun")
    per_entity("sat_latest", sat_latest, by="noun")
    per_entity("sat_current", sat_current, by="noun")
    per_entity("sat_of_known_keys", sat_of_known_keys, by="noun")
    per_entity("conflicting_versions", conflicts)
    for each in LINKS.values():
        found[each.name] = partial(link, link=each)
        found[f"{each.name}_incremental"] = partial(link_incremental, link=each)
        found[f"missing_references_{each.entity.name}"] = partial(missing, link=each)

    found["converted_payments"] = partial(converted_payments, rates=RATES)
    found["converted_payments_no_rates"] = partial(converted_payments, rates=None)
    found["converted_payments_into_eur"] = partial(rounded_payments, rates=RATES, into="EUR")
    found["top_customers_lucrative"] = _analytics(analytics.get_top_customers, "RUB", RATES, 10)
    found["top_customers_lucrative_no_rates"] = _analytics(analytics.get_top_customers, "EUR", None, 10)
    found["monthly_revenue"] = _analytics(analytics.get_monthly_revenue, "RUB", RATES)
    found["monthly_revenue_no_rates"] = _analytics(analytics.get_monthly_revenue, "EUR")
    for by in analytics.TOP_PRODUCTS:
        found[f"top_products_{by}"] = _analytics(analytics.top_products, by, 10)
    for by in analytics.TOP_CUSTOMERS:
        found[f"top_customers_{by}"] = _analytics(analytics.top_customers, by, 5)
    found["customers_without_orders"] = _analytics(analytics.get_customers_without_orders)
    found["structure_counts"] = structure
    found["structure_after_a_killed_load"] = structure_after_a_killed_load
    found["structure_after_two_loads"] = structure_after_two_loads
    found["log_after_two_loads"] = log_after_two_loads
    return found
