"""The load: raw entities -> staged parsed rows -> reject log, hubs, satellites, links."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tallyvault.model import ENTITIES, LINKS, Entity, Link
from tallyvault.operators.cleaning import cleaned_rows
from tallyvault.operators.hubs import new_hub_rows
from tallyvault.operators.links import checked_ids, linked_ids, missing_references, new_link_rows, rows_near
from tallyvault.operators.rejects import clean_rejects
from tallyvault.operators.satellites import conflicting_versions, new_sat_rows
from tallyvault.plans.staging import Staging, run_together, shuffles_dropped
from tallyvault.plans.vault import StoredVault, other_hubs


def load_id_of(load_time: datetime) -> str:
    """Load ids sort in load order; two loads of one microsecond would be one."""
    return load_time.strftime("%Y%m%dT%H%M%S%f")


@dataclass
class Load:
    """One load of one batch into a stored vault.

    Every source is read and parsed once, into staged Parquet tables of distinct raw rows with
    their values, tags and copy counts; all later steps read the columns they need from them.
    The steps run in the order hubs, then satellites and links; within a step the tables are
    independent and their jobs run side by side. No reader sees any of it before the last step, which
    publishes the load.
    """

    spark: SparkSession
    vault: StoredVault
    load_time: datetime
    staging: Staging
    load_id: str = ""
    again: bool = False  # load an id once more that is complete already

    def __post_init__(self) -> None:
        self.load_id = self.load_id or load_id_of(self.load_time)
        self.parsed: dict[str, DataFrame] = {}

    def run(self, raw: Mapping[str, DataFrame]) -> None:
        if self.vault.is_complete(self.load_id) and not self.again:
            raise ValueError(f"load {self.load_id} is in the vault already")
        self.vault.withdraw(self.load_id)
        with shuffles_dropped(self.spark):
            self.stage(raw)
            self.log_rejects()
            self.load_hubs()
            self.load_satellites()
            self.load_links()
        self.vault.set_complete(self.load_id)
        self.vault.drop_old_snapshots()

    def cleaned(self, entity: Entity) -> DataFrame:
        return cleaned_rows(self.parsed[entity.name], entity)

    def stage(self, raw: Mapping[str, DataFrame]) -> None:
        def parse_and_write(entity: Entity) -> None:
            self.parsed[entity.name] = self.staging.put_parsed(raw[entity.name], entity)

        run_together(partial(parse_and_write, e) for e in ENTITIES.values())

    def log_rejects(self) -> None:
        def write(entity: Entity) -> None:
            records = clean_rejects(self.parsed[entity.name], entity, self.load_time)
            self.vault.log(records, self.load_id, f"clean_{entity.name}")

        run_together(partial(write, e) for e in ENTITIES.values())

    def load_hubs(self) -> None:
        def write(entity: Entity) -> None:
            known = self.vault.before(entity.hub, self.load_id)
            rows = new_hub_rows(self.cleaned(entity), entity, self.load_time, known)
            self.vault.append(entity.hub, rows, self.load_id)

        run_together(partial(write, e) for e in ENTITIES.values())

    def load_satellites(self) -> None:
        def find_repeated(entity: Entity) -> DataFrame:
            return self.staging.repeats(f"keys_{entity.name}", self.cleaned(entity), [entity.key])

        repeated = dict(zip(ENTITIES, run_together(partial(find_repeated, e) for e in ENTITIES.values())))

        def write(entity: Entity) -> None:
            latest = self.vault.current(entity.sat, self.load_id)
            history = self.vault.before(entity.sat, self.load_id) if latest is None else None
            rows = new_sat_rows(
                self.cleaned(entity),
                entity,
                self.load_time,
                history,
                latest=latest,
                repeated=repeated[entity.name],
                bucketed=self.vault.buckets is not None,
            )
            self.vault.append(entity.sat, rows, self.load_id)
            self.vault.set_current(entity.sat, self.load_id)

        def log_conflicts(entity: Entity) -> None:
            conflicts = conflicting_versions(self.cleaned(entity), entity, self.load_time, repeated[entity.name])
            self.vault.log(conflicts, self.load_id, f"versions_{entity.name}")

        run_together(partial(job, e) for e in ENTITIES.values() for job in (write, log_conflicts))

    def load_links(self) -> None:
        def write(link: Link) -> None:
            rows = self.cleaned(link.entity)
            # the id tuples, and the checked ones, are written once and read by every later job
            ids = self.staging.put(f"ids_{link.name}", linked_ids(rows, link))
            checked = checked_ids(ids, link, other_hubs(link, self.vault.during(self.load_id)))
            checked = self.staging.put(f"checked_{link.name}", checked)
            known = self.vault.before(link.name, self.load_id)
            bucketed = self.vault.buckets is not None
            self.vault.append(
                link.name, new_link_rows(checked, link, self.load_time, known, bucketed), self.load_id
            )
            self.vault.sketch(link, self.load_id)
            # stored by themselves, so that few of them are broadcast; if they are many, other rows are not shuffled
            failing = self.staging.put(f"failing_{link.name}", checked.filter("missing_type IS NOT NULL"))
            missing = missing_references(rows_near(rows, failing, link), failing, link, self.load_time)
            self.vault.log(missing, self.load_id, f"references_{link.entity.name}")

        run_together(partial(write, link) for link in LINKS.values())
