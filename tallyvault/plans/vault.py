"""The vault: thirteen tables, either planned from one batch or stored as Parquet.

Both hold the rows the same operators produce. A planned vault is a dict of lazy DataFrames; a
stored one appends each load under its own ``load_id`` partition.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator, Mapping
from datetime import datetime
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyvault.model import BY_NOUN, ENTITIES, LINKS, REJECT_SCHEMA, REJECTS, VAULT_SCHEMAS, Link
from tallyvault.operators.hubs import new_hub_rows
from tallyvault.operators.links import checked_ids, linked_ids, new_link_rows
from tallyvault.operators.repeats import hashes_of, marked, parted
from tallyvault.operators.satellites import hash_diff_of, latest_version, new_sat_rows
from tallyvault.operators.skew import HotKeys, hot_keys_of, sketches
from tallyvault.plans.staging import CODEC


# The column each table is bucketed by. No bucket can be much larger than another: hub keys and
# link keys are unique, and a satellite has one row per key and load.
BUCKET_COLUMNS = (
    {e.hub: e.key for e in ENTITIES.values()}
    | {e.sat: e.hk for e in ENTITIES.values()}
    | {link.name: "link_hk" for link in LINKS.values()}
)


BY_SAT = {e.sat: e for e in ENTITIES.values()}


def other_hubs(link: Link, hubs: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Hub rows by noun for the ids a link's rows refer to; its own hub is complete by then."""
    return {noun: hubs[BY_NOUN[noun].hub] for noun in link.nouns[1:]}


def planned_vault(rows: Mapping[str, DataFrame], load_time: datetime) -> dict[str, DataFrame]:
    """All vault tables of a first load, from the accepted rows of each entity."""
    tables = {e.hub: new_hub_rows(rows[e.name], e, load_time) for e in ENTITIES.values()}
    tables |= {e.sat: new_sat_rows(rows[e.name], e, load_time) for e in ENTITIES.values()}
    for link in LINKS.values():
        ids = linked_ids(rows[link.entity.name], link)
        checked = checked_ids(ids, link, other_hubs(link, tables))
        tables[link.name] = new_link_rows(checked, link, load_time)
    return tables


class StoredVault(Mapping[str, DataFrame]):
    """Vault tables and the reject log as Parquet below one root folder.

    Every load writes ``<root>/<table>/load_id=<id>``, replacing only what an earlier attempt of
    the same load left there, so a load that failed half-way is simply run again. A load compares
    with earlier loads only (``before``), never with its own partition. Load ids sort in load
    order, e.g. ``20260131T235959000000``.

    The folder ``<root>/loads`` is the commit log: an empty file per load, made when all of the load
    is written. Every reader sees the loads in the log and no other, the reject log's included, so a
    load that died part-way, or still runs, changes no result; its own steps read through ``during``.
    A DataFrame keeps the loads that were published when it was made.

    ``<root>/current/<satellite>`` has the newest version of every key, written anew by each load from the
    one before and the load's own rows. It is named after the list of loads it stands for, so it counts
    as long as just these are in the log; after a load out of order, or one taken back, readers go
    through all versions until the next load. History is kept and read by nobody else. A snapshot has no
    ``hash_diff``, which follows from the values; it is worked out by those who read it.

    With ``buckets`` the tables are written in that many buckets: hubs by business key,
    satellites by hash key, links by link key. Finding latest versions, new keys, new versions and
    new links then needs no shuffle of the stored side. Use the session's shuffle partition count,
    as a batch is then shuffled straight into the buckets.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = self._agreed_buckets(buckets)
        if self.buckets is not None:
            digest = hashlib.md5(self.root.encode()).hexdigest()[:12]
            self._database = f"tallyvault_{digest}"
            self._create_tables()

    @staticmethod
    def default_buckets(spark: SparkSession, root: str) -> int | None:
        """The shuffle partition count for a new vault, and what a stored one was written with."""
        stored = StoredVault(spark, root)
        if stored.buckets or any(stored._exists(stored._path(table)) for table in VAULT_SCHEMAS):
            return stored.buckets
        return int(spark.conf.get("spark.sql.shuffle.partitions"))

    def __getitem__(self, table: str) -> DataFrame:
        return self._of_loads(self._read(table), self.published()).drop("load_id")

    def published(self) -> list[str]:
        """The loads of the commit log, in load order; one listing of one folder."""
        folder, files = self._hadoop(f"{self.root}/loads")
        if not files.exists(folder):
            return []
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        return sorted(unquote(name) for name in names if not name.startswith(("_", ".")))

    def during(self, load_id: str) -> dict[str, DataFrame]:
        """The tables as a load sees them: published ones and its own rows."""
        loads = [*self.published(), load_id]
        return {table: self._of_loads(self._read(table), loads).drop("load_id") for table in VAULT_SCHEMAS}

    @staticmethod
    def _of_loads(rows: DataFrame, loads: list[str]) -> DataFrame:
        return rows.filter(F.col("load_id").isin(loads))

    def __iter__(self) -> Iterator[str]:
        return iter(VAULT_SCHEMAS)

    def __len__(self) -> int:
        return len(VAULT_SCHEMAS)

    def is_complete(self, load_id: str) -> bool:
        """Whether a load with this id has reached its end."""
        return self._exists(self._mark(load_id))

    def set_complete(self, load_id: str) -> None:
        """Publish a load: one empty file appears, or doesn't."""
        path, files = self._hadoop(self._mark(load_id))
        files.create(path, True).close()

    def withdraw(self, load_id: str) -> None:
        """Take a load out of the commit log, before it is written again."""
        path, files = self._hadoop(self._mark(load_id))
        files.delete(path, True)

    def before(self, table: str, load_id: str) -> DataFrame | None:
        """Rows of earlier published loads, None before the first one."""
        loads = [name for name in self.published() if name < load_id]
        return self._of_loads(self._read(table), loads).drop("load_id") if loads else None

    def rejects(self) -> DataFrame:
        """The reject log with its ``load_id`` and ``stage``."""
        log = self._read_files(REJECTS, REJECT_SCHEMA, ("load_id", "stage"))
        return self._of_loads(log, self.published())

    def current(self, sat: str, before: str | None = None) -> DataFrame | None:
        """The newest version per key of the published loads, or of those before a load id; None if
        there is no snapshot of just these loads. A single load has one version per key, so its rows in
        the satellite are their own snapshot."""
        loads = [name for name in self.published() if before is None or name < before]
        if len(loads) == 1:
            return self._of_loads(self._read(sat), loads).select(VAULT_SCHEMAS[sat].names)
        name = self._snapshot(loads)
        if not loads or not self._exists(f"{self._path('current')}/{sat}/{name}"):
            return None
        return self._read_current(sat, name)

    def set_current(self, sat: str, load_id: str) -> None:
        """Write the snapshot that stands for the published loads before this one and its own rows.

        Keys with a new version are left out of the snapshot before by an anti join on the partitioning
        that both have, so with buckets no row of it is shuffled. Without buckets a bitmap of the new
        versions' keys tells most other rows, and only the rest is shuffled for the join. The first load
        needs none, see ``current``.
        """
        loads = [name for name in self.published() if name < load_id]
        if not loads:
            return
        hk = BY_SAT[sat].hk
        columns = self._snapshot_schema(sat).names
        own = self._of_loads(self._read(sat), [load_id]).select(columns)
        last = self.current(sat, load_id)
        if last is None:
            last = latest_version(self.before(sat, load_id), hk)
        last, rows = last.select(columns), own
        if self.buckets is None:
            kept, last = parted(last, [hk], marked(hashes_of(own, [hk])))
            rows = kept.unionByName(own)
        rows = last.join(own.select(hk), hk, "left_anti").select(columns).unionByName(rows)
        name = self._snapshot([*loads, load_id])
        path = f"{self._path('current')}/{sat}/{name}"
        if self.buckets is None:
            rows.write.mode("overwrite").option("compression", CODEC).parquet(path)
            return
        writing = self._name(f"writing_{uuid.uuid4().hex}")
        rows.write.mode("overwrite").option("compression", CODEC).option("path", path).bucketBy(self.buckets, hk).saveAsTable(writing)
        self.spark.sql(f"DROP TABLE {writing}")

    def drop_old_snapshots(self) -> None:
        """Delete all snapshots but the last two: a reader may still be in the one before."""
        loads = self.published()
        kept = {self._snapshot(loads), self._snapshot(loads[:-1])}
        for sat in BY_SAT:
            folder, files = self._hadoop(f"{self._path('current')}/{sat}")
            for status in files.listStatus(folder) if files.exists(folder) else []:
                name = status.getPath().getName()
                if name not in kept:
                    if self.buckets is not None:
                        self.spark.sql(f"DROP TABLE IF EXISTS {self._name(f'current_{sat}_{name}')}")
                    files.delete(status.getPath(), True)

    @staticmethod
    def _snapshot_schema(sat: str) -> T.StructType:
        return T.StructType([f for f in VAULT_SCHEMAS[sat].fields if f.name != "hash_diff"])

    @staticmethod
    def _snapshot(loads: list[str]) -> str:
        return "of_" + hashlib.md5("\n".join(loads).encode()).hexdigest()

    def _read_current(self, sat: str, name: str) -> DataFrame:
        path, schema = f"{self._path('current')}/{sat}/{name}", self._snapshot_schema(sat)
        hash_diff = F.expr(hash_diff_of(BY_SAT[sat])).alias("hash_diff")
        if self.buckets is None:
            return self.spark.read.schema(schema).parquet(path).select("*", hash_diff)
        table = self._name(f"current_{sat}_{name}")
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet"
            f" CLUSTERED BY ({BUCKET_COLUMNS[sat]}) INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )
        self.spark.catalog.refreshTable(table)
        return self.spark.table(table).select("*", hash_diff)

    def sketch(self, link: Link, load_id: str) -> None:
        """Keep a sketch of the hot keys among the load's rows of a link, for ``hot_keys``."""
        rows = self._of_loads(self._read(link.name), [load_id])
        path = f"{self._path('sketches')}/{link.name}/load_id={load_id}"
        sketches(rows, link.hks).write.mode("overwrite").option("compression", CODEC).parquet(path)

    def hot_keys(self, table: str, column: str) -> HotKeys | None:
        """Hot keys of a link's column, merged from the sketches of its loads; None without sketches."""
        path = f"{self._path('sketches')}/{table}"
        if not self._exists(path):
            return None
        return hot_keys_of(self._of_loads(self.spark.read.parquet(path), self.published()), column)

    def append(self, table: str, rows: DataFrame, load_id: str) -> None:
        rows = rows.select(*VAULT_SCHEMAS[table].names)
        path = f"{self._path(table)}/load_id={load_id}"
        if self.buckets is None:
            rows.write.mode("overwrite").option("compression", CODEC).parquet(path)
            return
        column = BUCKET_COLUMNS[table]
        rows = rows.repartition(self.buckets, column)  # one file per bucket
        # a bucketed write needs a table; this one exists while the partition is written
        loading = self._name(f"loading_{uuid.uuid4().hex}")
        writer = rows.write.mode("overwrite").option("compression", CODEC).option("path", path)
        writer.bucketBy(self.buckets, column).saveAsTable(loading)
        self.spark.sql(f"DROP TABLE {loading}")  # the files stay
        self.spark.sql(
            f"ALTER TABLE {self._name(table)} ADD IF NOT EXISTS"
            f" PARTITION (load_id = '{load_id}') LOCATION '{path}'"
        )
        self.spark.catalog.refreshTable(self._name(table))

    def log(self, records: DataFrame, load_id: str, stage: str) -> None:
        """Add reject records; ``stage`` names the step, so a repeated step replaces its own."""
        path = f"{self._path(REJECTS)}/load_id={load_id}/stage={stage}"
        records.write.mode("overwrite").option("compression", CODEC).parquet(path)

    def clear(self) -> None:
        """Empty the commit log, then the known tables, by overwriting them; nothing else below the
        root is touched."""
        for load_id in self.published():
            self.withdraw(load_id)
        for table, schema in {**VAULT_SCHEMAS, REJECTS: REJECT_SCHEMA}.items():
            if self._exists(self._path(table)):
                empty = self.spark.createDataFrame([], schema)
                empty.write.mode("overwrite").parquet(self._path(table))
        if self.buckets is not None:
            for table in VAULT_SCHEMAS:
                self.spark.sql(f"DROP TABLE {self._name(table)}")
            self._create_tables()

    def _mark(self, load_id: str) -> str:
        """The load's file in the commit log; ids may hold what paths may not."""
        return f"{self.root}/loads/{quote(load_id, safe='')}"

    def _path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _name(self, table: str) -> str:
        return f"{self._database}.{table}"

    def _read(self, table: str) -> DataFrame:
        if self.buckets is not None:
            return self.spark.table(self._name(table))
        return self._read_files(table, VAULT_SCHEMAS[table], ("load_id",))

    def _read_files(
        self, table: str, schema: T.StructType, partitions: tuple[str, ...]
    ) -> DataFrame:
        # load ids are text even where they look like numbers
        typed = T.StructType(
            schema.fields + [T.StructField(p, T.StringType()) for p in partitions]
        )
        if not self._exists(self._path(table)):
            return self.spark.createDataFrame([], typed)
        return self.spark.read.schema(typed).parquet(self._path(table))

    def _exists(self, path: str) -> bool:
        """One question to the file system; no file below the path is listed."""
        where, files = self._hadoop(path)
        return files.exists(where)

    def _hadoop(self, path: str) -> tuple:
        """A path and its file system."""
        context = self.spark.sparkContext
        where = context._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(context._jsc.hadoopConfiguration())

    def _agreed_buckets(self, wanted: int | None) -> int | None:
        """The bucket count the vault was first opened with; files only fit that count, so it is
        kept next to them."""
        path = self._path("layout")
        if self._exists(path):
            stored = self.spark.read.schema("buckets int").json(path).first()["buckets"]
            if wanted not in (None, stored):
                raise ValueError(f"{self.root} is stored in {stored} buckets")
            return stored
        if wanted is None:
            return None
        if any(self._exists(self._path(table)) for table in VAULT_SCHEMAS):
            raise ValueError(f"{self.root} is stored without buckets")
        self.spark.createDataFrame([(wanted,)], "buckets int").coalesce(1).write.json(path)
        return wanted

    def _create_tables(self) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self._database} LOCATION '{self.root}'")
        for table, schema in VAULT_SCHEMAS.items():
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self._name(table)} ({columns}, load_id string)"
                f" USING parquet PARTITIONED BY (load_id)"
                f" CLUSTERED BY ({BUCKET_COLUMNS[table]}) INTO {self.buckets} BUCKETS"
                f" LOCATION '{self._path(table)}'"
            )
            if self._exists(self._path(table)):
                self.spark.sql(f"ALTER TABLE {self._name(table)} RECOVER PARTITIONS")
