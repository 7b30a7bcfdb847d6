"""Folders for intermediate tables that outlive a lost executor."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyvault.functions.hashing import md5_of
from tallyvault.model import Entity
from tallyvault.operators.cleaning import collapse_copies, parse
from tallyvault.operators.repeats import MOST_KEYS, marked, parted, repeated_keys

# Much of a stored row are hashes as text; zstd folds them to the bytes they stand for.
CODEC = "zstd"


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, which all executors must reach."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    return named.rstrip("/")


DROPS_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query are deleted when it ends; else they lie on the disks until the driver next
    collects its garbage. For steps that write tables: what reads these doesn't need the shuffles."""
    before = spark.conf.get(DROPS_SHUFFLES, None)
    spark.conf.set(DROPS_SHUFFLES, True)
    try:
        yield
    finally:
        spark.conf.set(DROPS_SHUFFLES, before) if before else spark.conf.unset(DROPS_SHUFFLES)


class Staging:
    """A folder of Parquet tables belonging to one run, each written once and read many times."""

    def __init__(self, spark: SparkSession, parent: str | None = None):
        self.spark = spark
        self.root = f"{parent or shared_folder(spark)}/staging-{uuid.uuid4().hex}"

    def put(self, name: str, rows: DataFrame) -> DataFrame:
        path = f"{self.root}/{name}"
        rows.write.mode("overwrite").option("compression", CODEC).parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def repeated(self, name: str, rows: DataFrame, keys: Sequence[str]) -> DataFrame | None:
        """``repeated_keys`` of stored rows, found now; None if they are too many to be broadcast."""
        found = self.put(name, repeated_keys(rows, keys))
        return found if found.count() <= MOST_KEYS else None

    def repeats(self, name: str, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        """``repeated_keys`` of stored rows for ``parted``, found now: themselves, or their bitmap if they are
        too many to be broadcast."""
        found = self.put(name, repeated_keys(rows, keys))
        return found if found.count() <= MOST_KEYS else self.put(f"{name}_marks", marked(found))

    def _put_unhashed(self, name: str, parsed: DataFrame, entity: Entity) -> DataFrame:
        """Parsed rows, stored without their row hash: it follows from the raw columns beside it, and no
        codec makes it smaller than 16 bytes a row."""
        row_hash = md5_of(f"raw_{c}" for c in entity.columns)
        return self.put(name, parsed.drop("row_hash")).withColumn("row_hash", F.expr(row_hash))

    def put_parsed(self, raw: DataFrame, entity: Entity) -> DataFrame:
        """Distinct raw rows with their copy counts, parsed: ``parse(collapse_copies(...))``, stored.

        Rows are parsed and written as they come. Those whose hash is their own are used from there; only
        the others are shuffled, to be counted and folded, and with them a few whose hash is their own where
        very many hashes repeat.
        """
        rows = self._put_unhashed(f"rows_{entity.name}", parse(raw.select(*entity.columns), entity), entity)
        repeated = self.repeats(f"hashes_{entity.name}", rows, ["row_hash"])
        single, several = parted(rows, ["row_hash"], repeated)
        hashed = several.selectExpr(*[f"raw_{c} AS {c}" for c in entity.columns], "row_hash")
        folded = self._put_unhashed(entity.name, parse(collapse_copies(hashed, entity), entity), entity)
        counts = ["1L AS copies", "1L AS duplicate_count", "1 AS variant"]
        return single.selectExpr("*", *counts).unionByName(folded)

    def drop(self) -> None:
        """Delete the run's folder, on whatever file system it is."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        path.getFileSystem(conf).delete(path, True)


def run_together(jobs: Iterable[Callable[[], object]]) -> list[object]:
    """Submit independent Spark jobs at once, so that small ones fill each other's idle cores."""
    with ThreadPoolExecutor(max_workers=8) as pool:
        return [running.result() for running in [pool.submit(job) for job in jobs]]
