"""Tables that cut a plan: written to the shared folder the session names, and read back."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


BATCH_BYTES = 4 << 20
_BYTES_PER_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Let the session send rows to Python in batches of at most BATCH_BYTES, and at least one row.

    By default only rows are counted, and ten thousand rows of long texts fill a worker. A session that
    was started with a bound of its own keeps it.
    """
    if not spark.sparkContext.getConf().contains(_BYTES_PER_BATCH):
        spark.conf.set(_BYTES_PER_BATCH, BATCH_BYTES)


Arrow = Iterator[pa.RecordBatch]


def freed(run: Callable[[Arrow], Arrow]) -> Callable[[Arrow], Arrow]:
    """The function of a mapInArrow, which gives back at its end what a task's arrays took.

    Workers stay for later tasks, idle ones too, and the allocators of C and Arrow keep freed pages: the
    tables of an earlier step would count as an executor's memory until the session ends.
    """

    @wraps(run)
    def of_task(batches: Arrow) -> Arrow:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc
                trim(0)

    return of_task


_made: list[list[str]] = []  # folders of tables, per open tables_of_a_step()


@contextmanager
def tables_of_a_step(spark: SparkSession) -> Iterator[list[str]]:
    """Gathers the folders that keep() writes to while it is open, and deletes them at its end but for
    those taken out of the list: what the step returns must not need them any more."""
    _made.append([])
    try:
        yield _made[-1]
    finally:
        for folder in _made.pop():
            _delete(spark, folder)


def keep(frame: DataFrame) -> DataFrame:
    """The frame's rows as a Parquet table below spark.checkpoint.dir.

    Executors can be lost without losing the rows. In a session without that setting (tests), the
    folder is the one given to SparkContext.setCheckpointDir, else it is an error.
    """
    spark: SparkSession = frame.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    path = f"{folder.rstrip('/')}/{uuid.uuid4().hex}"
    for step in _made[-1:]:
        step.append(path)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def carried(names: Sequence[str]) -> Column:
    """Columns that go through an operator untouched, as one column `extra`."""
    return (F.struct(*names) if names else F.lit(None).cast("struct<none: int>")).alias("extra")


def sent(rows: DataFrame, carry: Sequence[str]) -> DataFrame:
    """The rows with the columns of carry as `extra`, without a second copy of a text that is among them."""
    return rows.drop("text") if "text" in carry else rows


def with_text(batch: pa.RecordBatch) -> pa.RecordBatch:
    """A batch of rows from sent(): its text, where only `extra` has it, as a column; nothing is copied."""
    if "text" in batch.schema.names:
        return batch
    text = batch.column("extra").field("text").cast(pa.string())
    return pa.RecordBatch.from_arrays([*batch.columns, text], names=[*batch.schema.names, "text"])


def extra_ddl(rows: DataFrame) -> str:
    return f"extra {rows.schema['extra'].dataType.simpleString()}"


def drop(frame: DataFrame) -> None:
    """Delete a table made by keep()."""
    for folder in {f.rsplit("/", 1)[0] for f in frame.inputFiles()}:
        _delete(frame.sparkSession, folder)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
