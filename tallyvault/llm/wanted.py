"""Texts that others ask for by id, found where they are read by a bitmap of fixed size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyvault.llm.shared import Arrow, freed
from tallyvault.llm.text import mix

BITS = 1 << 24


def _place(ids: pa.Array) -> np.ndarray:
    return mix(ids.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)) & np.uint64(BITS - 1)


@freed
def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        bit = np.unique(_place(b.column("doc_id")))
        yield pa.RecordBatch.from_arrays(
            [pa.array((bit >> np.uint64(5)).astype(np.int64)), pa.array(1 << (bit & np.uint64(31)).astype(np.int64))],
            names=["word", "bits"],
        )


def bitmap(ids: DataFrame) -> np.ndarray:
    """The hashes of the column doc_id as BITS bits: 2 MB for any number of ids."""
    words = ids.mapInArrow(_words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    found = words.toArrow()
    out = np.zeros(BITS // 32, np.uint32)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.uint32)
    return out.view(np.uint8)


def _select(bits, inside: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            place = _place(b.column("doc_id"))
            hit = bits.value[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1
            kept = b.filter(pa.array(hit.astype(bool) == inside))
            if kept.num_rows:
                yield kept

    return freed(run)


def wanted_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, text) of all ids, and of few others: only these need a shuffle."""
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(ids))
    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(_select(bits, True), rows.schema)


def split_texts(
    docs: DataFrame, ids: DataFrame, of_rest: Callable[[Arrow], Arrow], rest_schema: str
) -> tuple[DataFrame, DataFrame]:
    """The rows of docs (doc_id, ...) of all ids and few others, and what of_rest, a function of a mapInArrow,
    makes of the rest of them: in the worker that selects them, as two in a row take two workers a task."""
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(ids))
    rest = _select(bits, False)
    return docs.mapInArrow(_select(bits, True), docs.schema), docs.mapInArrow(lambda b: of_rest(rest(b)), rest_schema)
