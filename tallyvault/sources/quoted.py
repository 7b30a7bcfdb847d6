"""Records of text files whose texts may hold the separator, read by any number of tasks.

A separator (the line feed of a CSV file, the closing brace of a JSON object, the end tag of an XML
element) ends a record where it is not within a quoted text, a comment or a CDATA section. Whether it is
follows from all of the file before it, so there are two passes. Each line takes the state it is met in
to another one (a quote swaps within and without), and what lines do one after another is one such step
again. The first pass gives a summary per split: the step that all its lines make, and which of them is
the last to begin a record, for every state the split may be met in. Summaries in file order tell in which
one it is, and the second pass cuts. Records of one line go on as they are; only the lines of longer ones,
and the last line of each split, meet in a shuffle. A line is what stands between two separators.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SUMMARY = pa.schema(
    [("file", pa.int64()), ("block", pa.int64()), ("ends", pa.list_(pa.int64())), ("begun", pa.list_(pa.int64()))]
)
SUMMARY_DDL = "file long, block long, ends array<long>, begun array<long>"
LINE = pa.schema(
    [
        ("file", pa.int64()),
        ("start_block", pa.int64()),
        ("start_line", pa.int64()),
        ("block", pa.int64()),
        ("line", pa.int64()),
        ("alone", pa.bool_()),
        ("value", pa.string()),
    ]
)
LINE_DDL = "file long, start_block long, start_line long, block long, line long, alone boolean, value string"
NONE = -1


class Kind(NamedTuple):
    """A separator, and what tells whether it counts.

    signs is SQL of what a line (value) has that matters; steps makes of a column of signs, per line, the
    state that follows each state. State 0 is the one in which a separator ends a record.
    """

    separator: str
    states: int
    signs: str
    steps: Callable[[pa.Array], np.ndarray]


def _swaps(signs: pa.Array) -> np.ndarray:
    odd = signs.to_numpy() % 2
    return np.stack([odd, 1 - odd], axis=1)


def _sections(signs: pa.Array) -> np.ndarray:
    """Steps between text (0), comment (1) and CDATA section (2)."""
    out = np.tile(np.arange(3), (len(signs), 1))
    for i, line in enumerate(signs.to_pylist()):
        for state in range(3) if line else ():
            now = state
            for sign in line:
                now = {(0, "<!--"): 1, (1, "-->"): 0, (0, "<![CDATA["): 2, (2, "]]>"): 0}.get((now, sign), now)
            out[i, state] = now
    return out


def _quotes(text: str) -> str:
    return f"length({text}) - length(replace({text}, '\"', ''))"


CSV = Kind("\n", 2, _quotes("value"), _swaps)
# a sign behind a backslash means nothing
JSON = Kind("}", 2, _quotes(r"regexp_replace(value, r'(?s)\\.', '')"), _swaps)
XML = Kind("</event>", 3, r"regexp_extract_all(value, r'<!--|-->|<!\[CDATA\[|\]\]>', 0)", _sections)


def _lines(spark: SparkSession, path: str, kind: Kind) -> DataFrame:
    """Lines in file order within each split, which is named by its file and first byte, and their signs."""
    return spark.read.text(path, lineSep=kind.separator).select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.expr(kind.signs).alias("signs"),
        "value",
    )


def _through(steps: np.ndarray, state: np.ndarray) -> np.ndarray:
    """The states before each line and after the last, for those that the lines are met in."""
    out, at = np.empty((len(steps) + 1, len(state)), np.int64), 0
    for i in np.flatnonzero((steps != np.arange(len(state))).any(axis=1)).tolist():  # few lines change a state
        out[at : i + 1] = state
        state, at = steps[i][state], i + 1
    out[at:] = state
    return out


def _blocks(
    batches: Iterator[pa.RecordBatch], kind: Kind
) -> Iterator[tuple[tuple[int, int], int, np.ndarray, pa.RecordBatch, bool]]:
    """Runs of lines of one split: its name, the number of the first line, the states before each line and
    after the last by the state the split is met in, the lines, and whether it is the split's last run."""
    held = None
    for whole in batches:
        file, block = (whole.column(c).to_numpy() for c in ("file", "block"))
        edge = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
        for lo, hi in zip([0, *edge], [*edge, len(file)], strict=True):
            if hi == lo:
                continue
            name = (int(file[lo]), int(block[lo]))
            same = held is not None and held[0] == name
            first, state = (held[1] + held[3].num_rows, held[2][-1]) if same else (0, np.arange(kind.states))
            if held is not None:
                yield *held, not same
            rows = whole.slice(lo, hi - lo)
            held = (name, first, _through(kind.steps(rows.column("signs")), state), rows)
    if held is not None:
        yield *held, True


def _summaries(kind: Kind):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = [NONE] * kind.states
        for name, first, states, _, ends in _blocks(batches, kind):
            for met in range(kind.states):
                begins = np.flatnonzero(states[:-1, met] == 0)
                last[met] = first + int(begins[-1]) if len(begins) else last[met]
            if ends:
                row = (*name, states[-1].tolist(), last)
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, SUMMARY, strict=True)], schema=SUMMARY)
                last = [NONE] * kind.states

    return run


def _contexts(summaries: pa.Table) -> dict[tuple[int, int], tuple[int, int, int]]:
    """Per split: the state it is met in, and the split and line of the last record begun before it."""
    out, file = {}, None
    for row in summaries.sort_by([("file", "ascending"), ("block", "ascending")]).to_pylist():
        if row["file"] != file:
            file, state, begun = row["file"], 0, (NONE, NONE)
        out[file, row["block"]] = (state, *begun)
        last = row["begun"][state]
        begun = (row["block"], last) if last != NONE else begun
        state = row["ends"][state]
    return out


def _cut(contexts, kind: Kind):
    """Lines with the split and line that their record begins in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = (NONE, NONE)
        for name, first, states, rows, _ in _blocks(batches, kind):
            met, *begun = contexts.value[name]
            if first == 0:
                at = tuple(begun)
            free = states[:, met] == 0  # before each line and after the last
            number = first + np.arange(rows.num_rows)
            latest = np.maximum.accumulate(np.where(free[:-1], number, NONE))
            block = np.where(latest == NONE, at[0], name[1])
            line = np.where(latest == NONE, at[1], latest)
            same = [np.full(len(number), v) for v in name]
            columns = (same[0], block, line, same[1], number, free[:-1] & free[1:], rows.column("value"))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, LINE, strict=True)], schema=LINE)
            at = (int(block[-1]), int(line[-1]))

    return run


def records(spark: SparkSession, path: str, kind: Kind = CSV) -> DataFrame:
    """(record): every record of the files, empty ones left out; of CSV files without the first, the header.

    A record keeps the separators within its texts. The first pass sends no text to Python but its signs;
    the driver holds one row per split of the files, some 80 bytes for each
    spark.sql.files.maxPartitionBytes read.
    """
    lines = _lines(spark, path, kind)
    counted = lines.drop("value").mapInArrow(_summaries(kind), SUMMARY_DDL)
    contexts = spark.sparkContext.broadcast(_contexts(counted.toArrow()))
    cut = lines.mapInArrow(_cut(contexts, kind), LINE_DDL)
    if kind is CSV:
        cut = cut.where("start_block > 0 OR start_line > 0")
    one = cut.where("alone").select("value")
    more = (
        cut.where("NOT alone")
        .groupBy("file", "start_block", "start_line")
        .agg(F.array_sort(F.collect_list(F.struct("block", "line", "value"))).alias("parts"))
        .select(F.concat_ws(kind.separator, "parts.value").alias("value"))
    )
    ended = F.regexp_replace("value", r"\r\z", "") if kind is CSV else F.col("value")  # lines may end in \r\n
    return one.unionByName(more).select(ended.alias("record")).where("record <> ''")
