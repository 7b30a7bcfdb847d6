"""Removal of repeated byte strings by sorted fingerprints of anchors and windows.

Prefix doubling, with ranks of growing length in rounds, is not what this does: two fixed lengths are
named, SEED bytes and the whole width. To keep the sorted table far smaller than the text, the first name
belongs to an anchor: of the SEED-byte strings inside a window the one of least hash, so equal windows
have equal anchors. An anchor stands for the run of windows that chose it, and its rows are (name of the seed, name of the whole run,
position). Spark sorts them by name and position:

1. a seed name that occurs once is unique, and its run's windows leave;
2. among equal seeds, a run whose whole name occurred earlier is removed as a whole;
3. what remains are first runs that share a seed only: their windows are named over the full width,
   which is the threshold, sorted again, and all but the first of each name are removed.

Names are 64-bit hashes of the bytes they stand for; strings count as equal when the names of the seed
and of the run (or of the window) both agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyvault.llm.shared import keep
from tallyvault.llm.text import batch, buffers, mix, pieces, signed

WIDTH = 100
SEED = 24
BUFFER = 1 << 20  # anchors among which a task folds repeated runs before anything is sent
HOT_RUNS = 4096  # runs of one seed beyond which their windows are spread over tasks by their own names

U64 = np.uint64
_BASE = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


class Names:
    """Names of any substrings of some bytes, from sums of a polynomial over their prefixes."""

    def __init__(self, data: np.ndarray, kind: int = 0):
        odd = _BASE[kind] | 1
        inverse = odd
        for _ in range(6):
            inverse = inverse * (2 - odd * inverse) & (2**64 - 1)
        n = len(data)
        power = np.full(n + 1, odd, U64)
        power[0] = 1
        np.cumprod(power, out=power)
        self.back = np.full(n + 1, inverse, U64)
        self.back[0] = 1
        np.cumprod(self.back, out=self.back)
        value = mix(np.arange(256, dtype=U64) + U64(977 + 4096 * kind))
        self.sum = np.zeros(n + 1, U64)
        np.cumsum(value[data] * power[:-1], out=self.sum[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sum[end] - self.sum[start]) * self.back[start] + (end - start).astype(U64))


def anchors(data: np.ndarray, text_at: np.ndarray, width: int, seed: int):
    """(text, first window, anchor, last window, seed name) of every run of windows, in order."""
    none = np.zeros(0, np.int64)
    if len(data) < width:
        return none, none, none, none, none.astype(U64)
    names = Names(data)
    starts = np.arange(len(data) - seed + 1)
    key = names.of(starts, starts + seed) & ~U64(127)
    # least key of each window, with the distance to its leftmost place in the low bits
    low, size, span = key, 1, width - seed + 1
    while size * 2 <= span:
        low = np.minimum(low[:-size], low[size:] + U64(size))
        size *= 2
    if rest := span - size:
        low = np.minimum(low[:-rest], low[rest:] + U64(rest))
    end = np.repeat(text_at[1:], np.diff(text_at))[: len(low)]
    p = np.flatnonzero(np.arange(len(low)) + width <= end)
    if not len(p):
        return none, none, none, none, none.astype(U64)
    q = p + (low[p] & U64(127)).astype(np.int64)
    new = np.ones(len(p), bool)
    new[1:] = (q[1:] != q[:-1]) | (p[1:] != p[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(p)) - 1
    text = np.searchsorted(text_at, p[first], "right") - 1
    return text, p[first], q[first], p[last], key[q[first]]


# A row's last column packs the first window's place, the anchor's distance from it, the run's length
# less one, and whether its task already knows an earlier equal run.
ANCHOR = pa.schema([("name", pa.int64()), ("run", pa.int64()), ("doc", pa.int64()), ("place", pa.int64())])
ANCHOR_DDL = "name long, run long, doc long, place long"


def _pack(lo, before, more, known):
    return (lo << 15) | (before << 8) | (more << 1) | known


def _others(*sorted_columns: np.ndarray) -> np.ndarray:
    """Which rows differ from the row before them: a row given twice is one position."""
    new = np.ones(len(sorted_columns[0]), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in sorted_columns], axis=0)
    return new


def _first_names(width: int, seed: int):
    def fold(rows: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        name, run, doc, lo, before, more = (np.concatenate(c) for c in zip(*rows, strict=True))
        order = np.lexsort((lo, doc, run, name))
        order = order[_others(name[order], run[order], doc[order], lo[order])]
        n, r = name[order], run[order]
        known = np.zeros(len(order), np.int64)
        known[1:] = (n[1:] == n[:-1]) & (r[1:] == r[:-1])
        place = _pack(lo[order], before[order], more[order], known)
        # a run known to be repeated needs no partner: it is spread evenly
        spread = mix(doc[order].view(U64) * U64(0xBF58476D1CE4E5B9) + lo[order].astype(U64))
        n = np.where(known == 1, spread & ~U64(127), n)
        for at in range(0, len(n), 1 << 16):
            to = slice(at, at + (1 << 16))
            yield batch(ANCHOR, signed(n[to]), signed(r[to]), doc[order][to], place[to])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for whole in batches:
            for b in pieces(whole):
                data, at = buffers(b.column("text"))
                text, lo, q, hi, name = anchors(data, at, width, seed)
                if not len(lo):
                    continue
                ids = b.column("doc").to_numpy(zero_copy_only=False).astype(np.int64)
                run = Names(data, 1).of(lo, hi + width) ^ mix((q - lo).astype(U64) + U64(1 << 20))
                rows.append((name, run, ids[text], lo - at[text], q - lo, hi - lo))
                held += len(lo)
                if held >= BUFFER:
                    yield from fold(rows)
                    rows, held = [], 0
        if rows:
            yield from fold(rows)

    return work


def runs_of(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """Sorted rows in tables that never split the rows of one value of the column."""
    rest: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        value = b.column(column).to_numpy()
        cut = int(np.searchsorted(value, value[-1]))
        if cut:
            yield pa.Table.from_batches([*rest, b.slice(0, cut)]).combine_chunks()
            rest = [b.slice(cut)]
        elif rest and rest[-1].column(column)[0].as_py() != value[0]:
            yield pa.Table.from_batches(rest).combine_chunks()
            rest = [b]
        else:
            rest.append(b)
    if rest:
        yield pa.Table.from_batches(rest).combine_chunks()


SORTED = pa.schema([("kind", pa.int8()), ("name", pa.int64()), ("doc", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64())])
SORTED_DDL = "kind byte, name long, doc long, lo long, hi long"
REMOVED, OPEN, OPEN_HOT = 0, 1, 2


def _reranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by name, run, doc and place: repeated runs, and first runs that share a seed."""
    for t in runs_of(batches, "name"):
        columns = [t[c].to_numpy() for c in ("name", "run", "doc", "place")]
        name, run, doc, place = (c[_others(*columns)] for c in columns)
        lo = place >> 15
        hi = lo + (place >> 1 & 127)
        known = (place & 1) == 1
        new_name = np.ones(len(name), bool)
        new_name[1:] = name[1:] != name[:-1]
        first = new_name.copy()
        first[1:] |= run[1:] != run[:-1]
        group = np.cumsum(new_name) - 1
        # a spread row may share a name by chance only; it takes no part in groups
        distinct = np.bincount(group, first & ~known)[group]
        removed = known | ~first
        open_ = ~removed & (distinct > 1)
        kind = np.where(removed, REMOVED, np.where(distinct > HOT_RUNS, OPEN_HOT, OPEN)).astype(np.int8)
        out = removed | open_
        if out.any():
            yield batch(SORTED, kind[out], name[out], doc[out], lo[out], hi[out])


CONTEXT = pa.schema(
    [("name", pa.int64()), ("doc", pa.int64()), ("lo", pa.int64()), ("bytes", pa.binary()), ("hot", pa.bool_())]
)
CONTEXT_DDL = "name long, doc long, lo long, bytes binary, hot boolean"


def _contexts(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in pieces(whole):
                data, at = buffers(b.column("text"))
                raw = data.tobytes()
                asked = b.column("asked")
                owner = np.repeat(np.arange(b.num_rows), np.diff(asked.offsets.to_numpy()))
                rows = asked.flatten()
                lo, hi = (rows.field(c).to_numpy() for c in ("lo", "hi"))
                begin, end = at[owner] + lo, at[owner] + hi + width
                fits = end <= at[owner + 1]
                cut = [raw[x:y] for x, y in zip(begin[fits].tolist(), end[fits].tolist(), strict=True)]
                yield batch(
                    CONTEXT,
                    rows.field("name").to_numpy()[fits],
                    b.column("doc").to_numpy()[owner][fits],
                    lo[fits],
                    pa.array(cut, pa.binary()),
                    rows.field("kind").to_numpy()[fits] == OPEN_HOT,
                )

    return run


def _windows(t: pa.Table, width: int):
    """Name, row and offset of every window of the rows' bytes."""
    raw = t["bytes"].combine_chunks()
    raw = raw.cast(pa.large_binary())
    off = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2], np.uint8)[off[0] : off[-1]]
    off = off - off[0]
    count = np.diff(off) - width + 1
    row = np.repeat(np.arange(len(count)), count)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    start = off[row] + offset
    return Names(data, 1).of(start, start + width), row, offset


SPAN = pa.schema([("doc", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64())])


def _repeated_windows(width: int):
    """Rows sorted by name: windows of one seed whose whole string occurs earlier, as spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs_of(batches, "name"):
            seed, doc, lo = (t[c].to_numpy() for c in ("name", "doc", "lo"))
            name, row, offset = _windows(t, width)
            p = lo[row] + offset
            order = np.lexsort((p, doc[row], name, seed[row]))
            order = order[_others(seed[row][order], name[order], doc[row][order], p[order])]
            n, s = name[order], seed[row][order]
            again = np.zeros(len(n), bool)
            again[1:] = (n[1:] == n[:-1]) & (s[1:] == s[:-1])
            hit = np.sort(order[again])
            if not len(hit):
                continue
            r, at = row[hit], p[hit]
            new = np.ones(len(hit), bool)
            new[1:] = (r[1:] != r[:-1]) | (at[1:] != at[:-1] + 1)
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(hit)) - 1
            yield batch(SPAN, doc[r[first]], at[first], at[last])

    return run


def _all_windows(width: int):
    schema = pa.schema([("seed", pa.int64()), ("name", pa.int64()), ("doc", pa.int64()), ("lo", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                t = pa.Table.from_batches([b.slice(at, 4096)])
                name, row, offset = _windows(t, width)
                yield batch(
                    schema,
                    t["name"].to_numpy()[row],
                    signed(name),
                    t["doc"].to_numpy()[row],
                    t["lo"].to_numpy()[row] + offset,
                )

    return run


def repeated_spans(docs: DataFrame, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """(doc, lo, hi): first and last start of windows whose string starts earlier in (doc, text)."""
    if not seed <= width - 1 <= seed + 126:
        raise ValueError("width - seed must be between 1 and 127")
    named = docs.mapInArrow(_first_names(width, seed), ANCHOR_DDL)
    ranked = keep(
        named.repartition("name")
        .sortWithinPartitions("name", "run", "doc", "place")
        .mapInArrow(_reranked, SORTED_DDL)
    )
    asked = (
        ranked.where(f"kind <> {REMOVED}")
        .groupBy("doc")
        .agg(F.collect_list(F.struct("kind", "name", "lo", "hi")).alias("asked"))
    )
    contexts = keep(docs.join(asked, "doc").mapInArrow(_contexts(width), CONTEXT_DDL))
    near = (
        contexts.where("NOT hot")
        .repartition("name")
        .sortWithinPartitions("name")
        .mapInArrow(_repeated_windows(width), "doc long, lo long, hi long")
    )
    spread = contexts.where("hot").mapInArrow(_all_windows(width), "seed long, name long, doc long, lo long")
    first = spread.groupBy("seed", "name").agg(F.min(F.struct("doc", "lo")).alias("first"), F.count("*").alias("n"))
    far = (
        spread.join(first.where("n > 1"), ["seed", "name"])
        .where("doc <> first.doc OR lo <> first.lo")
        .select("doc", "lo", F.col("lo").alias("hi"))
    )
    whole = ranked.where(f"kind = {REMOVED}").select("doc", "lo", "hi")
    return whole.unionByName(near).unionByName(far)


RESULT = pa.schema(
    [
        ("doc", pa.int64()),
        ("n_bytes", pa.int64()),
        ("n_removed", pa.int64()),
        ("n_spans", pa.int64()),
        ("kept", pa.binary()),
        ("kept_sha256", pa.string()),
    ]
)


def _removed(width: int, with_bytes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in pieces(whole):
                data, at = buffers(b.column("text"))
                spans = b.column("spans")
                owner = np.repeat(np.arange(b.num_rows), np.diff(spans.offsets.to_numpy()))
                rows = spans.flatten()
                begin = np.minimum(at[owner] + rows.field("lo").to_numpy(), at[owner + 1])
                end = np.minimum(at[owner] + rows.field("hi").to_numpy() + width, at[owner + 1])
                depth = np.zeros(len(data) + 1, np.int64)
                np.add.at(depth, begin, 1)
                np.add.at(depth, end, -1)
                gone = np.cumsum(depth[:-1]) > 0
                total = np.concatenate([[0], np.cumsum(gone)])
                edge = gone.copy()
                edge[1:] &= ~gone[:-1]
                inner = at[:-1][at[:-1] < len(data)]
                edge[inner] = gone[inner]
                starts = np.concatenate([[0], np.cumsum(edge)])
                left = data[~gone].tobytes()
                kept_at = at - total[at]
                cut = [left[x:y] for x, y in zip(kept_at[:-1].tolist(), kept_at[1:].tolist(), strict=True)]
                yield batch(
                    RESULT,
                    b.column("doc"),
                    np.diff(at),
                    np.diff(total[at]),
                    np.diff(starts[at]),
                    pa.array(cut if with_bytes else [None] * len(cut), pa.binary()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in cut]),
                )

    return run


def without_repeats(docs: DataFrame, width: int = WIDTH, seed: int = SEED, with_bytes: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256) for every row of docs (doc_id, text, ...).

    A byte goes if a `width`-byte string over it also starts earlier: in a document of smaller doc_id,
    or before in the same one. Null text counts as empty. Rows without doc_id have no place in that
    order: they keep all their bytes, and nobody loses bytes to them. Rows with equal doc_id and text
    are one document and get the same result; rows with equal doc_id must have equal text. Other
    columns are not looked at. An empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text"))
    spans = repeated_spans(rows.where("doc IS NOT NULL"), width, seed)
    grouped = spans.groupBy("doc").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    none = F.expr("cast(array() AS array<struct<lo: bigint, hi: bigint>>)")
    return (
        rows.join(grouped, "doc", "left")
        .withColumn("spans", F.coalesce("spans", none))
        .mapInArrow(
            _removed(width, with_bytes),
            "doc long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string",
        )
        .withColumnRenamed("doc", "doc_id")
    )
