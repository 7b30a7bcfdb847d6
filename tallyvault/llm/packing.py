"""Packing of token sequences into bins by bin completion over the histogram of piece lengths.

Only the number of pieces of each length matters to a packing, and there are at most `capacity`
lengths, so the search sees a table of bounded size however many documents there are. It takes the
largest remaining length, enumerates fillings of the space beside it that no other filling dominates,
and gives the chosen one to as many bins as the counts allow. Best-fit decreasing is the first
incumbent; a branch ends when its wasted space shows that it cannot beat the incumbent. Pieces then
find their place by their rank among the pieces of their length.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyvault.llm.shared import freed, keep
from tallyvault.llm.text import batch

CAPACITY = 1024
END = 2
NODES = 1500  # fillings that one search tries at most
ROUNDS = 60  # searches at most; the best packing found by then is taken
BRANCH = 3  # fillings tried for one bin
SLOTS = 1024  # parts of a length, so that no length is numbered by one task
SPECIAL = "<|endoftext|>"

Pattern = tuple[tuple[int, int], ...]  # (length, how often in a bin), longest first


# --- the search ------------------------------------------------------------------------------


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """No packing has fewer bins: long pieces can't share bins, and what they leave is all there is."""
    size = np.arange(capacity + 1)
    number = np.concatenate([[0], np.cumsum(counts)])
    space = np.concatenate([[0], np.cumsum(counts * size)])
    total = int(space[-1])
    best = -(-total // capacity)
    for k in range(1, capacity // 2 + 1):
        above = int(number[-1] - number[capacity - k + 1])
        half = int(number[capacity - k + 1] - number[capacity // 2 + 1])
        middle = int(space[capacity // 2 + 1] - space[k])
        free = half * capacity - int(space[capacity - k + 1] - space[capacity // 2 + 1])
        best = max(best, above + half + max(0, -(-(middle - free) // capacity)))
    return best


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing, with equal bins kept as one entry."""
    open_: dict[int, dict[Pattern, int]] = {0: {}}

    def put(room: int, pattern: Pattern, bins: int) -> None:
        group = open_.setdefault(room, {})
        group[pattern] = group.get(pattern, 0) + bins

    for size in range(capacity, 0, -1):
        left = int(counts[size])
        while left:
            rooms = [r for r in open_ if r >= size and open_[r]]
            room = min(rooms, default=None)
            if room is None:
                put(capacity, (), -(-left // (capacity // size)))
                continue
            pattern, bins = next(iter(open_[room].items()))
            each = min(room // size, left)
            filled = min(bins, left // each)
            del open_[room][pattern]
            if bins > filled:
                put(room, pattern, bins - filled)
            put(room - each * size, (*pattern, (size, each)), filled)
            left -= each * filled
    return [(p, n) for group in open_.values() for p, n in group.items() if p and n]


def fillings(counts: np.ndarray, sizes: list[int], room: int, most: int) -> list[Pattern]:
    """Fillings of the room that no other dominates, the fullest first, then those of fewest pieces.

    A filling is dominated if a remaining piece still fits beside it, or if one longer piece fits in
    the place of one of its pieces; the search goes from long to short pieces, and completes a
    filling only where the rest is exact or nothing remaining fits.
    """
    found: list[tuple[int, int, Pattern]] = []
    steps = 0

    def extend(start: int, rest: int, chosen: tuple[int, ...]) -> None:
        nonlocal steps
        steps += 1
        if steps > 400 or sum(waste == 0 for waste, _, _ in found) >= most:
            return
        if rest and counts[rest] > chosen.count(rest):  # one exact piece beats any way to go on
            pattern = (*chosen, rest)
            found.append((0, len(pattern), pattern))
            if rest < (chosen[-1] if chosen else rest + 1):
                rest -= 1
        fits = False
        lo, hi = start, len(sizes)
        while lo < hi:  # the first length that fits; lengths descend
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if sizes[mid] <= rest else (mid + 1, hi)
        tried = 0
        for i in range(lo, len(sizes)):
            s = sizes[i]
            if counts[s] > chosen.count(s):
                fits = True
                if len(chosen) < 6:
                    extend(i, rest - s, (*chosen, s))
                tried += 1
                if tried >= 12:
                    break
        if not fits and chosen:
            found.append((rest, len(chosen), chosen))

    extend(0, room, ())
    unique = dict.fromkeys(p for _, _, p in sorted(found, key=lambda f: (f[0], f[1], [-x for x in f[2]])))
    return [tuple((s, p.count(s)) for s in dict.fromkeys(p)) for p in list(unique)[:most]] or [()]


def waste(pattern: Pattern, capacity: int) -> int:
    return capacity - sum(s * k for s, k in pattern)


def complete(counts: np.ndarray, capacity: int, rounds: int = ROUNDS, nodes: int = NODES) -> list[tuple[Pattern, int]]:
    """(pattern, bins) with as few bins as the search finds; optimal if the lower bound is met.

    Best-fit bins that waste space are searched anew, so many at a time that their waste makes a bin,
    together with full bins whose short pieces give the search something to complete bins with. What
    saves a bin once is done as often as the counts of those patterns allow.
    """
    bound = lower_bound(np.asarray(counts, np.int64), capacity)
    bins = dict(best_fit(counts, capacity))
    order = np.random.default_rng(1)  # which wasteful bins meet in a search; the same in every run
    failed = 0
    for _ in range(rounds):
        if sum(bins.values()) <= bound or failed > 3:
            break
        units: dict[Pattern, int] = {}
        spare = 0
        wasteful = sorted(p for p in bins if waste(p, capacity))
        for at in order.permutation(len(wasteful)):
            if spare >= capacity + capacity // 2:
                break
            units[wasteful[at]] = min(bins[wasteful[at]], 3)
            spare += waste(wasteful[at], capacity) * units[wasteful[at]]
        if spare < capacity:
            break
        full = sorted(p for p in bins if waste(p, capacity) == 0 and p[-1][0] <= capacity // 25)
        units |= dict.fromkeys((full[at] for at in order.permutation(len(full))[:100]), 1)
        part = np.zeros(capacity + 1, np.int64)
        for pattern, n in units.items():
            for size, k in pattern:
                part[size] += k * n
        better = search(part, capacity, sum(units.values()), nodes)
        if better is None:
            failed += 1
            continue
        times = min(bins[p] // n for p, n in units.items())
        for pattern, n in units.items():
            bins[pattern] -= n * times
        for pattern, n in better:
            bins[pattern] = bins.get(pattern, 0) + n * times
        bins = {p: n for p, n in bins.items() if n}
        failed = 0
    return list(bins.items())


def search(
    counts: np.ndarray, capacity: int, fewest: int, nodes: int = NODES, branch: int = BRANCH
) -> list[tuple[Pattern, int]] | None:
    """Bin completion with branch and bound: a packing with less than `fewest` bins, if one is found."""
    total = int((counts * np.arange(capacity + 1)).sum())
    incumbent = None
    bound = lower_bound(counts, capacity)
    if fewest <= bound:
        return None
    state = counts.copy()
    path: list[tuple[Pattern, int]] = []
    used = wasted = 0

    def options() -> Iterator[tuple[Pattern, int]]:
        sizes = [int(s) for s in np.flatnonzero(state)[::-1]]
        top = sizes[0]
        state[top] -= 1
        kinds = fillings(state, sizes if state[top] else sizes[1:], capacity - top, branch)
        state[top] += 1
        for filling in kinds:
            amount = dict(filling)
            amount[top] = amount.get(top, 0) + 1
            pattern = tuple(sorted(amount.items(), reverse=True))
            yield pattern, int(min(state[s] // k for s, k in pattern))

    def apply(pattern: Pattern, bins: int, sign: int) -> int:
        for s, k in pattern:
            state[s] -= sign * k * bins
        return sign * bins * (capacity - sum(s * k for s, k in pattern))

    tried = 0
    stack = [options()]
    while stack and tried < nodes:
        step = next(stack[-1], None)
        if step is None:
            stack.pop()
            if path:
                pattern, bins = path.pop()
                wasted += apply(pattern, bins, -1)
                used -= bins
            continue
        tried += 1
        wasted += apply(*step, 1)
        used += step[1]
        path.append(step)
        if wasted > (fewest - 1) * capacity - total or used >= fewest:  # can't beat the incumbent
            pattern, bins = path.pop()
            wasted += apply(pattern, bins, -1)
            used -= bins
        elif not state.any():
            incumbent, fewest = list(path), used
            if fewest <= bound:
                break
            pattern, bins = path.pop()
            wasted += apply(pattern, bins, -1)
            used -= bins
        else:
            stack.append(options())
    return incumbent


# --- tokens ----------------------------------------------------------------------------------


@lru_cache(maxsize=2)
def _encoders(path: str):
    """The tokenizer of a file, and a quicker one of the same vocabulary if that lies beside it."""
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    try:
        import public_tokenizers
        import tiktoken

        with open(path.removesuffix(".json") + ".tiktoken", "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        quick = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
    except (ImportError, OSError):
        quick = None
    return slow, quick


def token_ids(text: str, path: str) -> np.ndarray:
    """The text's ids by tokenizers, add_special_tokens=False, as unsigned 32-bit numbers."""
    slow, quick = _encoders(path)
    if quick is not None and SPECIAL not in text:
        try:
            return np.array(quick.encode_ordinary(text), dtype="<u4")
        except Exception:  # its pattern engine gives up on some very long runs of blanks
            pass
    return np.array(slow.encode(text, add_special_tokens=False).ids, dtype="<u4")


PIECE_DDL = "doc_id long, piece int, start long, length long, ids array<int>, ids_crc32 long"
PIECE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.list_(pa.int32())),
        ("ids_crc32", pa.int64()),
    ]
)


def _cut(path: str, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                rows: list[tuple] = []
                for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                    ids = np.append(token_ids(text or "", path), np.uint32(END)).astype("<u4")
                    edges = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                    for k, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)):
                        part = ids[lo:hi]
                        rows.append(
                            (doc, k, lo, hi - lo, part.tolist() if with_ids else None, zlib.crc32(part.tobytes()))
                        )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), PIECE, strict=True)], schema=PIECE
                )

    return freed(run)


# --- places ----------------------------------------------------------------------------------


def _places(plan: list[tuple[Pattern, int]], capacity: int):
    """Per length: rank where a pattern's pieces begin, how many a bin has, first bin, offset."""
    entries: dict[int, list[tuple[int, int, int, int]]] = {}
    taken = np.zeros(capacity + 1, np.int64)
    first = 0
    for pattern, bins in plan:
        offset = 0
        for size, each in pattern:
            entries.setdefault(size, []).append((int(taken[size]), each, first, offset))
            taken[size] += each * bins
            offset += each * size
        first += bins
    return {size: np.array(rows, np.int64) for size, rows in entries.items()}


def _placed(table):
    schema = pa.schema(
        [*PIECE, ("sequence_id", pa.int64()), ("offset", pa.int64())],
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            bin_, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for size in np.unique(length):
                mine = length == size
                rows = table.value[int(size)]
                row = rows[np.searchsorted(rows[:, 0], rank[mine], "right") - 1]
                inside = rank[mine] - row[:, 0]
                bin_[mine] = row[:, 2] + inside // row[:, 1]
                offset[mine] = row[:, 3] + inside % row[:, 1] * size
            yield batch(schema, *(b.column(f.name) for f in PIECE), bin_, offset)

    return freed(run)


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = True, rounds: int = ROUNDS
) -> DataFrame:
    """(doc_id, piece, start, length, ids, ids_crc32, sequence_id, offset) of docs (doc_id, text, ...).

    A text's ids and END are one piece, or if longer pieces of `capacity` with the shorter one first.
    Null text counts as empty and is the piece [END]. Every row of docs is packed, also one that
    repeats another or has a null doc_id. Other columns are not looked at. An empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    slot = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SLOTS))
    cut = keep(rows.mapInArrow(_cut(tokenizer, capacity, with_ids), PIECE_DDL).withColumn("slot", slot))
    counted = cut.groupBy("length", "slot").agg(F.count("*").alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in counted.groupBy("length").agg(F.sum("n")).collect():  # at most `capacity` rows
        counts[length] = n
    table = spark.sparkContext.broadcast(_places(complete(counts, capacity, rounds), capacity))
    before = Window.partitionBy("length").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    base = counted.select("length", "slot", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    own = Window.partitionBy("length", "slot").orderBy("doc_id", "piece", "ids_crc32")
    ranked = cut.join(base, ["length", "slot"]).withColumn("rank", F.col("base") + F.row_number().over(own) - 1)
    return ranked.drop("base", "slot").mapInArrow(_placed(table), f"{PIECE_DDL}, sequence_id long, offset long")
