"""Benchmark decontamination: BM25 over test items with block upper bounds, then a check of overlap.

The index holds the test items, in shards of bounded size. Every passage of every text is a query: its
words' impacts on an item, as a share of what the item scores against itself, add up to the score. As in
block-max WAND, items stand in blocks, and per word the largest impact within a block bounds what any of
its items can get; only blocks whose bound reaches the threshold are scored item by item. Bounds and
scores of all passages of a batch are sums over rows of one table. An item found this way contaminates
the text if enough of its question and of its answer stand there: runs of words, or of a short part the
words in order, less one for each that is changed, left out or put in.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyvault.llm.shared import carried, extra_ddl, freed, sent, with_text
from tallyvault.llm.text import Words, batch, mix, pieces

K1, B = 1.2, 0.75
BLOCK = 16  # items of a block
SHARD = 512  # items of a shard; a pass over the texts meets one shard after the other
THRESHOLD = 0.5  # of an item's score against itself
GRAM = 3  # words of the runs that are compared in the end
OVERLAP = 0.6  # share of these that must be in the passage, of the question and of the answer
SHORT = 10  # words; in a part of fewer one changed word may spoil more runs than that, so words in order count too


class Shard:
    """Impacts of words on some items, their block bounds, and the items' word runs."""

    def __init__(self, items: list[tuple[int, str]], n_items: int, df: dict[int, int], mean: float):
        self.ids = np.array([i for i, _ in items], np.int64)
        words = Words(pa.array([t for _, t in items], pa.string()))
        h = words.hashes()
        self.vocabulary, at = np.unique(h, return_inverse=True)
        n = len(items)
        width = -(-n // BLOCK) * BLOCK
        tf = np.zeros((len(self.vocabulary) + 1, width))
        np.add.at(tf, (at, words.text_of), 1.0)
        length = np.zeros(width)
        length[:n] = np.diff(words.at)
        seen = np.array([df[int(v)] for v in self.vocabulary] + [0.0])
        idf = np.log1p((n_items - seen + 0.5) / (seen + 0.5))[:, None]
        impact = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / max(mean, 1e-9)))
        impact[-1] = 0.0  # what stands for words that no item has
        own = np.zeros(width)
        np.add.at(own, words.text_of, impact[at, words.text_of])
        self.impact = (impact / np.maximum(own, 1e-9)).astype(np.float32)
        self.bound = self.impact.reshape(len(impact), -1, BLOCK).max(axis=2)
        self.longest = max(int(length.max()), 8)
        self.parts = [(part_hashes(q), part_hashes(a)) for q, a in (question_answer(t) for _, t in items)]

    def search(self, words: Words) -> Iterator[tuple[int, int, float]]:
        """(text, item, score) of every passage's hits; a passage is two neighbouring cells of words.

        A word counts once in a cell, however often it stands there.
        """
        cell = self.longest
        n = np.diff(words.at)
        cells = -(-n // cell)
        owner = np.repeat(np.arange(len(n)), cells)
        if not len(owner):
            return
        place = np.arange(len(owner)) - np.repeat(np.cumsum(cells) - cells, cells)
        begin = words.at[owner] + place * cell
        h = words.hashes()
        term, size = np.searchsorted(self.vocabulary, h), len(self.vocabulary)
        term[term == size] = 0
        known = np.flatnonzero(self.vocabulary[term] == h) if size else np.zeros(0, np.int64)
        inside = np.searchsorted(begin, known, "right") - 1
        pair = np.unique(inside * size + term[known])
        of, term = pair // max(size, 1), pair % max(size, 1)
        starts = np.append(np.searchsorted(of, np.arange(len(owner))), len(of))
        joined = np.append(owner[:-1] == owner[1:], False)
        both = self._passages(self.bound, term, starts, np.arange(len(owner)), joined)
        for block in range(both.shape[1]):
            likely = np.flatnonzero(both[:, block] >= THRESHOLD)
            if not len(likely):
                continue
            at = slice(block * BLOCK, min((block + 1) * BLOCK, len(self.ids)))
            score = self._passages(self.impact[:, at], term, starts, likely, joined)
            for row, i in zip(*(x.tolist() for x in np.nonzero(score >= THRESHOLD)), strict=True):
                passage, item = int(likely[row]), block * BLOCK + i
                stop = min(int(begin[passage]) + 2 * cell, int(words.at[owner[passage] + 1]))
                held = h[begin[passage] : stop]
                runs = grams_of(held)
                if all(overlap(part, held, runs) >= OVERLAP for part in self.parts[item]):
                    yield int(owner[passage]), item, float(score[row, i])

    @staticmethod
    def _passages(table, term, starts, passages, joined) -> np.ndarray:
        """Sums of the table's rows over the words of each passage: of its cell and the next one."""
        cells = np.unique(np.concatenate([passages, passages[joined[passages]] + 1]))
        length = starts[cells + 1] - starts[cells]
        first = np.cumsum(length) - length
        rows = np.repeat(starts[cells] - first, length) + np.arange(length.sum())
        total = np.zeros((len(cells), table.shape[1]), np.float32)
        some = length > 0
        if some.any():
            total[some] = np.add.reduceat(table[term[rows]], first[some], axis=0)
        out = total[np.searchsorted(cells, passages)]
        with_next = joined[passages]
        out[with_next] += total[np.searchsorted(cells, passages[with_next] + 1)]
        return out


def grams_of(h: np.ndarray) -> np.ndarray:
    """Names of the runs of GRAM words; of fewer words, of the whole."""
    if len(h) < GRAM:
        return mix(h[:1] + np.uint64(len(h))) if len(h) else h
    name = np.zeros(len(h) - GRAM + 1, np.uint64)
    for j in range(GRAM):
        name = mix(name + h[j : len(h) - GRAM + 1 + j])
    return name


def part_hashes(text: str) -> np.ndarray:
    return Words(pa.array([text], pa.string())).hashes()


def overlap(part: np.ndarray, held: np.ndarray, runs: np.ndarray) -> float:
    """Share of a part's runs, or of a short part's words in order, that the passage has.

    An empty part is always there; held are the passage's words.
    """
    if not len(part):
        return 1.0
    share = float(np.isin(np.unique(grams_of(part)), runs).mean())
    return max(share, in_order(part, held)) if share < OVERLAP and len(part) < SHORT else share


def in_order(part: np.ndarray, held: np.ndarray) -> float:
    """1 less the fewest edits of words that turn a part into some stretch of the passage, per word of it."""
    place = np.arange(len(held) + 1)
    edits = np.zeros(len(held) + 1, np.int64)  # a stretch may begin anywhere
    for word in part:
        row = edits + 1
        row[1:] = np.minimum(row[1:], edits[:-1] + (held != word))
        edits = np.minimum.accumulate(row - place) + place
    return 1.0 - float(edits.min()) / len(part)


def question_answer(text: str) -> tuple[str, str]:
    """An item's last sentence is its answer if it has enough words to compare, the rest the question."""
    cuts = [m.end() for m in re.finditer(r"[.?!]\s+", text)]
    for cut in reversed(cuts):
        if min(len(text[:cut].split()), len(text[cut:].split())) >= GRAM:
            return text[:cut], text[cut:]
    return text, ""


def build_index(benchmark: DataFrame) -> list[Shard]:
    """Shards of at most SHARD items each; items without words are left out."""
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where(
        "item_id IS NOT NULL AND text IS NOT NULL"
    )
    items = sorted((i, t) for i, t in {(r[0], r[1]) for r in rows.toLocalIterator()} if t.split())
    words = Words(pa.array([t for _, t in items], pa.string()))
    pair = np.unique(np.stack([words.hashes(), words.text_of.astype(np.uint64)]), axis=1)
    term, number = np.unique(pair[0], return_counts=True)
    df = dict(zip(term.tolist(), number.tolist(), strict=True))
    mean = len(words) / max(len(items), 1)
    return [Shard(items[at : at + SHARD], len(items), df, mean) for at in range(0, len(items), SHARD)]


def _search(index):
    fields = [("doc_id", pa.int64()), ("item_ids", pa.list_(pa.int64())), ("score", pa.float64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            schema = pa.schema([*fields, ("extra", whole.column("extra").type)])
            for b in pieces(with_text(whole)):
                words = Words(b.column("text"))
                found: list[dict[int, float]] = [{} for _ in range(b.num_rows)]
                for shard in index.value:
                    for text, item, score in shard.search(words):
                        name = int(shard.ids[item])
                        found[text][name] = max(score, found[text].get(name, 0.0))
                yield batch(
                    schema,
                    b.column("doc_id"),
                    pa.array([sorted(f) for f in found], pa.list_(pa.int64())),
                    np.array([max(f.values(), default=0.0) for f in found]),
                    b.column("extra"),
                )

    return freed(run)


def find_contamination(docs: DataFrame, benchmark: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """(doc_id, contaminated, item_ids, score, extra) for every row of docs (doc_id, text, ...).

    benchmark has (item_id, text, ...); rows without one of them, or without words, are left out.
    item_ids lists every item that some passage holds, score is the best BM25 score as a share of the
    item's own. Null text holds nothing. Repeated rows and null ids stay as they are; extra has the
    columns named in carry, others are not looked at. Empty tables give an empty result, or one
    without hits.
    """
    index = docs.sparkSession.sparkContext.broadcast(build_index(benchmark))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), carried(carry))
    found = sent(rows, carry).mapInArrow(
        _search(index), f"doc_id long, item_ids array<long>, score double, {extra_ddl(rows)}"
    )
    return found.select("doc_id", (F.size("item_ids") > 0).alias("contaminated"), "item_ids", "score", "extra")
