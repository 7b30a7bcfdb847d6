"""Language-model scores by context-tree weighting over bytes.

A text is its words, lower-cased in A-Z, each followed by a space, then an end symbol. A byte is eight
binary decisions; the contexts of a decision are the 0 to DEPTH bytes before it, back to the space
before the word. Every context holds zeros and ones seen, a Krichevsky-Trofimov estimate, and the
weighted probability of all that it saw: half its own estimate's, half the product of its children's.
A prediction mixes the estimates of all depths by these weights; a context that training never saw
hands over to the longest one that it did see.

Counts come from all training texts: words fold per task, then over the corpus, and only distinct words
are cut into contexts. A context's last two bytes decide where it is worked on; the levels above have
at most 256 contexts. Documents meet scores of the most frequent words by a broadcast of bounded size,
and those of all other words by a join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyvault.llm.shared import keep
from tallyvault.llm.text import Words, batch, buffers, lists, mix, pieces, signed

DEPTH = 6  # bytes of context; with the next byte they fit a long
FREQUENT = 1 << 18  # words, and contexts with a next byte, in a broadcast: 6 MB at most
SPACE, END = 0x20, 0x0A
HALF = math.log(0.5)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln of the gamma function for x >= 0.5, by Stirling's series beyond 8."""
    x = np.asarray(x, float)
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        low = y < 8
        shift[low] += np.log(y[low])
        y[low] += 1
    z = 1 / (y * y)
    series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of that many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - math.log(math.pi) - log_gamma(zeros + ones + 1.0)


# --- the tree --------------------------------------------------------------------------------


def word_keys(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys (context, next byte) of all symbols of words given end to end, and each key's word.

    The context's latest byte stands highest; bytes before the space of the word's start are 0.
    """
    n = len(at) - 1
    length = np.diff(at)
    begin = at[:-1] + np.arange(n) * 2  # each word gets a space before and after it
    line = np.full(len(data) + 2 * n, SPACE, np.uint64)
    owner = np.repeat(np.arange(n), length)
    line[np.arange(len(data)) + 1 + 2 * owner] = data
    word = np.repeat(np.arange(n), length + 1)
    place = np.arange(len(word)) - np.repeat(np.cumsum(length + 1) - (length + 1), length + 1)
    here = begin[word] + 1 + place
    key = np.zeros(len(word), np.uint64)
    for back in range(DEPTH):
        inside = back <= place
        key[inside] |= line[here[inside] - 1 - back] << np.uint64(8 * (DEPTH - back))
    return key | line[here], word


def _depths(key: np.ndarray) -> np.ndarray:
    """How many bytes of context a key has: the word's start ends it."""
    depth = np.full(len(key), DEPTH)
    for d in range(DEPTH, 0, -1):
        depth[(key >> np.uint64(8 * (DEPTH - d + 1)) & np.uint64(255)) == SPACE] = d
    return depth


def _level(key: np.ndarray, d: int) -> np.ndarray:
    """The key with only the latest d bytes of its context."""
    return key >> np.uint64(8 * (DEPTH - d + 1)) << np.uint64(8) | key & np.uint64(255)


class Level:
    """Binary decisions of one depth: for each of the eight bits the nodes, counts and weights."""

    def __init__(self, key: np.ndarray, count: np.ndarray):
        order = np.argsort(key, kind="stable")
        key, count = key[order], count[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(new)
        self.key = key[first]
        self.count = np.add.reduceat(count.astype(float), first) if len(first) else count.astype(float)
        self.nodes, self.zeros, self.ones, self.own = [], [], [], []
        for k in range(8):
            node = self.node(self.key, k)
            one = (self.key >> np.uint64(7 - k) & np.uint64(1)).astype(float)
            edge = np.ones(len(node), bool)
            edge[1:] = node[1:] != node[:-1]
            at = np.flatnonzero(edge)
            ones = np.add.reduceat(self.count * one, at) if len(at) else self.count
            both = np.add.reduceat(self.count, at) if len(at) else self.count
            self.nodes.append(node[at])
            self.zeros.append(both - ones)
            self.ones.append(ones)
            self.own.append(log_kt(both - ones, ones))
        self.weighted: list[np.ndarray] = [o.copy() for o in self.own]

    @staticmethod
    def node(key: np.ndarray, k: int) -> np.ndarray:
        """Context with the first k bits of the next byte behind a leading one."""
        prefix = (key & np.uint64(255)) >> np.uint64(8 - k) | np.uint64(1 << k)
        return key >> np.uint64(8) << np.uint64(8) | prefix

    def split(self, k: int, children: np.ndarray, inner: np.ndarray) -> None:
        """Weigh the nodes that have children, given the sums of their children's values."""
        value = np.logaddexp(HALF + self.own[k], HALF + children)
        self.weighted[k] = np.where(inner, value, self.own[k])

    def estimate(self, k: int, at: np.ndarray, one: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per decision: probability by the node's own counts, weight of these, whether it was seen."""
        zeros, ones = self.zeros[k][at], self.ones[k][at]
        both = zeros + ones
        p = (np.where(one, ones, zeros) + 0.5) / (both + 1)
        weight = np.exp(np.minimum(HALF + self.own[k][at] - self.weighted[k][at], 0.0))
        return p, weight, both > 0


def _tree(key: np.ndarray, count: np.ndarray) -> dict[int, Level]:
    """Levels 2 to DEPTH of contexts that agree in their latest two bytes, weighted from the leaves up."""
    depth = _depths(key)
    levels: dict[int, Level] = {}
    for d in range(DEPTH, 1, -1):
        mine = depth >= d
        levels[d] = level = Level(_level(key[mine], d), count[mine])
        if d == DEPTH:
            continue
        below = levels[d + 1]
        for k in range(8):
            child = below.nodes[k]
            parent = child >> np.uint64(16) << np.uint64(8) | child & np.uint64(255)
            at = np.searchsorted(level.nodes[k], parent)
            total = np.bincount(at, below.weighted[k], minlength=len(level.nodes[k]))
            inner = (level.nodes[k] >> np.uint64(8) & np.uint64(255)) != SPACE
            level.split(k, total, inner)
    return levels


def _predict(key: np.ndarray, levels: dict[int, Level], top: dict[int, Level]) -> np.ndarray:
    """log10 of the probability of each key's next byte in its context."""
    depth = _depths(key)
    out = np.zeros(len(key))
    for k in range(8):
        one = (key >> np.uint64(7 - k) & np.uint64(1)) == 1
        p, seen = np.full(len(key), 0.5), np.zeros(len(key), bool)
        for d in range(DEPTH, -1, -1):
            level = levels.get(d) or top[d]
            mine = np.flatnonzero(depth >= d)
            if not len(mine) or not len(level.key):
                continue
            node = Level.node(_level(key[mine], d), k)
            at = np.minimum(np.searchsorted(level.nodes[k], node), len(level.nodes[k]) - 1)
            known = level.nodes[k][at] == node
            own, weight, has = level.estimate(k, at, one[mine])
            has &= known
            leaf = depth[mine] == d
            mixed = weight * own + (1 - weight) * p[mine]
            p[mine] = np.where(has, np.where(leaf | ~seen[mine], own, mixed), p[mine])
            seen[mine] |= has
        out += np.log10(p)
    return out


def _roots(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("node", pa.int64()), ("value", pa.float64())])
    for key, count in _groups(tables):
        level = _tree(key, count)[2]
        for k in range(8):
            node = level.nodes[k]
            yield batch(schema, signed(node >> np.uint64(16) << np.uint64(8) | node & np.uint64(255)), level.weighted[k])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows sorted by key, in whole groups of equal latest two bytes; several groups at a time."""
    rest: list[tuple[np.ndarray, np.ndarray]] = []
    for b in batches:
        key, count = b.column("key").to_numpy().view(np.uint64), b.column("n_train").to_numpy()
        if not len(key):
            continue
        group = key >> np.uint64(8 * (DEPTH - 1))
        cut = int(np.searchsorted(group, group[-1]))
        if cut or (rest and rest[-1][0][-1] >> np.uint64(8 * (DEPTH - 1)) != group[0]):
            parts = [*rest, (key[:cut], count[:cut])]
            yield tuple(np.concatenate(c) for c in zip(*parts, strict=True))
            rest = []
        rest.append((key[cut:], count[cut:]))
    if rest:
        yield tuple(np.concatenate(c) for c in zip(*rest, strict=True))


def _probabilities(top):
    schema = pa.schema([("key", pa.int64()), ("logp", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, count in _groups(batches):
            yield batch(schema, signed(key), _predict(key, _tree(key, count), top.value))

    return run


def _top(pairs: DataFrame, sums: DataFrame) -> dict[int, Level]:
    """Levels 0 and 1: at most 256 contexts of 256 next bytes."""
    rows = pairs.select(
        F.expr(f"shiftright(key, {8 * DEPTH}) * 256 + (key & 255)").alias("key"), "n_train"
    ).groupBy("key").agg(F.sum("n_train").alias("n"))
    found = rows.toArrow()
    key, count = found["key"].to_numpy().astype(np.uint64), found["n"].to_numpy().astype(float)
    below = sums.groupBy("node").agg(F.sum("value").alias("value")).toArrow()
    node, value = below["node"].to_numpy().astype(np.uint64), below["value"].to_numpy()
    first = Level(key, count)
    for k in range(8):
        mine = (node & np.uint64(255)) >> np.uint64(k) == 1
        at = np.searchsorted(first.nodes[k], node[mine])
        total = np.bincount(at, value[mine], minlength=len(first.nodes[k]))
        first.split(k, total, first.nodes[k] >> np.uint64(8) != SPACE)
    root = Level(key & np.uint64(255), count)
    for k in range(8):
        at = np.searchsorted(root.nodes[k], first.nodes[k] & np.uint64(255))
        total = np.bincount(at, first.weighted[k], minlength=len(root.nodes[k]))
        root.split(k, total, np.ones(len(total), bool))
    return {0: root, 1: first}


# --- counts ----------------------------------------------------------------------------------


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("word", pa.binary()), ("n_train", pa.int64()), ("n_all", pa.int64())])
    for whole in batches:
        for b in pieces(whole):
            held = b.column("held_out")
            for side in (True, False):
                texts = pc.fill_null(b.filter(held if side else pc.invert(held)).column("text"), "")
                words = pc.ascii_split_whitespace(pc.ascii_lower(texts)).flatten()
                words = words.filter(pc.greater(pc.binary_length(words), 0))
                counted = pc.value_counts(words)
                n = counted.field(1)
                yield batch(schema, counted.field(0).cast(pa.binary()), pc.multiply(n, 0 if side else 1), n)


def _count_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("key", pa.int64()), ("n_train", pa.int64()), ("n_all", pa.int64())])
    for whole in batches:
        for b in pieces(whole, "word"):
            data, at = buffers_of(b.column("word"))
            key, word = word_keys(data, at)
            train, every = b.column("n_train").to_numpy()[word], b.column("n_all").to_numpy()[word]
            order = np.argsort(key)
            key = key[order]
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            first = np.flatnonzero(new)
            if len(first):
                yield batch(
                    schema, signed(key[first]), np.add.reduceat(train[order], first), np.add.reduceat(every[order], first)
                )


def buffers_of(binary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return buffers(binary.cast(pa.large_binary()).view(pa.large_string()))


def _lookup(table_key: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each key in a sorted table, and whether it is there."""
    at = np.searchsorted(table_key, key)
    inside = at < len(table_key)
    hit = np.zeros(len(key), bool)
    hit[inside] = table_key[at[inside]] == key[inside]
    return at, hit


def _score_words(frequent):
    schema = pa.schema(
        [("word", pa.int64()), ("n_train", pa.int64()), ("n_all", pa.int64()), ("score", pa.float64()), ("rest", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_key, table_value = frequent.value
        for whole in batches:
            for b in pieces(whole, "word"):
                data, at = buffers_of(b.column("word"))
                key, word = word_keys(data, at)
                place, hit = _lookup(table_key, signed(key))
                score = np.bincount(word[hit], table_value[place[hit]], minlength=b.num_rows)
                rest = np.bincount(word[~hit], minlength=b.num_rows)
                yield batch(
                    schema,
                    signed(Words(b.column("word").cast(pa.string()), lower=False).hashes()),
                    b.column("n_train"),
                    b.column("n_all"),
                    score,
                    lists(signed(key[~hit]), np.concatenate([[0], np.cumsum(rest)])),
                )

    return run


def _score_docs(frequent):
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("held_out", pa.bool_()),
            ("row", pa.int64()),
            ("n_words", pa.int64()),
            ("known", pa.int64()),
            ("base", pa.float64()),
            ("score", pa.float64()),
            ("rest", pa.list_(pa.int64())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_key, table_count, table_score = frequent.value
        for whole in batches:
            for b in pieces(whole):
                words = Words(b.column("text"))
                h = signed(words.hashes())
                text = words.text_of
                n = b.num_rows
                place, hit = _lookup(table_key, h)
                count = table_count[place[hit]]
                rest = np.bincount(text[~hit], minlength=n)
                # a row's name, for what is joined to it later: its id and its words in order
                order = np.arange(len(h)) - words.at[:-1][text]
                name = np.zeros(n, np.uint64)
                np.add.at(name, text, mix(h.view(np.uint64) + mix(order.astype(np.uint64))))
                ids = pc.fill_null(b.column("doc_id"), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                yield batch(
                    schema,
                    b.column("doc_id"),
                    b.column("held_out"),
                    signed(mix(name ^ mix(ids.view(np.uint64)))),
                    np.diff(words.at),
                    np.bincount(text[hit], count > 0, minlength=n).astype(np.int64),
                    np.bincount(text[hit], np.log10(count + 1.0), minlength=n),
                    np.bincount(text[hit], table_score[place[hit]], minlength=n),
                    lists(h[~hit], np.concatenate([[0], np.cumsum(rest)])),
                )

    return run


def _frequent(frame: DataFrame, key: str, by: str, *values: str) -> tuple[np.ndarray, ...]:
    """The FREQUENT most frequent rows as sorted arrays; the rest of the rows is met by a join."""
    top = frame.orderBy(F.desc(by), key).limit(FREQUENT).select(key, *values).toArrow()
    order = np.argsort(top[key].to_numpy())
    return tuple(top[c].to_numpy()[order] for c in (key, *values))


def score_texts(docs: DataFrame, held_out) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte).

    docs has doc_id, text and more columns that aren't looked at; held_out is a condition on it: such
    rows are scored but not learnt from, and where it is null the row is learnt from. Tokens are the
    words and one end. Null text counts as empty. Every row gets a score, also repeated ones and such
    without doc_id. An empty table gives an empty result.
    """
    sc = docs.sparkSession.sparkContext
    rows = docs.select(
        F.col("doc_id").cast("long"),
        F.col("text").cast("string"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
    )
    counted = rows.mapInArrow(_count_words, "word binary, n_train long, n_all long")
    vocabulary = keep(counted.groupBy("word").agg(F.sum("n_train").alias("n_train"), F.sum("n_all").alias("n_all")))
    n_docs, n_learnt = rows.agg(F.count("*"), F.count(F.when(~F.col("held_out"), 1))).first()
    tokens, kinds = vocabulary.agg(F.sum("n_train"), F.count(F.when(F.col("n_train") > 0, 1))).first()
    tokens, kinds = (tokens or 0) + n_learnt, kinds + (n_learnt > 0)

    end = docs.sparkSession.createDataFrame(
        [((SPACE << 8 * DEPTH) | END, n_learnt, n_docs)], "key long, n_train long, n_all long"
    )
    pairs = keep(
        vocabulary.mapInArrow(_count_keys, "key long, n_train long, n_all long")
        .unionByName(end)
        .groupBy("key")
        .agg(F.sum("n_train").alias("n_train"), F.sum("n_all").alias("n_all"))
    )
    grouped = pairs.repartition(F.expr(f"shiftright(key, {8 * (DEPTH - 1)})")).sortWithinPartitions("key")
    # the empty context's children of depth one are the top; a word's start has no level two
    longer = grouped.where(f"shiftright(key, {8 * DEPTH}) <> {SPACE}")
    top = sc.broadcast(_top(pairs, longer.mapInArrow(_roots, "node long, value double")))
    chances = keep(grouped.mapInArrow(_probabilities(top), "key long, logp double").join(pairs, "key"))

    table = sc.broadcast(_frequent(chances, "key", "n_all", "logp"))
    scored = keep(
        vocabulary.mapInArrow(
            _score_words(table), "word long, n_train long, n_all long, score double, rest array<long>"
        )
    )
    rest = (
        scored.select("word", F.explode("rest").alias("key"))
        .join(chances.select("key", "logp"), "key")
        .groupBy("word")
        .agg(F.sum("logp").alias("more"))
    )
    words = keep(
        scored.drop("rest").join(rest, "word", "left").withColumn("score", F.expr("score + coalesce(more, 0)")).drop("more")
    )

    table = sc.broadcast(_frequent(words, "word", "n_all", "n_train", "score"))
    partly = keep(
        rows.mapInArrow(
            _score_docs(table),
            "doc_id long, held_out boolean, row long, n_words long, known long, base double, score double, rest array<long>",
        )
    )
    rest = (
        partly.where("size(rest) > 0")
        .dropDuplicates(["row"])
        .select("row", F.explode("rest").alias("word"))
        .join(words.select("word", "n_train", F.col("score").alias("logp")), "word")
        .groupBy("row")
        .agg(
            F.count(F.when(F.col("n_train") > 0, 1)).alias("more_known"),
            F.sum(F.log10(F.col("n_train") + 1)).alias("more_base"),
            F.sum("logp").alias("more_score"),
        )
    )
    end_score = float(chances.where(F.col("key") == (SPACE << 8 * DEPTH | END)).first()["logp"])
    end_base = math.log10(n_learnt + 1)
    whole = math.log10(tokens + kinds + 1)
    return (
        partly.drop("rest")
        .join(rest, "row", "left")
        .select(
            "doc_id",
            "held_out",
            (F.col("n_words") + 1).alias("n_tokens"),
            (F.col("known") + F.coalesce("more_known", F.lit(0)) + int(n_learnt > 0)).alias("n_known"),
            F.lit(tokens).cast("long").alias("train_tokens"),
            (
                F.col("base") + F.coalesce("more_base", F.lit(0.0)) + end_base - (F.col("n_words") + 1) * F.lit(whole)
            ).alias("base_score"),
            (F.col("score") + F.coalesce("more_score", F.lit(0.0)) + end_score).alias("score"),
        )
    )
