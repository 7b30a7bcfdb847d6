"""Similarity join on word shingles by a token-group matrix.

Documents of equal shingle sets fold into one. Documents that share minhash values are compared with
the first document of each value, and what links forms the groups, cut into parts of bounded size. The
matrix holds, per group, the union of its documents' leading tokens in one global order (tokens
frequent in a sample last, then by hash). Two sets of Jaccard similarity 0.8 always share a leading
token, so a document meets every group that could hold a partner; its overlap with the group's union
bounds its overlap with any member, and only groups whose bound suffices are opened and their members
compared exactly, on whole sets. The sample decides the order only, never which pairs are found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyvault.llm.graph import components
from tallyvault.llm.shared import freed, keep
from tallyvault.llm.text import Words, batch, distinct, factors, lists, mix, pieces, shingles, signed
from tallyvault.llm.wanted import wanted_texts

SHINGLE = 5
PERCENT = 80
MINHASHES = 16
ALIKE = 3  # minhash values that a document must share with the first of them to be compared early
GROUP = 32  # documents of one group of the matrix
SAMPLE = 16  # one document in so many tells which tokens are frequent
FREQUENT = 1 << 20  # entries of that list at most: 8 MB

PROFILE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n", pa.int64()),
        ("key_a", pa.int64()),
        ("key_b", pa.int64()),
        ("minhash", pa.list_(pa.int32())),
        ("lead", pa.list_(pa.int64())),
    ]
)
PROFILE_DDL = "doc_id long, n long, key_a long, key_b long, minhash array<int>, lead array<long>"


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    words = Words(texts)
    return distinct(*shingles(words, size))


def needed(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """The smallest overlap with which sets of n and m elements are similar: 100 i >= percent (n + m - i)."""
    return -(-percent * (n + m) // (100 + percent))


def lead_size(n: np.ndarray, percent: int) -> np.ndarray:
    """How many of a set's first tokens must hold one that any similar set shares among its own."""
    return np.where(n > 0, n - -(-percent * n // 100) + 1, 0)


def _sampled(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in pieces(whole):
                values, _ = shingle_sets(b.column("text"), size)
                yield pa.RecordBatch.from_arrays([pa.array(signed(values))], names=["token"])

    return freed(run)


def frequent_tokens(docs: DataFrame, size: int = SHINGLE) -> np.ndarray:
    """Hashes found in two or more documents of a sample, the FREQUENT most frequent at most, sorted."""
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0)
    counted = sample.mapInArrow(_sampled(size), "token long").groupBy("token").count()
    top = counted.where("count > 1").orderBy(F.desc("count"), "token").limit(FREQUENT)
    found = top.select("token").toArrow()["token"].to_numpy()
    return np.sort(found.astype(np.int64).view(np.uint64))


def _profile(size: int, percent: int, frequent):
    seeds = factors(MINHASHES, 3)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = frequent.value
        for whole in batches:
            for b in pieces(whole):
                values, at = shingle_sets(b.column("text"), size)
                n = np.diff(at)
                some = n > 0
                keys = np.zeros((2, len(n)), np.uint64)
                low = np.zeros((len(n), MINHASHES), np.int32)
                if some.any():
                    begin = at[:-1][some]
                    for j in range(2):
                        keys[j, some] = np.add.reduceat(mix(values * factors(1, 20 + j)), begin)
                    for j in range(MINHASHES):
                        mixed = mix(values ^ seeds[j]) >> np.uint64(32)
                        low[some, j] = np.minimum.reduceat(mixed, begin).astype(np.uint32).view(np.int32)
                # leading tokens: rare ones first, each kind by hash
                owner = np.repeat(np.arange(len(n)), n)
                where = np.searchsorted(last, values)
                late = np.zeros(len(values), bool)
                inside = where < len(last)
                late[inside] = last[where[inside]] == values[inside]
                order = np.lexsort((values, late, owner))
                rank = np.arange(len(values)) - np.repeat(at[:-1], n)
                size_of = lead_size(n, percent)
                lead = order[rank < np.repeat(size_of, n)]
                yield batch(
                    PROFILE,
                    b.column("doc_id"),
                    n,
                    signed(keys[0]),
                    signed(keys[1]),
                    lists(low.reshape(-1), np.arange(len(n) + 1) * MINHASHES),
                    lists(signed(values[lead]), np.concatenate([[0], np.cumsum(size_of)])),
                )

    return freed(run)


def _overlaps(size: int, percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in pieces(whole, "left"):
                (x, x_at), (y, y_at) = (shingle_sets(part.column(c), size) for c in ("left", "right"))
                n, m = np.diff(x_at), np.diff(y_at)
                rows = np.arange(part.num_rows)
                value = np.concatenate([x, y])
                owner = np.concatenate([np.repeat(rows, n), np.repeat(rows, m)])
                order = np.lexsort((value, owner))
                v, o = value[order], owner[order]
                twice = (v[1:] == v[:-1]) & (o[1:] == o[:-1])
                both = np.bincount(o[1:][twice], minlength=len(rows))
                alike = pa.array((both > 0) & (100 * both >= percent * (n + m - both)))
                yield batch(schema, part.column("a").filter(alike), part.column("b").filter(alike))

    return freed(run)


def linked(pairs: DataFrame, docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Those of the pairs (a, b) whose whole sets are similar.

    Only texts that some pair needs are shuffled: a bitmap of fixed size drops most of the others where
    they are read, and the joins the rest.
    """
    ids = pairs.selectExpr("explode(array(a, b)) AS doc_id").distinct()
    texts = wanted_texts(docs, ids).dropDuplicates(["doc_id"])
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("right"))
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("left"))
    return pairs.join(right, "b").join(left, "a").mapInArrow(_overlaps(size, percent), "a long, b long")


def early_pairs(reps: DataFrame) -> DataFrame:
    """Pairs (a, b): a document and the first one with the same minhash value, if ALIKE values lead there."""
    values = reps.selectExpr("doc_id", "posexplode(minhash) AS (place, value)").selectExpr(
        "doc_id", "shiftleft(cast(place AS bigint), 32) + value AS value"
    )
    first = values.groupBy("value").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("last"))
    return (
        values.join(first.where("a < last").drop("last"), "value")
        .where("doc_id <> a")
        .groupBy("a", F.col("doc_id").alias("b"))
        .count()
        .where(f"count >= {ALIKE}")
        .select("a", "b")
    )


OPENED = pa.schema([("doc_id", pa.int64()), ("grp", pa.int64()), ("part", pa.int64())])
OPENED_DDL = "doc_id long, grp long, part long"


@freed
def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by token, group size, group and part: every document with the parts of the
    groups behind its own. Small groups come first, so their documents meet the parts of large ones
    and not the many documents of those the small ones."""
    rest: pa.Table | None = None

    def met(table: pa.Table) -> Iterator[pa.RecordBatch]:
        token, doc, grp, part = (table[c].to_numpy() for c in ("token", "doc_id", "grp", "part"))
        if not len(token):
            return
        here = np.arange(len(token))
        new = np.ones(len(token), bool)
        new[1:] = token[1:] != token[:-1]
        edge = np.append(np.flatnonzero(new), len(token))
        stop = edge[np.cumsum(new)]
        name = new.copy()
        name[1:] |= grp[1:] != grp[:-1]
        entry = name.copy()  # a part's first row stands for its entry of the matrix
        entry[1:] |= part[1:] != part[:-1]
        later = np.append(np.flatnonzero(entry), len(token))
        after = later[np.searchsorted(later, here, "right")]
        other = np.append(np.flatnonzero(name), len(token))
        ahead = other[np.searchsorted(other, here, "right")]
        live = np.flatnonzero(ahead < stop)
        while len(live):  # all rows at once, each with the next entry that is not its own group's
            i, j = live, ahead[live]
            yield batch(OPENED, doc[i], grp[j], part[j])
            ahead[live] = after[j]
            live = live[ahead[live] < stop[live]]

    for b in batches:
        t = pa.Table.from_batches([b])
        t = t if rest is None else pa.concat_tables([rest, t])
        token = t["token"].to_numpy()
        cut = int(np.searchsorted(token, token[-1])) if len(token) else 0
        yield from met(t.slice(0, cut).combine_chunks())
        rest = t.slice(cut).combine_chunks()
    if rest is not None:
        yield from met(rest)


def opened_pairs(reps: DataFrame, leads: DataFrame, group: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of documents of different groups that the matrix can't rule out.

    Linked documents are a group, any other document is one of its own. Groups are cut into parts of
    about GROUP documents, by hash.
    """
    grouped = reps.join(group.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "doc_id", "n", F.coalesce("component", "doc_id").alias("grp")
    )
    sizes = grouped.groupBy("grp").agg(F.count("*").alias("size"))
    grouped = keep(
        grouped.join(sizes, "grp").withColumn(
            "part", F.pmod(F.xxhash64("doc_id"), F.floor(F.col("size") / GROUP) + 1)
        )
    )
    members = grouped.groupBy("grp", "part").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.collect_list("doc_id").alias("members")
    )
    matrix = leads.join(grouped.drop("n"), "doc_id").select(
        F.explode("lead").alias("token"), "doc_id", "size", "grp", "part"
    )
    met = (
        matrix.repartition("token")
        .sortWithinPartitions("token", "size", "grp", "part")
        .mapInArrow(_meetings, OPENED_DDL)
    )
    counted = met.groupBy("doc_id", "grp", "part").agg(F.count("*").alias("shared"))
    counted = counted.join(grouped.select("doc_id", "n"), "doc_id")
    beyond = f"greatest(n, most) * {percent}"
    need = f"ceil({percent} * (n + greatest(least, ceil(n * {percent} / 100.0))) / {100 + percent}.0)"
    return (
        counted.join(members, ["grp", "part"])
        .where(f"100 * n >= {percent} * least AND 100 * most >= {percent} * n")
        .where(f"shared + ceil({beyond} / 100.0) - 1 >= {need}")
        .select("doc_id", F.explode("members").alias("other"))
        .select(F.least("doc_id", "other").alias("a"), F.greatest("doc_id", "other").alias("b"))
        .distinct()
    )


def similar_classes(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs (doc_id, text, ...).

    Documents link when 100 * intersection >= percent * union of their shingle sets; component_id is
    the smallest doc_id that links reach. A null or blank text has no shingles and no links. Rows with
    equal doc_id are separate rows with one class; a null doc_id keeps a null class. Other columns are
    not looked at. An empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    known = rows.where("doc_id IS NOT NULL")
    frequent = rows.sparkSession.sparkContext.broadcast(frequent_tokens(known, size))
    profile = keep(rows.mapInArrow(_profile(size, percent, frequent), PROFILE_DDL))
    sets = profile.where("n > 0 AND doc_id IS NOT NULL")
    # a table of its own, so that a class of very many copies is a join that Spark can split
    classes = keep(
        sets.groupBy("n", "key_a", "key_b").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"))
    )
    folded = (
        sets.select("doc_id", "n", "key_a", "key_b")
        .join(classes.where("rep < last"), ["n", "key_a", "key_b"])
        .where("doc_id <> rep")
        .select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    )
    first = classes.select(F.col("rep").alias("doc_id"))
    leads = sets.join(first, "doc_id", "left_semi").select("doc_id", "lead").dropDuplicates(["doc_id"])
    reps = keep(
        sets.join(first, "doc_id", "left_semi").select("doc_id", "n", "minhash").dropDuplicates(["doc_id"])
    )
    early = keep(linked(keep(early_pairs(reps)), known, size, percent))
    group = components(early)
    late = keep(linked(keep(opened_pairs(reps, leads, group, percent)), known, size, percent))
    links = folded.unionByName(early).unionByName(late)
    found = components(links)
    return (
        profile.select("doc_id", F.col("n").alias("n_shingles"))
        .join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    )
