"""Near duplicates by one-permutation hashing.

One hash per shingle deals a set's shingles to BINS bins; each bin's smallest hash is its value, and an
empty bin takes that of a bin drawn by a hash of its number and the attempt (optimal densification). Runs
of ROWS values are bands, and sets of one bucket (band and value) are candidates. A bucket of any size
gives a star: its members against its first one, compared on their whole sets. Members that a star can't
settle, neither linked by some path nor too far apart to be so, meet again in smaller buckets, by the
leading shingles that any two similar sets share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyvault.llm.graph import components
from tallyvault.llm.shared import keep
from tallyvault.llm.text import U64, Words, batch, distinct, factors, lists, mix, pieces, shingles, signed
from tallyvault.llm.wanted import wanted_texts

SHINGLE = 4
PERCENT = 80
BINS = 240
ROWS = 6  # values of a band: a pair of similarity 0.8 shares none of 40 bands once in 190,000 times
SLOT_BITS = 18  # of the counts that order leading shingles: 2 MB
CENTRES = 16  # of a bucket by leading shingles at first,
WIDEN = 8  # and so many times more in every further round

PROFILE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n", pa.int64()),
        ("key_a", pa.int64()),
        ("key_b", pa.int64()),
        ("bands", pa.list_(pa.int64())),
    ]
)
PROFILE_DDL = "doc_id long, n long, key_a long, key_b long, bands array<long>"


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and the bounds of each text's."""
    return distinct(*shingles(Words(texts), size))


def set_names(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Two 64-bit names per set; equal sets have equal names, sets without elements 0."""
    names = np.zeros((2, len(at) - 1), U64)
    some = np.diff(at) > 0
    if some.any():
        for j in range(2):
            names[j, some] = np.add.reduceat(mix(values * factors(1, 40 + j)), at[:-1][some])
    return names


def signatures(values: np.ndarray, at: np.ndarray, bins: int = BINS) -> np.ndarray:
    """A row of `bins` values per set that has elements; a set without any has a row of zeros."""
    n = np.diff(at)
    owner = np.repeat(np.arange(len(n)), n)
    place = ((values >> U64(32)) * U64(bins) >> U64(32)).astype(np.int64)
    # a set's hashes are sorted, so a bin's first one is its smallest
    first = np.ones(len(values), bool)
    first[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
    table = np.zeros((len(n), bins), U64)
    filled = np.zeros((len(n), bins), bool)
    table[owner[first], place[first]] = values[first]
    filled[owner[first], place[first]] = True
    row, empty = np.nonzero(~filled & (n > 0)[:, None])
    attempt = 0
    while len(row):
        drawn = mix(np.arange(bins, dtype=U64) + U64((attempt + 1) << 32)) % U64(bins)
        source = drawn[empty].astype(np.int64)
        hit = filled[row, source]
        table[row[hit], empty[hit]] = table[row[hit], source[hit]]
        row, empty = row[~hit], empty[~hit]
        attempt += 1
    return table


def band_names(table: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A hash per band of `rows` values, and its number."""
    bands = table.shape[1] // rows
    parts = table[:, : bands * rows].reshape(len(table), bands, rows)
    summed = (parts * factors(rows, 50)).sum(axis=2, dtype=U64)
    return mix(summed + np.arange(1, bands + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))


def least_linked(percent: int) -> int:
    """Sets of fewer elements are similar to equal sets only: i / (i + 1) is below the threshold."""
    return -(-percent // (100 - percent)) if percent < 100 else 1 << 62


def _profile(size: int, percent: int, bins: int, rows: int):
    least = least_linked(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in pieces(whole):
                values, at = shingle_sets(b.column("text"), size)
                n = np.diff(at)
                names = set_names(values, at)
                large = n >= least
                part = np.concatenate([[0], np.cumsum(n[large])])
                bands = band_names(signatures(values[np.repeat(large, n)], part, bins), rows)
                bounds = np.concatenate([[0], np.cumsum(np.where(large, bands.shape[1], 0))])
                yield batch(
                    PROFILE,
                    b.column("doc_id"),
                    n,
                    signed(names[0]),
                    signed(names[1]),
                    lists(signed(bands.reshape(-1)), bounds),
                )

    return run


def _compared(size: int, percent: int, far: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("near", pa.bool_()), ("mid", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in pieces(whole, "left"):
                (x, x_at), (y, y_at) = (shingle_sets(part.column(c), size) for c in ("left", "right"))
                rows, n, m = np.arange(part.num_rows), np.diff(x_at), np.diff(y_at)
                value = np.concatenate([x, y])
                owner = np.concatenate([np.repeat(rows, n), np.repeat(rows, m)])
                order = np.lexsort((value, owner))
                v, o = value[order], owner[order]
                twice = (v[1:] == v[:-1]) & (o[1:] == o[:-1])
                both = np.bincount(o[1:][twice], minlength=len(rows))
                near, mid = ((both > 0) & (100 * both >= most * (n + m - both)) for most in (percent, far))
                yield batch(schema, part.column("a"), part.column("b"), near, mid | (far <= 0))

    return run


def compared(pairs: DataFrame, docs: DataFrame, size: int, percent: int, far: int) -> DataFrame:
    """(a, b, near, mid) of the pairs (a, b): whether the whole sets reach percent, and far.

    Only texts that some pair needs are shuffled; a document that is in very many pairs meets them by a
    join that Spark can split.
    """
    ids = pairs.selectExpr("explode(array(a, b)) AS doc_id").distinct()
    texts = wanted_texts(docs, ids).distinct()
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("right"))
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("left"))
    met = pairs.join(right, "b").join(left, "a")
    told = met.mapInArrow(_compared(size, percent, far), "a long, b long, near boolean, mid boolean")
    return told.groupBy("a", "b").agg(F.bool_or("near").alias("near"), F.bool_or("mid").alias("mid"))


def similar_in_size(percent: int) -> str:
    return f"100 * least(n, m) >= {percent} * greatest(n, m)"


def _labelled(rows: DataFrame, component: DataFrame, node: str, label: str) -> DataFrame:
    """The rows with the component (id, component) of one of their columns; itself where it has none."""
    named = component.select(F.col("id").alias(node), F.col("component").alias(label))
    return rows.join(named, node, "left").withColumn(label, F.coalesce(label, node))


def _mixed(members: DataFrame) -> DataFrame:
    """Buckets with members (bucket, label) of several components."""
    ends = members.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    return ends.where("low < high").select("bucket")


def _pairs(met: DataFrame) -> DataFrame:
    return met.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()


def met_at_first(members: DataFrame, centres: DataFrame, percent: int) -> DataFrame:
    """The members (bucket, node, n, place, label) of every bucket with its centres (bucket, a, m, spot, of_a)
    of other components, where this can be the first bucket that two linked sets share.

    place and spot tell how many of a set's shingles come before the bucket's in the order of all. Of the two
    sets' common shingles none is before the first shared bucket, so at most the rest of either set is
    common; where that is fewer than a link needs, the pair has no link or meets in an earlier bucket.
    """
    other = f"label <> of_a AND {similar_in_size(percent)}"
    enough = f"least(n - place, m - spot) >= ceil({percent} * (n + m) / {100 + percent}.0)"
    return members.join(centres, "bucket").where(f"{other} AND {enough}")


def first_stars(
    members: DataFrame, docs: DataFrame, size: int, percent: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Compare the first of each bucket's members (bucket, node, n) with its others.

    Returns the pairs (a, b, near, mid) compared, the components of those that link, and the documents
    (node) that may have links the stars don't tell. A centre has met its whole bucket. Sets linked to
    it are one component and need no comparison among themselves. The Jaccard distance is a metric: a
    set more than twice the threshold's distance from a centre is linked to none that is linked to the
    centre, so these are told, too, unless the bucket has a set in between that is in another component.
    """
    far = max(0, 2 * percent - 100)
    first = members.groupBy("bucket").agg(F.min("node").alias("a"), F.min_by("n", "node").alias("m"))
    met = keep(members.join(first, "bucket").where("node <> a"))
    found = keep(compared(keep(_pairs(met.where(similar_in_size(percent)))), docs, size, percent, far))
    component = keep(components(found.where("near").select("a", "b")))
    labelled = _labelled(members, component, "node", "label")
    mixed = keep(_mixed(labelled))
    told = (
        met.join(mixed, "bucket", "left_semi")
        .select("bucket", "a", "node", "n", "m", F.least("a", "node").alias("u"), F.greatest("a", "node").alias("v"))
        .join(found.withColumnsRenamed({"a": "u", "b": "v"}), ["u", "v"], "left")
    )
    told = _labelled(_labelled(told, component, "a", "of_a"), component, "node", "label")
    between = F.expr(f"of_a <> label AND coalesce(mid, {similar_in_size(far)})")
    told = keep(told.select("bucket", "a", "node", F.coalesce("near", F.lit(False)).alias("near"), between.alias("between"), "label"))
    opened = told.groupBy("bucket").agg(F.bool_or("between").alias("opened"))
    left = told.join(opened, "bucket").where("opened OR NOT near")
    return found, component, left.join(_mixed(left), "bucket", "left_semi").select("node").distinct()


def more_stars(
    members: DataFrame, component: DataFrame, known: DataFrame, docs: DataFrame, size: int, percent: int
) -> DataFrame | None:
    """Links (a, b) between members (bucket, node, n, place) of a bucket that are in different components.

    Every bucket pairs its first members, CENTRES of them and WIDEN times more each round, with those of
    other components that they don't meet in an earlier bucket. The centres have then met all of these and
    leave the bucket, which is done when its rest is one component. Members of its smallest components come first, so that a bucket of one
    large component and a few others is done by a star around each of these. Pairs in known (a, b) have
    been compared before.
    """
    links: DataFrame | None = None
    members, centres = keep(_labelled(members, component, "node", "label")), CENTRES
    members = keep(members.join(_mixed(members), "bucket", "left_semi"))
    while not members.isEmpty():
        sizes = members.groupBy("bucket", "label").agg(F.count("*").alias("alike"))
        order = Window.partitionBy("bucket").orderBy("alike", "label", "node", "n", "place")  # cut before the shuffle
        ranked = members.join(sizes, ["bucket", "label"]).withColumn("rank", F.row_number().over(order))
        first = keep(ranked.where(F.col("rank") <= centres).drop("rank", "alike"))
        other = first.selectExpr("bucket", "node AS a", "n AS m", "place AS spot", "label AS of_a")
        wanted = _pairs(met_at_first(members, other, percent))
        wanted = keep(wanted.join(known, ["a", "b"], "left_anti"))
        found = compared(wanted, docs, size, percent, 0).where("near").select("a", "b")
        found = keep(found)
        links = found if links is None else links.unionByName(found)
        row = ["bucket", "node", "n", "place"]
        rest = members.join(first.select(row), row, "left_anti")
        members = keep(rest.join(_mixed(rest), "bucket", "left_semi"))
        centres *= WIDEN
    return links


def _slots(values: np.ndarray) -> np.ndarray:
    return (values >> U64(64 - SLOT_BITS)).astype(np.int64)


def _slot_counts(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SLOT_BITS, np.int64)
        for whole in batches:
            for b in pieces(whole):
                values, _ = shingle_sets(b.column("text"), size)
                total += np.bincount(_slots(values), minlength=len(total))
        slot = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(total[slot])], names=["slot", "count"])

    return run


def _leading(size: int, percent: int, counts):
    schema = pa.schema([("bucket", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("place", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in pieces(whole):
                values, at = shingle_sets(b.column("text"), size)
                n = np.diff(at)
                owner = np.repeat(np.arange(len(n)), n)
                order = np.lexsort((values, counts.value[_slots(values)], owner))
                rank = np.arange(len(values)) - np.repeat(at[:-1], n)
                lead = rank < np.repeat(n - -(-percent * n // 100) + 1, n)
                of = pa.array(owner[lead])
                yield batch(schema, signed(values[order][lead]), b.column("doc_id").take(of), n[owner[lead]], rank[lead])

    return run


def leading_members(docs: DataFrame, nodes: DataFrame, size: int, percent: int) -> DataFrame:
    """Members (bucket, node, n, place) of buckets by leading shingles, of the documents in nodes (node).

    In an order that all sets share, two similar sets share one of their first shingles. The order puts
    those of crowded slots last, by one count per slot over all these documents, so that a passage that
    many documents share leads in few; it decides which buckets there are, not which links are found. A
    set whose shingles from the bucket's on are fewer than it must share with the bucket's smallest set
    leaves the bucket: if it has a link there, it also shares an earlier shingle.
    """
    rows = wanted_texts(docs, nodes.select(F.col("node").alias("doc_id")))
    rows = keep(rows.join(nodes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi"))
    counted = rows.mapInArrow(_slot_counts(size), "slot long, count long").groupBy("slot").agg(F.sum("count").alias("count"))
    found = counted.toArrow()  # at most a row a slot
    table = np.zeros(1 << SLOT_BITS, np.int64)
    table[found["slot"].to_numpy()] = found["count"].to_numpy()
    counts = docs.sparkSession.sparkContext.broadcast(table)
    placed = rows.mapInArrow(_leading(size, percent, counts), "bucket long, node long, n long, place long")
    placed = shared_buckets(keep(placed.distinct()))
    smallest = placed.groupBy("bucket").agg(F.min("n").alias("m"))
    partner = f"greatest(m, ceil({percent} * n / 100.0))"
    within = placed.join(smallest, "bucket").where(f"n - place >= ceil({percent} * (n + {partner}) / {100 + percent}.0)")
    return shared_buckets(keep(within.select("bucket", "node", "n", "place")))


def shared_buckets(placed: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one document."""
    ends = placed.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    return keep(placed.join(ends.where("low < high"), "bucket", "left_semi"))


def star_components(members: DataFrame, docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) that connect whatever links between members (bucket, node, n) of a bucket connect.

    One star per bucket tells nearly all. Documents that it leaves open, such as those around a passage
    that many share, meet again in buckets by leading shingles, which tell them better apart.
    """
    found, component, open_nodes = first_stars(members, docs, size, percent)
    links = component.select(F.col("component").alias("a"), F.col("id").alias("b")).where("a <> b")
    open_nodes = keep(open_nodes)
    if not open_nodes.isEmpty():
        meeting = leading_members(docs, open_nodes, size, percent)
        more = more_stars(meeting, component, found.select("a", "b"), docs, size, percent)
        links = links if more is None else links.unionByName(more)
    return links


def near_duplicates(
    docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, bins: int = BINS, rows: int = ROWS
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of docs (doc_id, text, ...).

    Documents link when 100 * intersection >= percent * union of their sets of distinct shingles, taken
    whole; component_id is the smallest doc_id that links reach, and kept says that it is the row's own.
    Two sets of similarity s share no bucket, and so may miss a link between them, with probability
    (1 - s ^ rows) ^ (bins / rows): below 6 in a million at 0.8, less above. Equal sets are always found.
    A null or blank text has no shingles and no links; so has a row without doc_id, whose component_id
    is null and which is kept. Rows that repeat a doc_id are one document, with the links of each of its
    texts. Texts of any length are taken whole, one of more than a megabyte by itself. Other columns are
    not looked at. An empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    known = docs.where("doc_id IS NOT NULL")
    profile = keep(docs.mapInArrow(_profile(size, percent, bins, rows), PROFILE_DDL))
    name = ["n", "key_a", "key_b"]
    sets = profile.where("n > 0 AND doc_id IS NOT NULL")
    classes = keep(sets.groupBy(name).agg(F.min("doc_id").alias("rep")))
    # one row per class: whose bands are looked at
    first = sets.where(F.size("bands") > 0).join(classes, name).where("doc_id = rep")
    first = first.groupBy(name).agg(F.first("rep").alias("node"), F.first("bands").alias("bands"))
    placed = keep(first.select(F.explode("bands").alias("bucket"), "node", "n"))
    links = star_components(shared_buckets(placed), known, size, percent)
    # a document of several texts connects their classes
    several = sets.groupBy("doc_id").agg(*(f(k).alias(f"{f.__name__}_{k}") for f in (F.min, F.max) for k in name[1:]))
    several = keep(several.where("min_key_a < max_key_a OR min_key_b < max_key_b").select("doc_id"))
    if not several.isEmpty():
        of_text = sets.join(several, "doc_id").join(classes, name).select("doc_id", "rep").distinct()
        lowest = of_text.groupBy("doc_id").agg(F.min("rep").alias("a"))
        links = links.unionByName(of_text.join(lowest, "doc_id").where("rep <> a").select("a", F.col("rep").alias("b")))
    found = components(links).withColumnRenamed("id", "rep")
    of_class = classes.join(found, "rep", "left").select(*name, F.coalesce("component", "rep").alias("component"))
    component = F.expr("if(doc_id IS NULL, NULL, coalesce(component, doc_id))").alias("component_id")
    return (
        profile.select("doc_id", *name)
        .join(of_class, name, "left")
        .select("doc_id", F.col("n").alias("n_shingles"), component)
        .withColumn("kept", F.coalesce(F.expr("doc_id = component_id"), F.lit(True)))
    )
