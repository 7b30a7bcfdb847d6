"""Importance resampling towards a target text set, ranked by parallel sorting by regular sampling.

A feature is a run of words; its bucket is a checksum modulo BUCKETS, so each text set is one array of
counts and the log-ratio of the two arrays is one array of gains. A document's weight is the sum of its
features' gains, and its score adds Gumbel noise drawn from its id. To rank the scores, every task
sorts the rows it has scored (a run) and numbers them; rows at regular places of all runs give
splitters; rows meet by segment between splitters, are merged there, and the counts of the segments
before give exact ranks. Segments that begin beyond the last rank drawn are never exchanged.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyvault.llm.shared import keep
from tallyvault.llm.text import U64, Words, batch, factors, mix, pieces

BUCKETS = 10_000
PERCENT = 10  # of the eligible documents are drawn
LEAST_WORDS = 20
SEED = "2024"
SAMPLES = 16  # regular samples per segment

NOT_WORD = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])  # ASCII but for letters and digits

RUN = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_features", pa.int64()),
        ("weight", pa.int64()),
        ("score", pa.int64()),
        ("eligible", pa.bool_()),
        ("run", pa.int64()),
        ("place", pa.int64()),
    ]
)
RUN_DDL = "doc_id long, n_features long, weight long, score long, eligible boolean, run long, place long"


def feature_buckets(words: Words, shortest: int, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every run of shortest to longest words inside one text, and the text of each."""
    hashes = words.hashes()
    raw = words.data.tobytes()
    n = np.diff(words.at)
    found, owners = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for size in range(shortest, longest + 1):
        count = np.maximum(n - size + 1, 0)
        owner = np.repeat(np.arange(len(n)), count)
        begin = np.arange(len(owner)) + np.repeat(words.at[:-1] - (np.cumsum(count) - count), count)
        key = np.zeros(len(begin), U64)
        for j, factor in enumerate(factors(size, 11)):
            key += hashes[begin + j] * factor
        _, first, where = np.unique(mix(key), return_index=True, return_inverse=True)
        spans = [
            b" ".join(raw[words.start[k] : words.end[k]] for k in range(b, b + size)) for b in begin[first].tolist()
        ]
        bucket = np.array([zlib.crc32(span) % buckets for span in spans], np.int64)
        found.append(bucket[where] if len(where) else bucket)
        owners.append(owner)
    return np.concatenate(found), np.concatenate(owners)


def bucket_counts(texts: DataFrame, shortest: int, longest: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall in each bucket: one array per task, added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for whole in batches:
            for b in pieces(whole):
                bucket, _ = feature_buckets(Words(b.column("text"), blank=NOT_WORD), shortest, longest, buckets)
                total += np.bincount(bucket, minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    counted = texts.select(F.col("text").cast("string")).mapInArrow(run, "bucket long, n long")
    found = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # at most `buckets` rows
    out = np.zeros(buckets, np.int64)
    out[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket, 1000 times the log of its share in the target over that in the source, floored."""
    n, s, t = float(len(source)), float(source.sum()), float(target.sum())
    ratio = ((target + 1.0) * (s + n)) / ((source + 1.0) * (t + n))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio.tolist()], np.int64)


def noise(doc_id: int, seed: str = SEED) -> int:
    """Gumbel noise of a document, 1000-fold and floored."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _scored_runs(gain, shortest: int, longest: int, least_words: int, seed: str):
    """Rows of a task with their scores, sorted and numbered; all but numbers is let go on the way."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = gain.value
        parts: list[tuple[np.ndarray, ...]] = []
        for whole in batches:
            for b in pieces(whole):
                words = Words(b.column("text"), blank=NOT_WORD)
                bucket, owner = feature_buckets(words, shortest, longest, len(table))
                rows = b.num_rows
                weight = np.zeros(rows, np.int64)
                np.add.at(weight, owner, table[bucket])
                ids = b.column("doc_id")
                named = ids.is_valid().to_numpy(zero_copy_only=False)
                doc = ids.fill_null(0).to_numpy(zero_copy_only=False)
                score = weight + np.array([noise(d, seed) if v else 0 for d, v in zip(doc.tolist(), named, strict=True)], np.int64)
                parts.append((doc, named, np.bincount(owner, minlength=rows), weight, score, np.diff(words.at)))
        if not parts:
            return
        doc, named, n, weight, score, words_of = (np.concatenate(c) for c in zip(*parts, strict=True))
        eligible = named & (words_of >= least_words)
        order = np.lexsort((doc, -score, ~eligible))
        number = TaskContext.get().partitionId()
        for lo in range(0, len(order), 1 << 16):
            o = order[lo : lo + (1 << 16)]
            yield batch(
                RUN,
                pa.array(doc[o], mask=~named[o]),
                n[o],
                weight[o],
                pa.array(score[o], mask=~named[o]),
                eligible[o],
                np.full(len(o), number),
                np.arange(lo, lo + len(o)),
            )

    return run


def splitters(runs: DataFrame, count: int, segments: int) -> np.ndarray:
    """Keys (-score, doc_id, run, place) that cut the eligible rows of all runs into segments.

    Of every run, the rows at places 0, step, 2 * step ... come to the driver: at most SAMPLES a
    segment and one a run. A segment gets at most count / segments rows and step rows of each run.
    """
    step = max(1, count // (segments * SAMPLES))
    sample = runs.where(F.col("place") % step == 0).select("score", "doc_id", "run", "place").toArrow()
    key = np.array([-sample["score"].to_numpy(), *(sample[c].to_numpy() for c in ("doc_id", "run", "place"))])
    key = key[:, np.lexsort(key[::-1])]
    return key[:, SAMPLES::SAMPLES]


def _segments(cuts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = cuts.value
        for b in batches:
            names = ("score", "doc_id", "run", "place")
            score, doc, number, place = (b.column(c).to_numpy(zero_copy_only=False) for c in names)
            rows = np.array([-score, doc, number, place])
            key = np.concatenate([edges, rows], axis=1)
            is_row = np.arange(key.shape[1]) >= edges.shape[1]
            order = np.lexsort((is_row, *key[::-1]))
            before = np.cumsum(~is_row[order])
            segment = np.zeros(b.num_rows, np.int64)
            inside = is_row[order]
            segment[order[inside] - edges.shape[1]] = before[inside]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(segment)], names=[*b.schema.names, "segment"])

    return run


def _ranks(before, draw: int):
    """Numbers rows that come sorted by segment and key; `before` has the rows ahead of each segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, done = -1, 0
        for b in batches:
            segment = b.column("segment").to_numpy()
            if not len(segment):
                continue
            new = np.flatnonzero(np.concatenate([[segment[0] != last], segment[1:] != segment[:-1]]))
            begin = np.zeros(len(segment), np.int64)
            begin[new] = new
            place = np.arange(len(segment)) - np.maximum.accumulate(begin)
            if segment[0] == last:
                place[: new[0] if len(new) else None] += done
            rank = before.value[segment] + place + 1
            last, done = int(segment[-1]), int(place[-1]) + 1
            kept = [b.column(c) for c in ("doc_id", "n_features", "weight", "score")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(rank, mask=rank > draw)], names=["doc_id", "n_features", "weight", "score", "rank"]
            )

    return run


def resample(
    docs: DataFrame,
    target: DataFrame,
    shortest: int = 1,
    longest: int = 1,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: str = SEED,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) for every row of docs (doc_id, text, ...).

    target (text, ...) is the text set to come close to. Of the N rows with a doc_id and at least
    least_words words, the floor(percent * N / 100) of the highest scores have a rank from 1 on, ties
    by the smaller doc_id; all others have none. Null and empty texts have no features and weight 0. A
    row without doc_id counts for the shares, has a weight, and neither score nor rank. Rows that repeat
    a doc_id are rows of their own, ranked side by side. A text of any length is read whole, one of more
    than a megabyte by itself. Other columns are not looked at; empty tables give an empty result or
    weights against an empty target. A task holds five numbers for each of its rows; the driver holds
    two arrays of `buckets` counts, the samples that splitters() bounds, and one count a segment.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    table = gains(bucket_counts(rows, shortest, longest, buckets), bucket_counts(target, shortest, longest, buckets))
    gain = spark.sparkContext.broadcast(table)  # 8 bytes a bucket
    scored = keep(rows.mapInArrow(_scored_runs(gain, shortest, longest, least_words, seed), RUN_DDL))
    gain.unpersist()
    eligible = scored.where("eligible")
    count = eligible.count()
    draw = percent * count // 100
    segments = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = spark.sparkContext.broadcast(splitters(eligible, count, segments))
    dealt = eligible.mapInArrow(_segments(cuts), f"{RUN_DDL}, segment long")
    sizes = np.zeros(cuts.value.shape[1] + 2, np.int64)
    for row in dealt.groupBy("segment").count().collect():  # one row a segment
        sizes[row["segment"] + 1] = row["count"]
    ahead = np.cumsum(sizes)[:-1]
    reached = int(np.searchsorted(ahead, draw))  # segments from here on begin beyond the last rank drawn
    before = spark.sparkContext.broadcast(ahead)
    ranked = (
        dealt.where(F.col("segment") < reached)
        .repartition(segments, "segment")
        .sortWithinPartitions("segment", F.desc("score"), "doc_id", "run", "place")
        .mapInArrow(_ranks(before, draw), "doc_id long, n_features long, weight long, score long, rank long")
    )
    rest = dealt.where(F.col("segment") >= reached).unionByName(
        scored.where("NOT eligible").withColumn("segment", F.lit(None).cast("long"))
    )
    return ranked.unionByName(
        rest.select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    )


def resample_sql(buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: str = SEED) -> str:
    """The same for single words over the tables documents and benchmark."""
    words = (
        "unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
        r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))"
    )
    return f"""
WITH crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab
), doc_words AS (SELECT doc_id, {words} AS w FROM documents),
item_words AS (SELECT {words} AS w FROM benchmark),
vocabulary AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM doc_words UNION SELECT w FROM item_words)),
placed AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(h) // 2),
    lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % {buckets} AS bucket
  FROM vocabulary, crc
),
source AS (SELECT bucket, count(*) AS s FROM doc_words JOIN placed USING (w) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM item_words JOIN placed USING (w) GROUP BY bucket),
counts AS (
  SELECT range AS bucket, coalesce(s, 0)::DOUBLE AS s, coalesce(t, 0)::DOUBLE AS t,
    sum(coalesce(s, 0)) OVER ()::DOUBLE AS all_s, sum(coalesce(t, 0)) OVER ()::DOUBLE AS all_t
  FROM range({buckets}) LEFT JOIN source ON range = source.bucket LEFT JOIN target ON range = target.bucket
),
gain AS (
  SELECT bucket, floor(1000 * ln(((t + 1) * (all_s + {buckets})) / ((s + 1) * (all_t + {buckets}))))::BIGINT AS g FROM counts
),
weights AS (
  SELECT doc_id, count(*) AS n, sum(g)::BIGINT AS weight
  FROM doc_words JOIN placed USING (w) JOIN gain USING (bucket) GROUP BY doc_id
),
scored AS (
  SELECT d.doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{seed}:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296)))::BIGINT AS score
  FROM documents AS d LEFT JOIN weights AS w ON w.doc_id = d.doc_id
),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS total
  FROM scored WHERE n_features >= {least_words}
)
SELECT s.doc_id, n_features, weight, score, CASE WHEN rank <= {percent} * total // 100 THEN rank END AS rank
FROM scored AS s LEFT JOIN ranked AS r ON r.doc_id = s.doc_id
"""
