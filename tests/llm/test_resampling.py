"""Importance resampling: ranks by regular sampling against a plain sort, odd rows, runs of words."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa

from tallyvault.llm import resampling
from tallyvault.llm.text import Words
from tests.llm import brute

DDL = "doc_id long, text string, score string, rank string, run string, place string, segment string"


def plain(rows, target, longest=1, buckets=resampling.BUCKETS, percent=10, least=20):
    def features(text):
        w = brute.words(text)
        return w, [zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets for k in range(1, longest + 1) for i in range(len(w) - k + 1)]

    s, t = np.zeros(buckets), np.zeros(buckets)
    for _, text in rows:
        np.add.at(s, np.array(features(text)[1], int), 1)
    for text in target:
        np.add.at(t, np.array(features(text)[1], int), 1)
    gain = [math.floor(1000 * math.log((b + 1) * (s.sum() + buckets) / ((a + 1) * (t.sum() + buckets)))) for a, b in zip(s, t)]
    out, eligible = [], []
    for i, text in rows:
        w, f = features(text)
        weight = sum(gain[k] for k in f)
        score = None if i is None else weight + resampling.noise(i)
        out.append([i, len(f), weight, score, None])
        if i is not None and len(w) >= least:
            eligible.append(out[-1])
    eligible.sort(key=lambda r: (-r[3], r[0]))
    for k, row in enumerate(eligible[: percent * len(eligible) // 100]):
        row[4] = k + 1
    return sorted(map(tuple, out), key=repr)


def resampled(spark, rows, target, parts, **options):
    docs = spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in rows], DDL).repartition(parts)
    found = resampling.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), **options)
    return sorted(map(tuple, found.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def corpus(n, seed=0):
    random = np.random.default_rng(seed)
    rows = [(i, " ".join(f"w{k}" for k in (random.pareto(1, int(random.integers(0, 60))) * 5).astype(int))) for i in range(n)]
    return rows, [" ".join(f"w{k}" for k in range(40, 80)) for _ in range(5)]


def test_ranks_over_many_runs_and_segments(spark):
    rows, target = corpus(900)
    for parts, percent in ((1, 10), (7, 100), (13, 35)):
        assert resampled(spark, rows, target, parts, percent=percent) == plain(rows, target, percent=percent)


def test_runs_of_words(spark):
    rows, target = corpus(120, 3)
    options = {"longest": 3, "buckets": 97, "percent": 50}
    assert resampled(spark, rows, target, 3, **options) == plain(rows, target, 3, 97, 50)


def test_odd_rows(spark):
    rows, target = corpus(60, 5)
    rows += [(None, rows[3][1] + " x" * 30), (1000, None), (1001, ""), (1002, "long " * 50_000), (1003, "9" * 3_000_000)]
    assert resampled(spark, rows, target, 4, percent=60) == plain(rows, target, percent=60)
    assert resampled(spark, rows, [], 2) == plain(rows, [])


def test_rows_that_repeat_are_ranked_side_by_side(spark):
    """A third of all rows are one row; its ranks are gapless and every segment stays bounded."""
    rows, target = corpus(200, 7)
    text = " ".join(f"w{k}" for k in range(50, 90))
    found = resampled(spark, rows + [(5000, text)] * 100, target, 6, percent=100)
    ranks = sorted(r[4] for r in found if r[4])
    assert ranks == list(range(1, len(ranks) + 1))
    same = sorted(r[4] for r in found if r[0] == 5000)
    assert same == list(range(same[0], same[0] + 100))


def test_empty_table(spark):
    assert resampled(spark, [], ["a b"], 2) == []


def test_letters_and_digits_only():
    words = Words(pa.array(["Ab-c9 é_x \x7f 日本,Z"]), blank=resampling.NOT_WORD)
    assert words.strings(np.arange(len(words))) == [w.encode() for w in ("ab", "c9", "é", "x", "日本", "z")]
