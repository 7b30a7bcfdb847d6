"""One-permutation hashing against brute force: signatures, stars, buckets that one star can't settle."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from tallyvault.llm import minhash
from tests.llm import brute


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def classes(found):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()}


def test_signatures_agree_as_often_as_sets_are_alike():
    random = np.random.default_rng(1)
    for n, shared in ((6, 5), (40, 30), (900, 700)):
        agreed = []
        for _ in range(60):
            values = random.integers(0, 1 << 63, 2 * n - shared, dtype=np.uint64)
            one, other = np.sort(values[:n]), np.sort(values[n - shared :])
            table = minhash.signatures(np.concatenate([one, other]), np.array([0, n, 2 * n]))
            assert (table > 0).all()
            agreed.append((table[0] == table[1]).mean())
        assert np.mean(agreed) == pytest.approx(shared / (2 * n - shared), abs=0.06)


def test_sets_without_elements_have_no_signature():
    table = minhash.signatures(np.zeros(0, np.uint64), np.array([0, 0]))
    assert table.shape == (1, minhash.BINS) and not table.any()
    values, at = minhash.shingle_sets(pa.array(["a b c d e", None, ""]), 4)
    assert np.diff(at).tolist() == [2, 0, 0]


def test_small_sets(spark):
    """The smallest sets that can link without being equal, and those just too small."""
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g h"), (3, "a b c d e f"), (4, "x y"), (5, "y x"), (6, "X  y")]
    found = classes(minhash.near_duplicates(frame(spark, rows)))
    assert found == brute.similar_classes(rows, size=4)
    assert found[2] == (5, 1) and found[3] == (3, 3) and found[6] == (1, 4) and found[5] == (1, 5)


@pytest.mark.parametrize("seed", [3, 4])
def test_one_large_group_of_near_copies(spark, seed):
    """Copies with so many changes that some link to the original, some to each other only, some to none."""
    random = np.random.default_rng(seed)
    base, rows = [f"w{i}" for i in range(140)], []
    for i in range(500):
        text = list(base) if i % 5 else [f"v{i}_{j}" for j in range(60)] + base[:60]
        for j in random.integers(0, len(text), int(random.integers(0, 14))):
            text[j] = f"x{int(random.integers(0, 9))}"
        rows.append((i, " ".join(text)))
    assert classes(minhash.near_duplicates(frame(spark, rows))) == brute.similar_classes(rows, size=4)


def test_chain_of_near_copies(spark):
    """Neighbours link, ends have nothing in common."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[5 * i : 5 * i + 120])) for i in range(50)]
    found = classes(minhash.near_duplicates(frame(spark, rows)))
    assert found == brute.similar_classes(rows, size=4)
    assert {c for _, c in found.values()} == {0}


def test_leading_buckets_alone_find_every_link(spark):
    """What the stars leave over meets by leading shingles: all documents are sent there."""
    random = np.random.default_rng(8)
    base, rows = [f"w{i}" for i in range(60)], []
    for i in range(300):
        text = list(base)
        for j in random.integers(0, 60, int(random.integers(0, 9))):
            text[j] = f"x{int(random.integers(0, 300))}"
        rows.append((i, " ".join(text[int(random.integers(0, 6)) :])))
    docs = frame(spark, rows)
    members = minhash.leading_members(docs, docs.selectExpr("doc_id AS node"), 4, 80)
    bucket: dict[int, set[int]] = {}
    for r in members.collect():
        bucket.setdefault(r["bucket"], set()).add(r["node"])
    sets = {i: brute.shingles(t, 4) for i, t in rows}
    together = {(a, b) for nodes in bucket.values() for a in nodes for b in nodes if a < b}
    for a in sets:
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                assert (b, a) in together


def centres_of(members):
    return members.selectExpr("bucket", "node AS a", "n AS m", "place AS spot", "label AS of_a")


def test_a_bucket_brings_no_pairs_that_must_meet_earlier(spark):
    """Sets of 100 need 89 in common: one with 20 shingles before the bucket's has 80 left at most."""
    rows = [(3, 1, 100, 0), (3, 2, 100, 11), (7, 1, 100, 5), (7, 2, 100, 20), (7, 4, 80, 0), (9, 4, 80, 4), (9, 5, 100, 0), (9, 6, 101, 0)]
    members = spark.createDataFrame(rows, "bucket long, node long, n long, place long").selectExpr("*", "node AS label")
    met = minhash.met_at_first(members, centres_of(members), 80).where("a < node").select("bucket", "a", "node")
    assert sorted(map(tuple, met.collect())) == [(3, 1, 2), (7, 1, 4), (7, 2, 4), (9, 5, 6)]


def test_every_link_meets_at_its_first_bucket(spark):
    random = np.random.default_rng(9)
    base, rows = [f"w{i}" for i in range(80)], []
    for i in range(120):
        text = list(base)
        for j in random.integers(0, 80, int(random.integers(0, 5))):
            text[j] = f"x{int(random.integers(0, 300))}"
        rows.append((i, " ".join(text[: int(random.integers(55, 81))])))
    docs = frame(spark, rows)
    members = minhash.leading_members(docs, docs.selectExpr("doc_id AS node"), 4, 80).selectExpr("*", "node AS label")
    met = minhash.met_at_first(members, centres_of(members), 80).where("a < node").select("a", "node").collect()
    sets = {i: brute.shingles(t, 4) for i, t in rows}
    links = set()
    for b in sets:
        for a in range(b):
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                links.add((a, b))
    assert links and links <= {tuple(r) for r in met}


def test_rows_that_repeat_a_doc_id(spark):
    one, two, three = (" ".join(f"{k}{i}" for i in range(30)) for k in "abc")
    rows = [(1, one), (2, one), (2, two), (3, two), (4, three), (4, three), (None, three), (5, None)]
    found = minhash.near_duplicates(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in found} == {
        (1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True), (None, None, True), (5, 5, True),
    }
