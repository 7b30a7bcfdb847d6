"""The source audit on small tables: skybands against brute force, SQL on odd rows."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest

from tallyvault.llm import divergence

DDL = "lang string, source string, text string, n string, value string, rank string"


def both(spark, rows, least_docs, ranks):
    """Rows of the operator and of its SQL."""
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (lang VARCHAR, source VARCHAR, text VARCHAR)")
    if rows:
        connection.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    expected = connection.execute(divergence.audit_sql(least_docs, ranks))
    names = [c[0] for c in expected.description]
    docs = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], DDL).repartition(5)
    found = divergence.audit(docs, least_docs, ranks).select(*names).collect()
    return sorted(map(tuple, found)), sorted(expected.fetchall())


def test_random_tables(spark):
    random = np.random.default_rng(2)
    rows = []
    for _ in range(400):
        words = [f"{chr(97 + k % 26)}{'é' * (k % 3)}" for k in (random.pareto(0.6, int(random.integers(0, 30))) * 3).astype(int) % 90]
        lang = ["en", "de", "", None, "zz"][int(random.integers(0, 5))]
        rows.append((lang, [f"s{int(random.integers(0, 7))}", None, "Ü"][int(random.integers(0, 3))], " ".join(words)))
    rows += [("solo", "one", "alone here"), ("bare", "x", None), ("bare", "y", "12 34")]
    for least_docs, ranks in ((3, 4), (1, 50), (25, 2)):
        found, expected = both(spark, rows, least_docs, ranks)
        assert found == expected and found


def test_ties_go_to_the_earlier_term(spark):
    rows = [("en", "a", "Zeta beta Éta alpha zeta9beta"), ("en", "b", "other"), ("en", "b", "other")]
    found, expected = both(spark, rows, 1, 3)
    assert found == expected
    ranked = {rank: item for _, source, part, item, _, rank in found if source == "a" and part == "term"}
    assert ranked == {1: "beta", 2: "zeta", 3: "alpha"}


def test_empty_table(spark):
    assert both(spark, [], 1, 5) == ([], [])


@pytest.mark.parametrize("k", [1, 3, 50])
def test_skyband(k):
    random = np.random.default_rng(k)
    n, lang_n = random.integers(1, 9, 200), random.integers(1, 9, 200)
    term = np.array([f"t{i}".encode() for i in random.permutation(200)], dtype=object)
    kept = set(divergence.skyband(n, lang_n, term, k).tolist())
    for i in range(200):
        others = (n >= n[i]) & (lang_n <= lang_n[i]) & (term < term[i])
        assert (i in kept) == (others.sum() < k)


def test_blocks_and_stripes(spark, monkeypatch):
    random = np.random.default_rng(9)
    rows = [("en", f"s{i % 11}", " ".join(f"w{chr(97 + j)}" for j in random.integers(0, 26, 12))) for i in range(80)]
    monkeypatch.setattr(divergence, "BLOCK", 4)
    monkeypatch.setattr(divergence, "STRIPE", 3)
    monkeypatch.setattr(divergence, "CELLS", 20)
    found, expected = both(spark, rows, 2, 5)
    assert found == expected
