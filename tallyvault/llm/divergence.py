"""Audit of how the sources of each language diverge, with the terms that tell them apart.

Counts of terms per (lang, source) give smoothed shares in exact integers. The terms by which a source
exceeds its language most are found by dominance: a term can't be among the first k if k others have no
lower count in the group, no higher count in the language and come earlier in UTF-8, as each of them
ranks before it. Every task keeps only the terms of its rows that fewer than k others dominate (a
k-skyband), the skybands of a group are merged in two steps, and what is left is ranked by exact value.
The distance of two sources is added up over blocks of terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyvault.llm.shared import keep
from tallyvault.llm.text import NOT_LETTER, Words, batch, pieces

LEAST_DOCS = 30  # documents of a language that a term must be in
SMOOTHING = 5
UNIT = 1_000_000_000
RANKS = 50
BLOCK = 4096  # terms of a language whose distances are added up together,
STRIPE = 512  # for so many of its sources against all others
CELLS = 1 << 20  # cells of a dense table of shares at most
TOGETHER = 256  # rows compared with one another at a time
WAITING = 100_000  # rows of a task that are gathered before their skybands are taken
SALTS = 16  # parts that a group's skybands are merged in first

COUNTS = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())]
)
COUNTS_DDL = "lang string, source string, term string, n long, docs long"
BAND = ["lang", "source", "term", "n", "lang_n", "value"]
BAND_DDL = "lang string, source string, term string, n long, lang_n long, value long"
PAIRS_DDL = "lang string, source string, item string, value long"
TERMS_DDL = "lang string, source string, part string, item string, value long, rank int"


def _texts(words: Words, which: np.ndarray) -> pa.Array:
    """Some of the words as one Arrow array."""
    start, length = words.start[which], words.end[which] - words.start[which]
    at = np.concatenate([[0], np.cumsum(length)])
    data = words.data[np.arange(at[-1]) + np.repeat(start - at[:-1], length)]
    return pa.StringArray.from_buffers(len(which), pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of every term per group, folded over about a megabyte of text; a
    group also gets a row without a term."""
    for whole in batches:
        for b in pieces(whole):
            langs, sources = (b.column(c).dictionary_encode() for c in ("lang", "source"))
            lang, source = (c.indices.to_numpy(zero_copy_only=False).astype(np.int64) for c in (langs, sources))
            pair, group = np.unique(lang * len(sources.dictionary) + source, return_inverse=True)
            names = [
                (langs.dictionary[int(p) // len(sources.dictionary)], sources.dictionary[int(p) % len(sources.dictionary)])
                for p in pair
            ]
            words = Words(b.column("text"), blank=NOT_LETTER)
            text, h = words.text_of, words.hashes()
            order = np.lexsort((text, h, group[text]))
            g, k, t = group[text][order], h[order], text[order]
            new = np.ones(len(order), bool)
            new[1:] = (g[1:] != g[:-1]) | (k[1:] != k[:-1])
            first_in_text = new.copy()
            first_in_text[1:] |= t[1:] != t[:-1]
            at = np.flatnonzero(new)
            n = np.diff(np.append(at, len(order)))
            docs = np.add.reduceat(first_in_text.astype(np.int64), at) if len(at) else n
            owner = np.concatenate([g[at], np.arange(len(names))])
            yield batch(
                COUNTS,
                pa.array([n_[0] for n_ in names], pa.string()).take(pa.array(owner)),
                pa.array([n_[1] for n_ in names], pa.string()).take(pa.array(owner)),
                pa.concat_arrays([_texts(words, order[at]), pa.nulls(len(names), pa.string())]),
                np.concatenate([n, np.zeros(len(names), np.int64)]),
                np.concatenate([docs, np.zeros(len(names), np.int64)]),
            )


def share(count: str, total: str) -> str:
    """SQL of 1 + floor(UNIT * (count + SMOOTHING) / total) by long division, exact in 64 bits.

    total is not below count + SMOOTHING; a sum beyond 9e13 stops the query instead of wrapping.
    """
    a = f"({count} + {SMOOTHING})"
    return f"(1 + ({a} * 100000L div {total}) * 10000L + ((({a} * 100000L) % {total}) * 10000L) div {total})"


def shares(docs: DataFrame, least_docs: int = LEAST_DOCS) -> tuple[DataFrame, DataFrame]:
    """Groups (lang, source, p0, q0, terms, total): every group, with the share of a term it lacks, and
    cells (lang, source, term, n, lang_n, p, q): every kept term of a group that has it."""
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counts = keep(
        rows.mapInArrow(_counted, COUNTS_DDL)
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )
    kept = (
        counts.where("term IS NOT NULL")
        .groupBy("lang", "term")
        .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= least_docs)
        .drop("docs")
    )
    cells = keep(counts.where("term IS NOT NULL").drop("docs").join(kept, ["lang", "term"]))
    of_lang = cells.groupBy("lang").agg(F.sum("n").alias("lang_total"))
    of_lang = of_lang.join(kept.groupBy("lang").agg(F.count("*").alias("terms")), "lang")
    groups = (
        counts.where("term IS NULL")
        .select("lang", "source")
        .join(cells.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
        .join(of_lang, "lang", "left")
        .na.fill(0, ["total", "lang_total", "terms"])
        .withColumns(
            {
                "below": F.col("total") + SMOOTHING * F.col("terms"),
                "lang_below": F.col("lang_total") + SMOOTHING * F.col("terms"),
            }
        )
        .withColumn("p0", F.expr(f"if(terms > 0, {share('0L', 'below')}, 0L)"))
    )
    groups = keep(groups)
    cells = (
        cells.join(groups.select("lang", "source", "below", "lang_below"), ["lang", "source"])
        .withColumns({"p": F.expr(share("n", "below")), "q": F.expr(share("lang_n", "lang_below"))})
        .select("lang", "source", "term", "n", "lang_n", "p", "q")
    )
    return groups.select("lang", "source", "p0", "terms"), keep(cells)


def skyband(n: np.ndarray, lang_n: np.ndarray, term: np.ndarray, k: int) -> np.ndarray:
    """Places of the rows that fewer than k others dominate: no lower n, no higher lang_n, earlier term.

    Whatever dominates a row comes before it in the order by these three, so rows are looked at in this
    order, some at a time, and compared with one another and with the rows retained before them only: a
    dominator left out there is dominated by k that are retained.
    """
    name = np.empty(len(term), np.int64)
    name[np.argsort(term, kind="stable")] = np.arange(len(term))
    order = np.lexsort((name, lang_n, -n))
    kept = order[:0]
    for lo in range(0, len(order), TOGETHER):
        rows = order[lo : lo + TOGETHER]
        others = np.concatenate([kept, rows])
        over = (lang_n[others] <= lang_n[rows][:, None]) & (name[others] < name[rows][:, None])
        over[:, len(kept) :] &= np.tri(len(rows), k=-1, dtype=bool)
        kept = np.concatenate([kept, rows[np.count_nonzero(over, axis=1) < k]])
    return kept


def _skybands(table: pa.Table, k: int) -> pa.Table:
    """What each group of the table retains."""
    if not table.num_rows:
        return table
    group = table["lang"].combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
    source = table["source"].combine_chunks().dictionary_encode()
    group = group * len(source.dictionary) + source.indices.to_numpy()
    order = np.argsort(group, kind="stable")
    edges = np.flatnonzero(np.diff(group[order])) + 1
    term = np.array([t.encode() for t in table["term"].to_pylist()], dtype=object)
    n, lang_n = table["n"].to_numpy(), table["lang_n"].to_numpy()
    kept = [part[skyband(n[part], lang_n[part], term[part], k)] for part in np.split(order, edges)]
    return table.take(pa.array(np.concatenate(kept))).combine_chunks()


def _local(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:  # skybands so far and about as many more rows make the next skybands
            held.append(pa.Table.from_batches([b]))
            if sum(map(len, held)) > max(WAITING, 2 * size):
                held = [_skybands(pa.concat_tables(held), k)]
                size = len(held[0])
        if held:
            yield from _skybands(pa.concat_tables(held), k).to_batches()

    return run


def _ranked(k: int):
    def run(table: pa.Table) -> pa.Table:
        table = _skybands(table, k)
        term = np.array([t.encode() for t in table["term"].to_pylist()], dtype=object)
        name = np.empty(len(term), np.int64)
        name[np.argsort(term)] = np.arange(len(term))
        value = table["value"].to_numpy()
        first = pa.array(np.lexsort((name, -value))[:k])
        got = table.select(["lang", "source", "term", "value"]).take(first)
        return pa.table(
            {
                "lang": got["lang"],
                "source": got["source"],
                "part": pa.array(["term"] * len(got), pa.string()),
                "item": got["term"],
                "value": got["value"],
                "rank": pa.array(np.arange(1, len(got) + 1), pa.int32()),
            }
        )

    return run


def telling_terms(cells: DataFrame, ranks: int = RANKS) -> DataFrame:
    """(lang, source, part, item, value, rank): per group the terms of the largest p - q above 0."""
    rows = cells.where("p > q").withColumn("value", F.col("p") - F.col("q")).select(BAND)
    local = rows.mapInArrow(_local(ranks), BAND_DDL)
    salted = local.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    merged = salted.groupBy("lang", "source", "salt").applyInArrow(
        lambda t: _skybands(t.select(BAND), ranks), BAND_DDL
    )
    return merged.groupBy("lang", "source").applyInArrow(_ranked(ranks), TERMS_DDL)


def _distances(key: tuple, cells: pa.Table, groups: pa.Table) -> pa.Table:
    """Sums of |p - p'| over the terms of one block, for the sources of one stripe and all after them."""
    lang, _, stripe = (k.as_py() for k in key)
    groups = groups.sort_by("source")
    sources, base = groups["source"].combine_chunks(), groups["p0"].to_numpy()
    term = cells["term"].combine_chunks().dictionary_encode().indices.to_numpy()
    where = pc.index_in(cells["source"].combine_chunks(), sources).to_numpy(zero_copy_only=False)
    p = cells["p"].to_numpy()
    order = np.argsort(term, kind="stable")
    term, where, p = term[order], where[order], p[order]
    terms = int(term[-1]) + 1 if len(term) else 0
    step = max(1, CELLS // max(1, len(sources)))
    mine = range(stripe * STRIPE, min((stripe + 1) * STRIPE, len(sources)))
    total = np.zeros((len(mine), len(sources)), np.int64)
    for lo in range(0, terms, step):
        size = min(step, terms - lo)
        dense = np.repeat(base[:, None], size, axis=1)
        inside = slice(*np.searchsorted(term, [lo, lo + size]))
        dense[where[inside], term[inside] - lo] = p[inside]
        for i in mine:
            total[i - mine.start, i + 1 :] += np.abs(dense[i + 1 :] - dense[i]).sum(axis=1)
    one, other = np.nonzero(np.arange(len(sources)) > np.array(mine)[:, None])
    return pa.table(
        {
            "lang": pa.array([lang], pa.string()).take(pa.array(np.zeros(len(one), np.int64))),
            "source": sources.take(pa.array(one + mine.start)),
            "item": sources.take(pa.array(other)),
            "value": total[one, other],
        }
    )


def source_distances(groups: DataFrame, cells: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank): every other source of the language by distance.

    A language's terms are dealt to blocks and its sources to stripes; a task holds a block's cells
    (BLOCK terms in as many sources as have them) and sums for STRIPE sources against all others.
    """
    dealt = groups.groupBy("lang").agg(
        F.greatest(F.lit(1), F.ceil(F.max("terms") / BLOCK)).cast("int").alias("blocks"),
        F.ceil(F.count("*") / STRIPE).cast("int").alias("stripes"),
    )
    stripe = F.explode(F.sequence(F.lit(0), F.col("stripes") - 1)).alias("stripe")
    block = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    placed = (
        cells.select("lang", "source", "term", "p")
        .join(dealt, "lang")
        .withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int"))
        .select("lang", "source", "term", "p", "block", stripe)
    )
    sides = (
        groups.join(dealt, "lang")
        .select("lang", "source", "p0", "stripes", block)
        .select("lang", "source", "p0", "block", stripe)
    )
    half = (
        placed.groupBy("lang", "block", "stripe")
        .cogroup(sides.groupBy("lang", "block", "stripe"))
        .applyInArrow(_distances, PAIRS_DDL)
    )
    half = keep(half.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))
    both = half.unionByName(half.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return both.select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank")
    )


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, ranks: int = RANKS) -> DataFrame:
    """(lang, source, part, item, value, rank) for every (lang, source) of docs (text, lang, source, ...).

    Terms are runs of letters and of what is not ASCII, A-Z lower-cased; a language keeps those that
    least_docs of its rows hold. A kept term's share is 1 + floor(10^9 (count + 5) / (N + 5 V)) in whole
    numbers. Part `pair`: every other source of the language, by the sum of the differences of shares
    over all kept terms. Part `term`: the terms whose share is above the language's, by how much, the
    first `ranks` only. Ties go to what is earlier in UTF-8. Null text, lang and source read as ''. Rows
    that repeat one another are documents of their own; ids aren't looked at, nor other columns. A group
    without kept terms has pairs and no terms; a language of one source has no pairs; an empty table
    gives an empty result. Texts of any length are counted whole, one of more than a megabyte by itself.
    """
    groups, cells = shares(docs, least_docs)
    return source_distances(groups, cells).unionByName(telling_terms(cells, ranks))


def audit_sql(least_docs: int = LEAST_DOCS, ranks: int = RANKS) -> str:
    """The same over the table documents."""
    p = f"1 + ({UNIT}::HUGEINT * ({{}} + {SMOOTHING})) // ({{}} + {SMOOTHING} * v)"
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents
),
words AS (SELECT id, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS lang_n FROM words GROUP BY ALL HAVING count(DISTINCT id) >= {least_docs}),
lang_size AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
cells AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (
  SELECT g.lang, g.source, coalesce(any_value(v), 0) AS v, coalesce(any_value(lang_total), 0) AS lang_total,
    coalesce(sum(n), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) AS g
  LEFT JOIN lang_size AS l ON l.lang = g.lang LEFT JOIN cells AS c ON c.lang = g.lang AND c.source = g.source
  GROUP BY ALL
),
dense AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n, {p.format("coalesce(c.n, 0)", "total")} AS p,
    {p.format("lang_n", "lang_total")} AS q
  FROM sizes AS s JOIN kept AS k ON k.lang = s.lang
  LEFT JOIN cells AS c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
  FROM sizes AS a JOIN sizes AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN dense AS x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN dense AS y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM dense WHERE n > 0 AND p > q
),
ranked AS (
  SELECT lang, source, part, item, value::BIGINT AS value,
    row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM found
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {ranks}
"""
