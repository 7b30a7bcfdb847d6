"""Quality rules as a ledger: each rule is evaluated once, and policies only look at bits.

The ledger keeps, per document, what was measured and one bit per failed rule. A policy is a version
with a mask of rules that a document must not fail; it can change without reading a text again, and
what each rule costs is a bitwise aggregation over the ledger.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyvault.llm.text import LINE_END, Words, batch, factors, mix, pieces

WINDOW = 8

#: Rule: when it fails, in terms of the measurements. A rule's bit is its place; add new ones at the end.
RULES = {
    "few_words": "n_words < 20",
    "repeated_words": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > 2 * n_words",
    "repeated_lines": "100 * n_dup_lines > 30 * n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 15 * n_words",
    "capitals": "100 * n_capitals > 50 * word_chars",
}
BASE = ("few_words", "repeated_words")

#: Version: the rules that reject.
POLICIES = {
    "base": BASE,
    "2": (*BASE, "symbols", "capitals"),
    "3": (*BASE, "symbols", "repeated_lines", "word_length", "capitals"),
}
CURRENT = "3"

MEASURED = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals"]
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True


def bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def mask(policy: str) -> int:
    return sum(bit(rule) for rule in POLICIES[policy])


def _seen_before(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per value: whether its text has it earlier, and whether its text has it anywhere else."""
    order = np.lexsort((np.arange(len(values)), values, owner))
    v, o = values[order], owner[order]
    again = np.zeros(len(v), bool)
    again[1:] = (v[1:] == v[:-1]) & (o[1:] == o[:-1])
    twice = again.copy()
    twice[:-1] |= again[1:]
    earlier, anywhere = np.zeros(len(v), bool), np.zeros(len(v), bool)
    earlier[order], anywhere[order] = again, twice
    return earlier, anywhere


def _per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[at[1:]] - total[at[:-1]]


def measures(texts: pa.Array, window: int = WINDOW) -> list[np.ndarray]:
    """The MEASURED numbers of each text, in that order."""
    words = Words(texts, lower=False)
    data, at = words.data, words.text_at
    n_words = np.diff(words.at)
    lead = words.solid & (data & 0xC0 != 0x80)  # first bytes of characters
    lines = Words(texts, lower=False, blank=LINE_END)
    solid = np.concatenate([[0], np.cumsum(words.solid)])
    full = solid[lines.end] > solid[lines.start] if len(lines) else np.zeros(0, bool)
    repeated, _ = _seen_before(lines.hashes(), lines.text_of)
    # windows of words that occur again in their text, and the words inside them
    h = words.hashes()
    count = np.maximum(n_words - window + 1, 0)
    begin = np.repeat(words.at[:-1], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    weight = factors(window, 11)
    name = np.zeros(len(begin), np.uint64)
    for j in range(window):
        name += h[begin + j] * weight[j]
    _, twice = _seen_before(mix(name), np.repeat(np.arange(len(count)), count))
    depth = np.zeros(len(h) + 1, np.int64)
    np.add.at(depth, begin[twice], 1)
    np.add.at(depth, begin[twice] + window, -1)
    return [
        n_words,
        _per_text(lead, at),
        _per_text(_SYMBOL[data], at),
        _per_text(full, lines.at),
        _per_text(full & repeated, lines.at),
        _per_text(np.cumsum(depth[:-1]) > 0, words.at),
        _per_text(_CAPITAL[data], at),
    ]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), *((m, pa.int64()) for m in MEASURED)])
    for whole in batches:
        for b in pieces(whole):
            yield batch(schema, b.column("doc_id"), *measures(b.column("text")))


def ledger(docs: DataFrame) -> DataFrame:
    """(doc_id, the MEASURED numbers, failed) for every row of docs (doc_id, text, ...).

    Null text has no words. Each row is judged by itself, so repeated rows and null ids stay as they
    are. Other columns are not looked at. An empty table gives an empty ledger.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    measured = rows.mapInArrow(_measure, ", ".join(f"{c} long" for c in ["doc_id", *MEASURED]))
    bits = [F.when(F.expr(fails), F.lit(bit(rule))).otherwise(F.lit(0)) for rule, fails in RULES.items()]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return measured.withColumn("failed", failed.cast("long"))


def passes(policy: str, failed: str | Column = "failed") -> Column:
    """Whether a document's failure bits satisfy a policy."""
    failed = F.col(failed) if isinstance(failed, str) else failed
    return failed.bitwiseAND(F.lit(mask(policy))) == 0


def apply_policy(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The ledger with base_failed and kept; the base rules hold under every policy."""
    return rows.withColumn("base_failed", ~passes("base")).withColumn("kept", passes("base") & passes(policy))


def ablations(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """(rule, failed, alone, kept_without): per rule of a policy, how many documents fail it, how many
    fail nothing else of the policy, and how many would be kept without it. One pass over the ledger."""
    whole = mask(policy)
    found = F.lit(0)
    aggregates = [F.count(F.when(F.col("failed").bitwiseAND(F.lit(whole)) == found, 1)).alias("kept")]
    for rule in POLICIES[policy]:
        of = F.col("failed").bitwiseAND(F.lit(whole))
        aggregates.append(F.count(F.when(of.bitwiseAND(F.lit(bit(rule))) != 0, 1)).alias(f"{rule}_failed"))
        aggregates.append(F.count(F.when(of == bit(rule), 1)).alias(f"{rule}_alone"))
    one = rows.agg(*aggregates)
    cells = ", ".join(f"'{r}', {r}_failed, {r}_alone, kept + {r}_alone" for r in POLICIES[policy])
    return one.selectExpr(f"stack({len(POLICIES[policy])}, {cells}) AS (rule, failed, alone, kept_without)")


def _words_sql(column: str) -> str:
    return f"[w FOR w IN string_split_regex({column}, '[\\x20\\x09-\\x0D]+') IF w <> '']"


def policy_sql(policy: str = CURRENT) -> str:
    """The op2 query for DuckDB."""
    cases = {r: f"CASE WHEN {fails} THEN {bit(r)} ELSE 0 END" for r, fails in RULES.items()}
    return f"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT *, {_words_sql("text")} AS w, [l FOR l IN string_split(text, chr(10))
         IF regexp_matches(l, '[^\\x20\\x09-\\x0D]')] AS lines FROM t
), windows AS (
  SELECT r, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS run
  FROM (SELECT r, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM split)
), twice AS (
  SELECT r, i FROM windows JOIN (SELECT r, run FROM windows GROUP BY r, run HAVING count(*) > 1) USING (r, run)
), inside AS (
  SELECT r, count(DISTINCT i + j) AS n FROM twice, range({WINDOW}) s(j) GROUP BY r
), m AS (
  SELECT doc_id, len(w) AS n_words, coalesce(list_sum([length(x) FOR x IN w]), 0) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals
  FROM split LEFT JOIN inside USING (r)
), f AS (SELECT *, {" + ".join(cases.values())} AS failed FROM m)
SELECT doc_id, n_words, cast(word_chars AS BIGINT) AS word_chars, n_symbols, n_dup_lines, n_repeat_words,
  failed & {mask("base")} <> 0 AS base_failed, failed & {mask("base") | mask(policy)} = 0 AS kept FROM f
"""
