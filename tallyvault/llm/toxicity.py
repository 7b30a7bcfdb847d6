"""Toxicity by class-conditional Kneser-Ney models.

Two bigram models, of toxic and of ordinary texts, share what they back off to: a word's continuation
counts over both classes. A text's evidence is the difference of their log-likelihoods per word, over
the whole text and over its most toxic passage, with the strongest words; and the same of the ratios
of single words as far as they are beyond doubt, so that a word that few labelled texts have weighs
nothing. A logistic function of that evidence, learnt from labelled texts that the counts have not seen,
makes it a probability at the shares that the classes have among all labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyvault.llm.shared import keep
from tallyvault.llm.text import NOT_LETTER, Words, batch, mix, pieces

SAMPLE_DOCS = (4000, 1500)  # labelled documents, ordinary and toxic, at most,
SAMPLE_CHARS = (10_000_000, 5_000_000)  # and characters of them: the bounds of what is learnt from
PASSAGE = 12  # words of a passage
STRONGEST = 3  # words
DOUBT = 2.0  # standard errors that a word's ratio must be away from none
LINKS = np.uint64(0x9E3779B97F4A7C15)


def _discounted(counts: np.ndarray) -> np.ndarray:
    """Counts less the Kneser-Ney discount of once, twice and more often seen ones, from their own numbers."""
    n1, n2, n3, n4 = (float(np.count_nonzero(counts == k)) for k in (1, 2, 3, 4))
    if not n1 or not n2:
        return np.maximum(counts - 0.75, 0.0)
    y = n1 / (n1 + 2 * n2)
    less = np.array([0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.0])
    less = np.clip(less, [0.0, 0.1, 0.1, 0.1], [0.0, 0.95, 1.9, 2.9])
    return counts - less[np.minimum(counts, 3).astype(np.int64)]


def _pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * LINKS + second)


class Model:
    """Log-likelihood ratios, toxic over ordinary, of seen bigrams and of what they back off to."""

    def __init__(self, first: np.ndarray, second: np.ndarray, toxic: np.ndarray, text: np.ndarray):
        pair = _pairs(first, second)
        key, where, index = np.unique(pair, return_index=True, return_inverse=True)
        v, w = first[where], second[where]
        count = [np.bincount(index[toxic == c], minlength=len(key)) for c in (0, 1)]
        self.words = words = np.unique(np.concatenate([v, w]))
        at_v, at_w = np.searchsorted(words, v), np.searchsorted(words, w)
        n = len(words)
        shared = np.bincount(at_w, minlength=n) + 1.0
        shared /= shared.sum() + 1.0
        unseen = 1.0 / (len(key) + n + 1.0)
        uni, pairs, left = [], [], []
        for c in (0, 1):
            seen = count[c] > 0
            ends = np.bincount(at_w[seen], minlength=n)  # how many words it follows
            kept = _discounted(ends)
            total = max(ends.sum(), 1)
            backoff = 1.0 - kept.sum() / total
            p = kept / total + backoff * shared
            uni.append((p, backoff * unseen))
            mass = np.bincount(at_v, count[c], minlength=n)
            own = _discounted(count[c])
            used = np.bincount(at_v, own, minlength=n)
            rest = np.where(mass > 0, 1.0 - used / np.maximum(mass, 1), 1.0)
            left.append(rest)
            pairs.append(own / np.maximum(mass[at_v], 1) + rest[at_v] * p[at_w])
        self.word_ratio = np.log(uni[1][0] / uni[0][0]).astype(np.float32)
        self.new_word = float(np.log(uni[1][1] / uni[0][1]))
        self.left_ratio = np.log(left[1] / left[0]).astype(np.float32)
        self.pair_key = key
        self.pair_ratio = np.log(pairs[1] / pairs[0]).astype(np.float32)
        # texts of each class that have a word, and how far their shares are apart beyond doubt
        key, where = np.unique(mix(second) ^ mix(text.astype(np.uint64)), return_index=True)
        at, of = np.searchsorted(words, second[where]), toxic[where]
        texts = [len(np.unique(text[toxic == c])) for c in (0, 1)]
        holds = [np.bincount(at[of == c], minlength=n) + 0.5 for c in (0, 1)]
        apart = np.log(holds[1] / (texts[1] + 1)) - np.log(holds[0] / (texts[0] + 1))
        doubt = DOUBT * np.sqrt(1 / holds[0] + 1 / holds[1])
        self.sure_ratio = (np.sign(apart) * np.maximum(np.abs(apart) - doubt, 0)).astype(np.float32)

    def sure_ratios(self, hashes: np.ndarray) -> np.ndarray:
        """Each word's log ratio of the shares of texts that have it, less its doubt; 0 for new words."""
        out = np.zeros(len(hashes), np.float32)
        place, known = _find(self.words, hashes)
        out[known] = self.sure_ratio[place[known]]
        return out

    def ratios(self, hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Each word's log-likelihood ratio given the word before it; a text's first follows a start."""
        first = np.concatenate([np.zeros(1, np.uint64), hashes[:-1]]) if len(hashes) else hashes
        begin = at[:-1][np.diff(at) > 0]
        first[begin] = 0
        out = np.full(len(hashes), self.new_word, np.float32)
        place, known = _find(self.words, hashes)
        out[known] = self.word_ratio[place[known]]
        before, known = _find(self.words, first)
        out[known] += self.left_ratio[before[known]]
        place, known = _find(self.pair_key, _pairs(first, hashes))
        out[known] = self.pair_ratio[place[known]]
        return out


def _find(table: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(table, key)
    at[at == len(table)] = 0
    return at, (table[at] == key) if len(table) else np.zeros(len(key), bool)


def letters(texts: pa.Array) -> Words:
    """Runs of letters, lower-cased in A-Z: what stands between ASCII signs, digits and blanks."""
    return Words(texts, blank=NOT_LETTER)


def bigrams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    h = words.hashes()
    first = np.concatenate([np.zeros(1, np.uint64), h[:-1]]) if len(h) else h
    first[words.at[:-1][np.diff(words.at) > 0]] = 0
    return first, h


def _summary(ratio: np.ndarray, words: Words) -> np.ndarray:
    """Per text: mean ratio, mean of the strongest passage, mean of the strongest words, the strongest."""
    n = np.diff(words.at)
    out = np.zeros((len(n), 4))
    some, text = n > 0, words.text_of
    total = np.concatenate([[0.0], np.cumsum(ratio)])
    out[some, 0] = (total[words.at[1:]] - total[words.at[:-1]])[some] / n[some]
    stop = np.minimum(np.arange(len(ratio)) + PASSAGE, words.at[1:][text])
    begin = words.at[:-1][some]
    out[some, 1] = np.maximum.reduceat((total[stop] - total[:-1]) / PASSAGE, begin)
    order = np.lexsort((-ratio, text))
    place = np.arange(len(ratio)) - words.at[:-1][text]
    out[some, 2] = np.add.reduceat(np.where(place < STRONGEST, ratio[order], 0.0), begin) / STRONGEST
    out[some, 3] = np.maximum.reduceat(ratio, begin)
    return out


def evidence(model: Model, words: Words) -> np.ndarray:
    """Per text: summaries of its words' ratios in context and of their sure ratios, and its length."""
    if not len(words):
        return np.zeros((len(words.at) - 1, EVIDENCE))
    hashes = words.hashes()
    in_context, sure = model.ratios(hashes, words.at), model.sure_ratios(hashes)
    length = np.log1p(np.diff(words.at))
    return np.column_stack([_summary(in_context.astype(float), words), _summary(sure.astype(float), words), length])


EVIDENCE = 9


class Scorer:
    """A Model and the logistic function of its evidence.

    odds is by how much toxic documents are rarer among all labelled ones than among these texts.
    """

    def __init__(self, texts: list[str], toxic: np.ndarray, odds: float = 1.0):
        half = np.arange(len(texts)) % 3 > 0  # two thirds count, one third weighs
        counted = letters(pa.array([t for t, h in zip(texts, half, strict=True) if h], pa.string()))
        first, second = bigrams(counted)
        self.model = Model(first, second, np.repeat(toxic[half], np.diff(counted.at)), counted.text_of)
        rest = letters(pa.array([t for t, h in zip(texts, half, strict=True) if not h], pa.string()))
        x, y = evidence(self.model, rest), toxic[~half].astype(float)
        self.mean, self.scale = (x.mean(axis=0), x.std(axis=0) + 1e-9) if len(x) else (np.zeros(EVIDENCE), np.ones(EVIDENCE))
        z = np.column_stack([np.ones(len(x)), (x - self.mean) / self.scale])
        self.weight = np.zeros(z.shape[1])
        if 0 < y.sum() < len(y):
            ridge = np.diag([0.0, *[0.3] * (z.shape[1] - 1)])
            for _ in range(30):  # Newton's method
                p = 1 / (1 + np.exp(-np.clip(z @ self.weight, -30, 30)))
                step = z.T @ (p - y) + ridge @ self.weight
                self.weight -= np.linalg.solve(z.T @ (z * (p * (1 - p) + 1e-6)[:, None]) + ridge + 1e-9, step)
            self.weight[0] += np.log(odds)
        elif len(y):
            self.weight[0] = 4.0 if y.all() else -4.0
        else:
            self.weight[0] = -4.0

    def scores(self, words: Words) -> np.ndarray:
        z = (evidence(self.model, words) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(self.weight[0] + z @ self.weight[1:], -30, 30)))


def fair_share(sizes: list[int], room: int) -> int:
    """What one may take at most so that all together take no more than the room; all of it if that does."""
    for i, size in enumerate(sorted(sizes)):
        if size > (share := room // (len(sizes) - i)):
            return share
        room -= size
    return max(sizes, default=0)


def labelled_sample(docs: DataFrame, labels: DataFrame, held_out: Column) -> tuple[list[str], np.ndarray, float]:
    """Texts and labels of a bounded sample per class, in an order that depends on the ids only, and the
    odds of a toxic document among all labelled ones over those in the sample.

    Where a class has more characters than the bound, its longest texts are shortened to an equal length.
    """
    marked = (
        labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .where(~F.coalesce(held_out, F.lit(False)))
    )
    sizes = keep(docs.select("doc_id", F.length("text").alias("chars")).where("chars > 0").join(marked, "doc_id"))
    everything = {row["toxic"]: row["count"] for row in sizes.groupBy("toxic").count().collect()}
    chosen: dict[int, int] = {}
    taken = {}
    for toxic in (0, 1):
        wanted = sizes.where(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id")
        rows = wanted.limit(SAMPLE_DOCS[toxic]).collect()
        most = fair_share([row["chars"] for row in rows], SAMPLE_CHARS[toxic])
        chosen |= {row["doc_id"]: most for row in rows}
        taken[toxic] = len(rows)
    share = [taken[c] / everything[c] if everything.get(c) else 1.0 for c in (0, 1)]
    ids = docs.sparkSession.createDataFrame(list(chosen.items()), "doc_id long, most int")
    found = docs.join(F.broadcast(ids), "doc_id").join(marked, "doc_id")
    found = found.select("doc_id", F.expr("substring(text, 1, most)").alias("text"), "toxic")
    table = found.orderBy(F.xxhash64("doc_id"), "doc_id").toArrow()  # at most the sum of SAMPLE_CHARS characters
    return table["text"].to_pylist(), table["toxic"].to_numpy().astype(int), share[0] / share[1]


def _score(scorer):
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in pieces(whole):
                yield batch(schema, b.column("doc_id"), b.column("held_out"), scorer.value.scores(letters(b.column("text"))))

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs (doc_id, text, ...).

    labels has (doc_id, toxic, ...); a document with several labels is toxic if one says so, and null
    labels say nothing. Documents for which held_out is true are not learnt from. Null and empty texts
    have no evidence and get the score of that. Without labels every score is low. Repeated rows and
    null ids stay as they are; other columns are not looked at. An empty table gives an empty result.
    Texts of any length are scored whole, one of more than a megabyte by itself.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    scorer = docs.sparkSession.sparkContext.broadcast(Scorer(*labelled_sample(rows, labels, held_out)))
    flagged = rows.withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    return flagged.mapInArrow(_score(scorer), "doc_id long, held_out boolean, score double").withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )
