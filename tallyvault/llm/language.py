"""Language of texts and of their spans.

A word's script, by ranges of code points, leaves the languages that training saw in that script. Its
score in each of these is the log-probability of its byte trigrams. Viterbi over the words of a text,
where changing the language costs a penalty, labels spans of mixed texts; a text's own language is the
one that labels most of its letters.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyvault.llm.shared import carried, extra_ddl, freed, sent, with_text
from tallyvault.llm.text import Words, batch, pieces

BUCKETS = 1 << 15  # of trigrams; a model has so many numbers per language
SWITCH = 12.0  # what a change of language costs, in nats
SMOOTH = 0.5
SHARE = 0.001  # of a language's letters that a script must have to belong to it
UNKNOWN = "und"

# First code points of blocks, and the script of each. 0 stands for no letter.
_BLOCKS = [
    (0x0000, 0), (0x0041, 1), (0x005B, 0), (0x0061, 1), (0x007B, 0), (0x00AA, 1), (0x00AB, 0), (0x00B5, 1),
    (0x00B6, 0), (0x00BA, 1), (0x00BB, 0), (0x00C0, 1), (0x00D7, 0), (0x00D8, 1), (0x00F7, 0), (0x00F8, 1),
    (0x0250, 1), (0x0300, 0), (0x0370, 2), (0x0400, 3), (0x0530, 4), (0x0590, 5), (0x0600, 6), (0x0700, 7),
    (0x0750, 6), (0x0780, 7), (0x0900, 8), (0x0980, 9), (0x0A00, 10), (0x0E00, 11), (0x0E80, 10),
    (0x10A0, 4), (0x1100, 12), (0x1200, 10), (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x2C00, 10),
    (0x2E00, 0), (0x3040, 13), (0x3100, 10), (0x3130, 12), (0x3190, 10), (0x3400, 14), (0xA000, 10),
    (0xAC00, 12), (0xD800, 0), (0xF900, 14), (0xFB00, 1), (0xFB1D, 5), (0xFB50, 6), (0xFE00, 0),
    (0xFE70, 6), (0xFF00, 0), (0xFF21, 1), (0xFF3B, 0), (0xFF41, 1), (0xFF5B, 13), (0xFFA0, 12),
    (0xFFF0, 0), (0x10000, 10), (0x1F000, 0), (0x20000, 14),
]
_FIRST = np.array([f for f, _ in _BLOCKS])
_SCRIPT = np.array([s for _, s in _BLOCKS])
SCRIPTS = 15


def scripts(data: np.ndarray) -> np.ndarray:
    """The script of the character that starts at each byte of UTF-8 text; 0 inside characters."""
    out = _SCRIPT[np.searchsorted(_FIRST, np.arange(128), "right") - 1][data & 127].astype(np.uint8)
    high = data >= 128
    out[high] = 0
    lead = np.flatnonzero(high & (data >= 0xC0))
    if len(lead):
        padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int64)
        b = padded[lead]
        size = 2 + (b >= 0xE0) + (b >= 0xF0)
        code = b & np.where(size == 2, 0x1F, np.where(size == 3, 0x0F, 0x07))
        for j in range(1, 4):
            code = np.where(size > j, code << 6 | padded[lead + j] & 0x3F, code)
        out[lead] = _SCRIPT[np.searchsorted(_FIRST, code, "right") - 1]
    return out


def trigrams(words: Words) -> np.ndarray:
    """The bucket of the trigram that ends at each solid byte; blanks around words count as one byte."""
    data = np.where(words.space, 0x20, words.data).astype(np.uint32)
    inner = words.text_at[:-1]
    first = data.copy()
    second = data.copy()
    first[1:], second[2:] = data[:-1], data[:-2]
    first[:1], second[:2] = 0x20, 0x20
    begin = words.start
    first[begin] = 0x20  # also where a text begins right behind the last one
    second[begin] = 0x20
    second[begin[begin + 1 < len(data)] + 1] = 0x20
    del inner
    h = (second << 16 | first << 8 | data) * np.uint32(2654435761)
    return (h >> np.uint32(32 - 15)).astype(np.int32)


class Model:
    """Log-probabilities of trigram buckets per language, and the languages of each script."""

    def __init__(self, languages: list[str], counts: np.ndarray, letters: np.ndarray):
        self.languages = languages
        total = counts.sum(axis=1, keepdims=True) + SMOOTH * BUCKETS
        self.log = np.log((counts + SMOOTH) / total).T.astype(np.float32).copy()
        share = letters / np.maximum(letters.sum(axis=1, keepdims=True), 1)
        self.uses = share > SHARE
        self.uses[:, 0] = False

    def word_scores(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Per word and language a log-probability, 0 for words without letters; and letters per word."""
        n = len(words)
        if not n:
            return np.zeros((0, len(self.languages)), np.float32), np.zeros(0, np.int64)
        script = scripts(words.data)
        solid = words.solid
        lengths = words.end - words.start
        begin = np.cumsum(lengths) - lengths
        bucket = trigrams(words)[solid]
        script = script[solid]
        letters = np.add.reduceat((script > 0).astype(np.int64), begin)
        kinds = np.bitwise_or.reduceat((1 << script.astype(np.uint32)) & ~np.uint32(1), begin)
        out = np.empty((n, len(self.languages)), np.float32)
        for i in range(len(self.languages)):
            out[:, i] = np.add.reduceat(self.log[bucket, i], begin)
            mine = sum(1 << int(s) for s in np.flatnonzero(self.uses[i]))
            out[(kinds & np.uint32(mine)) == 0, i] -= 1000.0
        out[letters == 0] = 0
        out -= out.max(axis=1, keepdims=True)
        return np.maximum(out, -1000.0), letters

    def label(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """The language of each word by Viterbi within its text, and letters per word."""
        score, letters = self.word_scores(words)
        n = np.diff(words.at)
        order = np.argsort(-n, kind="stable")
        start, size = words.at[:-1][order], n[order]
        longest = int(size[0]) if len(size) else 0
        live_at = np.searchsorted(-size, -np.arange(longest), "left")  # texts with more words than step
        came = np.zeros(score.shape, np.int16)
        best = np.zeros((len(size), len(self.languages)), np.float32)
        own = np.arange(len(self.languages), dtype=np.int16)
        for step in range(longest):
            live = live_at[step]
            at = start[:live] + step
            now = best[:live]
            if step:
                top = now.argmax(axis=1)
                other = now[np.arange(live), top][:, None] - SWITCH
                came[at] = np.where(now >= other, own, top[:, None].astype(np.int16))
                now = np.maximum(now, other)
            best[:live] = now + score[at]
        label = np.zeros(len(score), np.int16)
        state = best.argmax(axis=1).astype(np.int16)
        for step in range(longest - 1, -1, -1):
            live = live_at[step]
            at = start[:live] + step
            label[at] = state[:live]
            state[:live] = came[at, state[:live]]
        return label, letters


@freed
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("lang", pa.string()), ("kind", pa.int32()), ("n", pa.int64())])
    for whole in batches:
        for b in pieces(whole):
            words = Words(b.column("text"))
            names = b.column("lang").dictionary_encode()
            of = names.indices.to_numpy(zero_copy_only=False)
            owner = np.repeat(of, np.diff(words.text_at))
            bucket, script = trigrams(words), scripts(words.data)
            for i, lang in enumerate(names.dictionary.to_pylist()):
                mine = (owner == i) & words.solid
                number = np.bincount(bucket[mine], minlength=BUCKETS)
                letters = np.bincount(script[mine], minlength=SCRIPTS)
                every = np.concatenate([number, letters])
                some = np.flatnonzero(every)
                yield batch(schema, [lang] * len(some), some.astype(np.int32), every[some])


def fit(docs: DataFrame) -> Model:
    """Learn from all rows of docs (text, lang) whose lang isn't null."""
    rows = docs.select(F.col("text").cast("string"), F.col("lang").cast("string")).where("lang IS NOT NULL")
    found = (
        rows.mapInArrow(_count, "lang string, kind int, n long").groupBy("lang", "kind").agg(F.sum("n").alias("n"))
    ).toArrow()  # at most BUCKETS + SCRIPTS rows a language
    lang, kind, n = (np.array(found[c].to_pylist()) for c in ("lang", "kind", "n"))
    languages = sorted(set(lang.tolist()))
    counts, letters = np.zeros((len(languages), BUCKETS)), np.zeros((len(languages), SCRIPTS))
    for i, name in enumerate(languages):
        mine = lang == name
        k, v = kind[mine], n[mine]
        counts[i, k[k < BUCKETS]] = v[k < BUCKETS]
        letters[i, k[k >= BUCKETS] - BUCKETS] = v[k >= BUCKETS]
    return Model(languages, counts, letters)


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))


def _label(model):
    fields = [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()), ("spans", SPANS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        names = np.array([*known.languages, UNKNOWN], dtype=object)
        for whole in batches:
            schema = pa.schema([*fields, ("extra", whole.column("extra").type)])
            for b in pieces(with_text(whole)):
                words = Words(b.column("text"))
                n, some = b.num_rows, len(known.languages)
                label, letters = known.label(words) if some else (np.zeros(len(words), int), np.zeros(len(words), int))
                text = words.text_of
                share = np.bincount(text * max(some, 1) + label, letters, minlength=n * max(some, 1)).reshape(n, -1)
                total = share.sum(axis=1)
                lettered = b.column("lettered").to_numpy(zero_copy_only=False) & (some > 0)
                best = np.where(lettered, share.argmax(axis=1), some)
                score = np.where(total > 0, share.max(axis=1) / np.maximum(total, 1), 0.0)
                new = np.ones(len(label), bool)
                new[1:] = (label[1:] != label[:-1]) | (text[1:] != text[:-1])
                first = np.flatnonzero(new)
                last = np.append(first, len(label))[1:] - 1
                of = text[first]
                spans = pa.StructArray.from_arrays(
                    [
                        pa.array(words.start[first] - words.text_at[of]),
                        pa.array(words.end[last] - words.text_at[of]),
                        pa.array(names[label[first]] if some else [UNKNOWN] * len(first), pa.string()),
                    ],
                    names=["start", "end", "lang"],
                )
                yield batch(
                    schema,
                    b.column("doc_id"),
                    b.column("held_out"),
                    pa.array(names[best], pa.string()),
                    np.where(lettered, score, 0.0),
                    pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(n + 1)).astype(np.int32)), spans),
                    b.column("extra"),
                )

    return freed(run)


def identify(docs: DataFrame, held_out: Column, carry: Sequence[str] = ()) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, spans, extra) for every row of docs (doc_id, text, lang, ...).

    Rows with held_out false or null and a lang are learnt from. score is the share of the text's
    letters in the spans of lang_pred; spans are byte ranges of the text with a language each. Null
    text, text without letters, and any text when nothing was learnt, is `und` with score 0. Repeated
    rows and null ids stay as they are. extra has the columns named in carry; others are not looked at.
    An empty table gives an empty result.
    """
    rows = docs.select(
        F.col("doc_id").cast("long"),
        F.col("text").cast("string"),
        F.col("lang").cast("string"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        carried(carry),
    )
    model = docs.sparkSession.sparkContext.broadcast(fit(rows.where("NOT held_out")))
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered")
    return sent(rows.select("doc_id", "text", "held_out", lettered, "extra"), carry).mapInArrow(
        _label(model),
        "doc_id long, held_out boolean, lang_pred string, score double, "
        f"spans array<struct<start: long, end: long, lang: string>>, {extra_ddl(rows)}",
    )
