"""Main text of pages by a recurrent labeller of their blocks.

Each leaf block becomes a vector: its tag path and its words, both hashed, and a few measures. A
bidirectional LSTM reads the vectors of a page in order, so that every block is judged by all that stands
before and after it. It is trained when needed, on a bounded sample of pages whose markup says what the
article is, and on variants of them with other markup around the same text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyvault.llm.blocks import AROUND, HOLDS, Block, blocks, supposed_main
from tallyvault.llm.text import Words, batch

PATH, WORDS, MEASURES = 32, 24, 9
INPUT = PATH + WORDS + MEASURES
HIDDEN = 16
SAMPLE_PAGES = 240  # pages trained on, at most,
SAMPLE_CHARS = 60_000  # none longer than this: the bounds of the sample
EPOCHS = 5
TOGETHER = 64  # pages labelled at a time


@lru_cache(maxsize=65536)
def _path_place(token: str) -> int:
    return zlib.crc32(token.encode()) % PATH


def vectors(page: list[Block]) -> np.ndarray:
    """One row per block."""
    n = len(page)
    x = np.zeros((n, INPUT), np.float32)
    if not n:
        return x
    for i, block in enumerate(page):
        for token in block.path:
            x[i, _path_place(token)] = 1.0
        around = sum(t in AROUND for t in block.path)
        holds = sum(t in HOLDS for t in block.path)
        text = block.text
        x[i, PATH + WORDS :] = (
            min(around, 2),
            min(holds, 2),
            len(block.path) / 8,
            np.log1p(len(text)) / 6,
            min(1.0, block.linked / max(len(text), 1)),
            text[-1] in ".!?:;\"'»”",
            i / n,
            (n - i) / n,
            any(t in ("h1", "h2", "h3") for t in block.path),
        )
    words = Words(pa.array([b.text for b in page], pa.string()))
    place = (words.hashes() >> np.uint64(40)) % np.uint64(WORDS)
    np.add.at(x, (words.text_of, PATH + place.astype(np.int64)), 1.0)
    part = x[:, PATH : PATH + WORDS]
    part /= np.maximum(np.sqrt((part * part).sum(axis=1, keepdims=True)), 1.0)
    return x


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Direction:
    """An LSTM over one direction of padded sequences (time, page, feature)."""

    def __init__(self, seed: np.random.Generator):
        scale = 1 / np.sqrt(INPUT + HIDDEN)
        self.weight = seed.normal(0, scale, (INPUT + HIDDEN, 4 * HIDDEN)).astype(np.float32)
        self.bias = np.zeros(4 * HIDDEN, np.float32)
        self.bias[HIDDEN : 2 * HIDDEN] = 1.0  # remember at first

    def forward(self, x: np.ndarray, keep: list | None = None) -> np.ndarray:
        steps, pages, _ = x.shape
        h, c = (np.zeros((pages, HIDDEN), np.float32) for _ in range(2))
        out = np.zeros((steps, pages, HIDDEN), np.float32)
        inner = x.reshape(-1, INPUT) @ self.weight[:INPUT] + self.bias
        inner = inner.reshape(steps, pages, -1)
        for t in range(steps):
            z = inner[t] + h @ self.weight[INPUT:]
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            new = np.tanh(z[:, 3 * HIDDEN :])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            before, last = c, h
            c = f * c + i * new
            squashed = np.tanh(c)
            h = o * squashed
            out[t] = h
            if keep is not None:
                keep.append((i, f, o, new, before, last, squashed))
        return out

    def backward(self, x: np.ndarray, keep: list, grad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        weight, bias = np.zeros_like(self.weight), np.zeros_like(self.bias)
        dh, dc = (np.zeros_like(grad[0]) for _ in range(2))
        for t in range(len(x) - 1, -1, -1):
            i, f, o, new, before, last, squashed = keep[t]
            dh = dh + grad[t]
            dc = dc + dh * o * (1 - squashed**2)
            z = np.concatenate(
                [dc * new * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - new**2)],
                axis=1,
            )
            weight[:INPUT] += x[t].T @ z
            weight[INPUT:] += last.T @ z
            bias += z.sum(axis=0)
            dh = z @ self.weight[INPUT:].T
            dc = dc * f
        return weight, bias


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pages as (time, page, feature), the same backwards, and which places are real."""
    steps = max(len(p) for p in pages)
    x, y = (np.zeros((steps, len(pages), INPUT), np.float32) for _ in range(2))
    real = np.zeros((steps, len(pages)), bool)
    for k, p in enumerate(pages):
        x[: len(p), k], y[: len(p), k], real[: len(p), k] = p, p[::-1], True
    return x, y, real


def turned(values: np.ndarray, real: np.ndarray) -> np.ndarray:
    """Each page's places in the opposite order."""
    out = np.zeros_like(values)
    for k, n in enumerate(real.sum(axis=0)):
        out[:n, k] = values[:n, k][::-1]
    return out


class Labeller:
    """Bidirectional LSTM with a logistic output per block."""

    def __init__(self, seed: int = 7):
        random = np.random.default_rng(seed)
        self.ahead, self.back = Direction(random), Direction(random)
        self.out = random.normal(0, 0.3, 2 * HIDDEN).astype(np.float32)
        self.shift = np.zeros(1, np.float32)

    def probabilities(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Per page the probability of each block to be main text."""
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        for at in range(0, len(order), TOGETHER):
            mine = order[at : at + TOGETHER]
            x, y, real = padded([pages[i] for i in mine])
            h = np.concatenate([self.ahead.forward(x), turned(self.back.forward(y), real)], axis=2)
            p = _sigmoid(h @ self.out + self.shift)
            for k, i in enumerate(mine):
                out[i] = p[: len(pages[i]), k]
        return out

    def train(self, pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = EPOCHS) -> None:
        """Adam on the cross-entropy of all blocks."""
        parts = [self.ahead.weight, self.ahead.bias, self.back.weight, self.back.bias, self.out, self.shift]
        first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
        random, step = np.random.default_rng(1), 0
        order = np.array(sorted(range(len(pages)), key=lambda i: len(pages[i])))
        groups = [order[at : at + 16] for at in range(0, len(order), 16)]
        for _ in range(epochs):
            for g in random.permutation(len(groups)):
                x, y, real = padded([pages[i] for i in groups[g]])
                target = np.zeros(real.shape, np.float32)
                for k, i in enumerate(groups[g]):
                    target[: len(labels[i]), k] = labels[i]
                kept: tuple[list, list] = ([], [])
                ahead, back = self.ahead.forward(x, kept[0]), turned(self.back.forward(y, kept[1]), real)
                h = np.concatenate([ahead, back], axis=2)
                error = np.where(real, _sigmoid(h @ self.out + self.shift) - target, 0).astype(np.float32)
                error /= max(real.sum(), 1)
                dh = error[:, :, None] * self.out
                grads = [
                    *self.ahead.backward(x, kept[0], dh[:, :, :HIDDEN]),
                    *self.back.backward(y, kept[1], turned(dh[:, :, HIDDEN:], real)),
                    np.einsum("tp,tph->h", error, h),
                    error.sum().reshape(1),
                ]
                step += 1
                for p, m, v, grad in zip(parts, first, second, grads, strict=True):
                    m += 0.1 * (grad - m)
                    v += 0.001 * (grad * grad - v)
                    p -= 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)


# What training pages look like with other markup: (from, to) of whole tags.
VARIANTS = [
    [],
    [("<nav>", '<div class="sidebar">'), ("</nav>", "</div>"), ("<article>", "<main>"), ("</article>", "</main>")],
    [
        ("<footer>", '<div class="comments"><p>'), ("</footer>", "</p></div>"), ('class="ad"', 'class="cookie-notice"'),
        ("<article>", '<div class="post-content">'), ("</article>", "</div>"),
    ],
    [
        ("<nav>", "<header>"), ("</nav>", "</header>"), ('<div class="ad">', "<aside><p>"),
        ("<article>", '<div id="content">'), ("</article>", '<form><p>Name</p></form></div>'),
    ],
]


def trained(sample: list[str]) -> Labeller:
    labeller = Labeller()
    pages, labels = [], []
    for number, page in enumerate(sample):
        for changes in (VARIANTS[0], VARIANTS[1 + number % (len(VARIANTS) - 1)]):
            for old, new in changes:
                page = page.replace(old, new)
            found = blocks(page)
            if found:
                pages.append(vectors(found))
                labels.append(np.array([supposed_main(b.path) for b in found], np.float32))
    if pages:
        labeller.train(pages, labels)
    return labeller


def _extract(labeller):
    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_blocks", pa.int64()), ("n_main", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                pages = [blocks(page) for page in b.column("html").to_pylist()]
                chances = labeller.value.probabilities([vectors(p) for p in pages])
                texts, counts = [], []
                for page, chance in zip(pages, chances, strict=True):
                    main = [x.text for x, p in zip(page, chance, strict=True) if p >= 0.5]
                    texts.append("\n".join(main))
                    counts.append((len(page), len(main)))
                n, m = np.array(counts, np.int64).reshape(-1, 2).T
                yield batch(schema, b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), n, m)

    return run


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks, n_main) for every row of pages (page_id, url, html, ...).

    text joins the main blocks in page order by line feeds; it is empty if there are none, and for null
    html. Repeated rows and null ids stay as they are; other columns are not looked at. An empty table
    gives an empty result.
    """
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    # which pages, by a hash of their names alone; only the drawn ones' html goes to the driver
    named = rows.where(f"length(html) BETWEEN 1 AND {SAMPLE_CHARS}").withColumn("name", F.xxhash64("page_id", "url"))
    drawn = [r["name"] for r in named.select("name").distinct().orderBy("name").limit(SAMPLE_PAGES).collect()]
    found = named.where(F.col("name").isin(drawn)).groupBy("name").agg(F.min("html").alias("html"))
    sample = [r["html"] for r in found.orderBy("name").collect()]
    labeller = pages.sparkSession.sparkContext.broadcast(trained(sample))
    found = rows.mapInArrow(_extract(labeller), "page_id long, url string, text string, n_blocks long, n_main long")
    return found.withColumn("n_chars", F.length("text").cast("long"))
