"""Words and hashes of whole Arrow batches of texts, without a Python loop over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20  # texts looked at together; bounds the arrays of one step
U64 = np.uint64

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_LETTER = np.array([c < 128 and not chr(c).isalpha() for c in range(256)])  # ASCII but for letters
LINE_END = np.zeros(256, dtype=bool)
LINE_END[0x0A] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: spreads every input bit over the 64 output bits."""
    h = h.astype(U64, copy=True)
    h ^= h >> U64(30)
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def factors(n: int, seed: int = 1) -> np.ndarray:
    """The first n odd pseudo-random factors of a multilinear hash."""
    golden = U64(0x9E3779B97F4A7C15)
    return mix((np.arange(1, n + 1, dtype=U64) + U64(seed << 40)) * golden) | U64(1)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and the n + 1 offsets of the texts. Null counts as empty."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if len(off) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]], off - off[0]


def pieces(batch: pa.RecordBatch, column: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of whole rows with about `most` bytes of text each; a longer text is a run of its own."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths.astype(np.int64)) // most
    edges = np.flatnonzero(np.diff(part)) + 1
    for lo, hi in zip([0, *edges], [*edges, len(part)], strict=True):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


class Words:
    """The words `[^\\x20\\x09-\\x0D]+` of texts: where each is, and per text the range of its words.

    Another table of blank bytes gives other runs, such as lines.
    """

    def __init__(self, texts: pa.Array, lower: bool = True, blank: np.ndarray = SPACE):
        data, self.text_at = buffers(texts)
        if lower:
            data = data.copy()
            data[(data >= 65) & (data <= 90)] += 32
        self.data = data
        self.space = blank[data]
        solid = ~self.space
        first = solid.copy()
        first[1:] &= self.space[:-1]
        last = solid.copy()
        last[:-1] &= self.space[1:]
        inner = self.text_at[1:-1]
        inner = inner[(inner > 0) & (inner < len(data))]
        first[inner] = solid[inner]
        last[inner - 1] = solid[inner - 1]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        #: words of text i are start[at[i]:at[i + 1]]
        self.at = np.searchsorted(self.start, self.text_at)
        self.solid = solid

    def __len__(self) -> int:
        return len(self.start)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))

    def hashes(self, seed: int = 1) -> np.ndarray:
        """A 64-bit hash per word; equal words have equal hashes everywhere."""
        if not len(self):
            return np.zeros(0, U64)
        lengths = self.end - self.start
        begin = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum())) - np.repeat(begin, lengths)
        weight = factors(int(lengths.max()), seed)
        summed = np.add.reduceat((self.data[self.solid].astype(U64) + U64(1)) * weight[place], begin)
        return mix(summed + lengths.astype(U64) * U64(0x632BE59BD9B4E019))

    def strings(self, which: np.ndarray) -> list[bytes]:
        raw = self.data.tobytes()
        return [raw[a:b] for a, b in zip(self.start[which].tolist(), self.end[which].tolist(), strict=True)]


def shingles(words: Words, size: int, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words inside one text, in order, and the n + 1 bounds per text.

    A text with 1 to size - 1 words has one shingle, its whole sequence; one without words has none.
    """
    h = words.hashes() if hashes is None else hashes
    n = np.diff(words.at)
    if not len(h):
        return np.zeros(0, U64), np.zeros(len(n) + 1, np.int64)
    weight = factors(size, 7)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    at = np.concatenate([[0], np.cumsum(count)])
    begin = np.repeat(words.at[:-1] - at[:-1], count) + np.arange(at[-1])
    padded = np.concatenate([h, np.zeros(size, U64)])
    out = np.zeros(len(begin), U64)
    short = np.repeat(n < size, count)
    stop = np.repeat(words.at[1:], count)
    for j in range(size):
        term = padded[begin + j] * weight[j]
        if short.any():
            term[short & (begin + j >= stop)] = 0
        out += term
    return mix(out + np.repeat(np.minimum(n, size), count).astype(U64)), at


def distinct(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values per text, and their bounds."""
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    keep = np.ones(len(v), dtype=bool)
    keep[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    return v[keep], np.searchsorted(o[keep], np.arange(len(at)))


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def lists(values: np.ndarray, at: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """An Arrow list per text."""
    kind = kind or pa.from_numpy_dtype(values.dtype)
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values).cast(kind))


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """A record batch of numpy or Arrow columns."""
    arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns]
    return pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema, strict=True)], schema=schema)
