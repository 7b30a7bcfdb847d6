"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict


def words(text: str | None) -> list[str]:
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]


def shingles(text: str | None, size: int = 5) -> set[tuple]:
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} - {()})


def similar_classes(rows: list[tuple[int, str]], percent: int = 80, size: int = 5) -> dict[int, tuple[int, int]]:
    sets = {i: shingles(t, size) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in sorted(sets.items()):
        shared = Counter(j for x in s for j in holders[x])
        for j, both in shared.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
        for x in s:
            holders[x].append(i)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def without_repeats(rows: list[tuple[int, str]], width: int = 100) -> dict[int, tuple]:
    seen, out = set(), {}
    for i, text in sorted(rows):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - width + 1):
            if raw[p : p + width] in seen:
                gone[p : p + width] = b"\1" * width
            seen.add(raw[p : p + width])
        kept = bytes(x for x, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


class ContextTree:
    """Counts of all contexts, weighted recursively."""

    def __init__(self, texts: list[str | None], depth: int = 6):
        self.depth, self.counts, self.children = depth, defaultdict(lambda: [0, 0]), defaultdict(set)
        self.tokens = Counter(w for t in texts for w in words(t))
        self.texts = len(texts)
        for word, n in self.tokens.items():
            for context, byte in self.symbols(word):
                self.add(context, byte, n)
        self.add(b" ", 10, self.texts)
        self.known: dict = {}

    def symbols(self, word: str):
        line = b" " + word.encode() + b" "
        for i in range(1, len(line)):
            yield line[max(0, i - self.depth) : i], line[i]

    def add(self, context: bytes, byte: int, n: int) -> None:
        for d in range(len(context) + 1):
            part = context[len(context) - d :]
            if d:
                self.children[part[1:]].add(part)
            for k in range(8):
                self.counts[part, k, byte >> (8 - k)][byte >> (7 - k) & 1] += n

    @staticmethod
    def kt(a: int, b: int) -> float:
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)

    def weighted(self, context: bytes, k: int, prefix: int) -> float:
        name = (context, k, prefix)
        if name not in self.known:
            own = self.kt(*self.counts[name])
            if len(context) < self.depth and context[:1] != b" ":
                below = sum(
                    self.weighted(c, k, prefix) for c in self.children[context] if (c, k, prefix) in self.counts
                )
                high, low = max(own, below), min(own, below)
                own = math.log(0.5) + high + math.log1p(math.exp(low - high))
            self.known[name] = own
        return self.known[name]

    def log10(self, context: bytes, byte: int) -> float:
        total = 0.0
        for k in range(8):
            prefix, bit, p, seen = byte >> (8 - k), byte >> (7 - k) & 1, 0.5, False
            for d in range(len(context), -1, -1):
                name = (context[len(context) - d :], k, prefix)
                if name not in self.counts:
                    continue
                n = self.counts[name]
                own = (n[bit] + 0.5) / (sum(n) + 1)
                weight = math.exp(min(0.0, math.log(0.5) + self.kt(*n) - self.weighted(*name)))
                p = weight * own + (1 - weight) * p if seen else own
                seen = True
            total += math.log10(p)
        return total

    def score(self, text: str | None) -> float:
        return self.log10(b" ", 10) + sum(self.log10(*s) for w in words(text) for s in self.symbols(w))

    def base(self, text: str | None) -> float:
        n, v = sum(self.tokens.values()) + self.texts, len(self.tokens) + (self.texts > 0)
        found = [self.tokens[w] for w in words(text)] + [self.texts]
        return sum(math.log10((c + 1) / (n + v + 1)) for c in found)


def repeated_words(rows: list[tuple[int, str]], size: int = 50) -> dict[int, set[int]]:
    """Per document the places of words within runs of `size` words that an earlier document has."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        w = words(text)
        runs = [tuple(w[k : k + size]) for k in range(len(w) - size + 1)]
        out[i] = {j for k, run in enumerate(runs) if run in seen for j in range(k, k + size)}
        seen.update(runs)
    return out
