"""Words of whole Arrow batches as NumPy arrays, hashed by prefix polynomials instead of one by one."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

WORD, GAP, END = 0, 1, 2

_U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def byte_kinds(gaps: bytes, ends: bytes = b"") -> np.ndarray:
    """What each byte is: part of a word, a gap between words, or the end of a piece that no run of words crosses."""
    kinds = np.full(256, WORD, np.uint8)
    kinds[list(gaps)] = GAP
    kinds[list(ends)] = END
    return kinds


def _byte_values(seed: int) -> np.ndarray:
    """A number for each byte; a capital A-Z has its small letter's."""
    values = mixed(np.arange(1, 257, dtype=_U) * _U(seed))
    values[65:91] = values[97:123]
    return values


class Powers:
    """Powers of an odd base modulo 2^64 and of its inverse, as far as they were needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, _U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 2 * len(self.up))
            self.up, self.down = (np.cumprod(np.concatenate([np.ones(1, _U), np.full(size - 1, _U(b))])) for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]


def _prefix(values: np.ndarray, up: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, _U)
    np.cumsum(values * up, out=out[1:])
    return out


class Hasher:
    """Hashes of words and of runs of words.

    With prefix sums of value times power, the polynomial of any stretch is a difference of two sums,
    brought back to power zero: a constant number of operations for a run of any length.
    """

    def __init__(self, seed: int = 0x9E3779B97F4A7C15):
        self.values = _byte_values(seed)
        low = seed & 0xFFFFFFF8
        self.letters, self.words = Powers(0xD1342543DE82EF00 | low & 0xF8 | 5), Powers(0xAF251AF3B0F02500 | low & 0xF8 | 3)

    def of_words(self, words: Words) -> np.ndarray:
        up, down = self.letters.upto(len(words.data) + 1)
        sums = _prefix(self.values[words.data], up[:-1])
        return mixed((sums[words.end] - sums[words.start]) * down[words.start])

    def of_runs(self, hashes: np.ndarray, sizes: list[int]) -> dict[int, np.ndarray]:
        """For each size, the hashes of the runs that begin at each word; those that cross an end are the caller's to leave out."""
        n = len(hashes)
        up, down = self.words.upto(n + 1)
        sums = _prefix(hashes, up[:-1])
        out = {}
        for size in sizes:
            k = max(n - size + 1, 0)
            out[size] = mixed((sums[size : size + k] - sums[:k]) * down[:k] + _U(size))
        return out


class Words:
    """Where the words of a batch of texts are: bytes from ``start`` to ``end``, the text's number, the piece's number."""

    def __init__(self, texts: pa.Array, kinds: np.ndarray):
        texts = texts.cast(pa.large_string())
        edges = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        body = texts.buffers()[2] if len(texts) else None
        self.data = np.frombuffer(body, np.uint8)[edges[0] : edges[-1]] if body is not None and edges[-1] > edges[0] else np.zeros(0, np.uint8)
        self.edges = edges - edges[0]
        size = len(self.data)
        kind = kinds[self.data]
        inside = kind == WORD
        cut = np.zeros(size + 1, bool)
        cut[self.edges] = True
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1] | cut[1:size]
        last[:-1] &= ~inside[1:] | cut[1:size]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.text = np.searchsorted(self.edges, self.start, side="right") - 1
        ends = np.cumsum(kind == END)[self.start] if size else self.start
        new = (np.diff(ends) != 0) | (np.diff(self.text) != 0)
        self.piece = np.concatenate([np.zeros(min(len(ends), 1), np.int64), np.cumsum(new)])
        # The first word of each text.
        self.first = np.searchsorted(self.text, np.arange(len(texts) + 1))

    def __len__(self) -> int:
        return len(self.start)
