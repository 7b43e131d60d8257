"""Words of many texts at once, as numpy arrays over the bytes of an Arrow column. Used inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are worked on in groups of about so many bytes, which bounds memory; one longer text is a group of its own.
GROUP_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Spans:
    """64-bit hashes of values[start:end] for many spans: differences of a running polynomial, shifted to one power."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        powers = np.full(n + 1, _BASE, np.uint64)
        self.back = np.full(n + 1, _INVERSE, np.uint64)
        powers[0] = self.back[0] = 1
        np.multiply.accumulate(powers, out=powers)
        np.multiply.accumulate(self.back, out=self.back)
        self.running = np.zeros(n + 1, np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers[:n], out=self.running[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.running[end] - self.running[start]) * self.back[start] + (end - start).astype(np.uint64))


def spans_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return Spans(values).hash(start, end)


def groups(column: pa.Array, most: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes of text each."""
    size = np.diff(_offsets(column))
    first, held = 0, 0
    for i, n in enumerate(size):
        if i > first and held + n > most:
            yield first, i
            first, held = i, 0
        held += n
    if first < len(size):
        yield first, len(size)


def _offsets(column: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    return np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)


class Texts:
    """Bytes of a few texts in one array; text i is data[bounds[i]:bounds[i + 1]]. Nulls must be replaced before."""

    def __init__(self, column: pa.Array):
        bounds = _offsets(column)
        held = column.buffers()[2]
        data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
        self.data = data[bounds[0] : bounds[-1]]
        self.bounds = bounds - bounds[0]
        self.n = len(bounds) - 1

    def text_of(self, at: np.ndarray) -> np.ndarray:
        """The text that holds each byte position."""
        return np.searchsorted(self.bounds, at, "right") - 1

    def per_text(self, text: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(text, weights, self.n)

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each maximal run of marked bytes within one text."""
        edge = np.zeros(len(inside) + 1, bool)
        edge[self.bounds] = True
        before = np.concatenate([[False], inside[:-1]]) if len(inside) else inside
        after = np.concatenate([inside[1:], [False]]) if len(inside) else inside
        return (
            np.flatnonzero(inside & (~before | edge[:-1])),
            np.flatnonzero(inside & (~after | edge[1:])) + 1,
        )


class Words(Texts):
    """Words are runs of anything but the six ASCII blanks: start, end (bytes), text (index of the text), n_words."""

    def __init__(self, column: pa.Array):
        super().__init__(column)
        self.start, self.end = self.runs(~_SPACE[self.data])
        self.text = self.text_of(self.start)
        self.n_words = np.bincount(self.text, minlength=self.n)
        self.first = np.concatenate([[0], np.cumsum(self.n_words)])

    def hashes(self) -> np.ndarray:
        return spans_hash(self.data, self.start, self.end)

    def grams(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each k consecutive words of one text, and the index of the first of them."""
        at = np.flatnonzero(self.text[: len(self.text) - k + 1] == self.text[k - 1 :]) if len(self.text) >= k else np.zeros(0, np.int64)
        return spans_hash(hashes, at, at + k), at


def repeated(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs more than once."""
    _, which, count = np.unique(keys, return_inverse=True, return_counts=True)
    return count[which] > 1


def later_repeats(keys: np.ndarray) -> np.ndarray:
    """Whether each key has occurred before."""
    later = np.ones(len(keys), bool)
    later[np.unique(keys, return_index=True)[1]] = False
    return later


def covered(n: int, starts: np.ndarray, k: int) -> np.ndarray:
    """Which of n places lie in one of the spans of length k that begin at ``starts``."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + k, -1)
    return np.cumsum(change[:-1]) > 0
