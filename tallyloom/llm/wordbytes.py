"""Words and their hashes over the bytes of many texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes worked on at once; a longer text is worked on alone.
SLICE = 2_000_000

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
_BASE, _STEP = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03  # odd, so they have inverses modulo 2**64


def _byte_values(lower: bool) -> np.ndarray:
    values = np.random.default_rng(20_11).integers(1, 2**64, 256, dtype=np.uint64)
    if lower:
        values[65:91] = values[97:123]
    return values


EXACT, LOWER = _byte_values(False), _byte_values(True)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n - 1) modulo 2**64, kept between calls."""
    if base not in _powers or len(_powers[base]) < n:
        steps = np.full(max(n, SLICE + 65_536), base, np.uint64)
        steps[0] = 1
        _powers[base] = np.multiply.accumulate(steps)
    return _powers[base][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class Rolling:
    """Hashes of stretches of a sequence from prefix sums: each costs the same, however long."""

    def __init__(self, values: np.ndarray, base: int):
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * powers(base, len(values)), out=self.sums[1:])
        self.back = powers(pow(base, -1, 2**64), len(values) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


class Slice:
    """Some texts laid end to end, a line break after each, and their words."""

    def __init__(self, texts: list[bytes], values: np.ndarray = EXACT):
        self.n = len(texts)
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, self.n)
        self.ends = np.cumsum(lengths + 1)  # one past the line break
        self.begins = self.ends - lengths - 1
        white = WHITE[self.data]
        edge = np.diff(white.view(np.int8), prepend=np.int8(1))
        self.start, self.end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)  # ends in a line break, so as many ends
        self.first = np.searchsorted(self.start, self.begins)  # first word of each text, and one past the last
        self.first = np.append(self.first, len(self.start))
        self.n_words = np.diff(self.first)
        self.bytes = Rolling(values[self.data], _BASE)

    def hashes(self) -> np.ndarray:
        """A hash for each word."""
        return self.bytes.of(self.start, self.end)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), self.n_words)


def windows(words: np.ndarray) -> Rolling:
    return Rolling(words, _STEP)


def binary(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The UTF-8 bytes of each text, null as empty."""
    return pc.fill_null(column.cast(pa.large_binary()), b"").to_pylist()


def slices(texts: list[bytes], most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold up to ``most`` bytes, or one text."""
    low, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > most:
            yield low, i
            low, held = i, 0
        held += len(t) + 1
    if low < len(texts):
        yield low, len(texts)
