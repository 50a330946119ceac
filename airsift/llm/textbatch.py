"""Words, windows and fingerprints of many texts at once, as numpy arrays over the UTF-8 bytes of a chunk.

A chunk is some consecutive rows of an Arrow batch, about ``CHUNK_BYTES`` of text or one longer text. Everything
works on whole texts; null texts are empty. Fingerprints are 64-bit: random values of bytes are summed with powers
of an odd base (so that any substring's value comes from two prefix sums) and mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_IN_WORD = ~_SPACE
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_DRAWN = np.random.Generator(np.random.PCG64(20240607))


def _odd(count: int) -> np.ndarray:
    return _DRAWN.integers(0, 2**64, count, dtype=np.uint64) | np.uint64(1)


class Prefixes:
    """Prefix sums of one random function of bytes, with growing tables of powers."""

    def __init__(self, values: np.ndarray, base: int):
        self.values, self.base = values, base
        self.inverse = pow(base, -1, 2**64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def _reach(self, length: int) -> None:
        if len(self.up) <= length:
            size = max(2 * len(self.up), length + 1)
            for name, factor in (("up", self.base), ("down", self.inverse)):
                powers = np.full(size, factor, dtype=np.uint64)
                powers[0] = 1
                setattr(self, name, np.cumprod(powers, dtype=np.uint64))

    def sums(self, data: np.ndarray) -> np.ndarray:
        """At i: the sum over the bytes before i."""
        return self.sums_of(self.values[data])

    def sums_of(self, values: np.ndarray) -> np.ndarray:
        """The same over random values that stand for other symbols than bytes."""
        self._reach(len(values))
        out = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * self.up[: len(values)], out=out[1:])
        return out

    def between(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A value of each substring that does not depend on where it starts."""
        return (sums[ends] - sums[starts]) * self.down[starts]


FIRST = Prefixes(_odd(256), 0x9E3779B97F4A7C15)
SECOND = Prefixes(_odd(256), 0xC2B2AE3D27D4EB4F)
_PLACES = _odd(64)
_OTHER_PLACES = _odd(64)


def mix(values: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit values that spreads every bit."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class Chunk:
    """Rows first to last (exclusive) of a batch, their text as bytes and the bounds of each text."""

    def __init__(self, rows: pa.RecordBatch, data: np.ndarray, bounds: np.ndarray):
        self.rows, self.data, self.bounds = rows, data, bounds
        self.texts = len(bounds) - 1

    def column(self, name: str) -> pa.Array:
        return self.rows.column(self.rows.schema.get_field_index(name))


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string())
        if texts.null_count:
            texts = texts.fill_null("")
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + size, side="right")) - 1)
            rows = batch.slice(first, last - first)
            yield Chunk(rows, data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first])
            first = last


class Words:
    """The words (runs without ASCII white space) of a chunk: bounds in bytes, and the word range of each text."""

    def __init__(self, chunk: Chunk, lower: bool):
        self.data = _LOWER[chunk.data] if lower else chunk.data
        inside = _IN_WORD[self.data]
        edge = np.empty(len(inside) + 1, dtype=bool)
        edge[0], edge[-1] = True, True
        edge[1:-1] = inside[1:] != inside[:-1]
        edge[chunk.bounds] = True
        cuts = np.flatnonzero(edge)
        kept = inside[cuts[:-1]] if len(cuts) > 1 else np.zeros(0, dtype=bool)
        self.starts, self.ends = cuts[:-1][kept], cuts[1:][kept]
        self.ranges = np.searchsorted(self.starts, chunk.bounds)
        self.counts = np.diff(self.ranges)
        self.texts = chunk.texts

    def values(self) -> np.ndarray:
        """A fingerprint of each word."""
        return mix(FIRST.between(FIRST.sums(self.data), self.starts, self.ends) + (self.ends - self.starts).astype(np.uint64))

    def text_of_each(self) -> np.ndarray:
        return np.repeat(np.arange(self.texts), self.counts)


def windows(words: Words, values: np.ndarray, width: int, short_whole: bool, second: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Text and fingerprint of every run of ``width`` words; of a shorter text the whole sequence, if ``short_whole``."""
    places = _OTHER_PLACES if second else _PLACES
    total = len(values)
    texts, found = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    if total >= width:
        sums = np.zeros(total - width + 1, dtype=np.uint64)
        for place in range(width):
            sums += values[place : total - width + 1 + place] * places[place]
        owner = words.text_of_each()
        inside = owner[: total - width + 1] == owner[width - 1 :]
        texts, found = owner[: total - width + 1][inside], mix(sums[inside] + np.uint64(width))
    if short_whole:
        few = np.flatnonzero((words.counts > 0) & (words.counts < width))
        if len(few):
            whole = np.array(
                [(values[words.ranges[t] : words.ranges[t + 1]] * places[: words.counts[t]]).sum(dtype=np.uint64) + np.uint64(words.counts[t]) for t in few],
                dtype=np.uint64,
            )
            order = np.argsort(np.concatenate([texts, few]), kind="stable")
            texts, found = np.concatenate([texts, few])[order], np.concatenate([found, mix(whole)])[order]
    return texts, found


def distinct(texts: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, value) pairs, sorted by text, then value."""
    order = np.lexsort((values, texts))
    texts, values = texts[order], values[order]
    if len(texts):
        new = np.empty(len(texts), dtype=bool)
        new[0] = True
        new[1:] = (texts[1:] != texts[:-1]) | (values[1:] != values[:-1])
        texts, values = texts[new], values[new]
    return texts, values


def shingle_sets(chunk: Chunk, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The distinct lower-cased word shingles of each text: (bounds of each text's set, sorted values)."""
    words = Words(chunk, lower=True)
    texts, values = distinct(*windows(words, words.values(), width, short_whole=True))
    return np.searchsorted(texts, np.arange(chunk.texts + 1)), values


def as_signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def long_lists(bounds: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(as_signed(values)))
