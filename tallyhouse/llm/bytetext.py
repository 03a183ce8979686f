"""Vectorised work on the UTF-8 bytes of an Arrow batch of texts: word bounds and 64-bit word hashes.

A batch is cut into runs of whole texts of about a quarter of a megabyte, so memory follows the run and the longest text, never the
partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

RUN_BYTES, BLOCK_ROWS = 1 << 18, 1024
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: A random value per byte, with A-Z falling on a-z.
BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64))
BYTE_VALUE[65:91] = BYTE_VALUE[97:123]

#: Bytes that separate words: space and \t \n \v \f \r.
SPACES = np.zeros(256, bool)
SPACES[[0x20, 9, 10, 11, 12, 13]] = True


class Run(NamedTuple):
    """Some whole texts: row numbers first..last of the batch, their bytes and the offsets of each."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    """Words of a run: byte bounds, a 64-bit hash each, and the index of each text's first word (one more at the end)."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def runs(texts: pa.Array, run_bytes: int = RUN_BYTES) -> Iterator[Run]:
    """Runs of whole texts; a null text counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    for k in range(0, len(texts), BLOCK_ROWS):  # what is copied to fill nulls is a block, not the batch
        yield from _block_runs(texts.slice(k, BLOCK_ROWS).cast(pa.large_string()).fill_null(""), k, run_bytes)


def _block_runs(texts: pa.Array, row: int, run_bytes: int) -> Iterator[Run]:
    n = len(texts)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + run_bytes, "right")) - 1
        last = min(n, max(last, first + 1))
        yield Run(row + first, row + last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the multiplier and of its inverse; kept for runs of the usual size."""
    if len(_POWERS[0]) >= n:
        return _POWERS
    out = []
    for base in (MULTIPLIER, INVERSE):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    if n <= 2 * RUN_BYTES:
        _POWERS[:] = out
    return out


class RollingHash:
    """Hashes of any byte span of a run in constant time."""

    def __init__(self, run: Run, values: np.ndarray = BYTE_VALUE):
        n = len(run.data)
        self.powers, self.inverses = _powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values[run.data] * self.powers[:n], out=self.sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.inverses[starts]
        return mix(raw + (ends - starts).astype(np.uint64))


def words(run: Run, separators: np.ndarray = SPACES) -> Words:
    """Words as maximal spans of bytes that are no separators, within each text."""
    inside = ~separators[run.data]
    n = len(inside)
    edge = np.zeros(n + 1, bool)
    edge[run.offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    hashes = RollingHash(run).spans(starts, ends)
    return Words(starts, ends, hashes, np.searchsorted(starts, run.offsets))


def _coefficients(size: int) -> np.ndarray:
    return mix(np.arange(1001, 1001 + size, dtype=np.uint64)) | np.uint64(1)


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of each run of ``size`` words; a text of fewer words, but not none, has its whole sequence."""
    counts = np.diff(w.first)
    total = len(w.hashes)
    out = np.full(max(total - size + 1, 0), np.uint64(size), np.uint64)
    for j, c in enumerate(_coefficients(size)):
        out += w.hashes[j : j + len(out)] * c
    text = w.text_of()
    keep = text[: len(out)] == text[size - 1 :] if total >= size else np.zeros(0, bool)
    owners, hashes = text[: len(out)][keep], mix(out[keep])
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        value = counts[short].astype(np.uint64)
        for j, c in enumerate(_coefficients(size)[: size - 1]):
            has = counts[short] > j
            value[has] += w.hashes[w.first[short[has]] + j] * c
        owners = np.concatenate([owners, short])
        hashes = np.concatenate([hashes, mix(value)])
    return owners, hashes
