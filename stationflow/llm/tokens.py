"""Words of many texts at once, as numpy arrays of positions and hashes.

Words are runs of bytes other than blank, tab, line feed, vertical tab, form feed
and carriage return. Texts are handled in slices of a few megabytes, so memory
does not follow the batch; a longer text is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20

_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Keeps the first n bytes of eight.
_MASK = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
_SEED = np.uint64(0xD1B54A32D192ED03)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """The words of a slice. Document d has words ``first[d]:first[d + 1]``."""

    rows: range  # of the batch
    data: np.ndarray  # bytes of the slice
    texts: np.ndarray  # where each text begins; one more entry than texts
    starts: np.ndarray  # where each word begins in ``data``
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows)), self.counts)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a binary array without nulls."""
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    places = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return places, np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[range, np.ndarray, np.ndarray]]:
    """(rows, offsets from the slice's begin, bytes) of at most ``most`` bytes, or of one text."""
    places, data = buffers(texts)
    at, n = 0, len(places) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(places, places[at] + most, "right")) - 1)
        to = min(to, n)
        yield range(at, to), places[at : to + 1] - places[at], data[places[at] : places[to]]
        at = to
    pa.default_memory_pool().release_unused()  # workers live on through later stages


def words(texts: pa.Array, lower: bool = False, hashed: bool = True, most: int = SLICE_BYTES) -> Iterator[Words]:
    """The words of every text, slice by slice."""
    for rows, places, data in slices(texts, most):
        if lower:
            data = _LOWER[data]
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = _IS_WORD[data]
        cut = np.zeros(len(data) + 1, bool)  # a text begins here
        cut[places] = True
        starts = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
        ends = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
        first = np.searchsorted(starts, places)
        yield Words(rows, data, places, starts, ends, first, byte_hashes(data, starts, ends) if hashed else starts)


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Each word's bytes, eight at a time, mixed into a value that begins with its length."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    lengths = ends - starts
    out = mix(lengths.astype(np.uint64) * _STEP + _SEED)
    left, at, which = lengths, starts, slice(None)
    while len(at):
        block = eights[at] & _MASK[np.minimum(left, 8)]
        out[which] = mix(out[which] * _STEP ^ block)
        more = np.flatnonzero(left > 8)
        which = more if isinstance(which, slice) else which[more]
        at, left = at[more] + 8, left[more] - 8
    return out


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each word on; the last ``k - 1`` entries are missing."""
    if len(hashes) < k:
        return np.zeros(0, np.uint64)
    doubled, size, power = hashes, 1, _STEP
    out, done = None, 0
    with np.errstate(over="ignore"):
        while True:
            if k & size:
                if out is None:
                    out, done = doubled, size
                else:
                    n = min(len(out), len(doubled) - done)
                    out = out[:n] * power + doubled[done : done + n]
                    done += size
            if size * 2 > k:
                break
            doubled = doubled[:-size] * power + doubled[size:]
            size, power = size * 2, power * power
    return mix(out[: len(hashes) - k + 1] + np.uint64(k))


def inside_documents(w: Words, k: int) -> np.ndarray:
    """For each shingle of ``k`` words, whether it lies in one document."""
    n = len(w.starts) - k + 1
    if n <= 0:
        return np.zeros(0, bool)
    last = np.repeat(w.first[1:], w.counts)[:n]
    return np.arange(n) + k <= last
