"""Many texts as one flat array: slices of bounded size, spans and their hashes.

The helpers work on Arrow batches inside tasks. A slice holds whole rows, a few
megabytes of text, so what a task keeps does not depend on the partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 8 << 20
_WINDOW = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_MIX = np.uint64(0xBF58476D1CE4E5B9)

_BYTE_VALUES = np.random.default_rng(20240917).integers(1, 2**63, 256, dtype=np.uint64)
_powers: list[np.ndarray] = []


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows whose ``column`` has about ``limit`` bytes each."""
    if not batch.num_rows:
        return
    ends = offsets_of(batch.column(column))[1:]
    block = ends // limit
    cuts = np.flatnonzero(np.diff(block)) + 1
    for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
        yield batch.slice(lo, hi - lo)


def offsets_of(column: pa.Array) -> np.ndarray:
    """Where each value starts and the last one ends, from 0."""
    column = column.cast(pa.large_string())
    raw = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
    return raw - raw[0]


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all values in a row, and the offsets of the values."""
    column = column.cast(pa.large_string())
    raw = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[raw[0] : raw[-1]], raw - raw[0]


def _grown_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, _WINDOW)
        with np.errstate(over="ignore"):
            steps = [np.full(size, x, np.uint64) for x in (_BASE, pow(_BASE, -1, 2**64))]
            for step in steps:
                step[0] = 1
            _powers[:] = [np.cumprod(step) for step in steps]
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * _MIX
    return h ^ (h >> np.uint64(29))


def hash_spans(values: np.ndarray, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``codes[start:end]``; ``values`` gives each code a random value.

    A polynomial from prefix sums, so the cost per code does not depend on the
    spans. Spans are sorted and disjoint; the sums run over windows of them.
    """
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        lo = starts[i]
        j = max(int(np.searchsorted(ends, lo + _WINDOW, "right")), i + 1)
        part = codes[lo : ends[j - 1]]
        power, inverse = _grown_powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(values[part] * power[: len(part)], out=sums[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64))
        i = j
    return out


def byte_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes that are ``inside``, none across two values."""
    flags = np.zeros(len(data) + 2, bool)
    flags[1:-1] = inside[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    here, before, after = flags[1:-1], flags[:-2], flags[2:]
    starts = np.flatnonzero(here & (~before | first[:-1]))
    ends = np.flatnonzero(here & (~after | first[1:])) + 1
    return starts, ends


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ALNUM = np.ones(256, bool)
_ALNUM[[*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False
_ALNUM[65:91] = True
_SOLID = np.ones(256, bool)
_SOLID[[0x20, *range(9, 14)]] = False


def word_hashes(column: pa.Array, solid: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, A-Z lower-cased, and how many each text has.

    A word is a run of ASCII letters, digits and non-ASCII characters; with
    ``solid``, of anything but white space (space and 0x09 to 0x0D).
    """
    data, offsets = bytes_of(column)
    starts, ends = byte_spans(data, offsets, _SOLID if solid else _ALNUM)
    hashes = hash_spans(_BYTE_VALUES[_LOWER], data, starts, ends)
    return hashes, np.diff(np.searchsorted(starts, offsets))


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ...`` with ``counts[i]`` values for each i."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)
