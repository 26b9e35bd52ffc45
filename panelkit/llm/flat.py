"""The texts of an Arrow batch as one byte array, and words, lines and hashes on it.

Nothing here loops over words or characters. A batch's UTF-8 bytes stay where Arrow has
them; a text is a pair of offsets, a word or line a pair of positions. Working memory is a
few bytes per byte of text plus a fixed amount per block.
"""

from __future__ import annotations

import ctypes
import functools
import os

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20

_MULTIPLIER = 0x9E3779B97F4A7C15
_U64 = np.uint64

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

NEWLINE = np.zeros(256, bool)
NEWLINE[0x0A] = True


def flatten(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; NULL is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20):
    """A batch in pieces of about ``limit`` bytes of ``column``; one longer text stays whole."""
    _, offsets = flatten(batch.column(batch.schema.get_field_index(column)))
    at, n = 0, batch.num_rows
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        end = min(n, max(end, at + 1))
        yield batch.slice(at, end - at)
        at = end
    give_back()


def give_back() -> None:
    """Free memory that Arrow and the C library keep goes back to the machine, where they can do so.

    A worker serves many tasks and shares its executor's memory with the JVM.
    """
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


@functools.cache
def _trim():
    return getattr(ctypes.CDLL(None), "malloc_trim", None) if os.name == "posix" else None


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    h = h ^ (h >> _U64(33))
    h = h * _U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> _U64(33))
    h = h * _U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U64(33))


@functools.cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, modulo 2**64."""
    out = []
    for base in (_MULTIPLIER, pow(_MULTIPLIER, -1, 1 << 64)):
        p = np.full(BLOCK + 1, base, _U64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def spans(
    data: np.ndarray, offsets: np.ndarray, separator: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each longest run without separators, per text."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~separator[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = np.zeros(n + 1, bool)  # at the position after a run
    last[1:] = inside
    last[:-1] &= ~inside
    cuts = offsets[(offsets > 0) & (offsets < n)]
    first[cuts] |= inside[cuts]
    last[cuts] |= inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes; runs are in ascending order."""
    power, inverse = _powers()
    out = np.empty(len(starts), _U64)
    at = 0
    while at < len(starts):
        low = starts[at]
        if ends[at] - low > BLOCK:  # one long run, piece by piece
            h, scale = np.zeros(1, _U64), np.ones(1, _U64)
            for p in range(low, ends[at], BLOCK):
                piece = data[p : min(p + BLOCK, ends[at])].astype(_U64) + _U64(1)
                h += (piece * power[: len(piece)]).sum(dtype=_U64) * scale
                scale *= power[BLOCK]
            out[at], end = h[0], at + 1
        else:
            end = int(np.searchsorted(ends, low + BLOCK, "right"))
            piece = data[low : ends[end - 1]].astype(_U64)
            piece += _U64(1)
            piece *= power[: len(piece)]
            sums = np.zeros(len(piece) + 1, _U64)
            np.cumsum(piece, out=sums[1:])
            s, e = starts[at:end] - low, ends[at:end] - low
            out[at:end] = (sums[e] - sums[s]) * inverse[s]
        at = end
    return mix(out ^ (ends - starts).astype(_U64))


def counts_between(mask: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """How many of ``mask`` are set before each of the ascending positions."""
    out = np.empty(len(positions), np.int64)
    total, at = 0, 0
    for low in range(0, len(mask) + 1, BLOCK):
        piece = mask[low : low + BLOCK]
        end = int(np.searchsorted(positions, low + BLOCK, "left"))
        if low + BLOCK > len(mask):
            end = len(positions)
        sums = np.zeros(len(piece) + 1, np.int64)
        np.cumsum(piece, out=sums[1:])
        out[at:end] = total + sums[positions[at:end] - low]
        total, at = total + sums[-1], end
    return out


def per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many bytes of each text are set in ``mask``."""
    return np.diff(counts_between(mask, offsets))


def code_point_starts(data: np.ndarray) -> np.ndarray:
    return (data & 0xC0) != 0x80


def windows(hashes: np.ndarray, docs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash per k consecutive words of one text, and the number of its first word."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, _U64), np.zeros(0, np.int64)
    h = hashes[:n].copy()
    for i in range(1, k):
        h *= _U64(_MULTIPLIER)
        h ^= h >> _U64(29)
        h += hashes[i : i + n]
    whole = np.flatnonzero(docs[:n] == docs[k - 1 :])
    return mix(h[whole]), whole
