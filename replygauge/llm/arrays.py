"""Whole texts as numpy arrays: bytes of an Arrow column, tokens and their 64-bit hashes.

Everything works on one slice of a batch at a time, so that memory follows the
slice (or the one text that is longer) and never the partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {_BASE: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}

#: Bytes 9 to 13 and 32 part words.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def powers(base: int, size: int) -> np.ndarray:
    """base to the power 0, 1, ... modulo 2 to the 64; a worker keeps those of a usual slice only."""
    found = _powers[base]
    if len(found) < size:
        found = np.full(max(size, SLICE_BYTES + 1), base, np.uint64)
        found[0] = 1
        np.cumprod(found, out=found)
        if len(found) == SLICE_BYTES + 1:
            _powers[base] = found
    return found[:size]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a fixed bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``most`` bytes of text."""
    if not batch.num_rows:
        return
    ends = np.cumsum(_lengths(batch[column]))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def _lengths(texts: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one after the other, and the bounds of each (null: empty)."""
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(_lengths(texts), out=bounds[1:])
    if texts.null_count:
        return np.frombuffer(b"".join(x or b"" for x in texts.cast(pa.binary()).to_pylist()), np.uint8), bounds
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if data is None:
        return np.zeros(0, np.uint8), bounds
    first = int(np.frombuffer(offsets, kind, 1, texts.offset * np.dtype(kind).itemsize)[0])
    return np.frombuffer(data, np.uint8, int(bounds[-1]), first), bounds


def runs(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of True; a run never crosses a bound."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.zeros(len(inside) + 1, bool)
    first[bounds] = True
    before = np.empty(len(inside), bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.empty(len(inside), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    return starts, np.flatnonzero(inside & (~after | first[1:])) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; it depends on the span's content alone."""
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(data)), out=prefix[1:])
    raw = (prefix[ends] - prefix[starts]) * powers(_INVERSE, len(data) + 1)[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def words(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words between white space, and the bounds of each text's words."""
    data, bounds = text_bytes(texts)
    if lower:
        data = LOWER[data]
    starts, ends = runs(~SPACE[data], bounds)
    return span_hashes(data, starts, ends), np.searchsorted(starts, bounds)


_ORDER = [np.uint64(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3,
                                 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x2F1B9D4C5E7A8B63, 0x94D8C2B7F0A3E591)]


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of the n values from each position on (the last n - 1 positions have none)."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    total = np.full(len(hashes) - n + 1, n, np.uint64)
    for i in range(n):
        total += hashes[i : len(hashes) - n + 1 + i] * _ORDER[i]
    return mix(total)
