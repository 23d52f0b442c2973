"""Numpy helpers on Arrow text columns: raw bytes, word spans, span hashes.

They run inside ``mapInArrow`` tasks. Every helper looks at whole texts; ``slices`` only cuts
a batch between rows, so that the temporary arrays stay small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)                   # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE**i and _BASE**-i for i < n (at least), modulo 2**64. Only the tables for a slice's length are kept by the
    worker; those for a longer text go with it."""
    def powers(base: np.uint64, size: int) -> np.ndarray:
        t = np.full(size, base, dtype=np.uint64)
        t[0] = 1
        return np.cumprod(t, dtype=np.uint64)

    if n > SLICE_BYTES + 1:
        return powers(_BASE, n), powers(_INVERSE, n)
    if not _powers:
        _powers.update(up=powers(_BASE, SLICE_BYTES + 1), down=powers(_INVERSE, SLICE_BYTES + 1))
    return _powers["up"], _powers["down"]


def whitespace() -> np.ndarray:
    """Separator table of the words ``[^\\x20\\x09-\\x0D]+``."""
    t = np.zeros(256, dtype=bool)
    t[[0x20, *range(0x09, 0x0E)]] = True
    return t


def non_alnum() -> np.ndarray:
    """Separator table of words made of ASCII letters, digits and all non-ASCII bytes."""
    t = np.ones(256, dtype=bool)
    t[0x80:] = False
    for lo, hi in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
        t[lo:hi + 1] = False
    return t


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all rows, offsets of each row); a null text counts as an empty one."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, dtype=np.int64 if wide else np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut between rows into runs of at most ``max_bytes`` of ``column`` (or one row)."""
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        _, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
        start = 0
        while start < n:
            stop = int(np.searchsorted(offsets, offsets[start] + max_bytes, side="right")) - 1
            stop = min(max(stop, start + 1), n)
            yield batch.slice(start, stop - start)
            start = stop


def lower_ascii(data: np.ndarray) -> np.ndarray:
    upper = (data >= 0x41) & (data <= 0x5A)
    return data + (upper * np.uint8(0x20))


def word_spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray):
    """(start, end, row) of every maximal run of non-separator bytes inside a row."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    word = ~separators[data]
    before = np.empty_like(word)
    before[0] = False
    before[1:] = word[:-1]
    heads = offsets[:-1]
    before[heads[heads < len(data)]] = False
    starts = np.flatnonzero(word & ~before)
    after = np.empty_like(word)
    after[-1] = False
    after[:-1] = word[1:]
    tails = offsets[1:] - 1
    after[tails[tails >= 0]] = False
    ends = np.flatnonzero(word & ~after) + 1
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, rows


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums over ``data``; ``span_hashes`` takes any span's hash from them."""
    up, _ = power_table(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; equal spans have equal hashes wherever they stand."""
    _, down = power_table(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])


def row_counts(rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, minlength=n).astype(np.int64)


def keyed(h: np.ndarray, key: int) -> np.ndarray:
    return mix(h ^ np.uint64(key & 0xFFFFFFFFFFFFFFFF))
