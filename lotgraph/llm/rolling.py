"""Vectorised polynomial hashes over concatenated UTF-8 texts (numpy, modulo 2**64)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
_tables: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE and its inverse to the powers 0 .. n-1, kept for the life of the worker."""
    if len(_tables.get("b", ())) < n:
        size = max(n, 1 << 16)
        for name, x in (("b", BASE), ("i", INVERSE)):
            t = np.full(size, x, np.uint64)
            t[0] = 1
            np.cumprod(t, out=t)
            _tables[name] = t
    return _tables["b"][:n], _tables["i"][:n]


def prefix(data: np.ndarray) -> np.ndarray:
    """p[i] = sum over j < i of (data[j] + 1) * BASE**j."""
    p = np.zeros(len(data) + 1, np.uint64)
    if len(data):
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data))[0], out=p[1:])
    return p


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads all bits."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(32)
    return h


def spans(p: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end], independent of where they stand."""
    return mix((p[end] - p[start]) * powers(len(p))[1][start])


def chunks(column: pa.Array, target: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, bytes, offsets) of consecutive texts of about ``target`` bytes together; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type == pa.large_string() or column.type == pa.large_binary():
        kind = np.int64
    else:
        kind = np.int32
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
        yield from chunks(column, target)
        return
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + target, "right")) - 1)
        b = min(b, n)
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b
