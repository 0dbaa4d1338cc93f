"""Hashes of many spans of UTF-8 text in numpy, straight from Arrow buffers: no Python object for a span."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .wordhash import MULT, _powers

#: Bytes with A-Z in lower case.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


@lru_cache(1)
def _values() -> np.ndarray:
    return LOWER.astype(np.uint64) + np.uint64(1)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets) of a string column; nulls are empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    at = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[-1]] if at[-1] > at[0] else np.zeros(0, np.uint8)
    return data, at - at[0]


def hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """64-bit hash of each span ``data[first:last]`` with A-Z in lower case; equal bytes have equal hashes wherever they stand."""
    power, inverse = _powers(1 << max(16, int(len(data)).bit_length()))
    run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_values()[data] * power[: len(data)], dtype=np.uint64)])
    h = (run[last] - run[first]) * inverse[first] + (last - first).astype(np.uint64) * np.uint64(MULT)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h
