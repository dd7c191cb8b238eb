"""Texts of an Arrow column as flat byte arrays, and their words as Arrow
arrays, without a Python object per word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column in one array, and where each
    value begins (and the end). Nulls are empty."""
    a = pc.fill_null(column.cast(pa.large_binary()), b"")
    at = np.frombuffer(a.buffers()[1], np.int64)[a.offset:a.offset + len(a) + 1] if len(a) else np.zeros(1, np.int64)
    data = np.frombuffer(a.buffers()[2] or b"", np.uint8)[at[0]:at[-1]]
    return data, at - at[0]


def cut(data: np.ndarray, at: np.ndarray) -> pa.Array:
    """The values that lie between the (sorted) positions ``at``, over the same bytes."""
    return pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(np.ascontiguousarray(at, np.int64)), pa.py_buffer(data)])


def owners(at: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Which value each byte position belongs to."""
    return np.searchsorted(at, positions, side="right") - 1


def runs(data: np.ndarray, at: np.ndarray, inside: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The maximal runs of the bytes marked in the table ``inside`` (256
    booleans), none across two values: (runs, value of each)."""
    if not len(data):
        return pa.array([], pa.large_binary()), np.zeros(0, np.int64)
    within = inside[data]
    mark = np.zeros(len(data) + 1, bool)
    mark[1:-1] = within[1:] != within[:-1]
    mark[at] = True
    edge = np.flatnonzero(mark)
    is_run = within[edge[:-1]]
    return cut(data, edge).filter(pa.array(is_run)), owners(at, edge[:-1][is_run])
