"""Small helpers for functions that run over Arrow batches in Python workers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def lists(rows: list, kind=pa.int32(), dtype=np.int32) -> pa.Array:
    """A list column from Python lists, built from one flat buffer."""
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    flat = np.fromiter((x for r in rows for x in r), dtype, count=int(offsets[-1]))
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def small_batches(batches, text_col: str, max_bytes: int = 16 << 20):
    """The same rows in batches whose text column holds about ``max_bytes`` at most (one row at least)."""
    for batch in batches:
        n = batch.num_rows
        if n <= 1 or batch.column(text_col).nbytes <= max_bytes:
            yield batch
            continue
        parts = min(n, -(-batch.column(text_col).nbytes // max_bytes))
        step = -(-n // parts)
        for at in range(0, n, step):
            yield batch.slice(at, step)
