"""Text columns of Arrow batches as numpy arrays, without a Python object per text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Byte classes of UTF-8.
BYTES = np.arange(256, dtype=np.uint8)
IS_LETTER = ((BYTES | 32) >= 97) & ((BYTES | 32) <= 122)
LOWER = np.where((BYTES >= 65) & (BYTES <= 90), BYTES + 32, BYTES).astype(np.uint8)


def views(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column (no nulls) as one array, and where each text starts (one more at the end)."""
    _, at, data = column.buffers()
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.dtype(np.int64 if large else np.int32)
    starts = np.frombuffer(at, dtype=kind, count=len(column) + 1, offset=kind.itemsize * column.offset).astype(np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return whole[starts[0] : starts[-1]], starts - starts[0]


def strings(pieces: list[bytes]) -> pa.Array:
    return pa.array(pieces, type=pa.binary()).cast(pa.string())
