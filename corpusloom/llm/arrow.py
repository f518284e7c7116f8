"""Reading text columns of Arrow batches as bytes, in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string or binary column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n, at = len(column), column.offset
    _, off, data = column.buffers()
    if not n:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    off = np.frombuffer(off, np.int64 if wide else np.int32)[at : at + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return off, data


def pieces(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts have at most ``most`` bytes together; a longer text stands alone."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1
        end = min(n, max(end, row + 1))
        yield row, end
        row = end


def rows_of(batch: pa.RecordBatch, most: int, column: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with the offsets and bytes of one text column."""
    off, data = column_bytes(batch.column(batch.schema.get_field_index(column)))
    for a, b in pieces(off, most):
        yield batch.slice(a, b - a), off[a : b + 1] - off[a], data[off[a] : off[b]]
