"""Arrow batches inside tasks: text columns as bytes, batches in pieces of bounded size, groups in sorted streams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def raw_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column without a copy of the text; a null is an empty text."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    content = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bounds - bounds[0], content[bounds[0] : bounds[-1]]


def pieces(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts have ``most`` bytes together, or one longer row."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        end = int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1
        end = min(max(end, start + 1), rows)
        yield start, end
        start = end


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every row; a null is an empty text."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables that hold whole groups only, from a stream sorted by ``keys``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, bool)
        for key in keys:
            values = batch.column(key).to_numpy(zero_copy_only=False)
            new[1:] |= values[1:] != values[:-1]
            if held:
                new[0] |= values[0] != held[-1].column(key)[held[-1].num_rows - 1].as_py()
        starts = np.flatnonzero(new)
        if not len(starts):
            held.append(batch)
            continue
        last = int(starts[-1])
        whole = held + ([batch.slice(0, last)] if last else [])
        if whole:
            yield pa.Table.from_batches(whole)
        held = [batch.slice(last)]
    if held:
        yield pa.Table.from_batches(held)
