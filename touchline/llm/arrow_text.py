"""Arrow text columns as byte buffers, for work that runs over bytes with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Text handled at a time inside a task; a single longer text is handled alone.
PIECE_BYTES = 1 << 20


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its row offsets; NULL counts as empty."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def pieces(batch: pa.RecordBatch, text: str, size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with about ``size`` bytes of text each."""
    if not batch.num_rows:
        return
    _, offsets = text_bytes(batch.column(batch.schema.get_field_index(text)))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of all rows: starts, ends, and the first word of every row.

    The third array has one entry more than there are rows. A word never
    crosses rows, and none of the six separators is part of a longer UTF-8 code.
    """
    inside = np.ones(len(data) + 1, bool)
    inside[:-1] = (data != 0x20) & ((data < 0x09) | (data > 0x0D))
    inside[-1] = False
    before = np.empty(len(data) + 1, bool)
    before[0] = False
    before[1:] = inside[:-1]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & (~before | edge))
    ends = np.flatnonzero(before & (~inside | edge))
    return starts, ends, np.searchsorted(starts, offsets)
