"""Arrow batches in pieces of bounded size, for tasks that turn them into Python values."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are Python values at a time.
SLICE_BYTES = 1_000_000


def slices(batch: pa.RecordBatch, column: int | str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batch`` in order, in pieces of at most ``size`` bytes of a text column, or one row each."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends = np.cumsum(lengths.to_numpy(zero_copy_only=False), dtype=np.int64)
    begin = 0
    while begin < batch.num_rows:
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end
