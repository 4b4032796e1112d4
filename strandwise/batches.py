"""Arrow batches in smaller runs of rows, so that what Python makes of them is bounded by bytes and not by rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: UTF-8 bytes of text that Python works on at once.
BYTES = 1 << 20


def slices(batches: Iterator[pa.RecordBatch], size: int = BYTES) -> Iterator[pa.RecordBatch]:
    """All rows of batches in order, in runs whose strings have at most ``size`` bytes together; a longer row is a run of its own."""
    for batch in batches:
        ends = np.zeros(batch.num_rows, np.int64)
        for column in batch.columns:
            if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
                ends += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        ends, lo = np.cumsum(ends), 0
        while lo < batch.num_rows:
            past = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + size, side="right")))
            yield batch.slice(lo, past - lo)
            lo = past
