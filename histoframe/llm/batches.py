"""Arrow batches cut to a bounded number of text bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text a Python worker takes at once (one longer text goes alone).
STEP_BYTES = 4 << 20


def steps(batches: Iterator[pa.RecordBatch], column: str, step_bytes: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches' rows in order, in slices of about ``step_bytes`` of a text column."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + step_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
