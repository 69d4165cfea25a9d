"""Arrow batches in smaller parts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

ROWS = 512


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that a worker holds few Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
